"""Embedding near-dedup and nearest neighbours against all pairs."""

from __future__ import annotations

import numpy as np

from folio.llm import op07_embeddings, op10_neighbours

SCHEMA = "vec_id long, embedding array<float>, label int, id long, v string, cell long"


def clustered(seed=4, n=900, dim=32):
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((n, dim))
    for c in range(12):
        for k in rng.choice(n, 12):
            x[k] = x[c] + rng.standard_normal(dim) * 0.12 * np.linalg.norm(x[c]) / np.sqrt(dim)
    x[100:140] = x[99] + rng.standard_normal((40, dim)) * 0.02
    return x.astype(np.float32)


def frame(spark, x, extra=()):
    rows = [(i, v.tolist(), 0, None, None, None) for i, v in enumerate(x)]
    return spark.createDataFrame(rows + [(1000 + k, v, 0, None, None, None) for k, v in enumerate(extra)], SCHEMA)


ODD = (None, [], [0.0] * 32, [1.0, None] + [0.0] * 30, [float("nan")] * 32, [float("inf")] + [0.0] * 31, [1.0, 2.0])


def cosines(x):
    u = x.astype(float)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    return u @ u.T


def test_links_and_components(spark):
    x = clustered()
    s = cosines(x) >= 0.95
    label = np.arange(len(x))
    while True:
        low = np.where(s, label[None, :], len(x)).min(axis=1)
        if (low == label).all():
            break
        label = low
    for block, small in ((4096, 64), (16, 3)):  # the second sends most cells through the blocks
        got = {r["id"]: r for r in op07_embeddings.near_vectors(frame(spark, x, ODD), block=block, small=small).collect()}
        assert len(got) == len(x) + len(ODD)
        assert [got[i]["n_links"] for i in range(len(x))] == (s.sum(axis=1) - 1).tolist()
        assert [got[i]["component_id"] for i in range(len(x))] == label.tolist()
        assert all(got[1000 + k]["n_links"] == 0 and got[1000 + k]["kept"] for k in range(len(ODD)))
    assert op07_embeddings.near_vectors(frame(spark, x).limit(0)).count() == 0


def test_needed_count_is_calibrated():
    rng = np.random.default_rng(0)
    c, (d, w) = op07_embeddings.needed(0.95), op07_embeddings.window(0.95)
    hits = (np.abs(rng.standard_normal((20000, op07_embeddings.PROJECTIONS)) * d) <= w).sum(axis=1)
    assert (hits >= c).mean() >= 0.998
    far = (np.abs(rng.standard_normal((20000, op07_embeddings.PROJECTIONS)) * 1.3) <= w).sum(axis=1)
    assert (far >= c).mean() < 0.01


def test_neighbours(spark):
    x = clustered(n=1500)
    s = cosines(x)
    np.fill_diagonal(s, -2)
    d = frame(spark, x, ODD)
    index = op10_neighbours.build_index(d, "vec_id", "embedding", rows_a_shard=500)
    assert index.count >= 3 and index.shards.count() >= 3
    out = op10_neighbours.nearest(index, d.where("vec_id % 20 = 0"), "vec_id", "embedding", part_rows=20).collect()
    got = {}
    for r in out:
        got.setdefault(r["query_id"], {})[r["rank"]] = (r["vec_id"], r["score"])
    queries = range(0, 1500, 20)
    assert set(got) >= set(queries) and all(sorted(got[q]) == [1, 2, 3, 4, 5] for q in queries)
    hits = sum(got[q][k + 1][0] in np.argsort(-s[q])[:5] for q in queries for k in range(5))
    assert hits >= 0.95 * 5 * len(queries)
    for q in queries:
        scores = [got[q][k][1] for k in range(1, 6)]
        assert scores == sorted(scores, reverse=True)
        v = got[q][1][0]
        assert abs(scores[0] - s[q, v]) < 1e-12 and v != q


def test_few_candidates(spark):
    d = frame(spark, clustered()[:3])
    out = op10_neighbours.nearest(op10_neighbours.build_index(d, "vec_id", "embedding"), d.where("vec_id = 0"), "vec_id", "embedding").collect()
    assert sorted(r["vec_id"] for r in out) == [1, 2]
    empty = d.limit(0)
    assert op10_neighbours.nearest(op10_neighbours.build_index(empty, "vec_id", "embedding"), d, "vec_id", "embedding").count() == 0


def exact(x, ids, q, k=5):
    """(id, score) of the k nearest of each query, ties to the smaller id."""
    u = x.astype(float) / np.abs(x).max(axis=1, keepdims=True)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    out = {}
    for i in q:
        s = u @ u[ids.index(i)]
        out[i] = sorted(((-round(float(c), 12), j) for c, j in zip(s, ids, strict=True) if j != i))[:k]
    return out


def test_neighbours_of_equal_vectors_and_ties(spark):
    rng = np.random.default_rng(9)
    x = rng.standard_normal((3000, 16))
    for g in range(20):
        x[100 * g + 7 : 100 * g + 60] = x[100 * g + 6]
    x[1000:2500] = x[999]  # half of all rows are one vector
    x[2600:2650] = x[2599] * np.array([2.0**k for k in range(50)])[:, None]
    d = frame(spark, x)
    index = op10_neighbours.build_index(d, "vec_id", "embedding", rows_a_shard=400)
    got = {}
    for r in op10_neighbours.nearest(index, d.where("vec_id % 20 = 0"), "vec_id", "embedding").collect():
        got.setdefault(r["query_id"], {})[r["rank"]] = (-round(r["score"], 12), r["vec_id"])
    want = exact(x, list(range(3000)), range(0, 3000, 20))
    assert set(got) == set(want) and all(sorted(got[q]) == [1, 2, 3, 4, 5] for q in want)
    assert np.mean([[got[q][k + 1][1] == want[q][k][1] for k in range(5)] for q in want]) >= 0.98
    assert all([got[q][k + 1] for k in range(5)] == want[q] for q in want if 1000 <= q < 2500)


def test_neighbours_with_any_finite_norm(spark):
    rows = [[1.0, 0.0, 1.0], [0.0, 1.0, 0.0], [1e-200, 0.0, 1e-200], [1e200, 1e199, 1e200], [1.0, 0.2, 1.0], [1e200, 0.0, -1e200], [5e-324, 0.0, 0.0], [1e308, -1e308, 1e308]]
    schema = "vec_id long, embedding array<double>"
    d = spark.createDataFrame(list(enumerate(rows)), schema)
    index = op10_neighbours.build_index(d, "vec_id", "embedding")
    got = {}
    for r in op10_neighbours.nearest(index, d, "vec_id", "embedding").orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((-round(r["score"], 12), r["vec_id"]))
    assert got == exact(np.array(rows), list(range(8)), range(8))
    # an id with several vectors counts once, a row without an id not at all
    twice = d.unionByName(d).unionByName(spark.createDataFrame([(1, [9.0, 9.0, 9.0]), (None, [1.0, 1.0, 1.0])], schema))
    again = op10_neighbours.nearest(op10_neighbours.build_index(twice, "vec_id", "embedding"), twice, "vec_id", "embedding").collect()
    assert sorted((r["query_id"], r["rank"], r["vec_id"]) for r in again) == sorted((q, k + 1, i) for q, best in got.items() for k, (_, i) in enumerate(best))


def test_graph_finds_near_copies():
    rng = np.random.default_rng(3)
    x = rng.standard_normal((4000, 32))
    x[1000:2500] = x[999] + rng.standard_normal((1500, 32)) * 0.01
    x = (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)
    g = op10_neighbours.build(x, np.arange(4000))
    q = np.arange(0, 4000, 25)
    s = x[q] @ x.T
    found = op10_neighbours.search(g, x, x[q])
    got = -np.sort(-np.where(found >= 0, np.take_along_axis(s, np.maximum(found, 0), axis=1), -9), axis=1)[:, :6]
    best = -np.sort(-s, axis=1)[:, :6]
    assert (got >= best - 1e-6).mean() >= 0.97


def test_shards_grow_with_the_table():
    assert [op10_neighbours.shard_rows(n) for n in (10, 10**6, 10**7, 10**9)] == [8192, 8192, 39063, 1 << 18]


def test_links_of_equal_vectors_and_of_any_norm(spark):
    rng = np.random.default_rng(8)
    x = rng.standard_normal((400, 16))
    x[100:240] = x[99]  # a third of the rows is one vector
    x[240:260] = x[99] + 0.01 * rng.standard_normal((20, 16))
    x[300] = x[301] * 1e-200
    x[302], x[303] = x[304] * 1e200, x[304] * 3e200
    schema = "vec_id long, embedding array<double>"
    d = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], schema)
    s = cosines(x / np.abs(x).max(axis=1, keepdims=True)) >= 0.95
    got = {r["id"]: r for r in op07_embeddings.near_vectors(d).collect()}
    assert [got[i]["n_links"] for i in range(400)] == (s.sum(axis=1) - 1).tolist()
    assert {got[i]["component_id"] for i in range(99, 260)} == {99} and got[301]["component_id"] == 300 and got[304]["component_id"] == 302
    # rows that repeat an id are one vector, a row without an id links with nothing
    again = op07_embeddings.near_vectors(d.unionByName(d).unionByName(spark.createDataFrame([(None, x[99].tolist())], schema))).collect()
    assert len(again) == 801 and all((r["n_links"], r["component_id"]) == (got[r["id"]]["n_links"], got[r["id"]]["component_id"]) for r in again if r["id"] is not None)
    assert [(r["n_links"], r["component_id"], r["kept"]) for r in again if r["id"] is None] == [(0, None, True)]
