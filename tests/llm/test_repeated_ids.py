"""Rows that repeat an id, larger k, long vectors and heavy blocks."""

import random

import numpy as np
import pytest

pytest.importorskip("folio.llm")

from folio.llm import op03_substrings as substrings  # noqa: E402
from folio.llm import op04_quality as quality  # noqa: E402
from folio.llm import op06_minhash as minhash  # noqa: E402
from folio.llm import op10_neighbours as neighbours  # noqa: E402


def prose(seed, n):
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdefghij") for _ in range(r.randint(2, 9))) for _ in range(n))


def test_texts_of_one_id_keep_their_passages(spark):
    a, b = prose(1, 300), prose(2, 300)
    df = spark.createDataFrame([(1, a), (1, b), (3, a), (4, b), (1, a)], "doc_id long, text string")
    spans = substrings.repeated_passages(df)
    got = {(r["id"], r["start"], r["end"]) for r in spans.collect()}
    assert got == {(1, 0, len(a)), (1, 0, len(b)), (3, 0, len(a)), (4, 0, len(b))}
    left = sorted((r["doc_id"], r["text"]) for r in substrings.without_copies(df, spans).collect())
    assert left == sorted([(1, a), (1, b), (1, a), (3, ""), (4, "")])


def test_texts_of_one_id_do_not_repeat_each_other(spark):
    a = prose(3, 100)
    df = spark.createDataFrame([(1, a), (1, a + " and more of it")], "doc_id long, text string")
    assert substrings.repeated_passages(df).count() == 0


def test_more_neighbours_than_twins_kept(spark):
    r = np.random.default_rng(0)
    same = r.normal(size=8)
    rows = [(k, same.tolist() if k < 30 else r.normal(size=8).tolist()) for k in range(80)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    index = neighbours.build_index(df, "vec_id", "embedding")
    with pytest.raises(ValueError, match="keep"):
        neighbours.nearest(index, df, "vec_id", "embedding", k=10)
    index = neighbours.build_index(df, "vec_id", "embedding", keep=11)
    got = neighbours.nearest(index, df.where("vec_id = 3"), "vec_id", "embedding", k=10).orderBy("rank").collect()
    assert [x["vec_id"] for x in got] == [0, 1, 2, 4, 5, 6, 7, 8, 9, 10]
    x = np.array([v for _, v in rows])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    cos = x @ x.T
    np.fill_diagonal(cos, -np.inf)
    hits = 0
    for row in neighbours.nearest(index, df, "vec_id", "embedding", k=10).collect():
        hits += row["score"] >= np.sort(cos[row["query_id"]])[-10] - 1e-12
    assert hits >= 0.98 * 800


def test_shards_are_bounded_by_bytes():
    assert neighbours.shard_rows(10**9, 64) == 1 << 18
    for dim in (768, 1024, 100_000):
        assert neighbours.shard_rows(10**9, dim) * dim * 8 <= neighbours.SHARD_BYTES


def test_sample_holds_an_id_once(spark, monkeypatch):
    good, bad = ["A clean line of words here.", "Another one stands there."], "x9 $$ !! x9"
    docs = spark.createDataFrame([(1, good[0])] * 200 + [(2, bad), (3, good[1]), (4, bad + " ~~")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (1, 1), (2, 0), (3, 1), (4, 0), (None, 1)], "doc_id long, quality int")
    seen = []
    monkeypatch.setattr(quality, "fit", lambda x, y: seen.append((len(x), y.tolist())))
    quality.train(docs, labels)
    assert seen == [(4, [1.0, 0.0, 1.0, 0.0])]


def test_blocks_of_heavy_sets(spark, monkeypatch):
    monkeypatch.setattr(minhash, "SMALL", 2)
    monkeypatch.setattr(minhash, "HEAVY", 150)
    base = [prose(k, 60).split(" ") for k in range(4)]
    rows = []
    for k in range(24):
        words = list(base[k % 4])
        words[k % 50] = f"w{k}"
        rows.append((k, " ".join(words)))
    got = {r["id"]: r["component_id"] for r in minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    sets = [{tuple(t.split(" ")[i : i + 5]) for i in range(56)} for _, t in rows]
    label = list(range(24))
    for _ in range(24):
        for i in range(24):
            for j in range(24):
                if 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                    label[i] = label[j] = min(label[i], label[j])
    assert got == dict(enumerate(label))


def test_sets_of_one_digest_are_told_apart(spark):
    """Nodes that clash are renamed in the same way wherever they come from."""
    rows = spark.createDataFrame([(1, 5, 7, 3), (2, 5, 8, 3), (3, 6, 9, 3), (4, 6, 9, 3), (5, 0, 0, 0)], "id long, node long, check long, n_shingles long")
    clashes = minhash.clashing(rows)
    assert [r["_clash"] for r in clashes.collect()] == [5]
    node = {r["id"]: r["node"] for r in minhash.told_apart(rows, clashes).collect()}
    assert node[1] != node[2] and 5 not in (node[1], node[2]) and node[3] == node[4] == 6 and node[5] == 0
    sets = minhash.told_apart(spark.createDataFrame([(5, 8, [1]), (6, 9, [2])], "node long, check long, set array<long>"), clashes)
    assert {r["node"] for r in sets.collect()} == {node[2], 6}
    assert minhash.clashing(rows.where("id > 2")) is None


def test_second_digest_is_of_the_set():
    r = np.random.default_rng(1)
    s = np.sort(r.integers(0, 2**63, 50, dtype=np.uint64))
    assert minhash.second_digest(s) == minhash.second_digest(s[::-1].copy()) != minhash.second_digest(s[1:])
    assert minhash.second_digest(s) != minhash.digest(s)
