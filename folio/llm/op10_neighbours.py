"""Approximate nearest neighbours by a hierarchical navigable small-world graph for each shard."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from folio.llm.common import materialize, table
from folio.llm.op07_embeddings import scaled

LEAST_ROWS, MOST_ROWS, SHARDS = 1 << 13, 1 << 18, 256
#: Bytes of the vectors of a shard, which is one value of a row.
SHARD_BYTES = 1 << 27
QUERY_PART = 1 << 16
BATCH = 1024
#: Marks of visited nodes held at once by searches that run side by side.
PLACES = 1 << 25
LINKS = 16
CANDIDATES = 48
BEAM = 160
EXPAND = 6
NEAREST = 5
SEED = 15485863


@dataclass
class Graph:
    """Flat arrays: the rows in order of insertion and, for each level from the highest, a row of neighbour places in that order for its first nodes, padded with -1."""

    order: np.ndarray
    links: list[np.ndarray]


def level_of(ids: np.ndarray) -> np.ndarray:
    """Geometric levels from a hash of the id, so a rebuild gives the same graph."""
    h = (ids.astype(np.int64).view(np.uint64) + np.uint64(SEED)) * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(29)
    u = ((h >> np.uint64(11)).astype(np.float64) + 1) / float(1 << 53)
    return np.floor(-np.log(u) / math.log(LINKS)).astype(np.int64)


def choose(x: np.ndarray, node: np.ndarray, cand: np.ndarray, most: int) -> np.ndarray:
    """Diverse neighbours: a candidate stays if it is nearer to the node than to any that stay already.

    cand holds candidate positions for each node, nearest first, -1 for none.
    """
    out = np.full((len(node), most), -1, np.int64)
    for i in range(0, len(node), 512):
        c = cand[i : i + 512]
        v = x[np.maximum(c, 0)]
        near = np.matmul(v, x[node[i : i + 512]][:, :, None])[:, :, 0]
        among = np.matmul(v, v.transpose(0, 2, 1))
        took, count = np.zeros(c.shape, bool), np.zeros(len(c), np.int64)
        for k in range(c.shape[1]):
            blocked = ((among[:, k, :] > near[:, k, None]) & took).any(axis=1)
            ok = (c[:, k] >= 0) & ~blocked & (count < most)
            took[:, k] = ok
            out[i + np.flatnonzero(ok), count[ok]] = c[ok, k]
            count += ok
        for k in range(c.shape[1]):  # room left goes to the nearest that were passed over
            ok = (c[:, k] >= 0) & ~took[:, k] & (count < most)
            out[i + np.flatnonzero(ok), count[ok]] = c[ok, k]
            count += ok
    return out


def by_nearness(x: np.ndarray, node: np.ndarray, cand: np.ndarray, most: int) -> np.ndarray:
    """The `most` nearest of each row of candidates, nearest first; -1 stays last."""
    near = np.where(cand >= 0, np.matmul(x[np.maximum(cand, 0)], x[node][:, :, None])[:, :, 0], -np.inf)
    rank = np.argsort(-near, axis=1, kind="stable")[:, :most]
    return np.take_along_axis(cand, rank, axis=1)


def among_themselves(x: np.ndarray, new: np.ndarray, k: int) -> np.ndarray:
    """For each of the new rows the k nearest others of them."""
    k = min(k, len(new) - 1)
    if k <= 0:
        return np.full((len(new), 1), -1, np.int64)
    s = x[new] @ x[new].T
    np.fill_diagonal(s, -np.inf)
    return new[np.argpartition(-s, k - 1, axis=1)[:, :k]]


def add_links(x: np.ndarray, links: np.ndarray, new: np.ndarray, mine: np.ndarray) -> None:
    """Links the new rows both ways; a row with more links than room is thinned to diverse ones."""
    room = links.shape[1]
    links[new, : mine.shape[1]] = mine
    to, by = mine.ravel(), np.repeat(new, mine.shape[1])
    by, to = by[to >= 0], to[to >= 0]
    known = (links[to] == by[:, None]).any(axis=1)
    by, to = by[~known], to[~known]
    s = np.argsort(to, kind="stable")
    by, to = by[s], to[s]
    nodes, first, count = np.unique(to, return_index=True, return_counts=True)
    for least, most in ((0, room), (room, 6 * LINKS), (6 * LINKS, len(x))):  # rows of similar width together
        at = np.flatnonzero((count > least) & (count <= most))
        for i in range(0, len(at), 1024):
            part = at[i : i + 1024]
            wide = np.full((len(part), int(count[part].max(initial=0))), -1, np.int64)
            r = np.repeat(np.arange(len(part)), count[part])
            c = np.arange(len(r)) - np.repeat(np.cumsum(count[part]) - count[part], count[part])
            wide[r, c] = by[np.repeat(first[part], count[part]) + c]
            node = nodes[part]
            both = np.concatenate([links[node].astype(np.int64), wide], axis=1)
            few = (both >= 0).sum(axis=1) <= room
            if few.any():
                links[node[few]] = -np.sort(-both[few], axis=1)[:, :room]
            if (~few).any():
                links[node[~few]] = choose(x, node[~few], by_nearness(x, node[~few], both[~few], 6 * LINKS), room)


def build_level(x: np.ndarray, most: int, above: list[np.ndarray]) -> np.ndarray:
    """Inserts rows in batches; a new row finds its neighbours by navigating the graph of those before it.

    above holds the links of the higher levels, highest first; their nodes are the first rows here, so
    one walk down gives the entry points. Rows of one batch do not know each other yet and are compared
    directly; a batch has at most BATCH rows and no more than stand already.
    """
    n = len(x)
    links = np.full((n, 2 * most), -1, np.int32)
    done = 0
    while done < n:
        new = np.arange(done, min(n, done + max(4 * most, min(done, BATCH))))
        cand = among_themselves(x, new, CANDIDATES)
        if done:
            found = walk(x, [*[g for g in above if len(g) <= done], links[:done]], x[new], CANDIDATES, 4)
            cand = np.concatenate([found, cand], axis=1)
        add_links(x, links, new, choose(x, new, by_nearness(x, new, cand, CANDIDATES), most))
        done += len(new)
    return links


def build(x: np.ndarray, ids: np.ndarray) -> Graph:
    """Levels of geometric size; the rows of a level are the first rows of an order by level and id."""
    level = level_of(ids)
    order = np.lexsort((ids, -level))
    xs = np.ascontiguousarray(x[order])
    links: list[np.ndarray] = []
    for l in range(int(level.max(initial=0)), -1, -1):
        n = int((level >= l).sum())
        links.append(build_level(xs[:n], LINKS, links))
    return Graph(order, links)


def search_level(xs: np.ndarray, links: np.ndarray, q: np.ndarray, start: np.ndarray, beam: int, expand: int) -> tuple[np.ndarray, np.ndarray]:
    """Best-first search of all queries side by side: (places on the level, similarities), best first."""
    n, m = len(links), len(q)
    beam = min(beam, n)
    pos = np.full((m, beam), -1, np.int64)
    sim = np.full((m, beam), -np.inf, xs.dtype)
    done = np.ones((m, beam), bool)
    seen = np.zeros((m, n), bool)
    for c in range(start.shape[1]):
        s = start[:, c]
        fresh = np.flatnonzero((s >= 0) & ~seen[np.arange(m), np.maximum(s, 0)])
        if c < beam and len(fresh):
            pos[fresh, c], done[fresh, c] = s[fresh], False
            sim[fresh, c] = (xs[s[fresh]] * q[fresh]).sum(axis=1)
            seen[fresh, s[fresh]] = True
    active = np.arange(m)
    while len(active):
        order = np.where(done[active], -np.inf, sim[active])
        pick = np.argsort(-order, axis=1)[:, : min(expand, beam)]
        live = np.take_along_axis(order, pick, axis=1) > -np.inf
        active, pick, live = active[live.any(axis=1)], pick[live.any(axis=1)], live[live.any(axis=1)]
        if not len(active):
            break
        here = np.where(live, pos[active[:, None], pick], 0)
        r, c = np.nonzero(live)
        done[active[r], pick[r, c]] = True
        nb = np.where(live[:, :, None], links[here], -1).reshape(len(active), -1).astype(np.int64)
        ok = (nb >= 0) & ~seen[active[:, None], np.maximum(nb, 0)]
        nb = np.where(ok, nb, -1)
        nb.sort(axis=1)  # a node met twice in one step counts once
        nb[:, 1:][nb[:, 1:] == nb[:, :-1]] = -1
        r, c = np.nonzero(nb >= 0)
        got = nb[r, c]
        seen[active[r], got] = True
        s = np.full(nb.shape, -np.inf, xs.dtype)
        s[r, c] = np.einsum("nd,nd->n", xs[got], q[active[r]])
        all_pos, all_sim = np.concatenate([pos[active], nb], axis=1), np.concatenate([sim[active], s], axis=1)
        all_done = np.concatenate([done[active], np.zeros(nb.shape, bool)], axis=1)
        top = np.argpartition(-all_sim, beam - 1, axis=1)[:, :beam]
        pos[active], sim[active] = np.take_along_axis(all_pos, top, axis=1), np.take_along_axis(all_sim, top, axis=1)
        done[active] = np.take_along_axis(all_done, top, axis=1) | (pos[active] < 0)
    rank = np.argsort(-sim, axis=1)
    return np.take_along_axis(pos, rank, axis=1), np.take_along_axis(sim, rank, axis=1)


def walk(xs: np.ndarray, levels: list[np.ndarray], q: np.ndarray, beam: int, expand: int = EXPAND) -> np.ndarray:
    """Places near each query on the last of the levels, best first, -1 for none; walks down from the first."""
    out = []
    step = max(16, min(512, PLACES // len(levels[-1])))
    for i in range(0, len(q), step):
        part = q[i : i + step]
        start = np.zeros((len(part), 1), np.int64)
        for links in levels[:-1]:
            start, _ = search_level(xs, links, part, start, 16, 2)
        pos, _ = search_level(xs, levels[-1], part, start, beam, expand)
        out.append(np.pad(pos, ((0, 0), (0, beam - pos.shape[1])), constant_values=-1))
    return np.concatenate(out) if out else np.zeros((0, beam), np.int64)


def search(g: Graph, x: np.ndarray, q: np.ndarray, beam: int = BEAM) -> np.ndarray:
    """Rows of the shard near each query, best first, -1 for none."""
    found = walk(x[g.order], g.links, q, beam)
    return np.where(found >= 0, g.order[np.maximum(found, 0)], -1)


INDEX = "shard int, dim int, n int, ids binary, vectors binary, levels array<int>, nodes binary, links binary"
WORK = "shard int, dim int, part int, is_query int, n int, ids binary, vectors binary, levels array<int>, nodes binary, links binary, qid long, q array<double>"


@dataclass
class Index:
    """The shards and `twins`: for vectors that occur several times, up to `keep` - 1 ids beside the smallest one, which stands in the graph."""

    shards: DataFrame
    twins: DataFrame
    count: int
    keep: int


def shard_rows(rows: int, dim: int = 1) -> int:
    """Rows of a shard: they grow with the table, so that the searches of a query do so slowly, up to what one task holds easily, whatever the length of the vectors; without a length by their number alone."""
    return max(1, min(max(LEAST_ROWS, min(MOST_ROWS, math.ceil(rows / SHARDS))), SHARD_BYTES // (8 * max(1, dim))))


def build_index(vectors: DataFrame, id_col: str, vec_col: str, rows_a_shard: int | None = None, keep: int = NEAREST + 1) -> Index:
    """One row a shard: ids, vectors and the graph as flat arrays. A shard is a hash range of ids of one vector length, of bounded size.

    Equal vectors are one node: the graph is over distinct directions, however often one occurs, and the
    `keep` smallest ids of each stand for it, so that ties go to the smaller ids. They are found by a
    window limit, which each task applies before the shuffle.
    """
    every = scaled(vectors, id_col, vec_col).withColumns({"_a": F.xxhash64("v"), "_b": F.xxhash64(F.lit(1), "v")})
    ranked = materialize(every.withColumn("_r", F.row_number().over(Window.partitionBy("_a", "_b").orderBy("id"))).where(F.col("_r") <= keep))
    rows = ranked.where("_r = 1")
    twins = ranked.where("_r > 1").select("_a", "_b", F.col("id").alias("twin")).join(rows.select("_a", "_b", F.col("id").alias("rep")), ["_a", "_b"]).select("rep", "twin")
    count, dim = rows.agg(F.count(F.lit(1)), F.max(F.size("v"))).first()
    shards = max(1, math.ceil(count / (rows_a_shard or shard_rows(count, dim or 1))))

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for batch in batches:
            lists = batch.column(2)
            dims = lists.value_lengths().to_numpy(zero_copy_only=False)
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                held.setdefault(int(dim), []).append((batch.column(0)[0].as_py(), batch.column(1).take(pa.array(at)).to_numpy(), lists.take(pa.array(at)).flatten().to_numpy().reshape(-1, dim)))
        for dim, parts in held.items():
            ids, u = np.concatenate([p[1] for p in parts]), np.concatenate([p[2] for p in parts])
            s = np.argsort(ids)
            ids, u = ids[s], np.ascontiguousarray(u[s])
            g = build((u / np.linalg.norm(u, axis=1, keepdims=True)).astype(np.float32), ids)
            values = {"shard": parts[0][0], "dim": dim, "n": len(ids), "ids": ids.tobytes(), "vectors": u.tobytes(), "levels": [len(x) for x in g.links], "nodes": g.order.astype(np.int32).tobytes(), "links": np.concatenate(g.links).tobytes()}
            kinds = [pa.int32()] * 3 + [pa.binary()] * 2 + [pa.list_(pa.int32())] + [pa.binary()] * 2
            yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values.values(), kinds, strict=True)], names=list(values))

    placed = rows.select(F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int").alias("shard"), "id", "v")
    return Index(materialize(placed.repartitionById(shards, F.col("shard")).mapInArrow(make, INDEX)), materialize(twins), shards, keep)


def nearest(index: Index, queries: DataFrame, id_col: str, vec_col: str, k: int = NEAREST, beam: int = BEAM, part_rows: int = QUERY_PART) -> DataFrame:
    """query_id, rank, vec_id, score: the k best of all shards for each query.

    Every shard sees every query (a stated query set against all rows). Queries go in parts of bounded
    size; the task of a shard and part gets the shard first, then its queries as a stream, and holds a
    batch of them at a time. The whole beam gets exact cosines in double precision before the k + 1
    best are taken, and the shards' results are merged. A query is never its own result.

    Vectors that are null, empty, zero or hold null or non-finite values take no part, as queries or as
    candidates; components of any finite size do. Ties go to the smaller id, also among any number of
    equal vectors: therefore k is less than the `keep` that the index was built with, and a larger one is an
    error. Rows that repeat an id count as one, with the smallest of its vectors; rows without an
    id take no part. Vectors of different lengths do not meet. An empty table gives an empty result;
    other columns are not read.
    """
    if not 0 < k < index.keep:
        raise ValueError(f"the index keeps {index.keep} ids of equal vectors, so k is 1 to {index.keep - 1}; build it with a larger keep")
    q = scaled(queries, id_col, vec_col)
    parts = max(1, math.ceil(q.count() / part_rows))
    columns = [c.split()[0] for c in WORK.split(", ")]
    copies = index.shards.withColumns({"part": F.explode(F.sequence(F.lit(0), F.lit(parts - 1))), "is_query": F.lit(0), "qid": F.lit(None).cast("long"), "q": F.lit(None).cast("array<double>")}).select(columns)
    sent = q.select(F.explode(F.sequence(F.lit(0), F.lit(index.count - 1))).alias("shard"), F.size("v").alias("dim"), F.pmod(F.xxhash64("id", F.lit(1)), F.lit(parts)).cast("int").alias("part"), F.lit(1).alias("is_query"), F.col("id").alias("qid"), F.col("v").alias("q"))
    work = copies.unionByName(sent, allowMissingColumns=True).select(columns)
    work = work.repartitionById(index.count * parts, F.col("shard") * parts + F.col("part")).sortWithinPartitions("dim", "is_query")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dim, held = None, None
        for batch in batches:
            dims, asks = batch.column(1).to_numpy(), batch.column(3).to_numpy()
            cuts = [0, *(np.flatnonzero((dims[1:] != dims[:-1]) | (asks[1:] != asks[:-1])) + 1).tolist(), batch.num_rows]
            for a, z in zip(cuts, cuts[1:], strict=False):
                if not asks[a]:
                    n, ids, u, levels, nodes, links = (batch.column(c)[a].as_py() for c in range(4, 10))
                    dim = int(dims[a])
                    ids, u = np.frombuffer(ids, np.int64), np.frombuffer(u, np.float64).reshape(n, dim)
                    norm, ends = np.linalg.norm(u, axis=1), np.cumsum(levels)
                    links = np.frombuffer(links, np.int32).reshape(-1, 2 * LINKS)
                    order = np.frombuffer(nodes, np.int32).astype(np.int64)
                    held = ids, u, norm, order, (u[order] / norm[order, None]).astype(np.float32), [links[e - c : e] for e, c in zip(ends, levels, strict=True)]
                    continue
                if dim != dims[a]:
                    continue  # no vector of this length in the shard
                ids, u, norm, order, xs, levels = held
                for i in range(a, z, 2048):
                    qids = batch.column(10).slice(i, min(2048, z - i)).to_numpy()
                    qv = batch.column(11).slice(i, min(2048, z - i)).flatten().to_numpy().reshape(-1, dim)
                    qn = np.linalg.norm(qv, axis=1)
                    found = walk(xs, levels, (qv / qn[:, None]).astype(np.float32), beam)
                    at = order[np.maximum(found, 0)]
                    cos = np.stack([(u[r] @ v) / (norm[r] * m) for r, v, m in zip(at, qv, qn, strict=True)])
                    cos[found < 0] = -np.inf
                    best = np.lexsort((ids[at], -cos), axis=1)[:, : k + 1]
                    cos, got = np.take_along_axis(cos, best, axis=1), ids[np.take_along_axis(at, best, axis=1)]
                    ok = cos > -np.inf
                    yield pa.RecordBatch.from_arrays([pa.array(np.repeat(qids, best.shape[1])[ok.ravel()]), pa.array(got[ok]), pa.array(cos[ok])], names=["query_id", "rep", "score"])

    found = materialize(work.mapInArrow(run, "query_id long, rep long, score double"))
    others = found.join(index.twins, "rep").select("query_id", F.col("twin").alias("vec_id"), "score")
    every = found.select("query_id", F.col("rep").alias("vec_id"), "score").unionByName(others).where("query_id <> vec_id")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return every.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op10_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Queries: ids divisible by 50, against all rows."""
    vectors = table(spark, sf_dir, "embeddings")
    return nearest(build_index(vectors, "vec_id", "embedding"), vectors.where(F.col("vec_id") % 50 == 0), "vec_id", "embedding")
