"""Near-duplicate documents by b-bit MinHash, links confirmed on full shingle sets."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.llm.common import connected_components, dealt_in_blocks, materialize, table
from folio.llm.kernels import list_array, mix, shingle_sets

WORDS = 5
SIMILARITY = 75  # per cent
BANDS, ROWS, BITS = 32, 4, 4
HASHES = BANDS * ROWS
_r = np.random.default_rng(7919)
MULT = _r.integers(0, 2**31, HASHES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
ADD = _r.integers(0, 2**32, HASHES, dtype=np.uint32)
LANES = HASHES * BITS // 64
SIGNATURE = "id long, text_key long, n_shingles long, node long, check long, " + ", ".join(f"s{k} long" for k in range(LANES)) + ", bands array<long>"


#: Buckets up to this size emit their pairs; larger ones are compared in blocks of BLOCK rows inside tasks.
SMALL, BLOCK = 48, 384
#: Shingles of a block, about.
HEAVY = 1 << 21
#: Shingles of a pair of blocks that are looked at together.
PASS = 1 << 20
MAP_BITS = 25


def digest(s: np.ndarray) -> int:
    """One number for a set of hashes, whatever their order."""
    return int(mix(np.array([s.sum(dtype=np.uint64) ^ np.uint64(len(s))])).view(np.int64)[0])


def second_digest(s: np.ndarray) -> int:
    """Another number for a set of hashes, independent of the first."""
    return int(np.bitwise_xor.reduce(mix(s * np.uint64(0xC2B2AE3D27D4EB4F) + np.uint64(0x165667B19E3779F9))).view(np.int64))


def told_apart(rows: DataFrame, clashes: DataFrame | None) -> DataFrame:
    """rows (node, check, …) without check; a node that stands for sets with other second digests too is named by both digests."""
    if clashes is None:
        return rows.drop("check")
    d = rows.join(F.broadcast(clashes), F.col("node") == F.col("_clash"), "left")  # by chance 2 or 3 nodes in 1e10 texts
    return d.withColumn("node", F.when(F.col("_clash").isNull(), F.col("node")).otherwise(F.xxhash64("node", "check"))).drop("_clash", "check")


def clashing(sig: DataFrame) -> DataFrame | None:
    """Nodes that several sets share, if there are any."""
    seen = sig.where("n_shingles > 0").groupBy("node").agg(F.min("check").alias("lo"), F.max("check").alias("hi"))
    both = materialize(seen.where("lo < hi").select(F.col("node").alias("_clash")))
    return None if both.isEmpty() else both


def minima(s: np.ndarray) -> np.ndarray:
    """The smallest value of each hash function over a set of 64-bit hashes."""
    x = (s >> np.uint64(32)).astype(np.uint32) ^ s.astype(np.uint32)
    out = np.full(HASHES, 0xFFFFFFFF, np.uint32)
    for i in range(0, len(x), 4096):
        h = x[None, i : i + 4096] * MULT[:, None]
        h += ADD[:, None]
        np.minimum(out, h.min(axis=1), out=out)
    return out


def signatures(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """A hash of the text, set size, a 64-bit digest of the set (node), the packed low bits of the minima, and a hash for each band."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shifts = (np.arange(64 // BITS, dtype=np.uint64) * np.uint64(BITS))[None, :]
        salt = mix(np.arange(1, BANDS + 1, dtype=np.uint64))
        for batch in batches:
            n = batch.num_rows
            count, node, check = (np.zeros(n, np.int64) for _ in range(3))
            sig, bands = np.zeros((n, LANES), np.uint64), [np.zeros(0, np.int64)] * n
            for k, s in shingle_sets(batch.column(1), WORDS):
                count[k] = len(s)
                if not len(s):
                    continue
                node[k], check[k] = digest(s), second_digest(s)
                m = minima(s)
                low = (m >> np.uint32(7)).astype(np.uint64) & np.uint64((1 << BITS) - 1)
                sig[k] = (low.reshape(LANES, -1) << shifts).sum(axis=1, dtype=np.uint64)
                h = salt.copy()
                for row in m.astype(np.uint64).reshape(BANDS, ROWS).T:
                    h = h * np.uint64(0xA0761D6478BD642F) + row
                bands[k] = mix(h).view(np.int64)
            arrays = [batch.column(0), batch.column(2), pa.array(count), pa.array(node), pa.array(check), *[pa.array(np.ascontiguousarray(sig[:, j]).view(np.int64)) for j in range(LANES)], list_array(bands, pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, names=["id", "text_key", "n_shingles", "node", "check", *[f"s{j}" for j in range(LANES)], "bands"])

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("text_key")).mapInArrow(run, SIGNATURE)


def estimate(left: str, right: str) -> Column:
    """Similarity from the bits of two packed signatures, corrected for values that agree by chance."""
    ones = sum(1 << (BITS * k) for k in range(64 // BITS))
    ones = ones - (1 << 64) if ones >= 1 << 63 else ones
    differ = F.lit(0)
    for j in range(LANES):
        x = F.col(f"{left}.s{j}").bitwiseXOR(F.col(f"{right}.s{j}"))
        y = x
        for b in range(1, BITS):
            y = y.bitwiseOR(F.shiftrightunsigned(x, b))
        differ = differ + F.bit_count(y.bitwiseAND(F.lit(ones).cast("long")))
    agree = 1 - differ / F.lit(float(HASHES))
    chance = 1.0 / (1 << BITS)
    return (agree - chance) / (1 - chance)


def shingles(docs: DataFrame) -> DataFrame:
    """(node, check, set): the full shingle sets of docs (text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, checks, sets, held = [], [], [], 0
            for k, s in shingle_sets(batch.column(0), WORDS):
                if len(s):
                    nodes.append(digest(s))
                    checks.append(second_digest(s))
                    sets.append(s.view(np.int64))
                    held += len(s)
                if nodes and (held > 500_000 or k == batch.num_rows - 1):
                    yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(checks, pa.int64()), list_array(sets, pa.int64())], names=["node", "check", "set"])
                    nodes, checks, sets, held = [], [], [], 0

    return docs.select("text").mapInArrow(run, "node long, check long, set array<long>")


def only(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of docs whose id may be one of ids, without a shuffle of the texts.

    The ids go into a bitmap of 2**MAP_BITS places, made by Spark and broadcast: at most 2**(MAP_BITS - 6)
    rows of 16 bytes however many ids there are. Some other rows pass too; joins by node drop them.
    Null ids share one place.
    """
    place = lambda c: F.pmod(F.xxhash64(c), F.lit(1 << MAP_BITS))
    p = ids.select(place("id").alias("p"))
    marks = p.groupBy(F.shiftright("p", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, int(p & 63))")).alias("bits"))
    d = docs.withColumn("_p", place("id"))
    return d.join(F.broadcast(marks), (F.shiftright("_p", 6) == F.col("word")) & (F.expr("bits & shiftleft(1L, int(_p & 63))") != 0)).select("id", "text")


def sets_of(nodes: DataFrame, classes: DataFrame, docs: DataFrame, clashes: DataFrame | None) -> DataFrame:
    """(node, set) for nodes, from the text of one document of each."""
    ids = classes.join(nodes, "node").select(F.col("cid").alias("id"))
    return materialize(told_apart(shingles(only(docs, ids)), clashes).join(nodes, "node", "left_semi").dropDuplicates(["node"]))


def confirmed(pairs: DataFrame, sets: DataFrame, per_cent: int) -> DataFrame:
    """The pairs (a, b) of nodes whose full sets are similar enough."""
    both = pairs.join(sets.select(F.col("node").alias("a"), F.col("set").alias("sa")), "a").join(sets.select(F.col("node").alias("b"), F.col("set").alias("sb")), "b")
    both = both.withColumn("common", F.size(F.array_intersect("sa", "sb")))
    return both.where(100 * F.col("common") >= per_cent * (F.size("sa") + F.size("sb") - F.col("common"))).select("a", "b")


def block_links(members: DataFrame, sets: DataFrame, per_cent: int, block: int = BLOCK) -> DataFrame:
    """Edges (a, b) that join what is linked inside large buckets (band, node).

    A bucket is cut into blocks by the number of its sets and of their shingles, and each pair of blocks is one group of bounded size. All its pairs are
    compared exactly by one product of 0/1 matrices over the shingles that occur twice; what comes out is
    a spanning edge for each row, not the pairs.
    """
    cut = dealt_in_blocks(members, "band", "node", block, weight="n_shingles", heavy=HEAVY).select("band", "i", "j", "node").join(sets, "node")

    def link(pdf: pd.DataFrame) -> pd.DataFrame:
        nodes, rows = pdf["node"].to_numpy(), [np.asarray(x, np.int64) for x in pdf["set"]]
        size = np.array([len(r) for r in rows])
        common = np.zeros((len(rows), len(rows)), np.float32)
        passes = -(-int(size.sum()) // PASS)
        for p in range(passes):  # shingles by their remainder, so the temporaries stay small however long the texts are
            parts = [r[r % passes == p] for r in rows] if passes > 1 else rows
            values, at, seen = np.unique(np.concatenate(parts), return_inverse=True, return_counts=True)
            use = seen[at] > 1
            column = np.cumsum(seen > 1) - 1
            row = np.repeat(np.arange(len(rows)), [len(r) for r in parts])[use]
            order = np.argsort(column[at[use]], kind="stable")
            row, col = row[order], column[at[use]][order]
            for first in range(0, int(col.max(initial=-1)) + 1, 4096):
                a, z = np.searchsorted(col, [first, first + 4096])
                m = np.zeros((len(rows), 4096), np.float32)
                m[row[a:z], col[a:z] - first] = 1
                common += m @ m.T
        near = 100 * common >= per_cent * (size[:, None] + size[None, :] - common)
        label = np.arange(len(rows))
        while True:
            low = np.where(near, label[None, :], len(rows)).min(axis=1)
            low = np.minimum(low, label)
            low = low[low]
            if (low == label).all():
                break
            label = low
        moved = label != np.arange(len(rows))
        return pd.DataFrame({"a": nodes[moved], "b": nodes[label[moved]]})

    return cut.groupBy("band", "i", "j").applyInPandas(link, "a long, b long")


def grouped(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", per_cent: int = SIMILARITY, margin: float = 0.22) -> DataFrame:
    """One row a row of docs: id, text_key (hash of the text), n_shingles, label (a node of its component, null for an empty set), component_id.

    Texts with equal shingle sets are one node, named by a 64-bit digest of the set; sets that a second
    digest tells apart are nodes of their own, so equality is that of 128 bits. Nodes that share a
    band of four minima are candidates (at similarity 0.75 a pair shares none of the 32 bands once in
    200,000); pairs whose b-bit estimate lies more than `margin` below the threshold (five standard
    deviations) fall away, the others are confirmed on their full sets. In a bucket, every node is first
    compared with the bucket's smallest one, so a bucket of m nodes makes m pairs. After components are
    known, only buckets that hold several components are looked at again: small ones pair by pair, large
    ones in blocks inside tasks, so no link between components is lost and no group is expanded into pairs.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    sig = materialize(signatures(docs, "id", "text"))
    clashes = clashing(sig)
    sig = told_apart(sig, clashes)
    full = sig.where("n_shingles > 0")
    classes = full.groupBy("node").agg(F.min("id").alias("cid"))
    banded = full.select("node", "n_shingles", F.explode("bands").alias("band"))
    buckets = banded.groupBy("band").agg(F.min("node").alias("rep"), F.max("node").alias("top")).where("rep < top").select("band", "rep")
    members = materialize(banded.join(buckets, "band").distinct())
    lanes = [f"s{j}" for j in range(LANES)]
    packed = materialize(full.select("node", F.struct(*lanes).alias("sig")).join(members.select("node").distinct(), "node", "left_semi").dropDuplicates(["node"]))
    least = per_cent / 100 - margin
    stars = members.where("node <> rep").select(F.col("rep").alias("a"), F.col("node").alias("b")).distinct()
    stars = stars.join(packed.select(F.col("node").alias("a"), F.col("sig").alias("l")), "a").join(packed.select(F.col("node").alias("b"), F.col("sig").alias("r")), "b")
    stars = materialize(stars.where(estimate("l", "r") >= least).select("a", "b"))
    in_pairs = lambda p: p.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    links = materialize(confirmed(stars, sets_of(in_pairs(stars), classes, docs, clashes), per_cent))
    labels = connected_components(links)
    named = members.join(labels.withColumnRenamed("id", "node"), "node", "left").select("band", "rep", "node", "n_shingles", F.coalesce("label", "node").alias("label"))
    mixed = named.groupBy("band").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.count(F.lit(1)).alias("size")).where("lo < hi").select("band", "size")
    left = materialize(named.join(mixed, "band").where("size > 2 OR node <> rep"))  # the pair of a bucket of two has been compared
    l = left.where(F.col("size").between(3, SMALL)).join(packed, "node")
    x, y = l.alias("x"), l.alias("y")
    rest = x.join(y, (F.col("x.band") == F.col("y.band")) & (F.col("x.node") < F.col("y.node")) & (F.col("x.label") != F.col("y.label")) & (F.col("x.node") != F.col("x.rep")) & (estimate("x.sig", "y.sig") >= least))
    rest = materialize(rest.select(F.col("x.node").alias("a"), F.col("y.node").alias("b")).distinct())
    large = left.where(F.col("size") > SMALL).select("band", "node", "n_shingles")
    sets = sets_of(in_pairs(rest).unionByName(large.select("node")).distinct(), classes, docs, clashes)
    more = confirmed(rest, sets, per_cent).unionByName(block_links(large, sets, per_cent)).distinct()
    labels = connected_components(labels.select(F.col("id").alias("a"), F.col("label").alias("b")).where("a <> b").unionByName(more))
    joined = classes.join(labels.withColumnRenamed("id", "node"), "node", "left").select("node", "cid", F.coalesce("label", "node").alias("label"))
    least_id = joined.groupBy("label").agg(F.min("cid").alias("component"))
    of_node = joined.join(least_id, "label").select(F.col("node").alias("_n"), F.col("label").alias("_label"), "component")
    out = sig.select("id", "text_key", "n_shingles", "node").join(of_node, (F.col("node") == F.col("_n")) & (F.col("n_shingles") > 0), "left")
    return out.select("id", "text_key", "n_shingles", F.col("_label").alias("label"), F.coalesce("component", "id").alias("component_id"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", per_cent: int = SIMILARITY) -> DataFrame:
    """One row a row of docs: id, n_shingles, component_id (the smallest id that links reach), kept (the id is that one).

    No words or a null text: an empty set, linked with nothing. A row without an id has the component_id
    of the ids it is linked with and is not kept; linked with none, its component_id is null and it is
    kept. Rows that repeat an id are linked each by its own text, and all rows of a kept id and group say
    kept; `without_near_duplicates` decides row by row. Ties cannot occur but between equal rows. Texts
    of any length are hashed in the task that reads them. An empty table gives an empty result. Only the
    two named columns are read.
    """
    g = grouped(docs, id_col, text_col, per_cent)
    return g.select("id", "n_shingles", "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.col("component_id").isNull()).alias("kept"))


def without_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", per_cent: int = SIMILARITY) -> DataFrame:
    """docs with one row of each group of near copies: the smallest id, null last, then the smallest hash of the text.

    The decision is made by row: another text of the same id is a row of its own, and of rows equal in
    id and text one stays, whichever. Rows without words or text all stay. Added columns begin with '_'.
    """
    rows = grouped(docs, id_col, text_col, per_cent).where("label IS NOT NULL").groupBy("label", "id", "text_key").agg(F.count(F.lit(1)).alias("n"))
    rows = materialize(rows.withColumn("place", F.struct(F.col("id").isNull().alias("last"), "id", "text_key")))
    best = rows.groupBy(F.col("label").alias("_l")).agg(F.min("place").alias("best"), F.sum("n").alias("all")).where("all > 1")
    marks = rows.join(best, F.col("label") == F.col("_l")).select(F.col("id").alias("_mark_id"), F.col("text_key").alias("_mark_key"), (F.col("place") == F.col("best")).alias("_first"), "n")
    marks = materialize(marks.where("NOT _first OR n > 1"))
    d = docs.withColumns({"_near_id": F.col(id_col).cast("long"), "_near_key": F.xxhash64(text_col)})
    same = F.col("_near_id").eqNullSafe(F.col("_mark_id")) & (F.col("_near_key") == F.col("_mark_key"))
    others = d.join(marks, same, "left_anti")
    repeated = d.join(marks.where("_first"), same, "left_semi").dropDuplicates(["_near_id", "_near_key"])
    return others.unionByName(repeated).drop("_near_id", "_near_key")


def op6_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


#: The same groups in DuckDB: all pairs that share a shingle, compared exactly, then the ids that links reach.
SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')] ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS g FROM d),
n AS (SELECT doc_id, len(g) AS n FROM s), u AS (SELECT doc_id, unnest(g) AS g FROM s),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM u a JOIN u b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT DISTINCT a AS id, a AS root FROM e UNION SELECT e.b, r.root FROM r JOIN e ON e.a = r.id WHERE r.root < e.b),
k AS (SELECT id, min(root) AS root FROM r GROUP BY 1)
SELECT n.doc_id, CAST(n.n AS BIGINT) AS n_shingles, coalesce(k.root, n.doc_id) AS component_id, coalesce(k.root, n.doc_id) = n.doc_id AS kept FROM n LEFT JOIN k ON k.id = n.doc_id
"""
