"""Near-duplicate embeddings by collision-counting projections."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from folio.llm.common import connected_components, dealt_in_blocks, materialize, table

COSINE = 0.95
PROJECTIONS = 64
RECALL = 0.999
SIGNS = 64
BLOCK = 4096
#: Classes of a cell whose windows are joined; beyond that a cell is compared in blocks.
SMALL = 64
#: Places on sorted projections are whole numbers of this.
UNIT = 1e-6
#: Projected values held at once while cells are made; at 1e8 rows a vector has some 7000 of them.
PLACES = 1 << 21
SEED = 104729


def gauss(dim: int, n: int, salt: int) -> np.ndarray:
    return np.random.default_rng(SEED + 1_000_003 * salt + dim).standard_normal((dim, n))


def window(cosine: float) -> tuple[float, float]:
    """(largest distance of unit vectors at this cosine, half width of a query-centred window)."""
    d = math.sqrt(2 - 2 * cosine)
    return d, 1.5 * d


def needed(cosine: float, projections: int = PROJECTIONS, recall: float = RECALL) -> int:
    """The largest count that a pair right at the cosine still reaches with the wished recall.

    Such a pair falls into a window of half width w on one projection with probability
    erf(w / (d sqrt 2)); on independent projections the count is binomial.
    """
    d, w = window(cosine)
    p = math.erf(w / (d * math.sqrt(2)))
    tail = 0.0
    for c in range(projections, -1, -1):
        tail += math.comb(projections, c) * p**c * (1 - p) ** (projections - c)
        if tail >= recall:
            return c
    return 0


def plan(rows: int, cosine: float, recall: float = 0.997) -> tuple[int, int, float]:
    """(projections that make the cells of a table, tables, cell width) for so many rows; a table sorts one more projection inside its cells.

    Cells are five distances wide. A table has so many projections in all that about one row falls
    into another row's cell by chance; as many tables are taken as the recall asks for, without an upper
    bound. The number of projections follows the logarithm of the rows, so work grows a little faster
    than the rows.
    """
    d, half = window(cosine)
    width = 5 * d
    near = 1 - d * math.sqrt(2 / math.pi) / width  # two values at mean distance d * sqrt(2 / pi) share a cell of random offset
    far = min(0.9, width / (2 * math.sqrt(math.pi)))
    k = max(4, math.ceil(math.log(max(rows, 2)) / -math.log(far))) - 1
    found = near**k * math.erf(half / (d * math.sqrt(2)))
    return k, math.ceil(math.log(1 - recall) / math.log(1 - found)), width


def scaled(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, v): one usable vector an id, divided by its largest component, so that no norm over- or underflows.

    Usable are rows with an id and a vector that is not empty, all finite and not all zero. Of rows that
    repeat an id the smallest vector stays; only those rows are shuffled with their vectors.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column(1).value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            some = np.flatnonzero((sizes > 0) & batch.column(0).is_valid().to_numpy(zero_copy_only=False))
            for dim in np.unique(sizes[some]).tolist():
                at = pa.array(some[sizes[some] == dim])
                x = batch.column(1).take(at).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
                most = np.abs(x).max(axis=1)
                ok = np.isfinite(x).all(axis=1) & (most > 0)
                x = x[ok] / most[ok, None] + 0.0  # no negative zero
                lists = pa.ListArray.from_arrays(np.arange(0, x.size + 1, dim, dtype=np.int32), x.ravel())
                yield pa.RecordBatch.from_arrays([batch.column(0).take(at).filter(pa.array(ok)), lists], names=["id", "v"])

    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("v")).mapInArrow(run, "id long, v array<double>")
    rows = materialize(rows)
    again = materialize(rows.groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("id"))
    return rows.join(again, "id", "left_anti").unionByName(rows.join(again, "id", "left_semi").groupBy("id").agg(F.min("v").alias("v")))


def keys(rows: DataFrame, k: int, tables: int, width: float) -> DataFrame:
    """(id, signs, cells, places): for each table a hash of the k cells that a vector falls into and its place on one more projection, in UNIT."""

    step = max(1, PLACES // ((k + 1) * tables))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = {}
        for whole in batches:
            for first in range(0, whole.num_rows, step):
                batch = whole.slice(first, step)
                lists = batch.column(1)
                dims = lists.value_lengths().to_numpy(zero_copy_only=False)
                signs, cells, places = np.zeros(len(dims), np.int64), np.zeros((len(dims), tables), np.int64), np.zeros((len(dims), tables), np.int32)
                for dim in np.unique(dims).tolist():
                    at = np.flatnonzero(dims == dim)
                    m = lists.take(pa.array(at)).flatten().to_numpy().reshape(-1, dim)
                    m = m / np.linalg.norm(m, axis=1, keepdims=True)
                    if dim not in made:
                        made = {dim: (gauss(dim, (k + 1) * tables, 1), np.random.default_rng(SEED + dim).random(k * tables), gauss(dim, SIGNS, 2))}
                    g, shift, planes = made[dim]
                    on = m @ g
                    places[at] = np.rint(on[:, k * tables :] / UNIT).astype(np.int32)
                    cell = np.floor(on[:, : k * tables] / width + shift).astype(np.int64).astype(np.uint64).reshape(len(at), tables, k)
                    h = np.arange(tables, dtype=np.uint64)[None, :] + np.full((len(at), 1), dim, np.uint64) * np.uint64(1 << 32)
                    for c in range(k):
                        h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + cell[:, :, c]
                    h ^= h >> np.uint64(32)
                    cells[at] = h.view(np.int64)
                    bits = (m @ planes > 0).astype(np.uint64) << np.arange(SIGNS, dtype=np.uint64)
                    signs[at] = bits.sum(axis=1, dtype=np.uint64).view(np.int64)
                ends = pa.array(np.arange(0, cells.size + 1, tables, dtype=np.int32))
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(signs), pa.ListArray.from_arrays(ends, cells.ravel()), pa.ListArray.from_arrays(ends, places.ravel())], names=["id", "signs", "cells", "places"])

    return rows.select("id", "v").mapInArrow(run, "id long, signs long, cells array<long>, places array<int>")


def close_pairs(pairs: DataFrame, rows: DataFrame, cosine: float) -> DataFrame:
    """The pairs (a, b) that collide often enough in query-centred windows and then have the cosine itself."""
    least, (_, half) = needed(cosine), window(cosine)
    both = pairs.join(rows.select(F.col("id").alias("a"), F.col("v").alias("va")), "a").join(rows.select(F.col("id").alias("b"), F.col("v").alias("vb")), "b").where(F.size("va") == F.size("vb"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.zeros(batch.num_rows, bool)
            dims = batch.column(2).value_lengths().to_numpy(zero_copy_only=False)
            for dim in np.unique(dims).tolist():
                at = np.flatnonzero(dims == dim)
                a, b = (batch.column(c).take(pa.array(at)).flatten().to_numpy().reshape(-1, dim) for c in (2, 3))
                na, nb = np.linalg.norm(a, axis=1), np.linalg.norm(b, axis=1)
                g = gauss(dim, PROJECTIONS, 3)
                hits = (np.abs((a / na[:, None]) @ g - (b / nb[:, None]) @ g) <= half).sum(axis=1)
                keep[at] = (hits >= least) & ((a * b).sum(axis=1) / (na * nb) >= cosine)
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    return both.select("a", "b", "va", "vb").mapInArrow(run, "a long, b long")


def sides(pdf: pd.DataFrame) -> Iterator[tuple[pd.DataFrame, pd.DataFrame, np.ndarray]]:
    """(rows of block i, rows of block j, cosines) of a pair of blocks: lengths apart, a strip of block i at a time."""
    i, j = int(pdf["i"].iloc[0]), int(pdf["j"].iloc[0])
    for _, part in pdf.groupby(pdf["v"].map(len)):
        left, right = part[part["mine"] == i], part[part["mine"] == j]
        if not len(left) or not len(right):
            continue
        a, b = np.stack(left["v"].to_list()), np.stack(right["v"].to_list())
        a, b = a / np.linalg.norm(a, axis=1, keepdims=True), b / np.linalg.norm(b, axis=1, keepdims=True)
        for k in range(0, len(a), 512):
            yield left.iloc[k : k + 512], right, a[k : k + 512] @ b.T


def crowded_links(members: DataFrame, rows: DataFrame, cosine: float, block: int) -> DataFrame:
    """Edges (a, b) between components that meet in crowded cells (cell, id, label): one for a vector and a component at most, no pairs."""
    cut = dealt_in_blocks(members, "cell", "id", block).join(rows.select("id", "v"), "id")

    def link(pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        for left, right, cos in sides(pdf):
            r, c = np.nonzero((cos >= cosine) & (left["label"].to_numpy()[:, None] != right["label"].to_numpy()[None, :]))
            edges = pd.DataFrame({"a": left["id"].to_numpy()[r], "b": right["id"].to_numpy()[c], "to": right["label"].to_numpy()[c]})
            out.append(edges.drop_duplicates(["a", "to"])[["a", "b"]])
        return pd.concat(out) if out else pd.DataFrame({"a": [], "b": []})

    return cut.groupBy("cell", "i", "j").applyInPandas(link, "a long, b long")


def link_counts(rows: DataFrame, labels: DataFrame, cosine: float, block: int = BLOCK) -> DataFrame:
    """(id, linked): vectors that rows (id, v, n) of a component are linked with, each counted n times, in pairs of blocks of bounded size."""
    named = rows.join(labels.withColumnRenamed("id", "_n"), F.col("id") == F.col("_n")).drop("_n")

    def count(pdf: pd.DataFrame) -> pd.DataFrame:
        out, same = [pd.DataFrame({"id": pdf["id"], "linked": 0})], pdf["i"].iloc[0] == pdf["j"].iloc[0]
        for left, right, cos in sides(pdf):
            hit = (cos >= cosine) & (left["id"].to_numpy()[:, None] != right["id"].to_numpy()[None, :])
            out.append(pd.DataFrame({"id": left["id"], "linked": hit @ right["n"].to_numpy()}))
            if not same:
                out.append(pd.DataFrame({"id": right["id"], "linked": left["n"].to_numpy() @ hit}))
        return pd.concat(out).groupby("id", as_index=False).sum()

    return dealt_in_blocks(named, "label", "id", block).groupBy("label", "i", "j").applyInPandas(count, "id long, linked long").groupBy("id").agg(F.sum("linked").alias("linked"))


def window_pairs(members: DataFrame, half: float, most: int) -> DataFrame:
    """Pairs (a, b) of different components that share a cell and whose places on its sorted projection are at most `half` apart.

    Each row looks at the rows after it in its window of the sorted places, so a pair of a cell is met
    once; signs of other projections drop most chance meetings before any vector is read.
    """
    w = Window.partitionBy("cell").orderBy("place").rangeBetween(Window.currentRow, math.ceil(half / UNIT))
    near = members.withColumn("near", F.collect_list(F.struct(F.col("id").alias("b"), F.col("signs").alias("s"), F.col("label").alias("l"))).over(w)).select("id", "signs", "label", F.inline("near"))
    near = near.where((F.col("id") != F.col("b")) & (F.col("label") != F.col("l")) & (F.bit_count(F.col("signs").bitwiseXOR(F.col("s"))) <= most))
    return near.select(F.least("id", "b").alias("a"), F.greatest("id", "b").alias("b")).distinct()


def near_vectors(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", cosine: float = COSINE, block: int = BLOCK, small: int = SMALL) -> DataFrame:
    """One row a row of vectors: id, n_links, component_id, kept.

    Equal vectors are one class with a count. Classes are sorted along many one-dimensional projections
    and meet in query-centred windows of them. As a window of one projection holds a quarter of all
    unrelated vectors, each projection is sorted inside cells of `k` others, so that work follows the
    rows; as many projections are taken as the recall asks for. Pairs whose count of window
    collisions over 64 further projections reaches the recall-calibrated one are verified by the cosine.

    In a cell each class is first compared with the smallest id of its part of the projection, so
    copies make a star and not their pairs; the windows then look for links between different
    components only. Cells of more than `small` classes are compared in blocks inside tasks, and no
    pair of them is written out. Links lie inside components; there they are counted exactly in blocks.

    Vectors that are null, empty, zero or hold null or non-finite values link with nothing; vectors
    of different lengths never link; components of any finite size do. A null id: n_links 0,
    component_id null, kept. Rows that repeat an id are one vector for linking, the smallest of them;
    equal vectors are links like others. An empty table gives an empty result; other columns are not read.
    """
    every = vectors.select(F.col(id_col).cast("long").alias("id"))
    one = materialize(scaled(vectors, id_col, vec_col).withColumns({"_a": F.xxhash64("v"), "_b": F.xxhash64(F.lit(1), "v")}))
    classes = materialize(one.groupBy("_a", "_b").agg(F.min("id").alias("class"), F.count(F.lit(1)).alias("n")))
    rows = materialize(one.select("id", "v").join(classes.select("class", "n"), F.col("id") == F.col("class")).drop("class"))
    k, tables, width = plan(rows.count(), cosine)
    cells = materialize(keys(rows, k, tables, width))
    spread = cells.select("id", "signs", F.inline(F.arrays_zip(F.col("cells").alias("cell"), F.col("places").alias("place"))))
    shared = spread.groupBy("cell").agg(F.min("id").alias("least"), F.max("id").alias("top")).where("least < top").select("cell")
    members = materialize(spread.join(shared, "cell"))
    # signs of 64 projections: at this cosine so many differ; five standard deviations are left
    p = math.acos(cosine) / math.pi
    most = int(SIGNS * p + 5 * math.sqrt(SIGNS * p * (1 - p)))
    part = F.floor(F.col("place") / int(width / UNIT))
    reps = members.groupBy("cell", part.alias("part")).agg(F.min(F.struct("id", "signs")).alias("rep"))
    stars = members.withColumn("part", part).join(reps, ["cell", "part"]).where((F.col("id") != F.col("rep.id")) & (F.bit_count(F.col("signs").bitwiseXOR(F.col("rep.signs"))) <= most))
    links = materialize(close_pairs(stars.select(F.col("rep.id").alias("a"), F.col("id").alias("b")).distinct(), rows, cosine))
    labels = connected_components(links)
    named = members.join(labels.withColumnRenamed("id", "_n"), F.col("id") == F.col("_n"), "left").select("cell", "place", "id", "signs", F.coalesce("label", "id").alias("label"))
    mixed = named.groupBy("cell").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.count(F.lit(1)).alias("size")).where("lo < hi").select("cell", "size")
    left = materialize(named.join(mixed, "cell"))
    more = close_pairs(window_pairs(left.where(F.col("size") <= small), window(cosine)[1], most), rows, cosine)
    more = more.unionByName(crowded_links(left.where(F.col("size") > small).select("cell", "id", "label"), rows, cosine, block))
    labels = materialize(connected_components(labels.select(F.col("id").alias("a"), F.col("label").alias("b")).where("a <> b").unionByName(more)))
    counts = link_counts(rows, labels, cosine, block)
    known = classes.join(labels, F.col("class") == F.col("id"), "left").drop("id").join(counts, F.col("class") == F.col("id"), "left")
    known = known.select("_a", "_b", (F.col("n") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links"), F.coalesce("label", "class").alias("component"))
    known = one.select(F.col("id").alias("_n"), "_a", "_b").join(known, ["_a", "_b"])
    out = every.join(known, F.col("id") == F.col("_n"), "left")
    component = F.coalesce("component", "id")
    return out.select("id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))


def op7_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings")).withColumnRenamed("id", "vec_id")


#: The same links in DuckDB: all pairs by cosine, then the ids that links reach.
SQL = """
WITH RECURSIVE v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings), g AS (SELECT vec_id, e, sqrt(list_inner_product(e, e)) AS m FROM v WHERE len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM g a JOIN g b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND a.m > 0 AND b.m > 0 AND list_inner_product(a.e, b.e) / (a.m * b.m) >= 0.95),
r AS (SELECT DISTINCT a AS id, a AS root FROM l UNION SELECT l.b, r.root FROM r JOIN l ON l.a = r.id WHERE r.root < l.b),
k AS (SELECT id, min(root) AS root FROM r GROUP BY 1), c AS (SELECT a, count(*) AS n FROM l GROUP BY 1)
SELECT v.vec_id, CAST(coalesce(c.n, 0) AS BIGINT) AS n_links, coalesce(k.root, v.vec_id) AS component_id, coalesce(k.root, v.vec_id) = v.vec_id AS kept FROM v LEFT JOIN k ON k.id = v.vec_id LEFT JOIN c ON c.a = v.vec_id
"""
