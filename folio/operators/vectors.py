"""A kept index for exact vector search: small codes with an error bound are scanned, and only what may be among the nearest is measured."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.operators.nearest import first_of
from folio.operators.search import cosine

BLOCK = 4096
INDEX = "dim int, n int, keys array<long>, codes binary, scales binary, errors binary"
#: Bounds are computed in floating point; this covers its error at any usual length of vectors.
SLACK = 1e-6


def build_index(vectors: DataFrame, key: str, vec: str, path: str) -> None:
    """Writes the index: a row for each block of up to BLOCK vectors of one length, with a byte a component, a scale and the distance of what the code stands for.

    A vector of length 1 is rounded to whole multiples of its scale. Zero vectors, whose cosine counts as 0, have code 0 and
    no error; null vectors and such with null or non-finite values are left out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            for dim in np.unique(sizes[sizes > 0]).tolist():
                at = np.flatnonzero(sizes == dim)
                x = lists.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
                ok = np.isfinite(x).all(axis=1)
                at, x = at[ok], x[ok]
                most = np.abs(x).max(axis=1, keepdims=True, initial=0)
                x = np.divide(x, most, out=np.zeros_like(x), where=most > 0)
                norm = np.linalg.norm(x, axis=1, keepdims=True)
                x = np.divide(x, norm, out=np.zeros_like(x), where=norm > 0)
                scale = np.abs(x).max(axis=1) / 127
                code = np.rint(np.divide(x, scale[:, None], out=np.zeros_like(x), where=scale[:, None] > 0)).astype(np.int8)
                error = np.linalg.norm(x - code * scale[:, None], axis=1)
                keys = batch.column(0).take(pa.array(at))
                for i in range(0, len(at), BLOCK):
                    s = slice(i, i + BLOCK)
                    n = len(code[s])
                    yield pa.RecordBatch.from_arrays([pa.array([dim], pa.int32()), pa.array([n], pa.int32()), pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), keys.slice(i, n).cast(pa.int64())), *[pa.array([v.tobytes()], pa.binary()) for v in (code[s], scale[s], error[s])]], names=[f.split(" ")[0] for f in INDEX.split(", ")])

    vectors.select(F.col(key).cast("long"), F.col(vec).cast("array<double>")).mapInArrow(run, INDEX).write.parquet(path)


def search_index(spark: SparkSession, path: str, vectors: DataFrame, key: str, vec: str, queries: dict[int, list[float]], k: int) -> DataFrame:
    """(query, place, key, similarity): the k nearest rows of each query by the exact cosine, ties to the smaller key; equal to a full scan.

    A code gives the cosine up to the stored distance. The k-th best lower bound of all blocks is a floor
    that k rows reach, so rows whose upper bound is below it are out; the cosine of the others is computed from
    the vectors. Queries are a stated few and go with the task; each block hands on k lower bounds a query.
    Zero vectors, as queries too, have similarity 0.
    """
    asked = {q: np.asarray(v, np.float64) / (np.linalg.norm(v) or 1.0) for q, v in queries.items()}

    def bounds(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        for b in range(batch.num_rows):
            dim, n = batch.column(0)[b].as_py(), batch.column(1)[b].as_py()
            mine = [q for q, v in asked.items() if len(v) == dim]
            if not mine:
                continue
            keys = batch.column(2)[b].values.to_numpy()
            code = np.frombuffer(batch.column(3)[b].as_py(), np.int8).reshape(n, dim).astype(np.float32)
            scale, error = (np.frombuffer(batch.column(c)[b].as_py(), np.float64) for c in (4, 5))
            about = (code @ np.stack([asked[q] for q in mine]).T.astype(np.float32)) * scale[:, None]
            for j, q in enumerate(mine):
                yield q, keys, about[:, j] - error - SLACK, about[:, j] + error + SLACK

    def lower(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for q, _, low, _ in bounds(batch):
                best = np.sort(low)[::-1][:k].astype(np.float64)
                yield pa.RecordBatch.from_arrays([pa.array([q] * len(best), pa.int64()), pa.array(best)], names=["query", "low"])

    index = spark.read.schema(INDEX).parquet(path)
    lows = first_of(index.mapInArrow(lower, "query long, low double"), ["query"], [F.desc("low")], k)
    floor = {r["query"]: r["floor"] for r in lows.groupBy("query").agg(F.count(F.lit(1)).alias("n"), F.min("low").alias("floor")).where(F.col("n") == k).collect()}  # a row a query

    def upper(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for q, keys, _, high in bounds(batch):
                some = keys[high >= floor.get(q, -np.inf)]
                yield pa.RecordBatch.from_arrays([pa.array([q] * len(some), pa.int64()), pa.array(some)], names=["query", "key"])

    may = index.mapInArrow(upper, "query long, key long")
    exact = F.create_map(*[F.lit(x) for q, v in queries.items() for x in (q, [float(c) for c in v])])
    d = may.join(vectors.select(F.col(key).cast("long").alias("key"), F.col(vec).alias("v")), "key").withColumn("similarity", cosine(F.col("v"), exact[F.col("query")]))
    return first_of(d.select("query", "key", "similarity"), ["query"], [F.desc("similarity"), "key"], k).select("query", "place", "key", "similarity")
