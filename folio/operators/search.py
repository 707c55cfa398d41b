"""Exact vector search: cosine top-k as built-in expressions over a scan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folio.functions.text import blank_to_null


def dot(a: Column, b: Column) -> Column:
    """Sum of products in double precision, in order."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def cosine(a: Column, b: Column) -> Column:
    """0 where a norm is 0."""
    n = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.coalesce(F.try_divide(dot(a, b), n), F.lit(0.0))


def top_k(vectors: DataFrame, query: list[float], key: str, vec: str, k: int, least: float | None = None) -> DataFrame:
    """The k most similar rows, in the order of the exact cosine, ties by key; each partition keeps k, then one merge (TakeOrderedAndProject).

    The similarity that comes out is rounded to six places; the order and `least` are not.
    """
    return _closest(vectors, query, key, vec, k, least).withColumn("similarity", F.round("similarity", 6))


def _closest(vectors: DataFrame, query: list[float], key: str, vec: str, k: int, least: float | None) -> DataFrame:
    q = F.array(*[F.lit(float(x)) for x in query])
    d = vectors.where(F.size(vec) == len(query)).select(key, cosine(F.col(vec), q).alias("similarity"))
    if least is not None:
        d = d.where(F.col("similarity") >= least)
    return d.orderBy(F.desc("similarity"), key).limit(k)


def search(vectors: DataFrame, rows: DataFrame, query: list[float], key: str, vec: str, k: int = 10, least: float | None = None) -> DataFrame:
    """Hits joined to their rows: k between 1 and 25; with a threshold four times as many are fetched first."""
    k = max(1, min(25, k))
    hits = _closest(vectors, query, key, vec, k * (4 if least is not None else 1), least)
    d = hits.join(rows, key)
    return d.orderBy(F.desc("similarity"), key).limit(k).withColumn("similarity", F.round("similarity", 4))


def normalized(vectors: DataFrame, vec: str) -> DataFrame:
    """Vectors of length 1 (zero vectors as they are), to be cached and searched again with dot products alone."""
    n = F.sqrt(dot(F.col(vec), F.col(vec)))
    return vectors.withColumn(vec, F.when(n > 0, F.transform(vec, lambda x: x.cast("double") / n)).otherwise(F.col(vec).cast("array<double>")))


def embedding_text(title: Column, raw_text: Column, summary: Column, venue: Column, source: Column, day: Column) -> Column:
    body = F.coalesce(blank_to_null(F.trim(raw_text)), blank_to_null(F.trim(summary)))
    place = F.coalesce(F.concat(F.lit("Journal: "), blank_to_null(F.trim(venue))), F.concat(F.lit("Source: "), blank_to_null(F.trim(source))))
    return F.concat_ws("\n\n", blank_to_null(F.trim(title)), body, place, F.concat(F.lit("Published: "), blank_to_null(F.trim(day))))


def missing(rows: DataFrame, vectors: DataFrame, key: str, model: str | None = None) -> DataFrame:
    """Rows without a vector of the model."""
    v = vectors if model is None else vectors.where(F.col("model") == model)
    return rows.join(v.select(key), key, "left_anti")


def backfill(rows: DataFrame, vectors: DataFrame, key: str, text: Column, embed, batch: int = 100) -> DataFrame:
    """(key, embedding) of the rows that have none and whose text has ten characters or more.

    `embed` maps a list of texts to a list of vectors; a batch that fails gives nulls.
    """
    import pandas as pd

    d = missing(rows, vectors, key).withColumn("_text", text).where(F.length("_text") >= 10)
    return d.select(key, "_text").mapInPandas(lambda it: (pd.DataFrame({key: p[key], "embedding": _embed(embed, list(p["_text"]), batch)}) for p in it), f"{key} long, embedding array<float>")


def _embed(embed, texts: list[str], batch: int) -> list:
    out: list = []
    for i in range(0, len(texts), batch):
        try:
            out += embed(texts[i : i + batch])
        except Exception:
            out += [None] * len(texts[i : i + batch])
    return out


def backfill_counts(rows: DataFrame, vectors: DataFrame, made: DataFrame, key: str, text: Column) -> DataFrame:
    """One row: rows in all, those that had a vector, too short ones, embedded and failed ones."""
    open_ = missing(rows, vectors, key).withColumn("_long", F.coalesce(F.length(text) >= 10, F.lit(False)))
    d = open_.join(made.select(F.col(key).alias("_m"), F.col("embedding").isNotNull().alias("_ok")), F.col(key) == F.col("_m"), "left")
    counts = d.agg(F.count(F.lit(1)).alias("_open"), F.count_if(~F.col("_long")).alias("too_short"), F.count_if(F.coalesce("_ok", F.lit(False))).alias("embedded"), F.count_if(F.col("_long") & ~F.coalesce("_ok", F.lit(False))).alias("failed"))
    return counts.crossJoin(F.broadcast(rows.agg(F.count(F.lit(1)).alias("total")))).select("total", (F.col("total") - F.col("_open")).alias("had_vector"), "too_short", "embedded", "failed")  # one row each
