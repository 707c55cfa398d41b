"""Scans and lookups over stored tables; filters and columns reach the Parquet scan."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folio.operators.match import latest


def newest(df: DataFrame, ts: str, key: str, limit: int, as_of: datetime | None = None, since_days: int | None = None) -> DataFrame:
    """Newest rows first, at most `limit`, optionally of the last days before as_of."""
    if since_days is not None:
        df = df.where(F.col(ts) >= F.lit(as_of).cast(df.schema[ts].dataType) - F.make_dt_interval(F.lit(since_days)))
    return df.orderBy(F.col(ts).desc_nulls_last(), key).limit(limit)


def by_id(df: DataFrame, key: str, value) -> DataFrame:
    return df.where(F.col(key) == value)


def hydrate(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Rows of df for a list of ids, whatever its length."""
    return df.join(ids.select(key), key, "left_semi")


def events_with_publications(events: DataFrame, publications: DataFrame, key: str, fill: tuple[str, ...] = (), run_id: str | None = None) -> DataFrame:
    """Events left-joined to publications; the columns in `fill` fall back to the publication's."""
    e = events if run_id is None else events.where(F.col("run_id") == run_id)
    p = publications.select(F.col(key).alias("_k"), *[F.col(c).alias(f"_p_{c}") for c in fill])
    d = e.join(p, F.col(key) == F.col("_k"), "left")
    for c in fill:
        d = d.withColumn(c, F.coalesce(c, f"_p_{c}") if c in e.columns else F.col(f"_p_{c}"))
    return d.drop("_k", *[f"_p_{c}" for c in fill])


def missing_canonical(df: DataFrame, as_of: datetime, since_days: int | None = None, legacy_precedence: bool = False) -> DataFrame:
    """Rows without a canonical URL of the last days; with legacy_precedence the days do not restrict null ones."""
    null, empty = F.col("canonical_url").isNull(), F.col("canonical_url") == ""
    if since_days is None:
        return df.where(null | empty)
    recent = F.col("created_at") >= F.lit(as_of).cast(df.schema["created_at"].dataType) - F.make_dt_interval(F.lit(since_days))
    return df.where(null | (empty & recent) if legacy_precedence else (null | empty) & recent)


def pending(df: DataFrame, week: str | None = None, status: str | None = None) -> DataFrame:
    if week is not None:
        df = df.where(F.col("week_start") == week)
    return df if status is None else df.where(F.col("status") == status)


def run_scores(events: DataFrame, run_id: str, key: str = "publication_id", order: str = "created_at") -> DataFrame:
    """The latest score of each publication in a run."""
    return latest(events.where(F.col("run_id") == run_id), [key], order)


def exploded_must_reads(files: DataFrame, json: str, order: str, schema: str) -> DataFrame:
    """Items of the JSON lists, for each id the one of the latest file."""
    d = files.select(order, F.explode(F.from_json(json, f"array<struct<{schema}>>")).alias("i"))
    return d.groupBy(F.col("i.id").alias("id")).agg(F.max_by("i", order).alias("i")).select("i.*")


def metadata_lookup(df: DataFrame, title_key: Column, key: str) -> DataFrame:
    """One row a normalised title: the first by key."""
    rest = [c for c in df.columns]
    return df.withColumn("_t", title_key).where("_t <> ''").groupBy("_t").agg(F.min_by(F.struct(*rest), F.col(key)).alias("r")).select(F.col("_t").alias("title_key"), "r.*")


def resolution_stats(df: DataFrame, source_type: str = "source_type", resolved: str = "canonical_url") -> DataFrame:
    """Rows and resolved rows of each source type."""
    ok = F.coalesce(F.col(resolved), F.lit("")) != ""
    return df.groupBy(source_type).agg(F.count(F.lit(1)).alias("total"), F.count_if(ok).alias("resolved"))


def pending_reminder(pending_rows: DataFrame, must_reads: DataFrame, week: str) -> DataFrame:
    """Pending rows of a week with the title of their must-read, 'Untitled' where there is none."""
    t = must_reads.groupBy(F.col("id").alias("_k")).agg(F.max("title").alias("title"))
    d = pending(pending_rows, week, "pending").join(t, F.col("publication_id") == F.col("_k"), "left")
    return d.withColumn("title", F.coalesce("title", F.lit("Untitled"))).drop("_k")


def get(df: DataFrame, publication_id: str | None, key: str = "id") -> DataFrame:
    """The row of an id; an empty or missing id is an error."""
    if publication_id is None or not str(publication_id).strip():
        raise ValueError("an id is needed")
    return by_id(df, key, publication_id)


def must_reads(df: DataFrame, as_of: datetime, since_days: int = 7, limit: int = 10, ts: str = "published_date", score: str = "score") -> DataFrame:
    """The best scored rows of the last days: 1 to 90 days and 1 to 20 rows, other values are drawn in."""
    days, n = max(1, min(90, since_days)), max(1, min(20, limit))
    d = df.where(F.col(ts) >= F.lit(as_of).cast(df.schema[ts].dataType) - F.make_dt_interval(F.lit(days)))
    return d.orderBy(F.coalesce(F.col(score), F.lit(-1)).desc(), F.col(ts).desc(), "id").limit(n)


def must_reads_of_files(files: DataFrame, json: str, order: str, schema: str, since: str | None = None, limit: int = 10) -> DataFrame:
    """The same from the JSON lists of earlier runs, for when no table can be read: each id by its latest file, those dated `since` or later, ranked by score."""
    items = exploded_must_reads(files, json, order, schema)
    if since is not None:
        items = items.where(F.coalesce("date", F.lit("")) >= since)
    return items.orderBy(F.col("score").desc_nulls_last(), "id").limit(max(1, min(20, limit)))
