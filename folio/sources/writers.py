"""Sinks: keyed swaps, exports, manifests and pointers. All writes are Spark's own, to the path given."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The columns of the export of new rows.
NEW_COLUMNS = ("id", "title", "source", "source_names", "date", "url", "one_liner", "sponsor_names", "company_names", "has_sponsor_signal", "company_affiliation_signal")


def flat(df: DataFrame, sep: str = ";") -> DataFrame:
    """Lists as text, for CSV."""
    return df.select(*[F.array_join(f.name, sep).alias(f.name) if isinstance(f.dataType, T.ArrayType) else F.col(f"`{f.name}`") for f in df.schema])


def new_rows_csv(changes: DataFrame, path: str) -> None:
    new = changes.where("status = 'NEW'")
    flat(new.select(*[F.col(c) if c in new.columns else F.lit(None).cast("string").alias(c) for c in NEW_COLUMNS])).write.mode("overwrite").csv(path, header=True, escape='"')


def results_csv(df: DataFrame, path: str) -> None:
    flat(df.select(*[c for c in df.columns if not c.startswith("_")])).write.mode("overwrite").csv(path, header=True, escape='"')


def events_jsonl(events: DataFrame, path: str, run_id: str | None = None, json_columns: tuple[str, ...] = (), order: str = "created_at") -> None:
    """Events of a run, oldest first within range partitions, JSON text expanded to variants where it parses."""
    d = events if run_id is None else events.where(F.col("run_id") == run_id)
    for c in json_columns:
        d = d.withColumn(c, F.try_parse_json(c))
    d.repartitionByRange(order).sortWithinPartitions(order).write.mode("overwrite").json(path)


def manifest(counts: DataFrame, path: str, **settings: str) -> None:
    """One row of counts with the run's settings."""
    counts.select(*[F.lit(v).alias(k) for k, v in settings.items()], F.struct(*counts.columns).alias("counts")).coalesce(1).write.mode("overwrite").json(path)


def latest_pointer(df: DataFrame, path: str) -> None:
    df.coalesce(1).write.mode("overwrite").json(path)


def partitioned(df: DataFrame, path: str, by: str) -> None:
    """Append by partition; a rerun replaces the partitions it writes and no others."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)


def compressed_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("compression", "gzip").json(path)


def quarantine(df: DataFrame, checks: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """(good, bad): bad rows carry the name of the first check that fails."""
    reason = F.coalesce(*[F.when(~F.coalesce(ok, F.lit(False)), name) for name, ok in checks.items()])
    d = df.withColumn("reject_reason", reason)
    return d.where("reject_reason IS NULL").drop("reject_reason"), d.where("reject_reason IS NOT NULL")


def chunked(df: DataFrame, key: str, size: int) -> DataFrame:
    """Adds chunk: ids of about `size` rows by hash, for batched delivery."""
    n = max(1, -(-df.count() // size))
    return df.withColumn("chunk", F.pmod(F.xxhash64(key), F.lit(n)))


def append_log(df: DataFrame, path: str) -> None:
    """Appends rows to a log of deliveries; each append is its own set of files."""
    df.write.mode("append").parquet(path)


def artifacts(df: DataFrame, path: str) -> None:
    """Rows as JSON with dates and times in ISO form and nulls kept, in one file a task."""
    iso = {f.name: F.date_format(f.name, "yyyy-MM-dd") if isinstance(f.dataType, T.DateType) else F.date_format(f.name, "yyyy-MM-dd'T'HH:mm:ss") for f in df.schema if isinstance(f.dataType, T.DateType | T.TimestampType | T.TimestampNTZType)}
    df.withColumns(iso).write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def evaluation_json(items: DataFrame, metrics: DataFrame, path: str, **settings: str) -> None:
    """Metrics (one row) and settings beside the items, as two JSON folders; names that begin with '_' are left out."""
    metrics.select(*[F.lit(v).alias(k) for k, v in settings.items()], F.struct(*metrics.columns).alias("metrics")).coalesce(1).write.mode("overwrite").json(f"{path}/metrics")
    items.select(*[c for c in items.columns if not c.startswith("_")]).write.mode("overwrite").json(f"{path}/items")


def compressed_copy(spark: SparkSession, source: str, path: str) -> DataFrame:
    """A gzip JSON copy of a stored table with (bytes, copied_bytes, ratio) from the file listings."""
    compressed_json(spark.read.parquet(source), path)
    size = lambda p, name: spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(p).agg(F.sum("length").alias(name))
    both = size(source, "bytes").crossJoin(size(path, "copied_bytes"))  # one row each
    return both.withColumn("ratio", F.round(F.col("copied_bytes") / F.col("bytes"), 4))
