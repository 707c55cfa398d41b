"""Open-access copies: choice of a location, classification, status changes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folio.functions.identifiers import attachable, licence
from folio.functions.text import blank_to_null


def best_location(locations: Column) -> Column:
    """Repository copies first, then by order of the list (structs host_type, url, license)."""
    with_url = F.filter(locations, lambda l: F.coalesce(l["url"], F.lit("")) != "")
    repository = F.filter(with_url, lambda l: l["host_type"] == "repository")
    return F.coalesce(F.try_element_at(repository, F.lit(1)), F.try_element_at(with_url, F.lit(1)))


def best_licence(licences: Column) -> Column:
    """The version-of-record licence, else the first (structs content_version, url)."""
    vor = F.filter(licences, lambda l: l["content_version"] == "vor")
    return licence(F.coalesce(F.try_element_at(vor, F.lit(1))["url"], F.try_element_at(licences, F.lit(1))["url"]))


def latest_version(versions: Column) -> Column:
    return F.try_element_at(versions, F.lit(-1))


def open_with_pdf(df: DataFrame) -> DataFrame:
    return df.where((F.col("is_open") == F.lit(True)) & F.exists("urls", lambda u: u["style"] == "pdf"))


def is_pdf(content: Column, least: int = 1024) -> Column:
    return (F.length(content) >= least) & (F.substring(content, 1, 4) == F.lit("%PDF").cast("binary"))


def classify(items: DataFrame, stored: DataFrame, found: DataFrame, key: str = "id") -> DataFrame:
    """Adds reason: cached, no_identifiers, miss, licence_blocked or fetched (stored: key; found: key, license)."""
    s = stored.select(F.col(key).alias("_s")).distinct()
    f = found.groupBy(F.col(key).alias("_f")).agg(F.first("license").alias("_licence"))
    d = items.join(s, F.col(key) == F.col("_s"), "left").join(f, F.col(key) == F.col("_f"), "left")
    none = blank_to_null(F.trim("doi")).isNull() & blank_to_null(F.trim("pmid")).isNull()
    reason = F.when(F.col("_s").isNotNull(), "cached").when(none, "no_identifiers").when(F.col("_f").isNull(), "miss").when(~attachable(licence(F.col("_licence"))), "licence_blocked").otherwise("fetched")
    return d.withColumn("reason", reason).drop("_s", "_f", "_licence")


def finalize(pending: DataFrame, attached: DataFrame, key: str = "id") -> tuple[DataFrame, DataFrame]:
    """(rows, counts): delivered rows become attached, open ones cutoff; a row in another status stays."""
    a = attached.select(F.col(key).alias("_a")).distinct()
    d = pending.join(a, F.col(key) == F.col("_a"), "left")
    status = F.when(F.col("_a").isNotNull(), "attached").when(F.col("status").isin("pending", "uploaded"), "cutoff").otherwise(F.col("status"))
    out = d.withColumn("status", status).drop("_a")
    return out, out.groupBy("status").agg(F.count(F.lit(1)).alias("n"))
