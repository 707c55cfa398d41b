"""Deduplication across sources by a key of strict precedence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folio.functions.identifiers import extracted, plain_doi, pmid_in_url
from folio.functions.text import blank_to_null, title_key


def first_author(authors: Column) -> Column:
    return blank_to_null(title_key(F.try_element_at(authors, F.lit(1)), "dedupe"))


def year_of(day: Column) -> Column:
    return extracted(day, r"(\d{4})")


def dedupe_key(title: Column, url: Column, raw_text: Column, authors: Column, day: Column) -> Column:
    """doi: before pmid: before composite: (title, first author, year) before url: before title:."""
    t, a, y = blank_to_null(title_key(title, "dedupe")), first_author(authors), year_of(day)
    doi = F.coalesce(plain_doi(url), plain_doi(F.concat_ws(" ", title, raw_text)))
    stable = F.when(~F.endswith(url, F.lit("#")) & (F.length(url) > 10), F.lower(F.trim(url)))
    # concat is null if any part is, so each form is there only where all its parts are
    return F.coalesce(F.concat(F.lit("doi:"), doi), F.concat(F.lit("pmid:"), pmid_in_url(url)), F.concat(F.lit("composite:"), t, F.lit("|"), a, F.lit("|"), y), F.concat(F.lit("url:"), stable), F.concat(F.lit("title:"), F.coalesce(t, F.lit(""))))


def deduplicate(df: DataFrame, key: str, seq: str, source: str = "source") -> DataFrame:
    """The first row (by seq) of each key with source_names, the distinct sources in order of first sight, and n_merged.

    Sources are reduced to one row a (key, source) before they are collected, so a key with very many
    rows collects only its sources; the survivor is found by min_by, which combines before the shuffle.
    """
    rest = [c for c in df.columns if c != key]
    per_source = df.groupBy(key, source).agg(F.min(seq).alias("_first"), F.count(F.lit(1)).alias("_n"), F.min_by(F.struct(*rest), F.col(seq)).alias("_row"))
    out = per_source.groupBy(key).agg(F.min_by("_row", "_first").alias("_row"), F.array_sort(F.collect_list(F.struct("_first", F.col(source).alias("s")))).alias("_s"), F.sum("_n").alias("_n"))
    return out.select(key, "_row.*", F.transform("_s", lambda x: x["s"]).alias("source_names"), (F.col("_n") - 1).alias("n_merged"))


def dedupe_stats(df: DataFrame, key: str) -> DataFrame:
    n = df.agg(F.count(F.lit(1)).alias("total_input"), F.count_distinct(key).alias("total_output"))
    return n.withColumn("total_merged", F.col("total_input") - F.col("total_output"))
