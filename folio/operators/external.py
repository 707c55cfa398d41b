"""Hooks for outside functions (reviewers, embedders, summarizers): batches in tasks, errors as columns, calls only for rows not yet answered."""

from __future__ import annotations

import hashlib
import json
import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from folio.operators.titles import stored

ANSWER = "answer string, latency_ms long, error string"


def call(df: DataFrame, key: str, kind: str, columns: list[str], fn: Callable[[list[dict]], list[dict]], batch: int = 100) -> DataFrame:
    """(key, answer, latency_ms, error): fn gets up to `batch` rows as dicts and returns one JSON-able dict each; a batch that fails carries its error."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in parts:  # converted once a part, however small the batches are
            rows, answers, took, errors = p[columns].to_dict("records"), [], [], []
            for i in range(0, len(rows), batch):
                some, began = rows[i : i + batch], time.monotonic()
                try:
                    got, error = [json.dumps(x) for _, x in zip(some, fn(some), strict=True)], None
                except Exception as e:
                    got, error = [None] * len(some), str(e)[:200]
                answers += got
                took += [int((time.monotonic() - began) * 1000)] * len(some)
                errors += [error] * len(some)
            yield pd.DataFrame({key: p[key], "answer": answers, "latency_ms": took, "error": errors})

    return df.select(*dict.fromkeys([key, *columns])).mapInPandas(run, f"{key} {kind}, {ANSWER}")


class Retry(Exception):
    """Raised by a function for a failure that may pass (a time-out, a busy server); other errors are final."""


def numbered(df: DataFrame, key: str, out: str = "number") -> DataFrame:
    """Adds the place of each row in the order of `key`, from 0: rows are sorted in ranges, and the ranges are counted.

    The ranges are written before they are counted, so a place never depends on a second sort; at most
    one row a range is broadcast.
    """
    part = F.spark_partition_id()
    d = stored(df.repartitionByRange(key).withColumn("_part", part).sortWithinPartitions(key))
    ends = d.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    first = ends.select(F.col("_part").alias("_p"), F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_first"))
    inside = F.row_number().over(Window.partitionBy("_part").orderBy(key)) - 1
    return d.withColumn("_in", inside).join(F.broadcast(first), F.col("_part") == F.col("_p")).withColumn(out, (F.col("_first") + F.col("_in")).cast("long")).drop("_part", "_p", "_in", "_first")


def deliver(df: DataFrame, key: str, kind: str, columns: list[str], send: Callable[..., None], size: int = 100, tries: int = 3, wait: float = 0.5, marked: bool = False) -> DataFrame:
    """(key, chunk, mark, attempts, error): rows are sent in chunks of `size` in the order of key; a Retry is tried again after a growing pause, other errors are not.

    Chunk numbers run over the whole delivery, floor(place / size), so all chunks but the last are full. The mark of a
    chunk is a hash of its keys, the same in each attempt and in a delivery that is run again; with
    `marked` it is the second argument of `send`, so that a receiver knows what it has had. A lost task sends its chunks again.
    A task takes its chunks one after the other from a stream of rows, so small chunks cost no group each and one chunk is held at a time.
    """

    def sent(keys: list, rows: list[dict]) -> tuple[str, int, str | None]:
        mark = hashlib.sha256("\n".join(str(k) for k in keys).encode()).hexdigest()
        error, attempt = None, 0
        while attempt < tries:
            attempt += 1
            try:
                send(rows, *([mark] if marked else []))
                error = None
                break
            except Retry as e:
                error = str(e)[:200]
                time.sleep(wait * 2 ** (attempt - 1) if attempt < tries else 0)
            except Exception as e:
                error = str(e)[:200]
                break
        return mark, attempt, error

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None  # the last chunk of a part, which may go on in the next one
        for p in parts:
            done = []
            for chunk, k, row in zip(p["chunk"].tolist(), p[key].tolist(), p[columns].to_dict("records"), strict=True):
                if held is None or held[0] != chunk:
                    done += [held] if held else []
                    held = (chunk, [], [])
                held[1].append(k)
                held[2].append(row)
            yield told(done)
        yield told([held] if held else [])

    def told(chunks: list[tuple[int, list, list[dict]]]) -> pd.DataFrame:
        rows = []
        for chunk, keys, records in chunks:
            mark, attempts, error = sent(keys, records)
            rows += [(k, chunk, mark, attempts, error) for k in keys]
        return pd.DataFrame(rows, columns=[key, "chunk", "mark", "attempts", "error"])

    d = numbered(df.select(*dict.fromkeys([key, *columns])), key).withColumn("chunk", F.floor(F.col("number") / size).cast("long"))
    d = d.repartition("chunk").sortWithinPartitions("number").drop("number")
    return d.mapInPandas(run, f"{key} {kind}, chunk long, mark string, attempts int, error string")


def unanswered(df: DataFrame, answers: DataFrame, keys: list[str]) -> DataFrame:
    return df.join(answers.where("error IS NULL").select(*keys), keys, "left_anti")


def pair_reviews(reviews: DataFrame, key: str, reviewers: tuple[str, str], value: str = "answer") -> DataFrame:
    """One row a key with the answers of two reviewers side by side."""
    d = reviews.groupBy(key).pivot("reviewer", list(reviewers)).agg(F.first(value, ignorenulls=True))
    return d.withColumn("complete", F.col(reviewers[0]).isNotNull() & F.col(reviewers[1]).isNotNull())


def read_through(df: DataFrame, cache: DataFrame, key: str, value: str, fallback) -> tuple[DataFrame, DataFrame]:
    """(rows, counts by origin): cached value, else the fallback column, else failed."""
    c = cache.select(F.col(key).alias("_k"), F.col(value).alias("_v"))
    d = df.join(c, F.col(key) == F.col("_k"), "left")
    origin = F.when(F.col("_v").isNotNull(), "hit").when(fallback.isNotNull(), "generated").otherwise("failed")
    out = d.withColumn("origin", origin).withColumn(value, F.coalesce("_v", fallback)).drop("_k", "_v")
    return out, out.groupBy("origin").agg(F.count(F.lit(1)).alias("n"))


def score_records(items: DataFrame, memo: DataFrame, answers: Callable[[DataFrame], DataFrame], run_id: str, key: str = "id") -> tuple[DataFrame, DataFrame]:
    """(scores of all items, rows to add to the memo): each item is asked once in a run and its answer is parsed and put through the rules.

    memo has (run_id, key, score, reason, confidence). Items it answers for this run are not asked again;
    `answers` maps the others to (key, answer). Answers that cannot be used give a null score with the
    error as reason and are not remembered, so the next run of the same id asks again.
    """
    from folio.functions.jsonx import scored
    from folio.functions.rules import apply_rules, with_reason

    known = memo.where(F.col("run_id") == run_id).groupBy(key).agg(F.min(F.struct("score", "reason", "confidence")).alias("m"))
    known = items.join(known, key).select(key, "m.score", "m.reason", "m.confidence", F.lit("memo").alias("origin"))
    open_ = items.join(memo.where(F.col("run_id") == run_id).select(key), key, "left_anti")
    got = open_.join(answers(open_), key, "left").withColumn("_r", scored(F.col("answer"), "relevancy_score", "relevancy_reason"))
    ruled = apply_rules(got.where("_r.valid").withColumn("score", F.col("_r.score")), "score", ("title", "source", "raw_text"))
    new = ruled.select(key, F.col("adjusted_score").alias("score"), with_reason(F.col("_r.reason"), F.col("adjustments")).alias("reason"), F.col("_r.confidence").alias("confidence"), F.lit("asked").alias("origin"))
    failed = got.where("NOT _r.valid").select(key, F.lit(None).cast("int").alias("score"), F.when(F.col("answer").isNull(), "no answer").otherwise("answer not usable").alias("reason"), F.lit("low").alias("confidence"), F.lit("failed").alias("origin"))
    return known.unionByName(new).unionByName(failed), new.select(F.lit(run_id).alias("run_id"), key, "score", "reason", "confidence")


def citation_features(items: DataFrame, cache: DataFrame, counts: DataFrame, as_of, days: int = 7, key: str = "id") -> DataFrame:
    """items with doi, pmid, citation_count, citations_per_year, available and origin (cache or looked_up).

    Identifiers come from the URL. A cache entry younger than `days` is used as it is; the others are
    looked up by DOI, else PMID, in counts (doi, pmid, citation_count, citations_per_year). A count of
    zero is no data.
    """
    from folio.functions.identifiers import URL_DOI, extracted, pubmed_path_pmid

    d = items.withColumns({"doi": extracted(F.col("url"), URL_DOI[-1]), "pmid": pubmed_path_pmid(F.col("url"))})
    fresh = cache.where(F.col("cached_at") > F.lit(as_of).cast("timestamp") - F.make_dt_interval(F.lit(days))).groupBy(F.col(key).alias("_k")).agg(F.max_by(F.struct(F.col("citation_count").alias("c"), F.col("citations_per_year").alias("y")), "cached_at").alias("_hit"))
    one = lambda c: counts.where(F.col(c).isNotNull()).groupBy(F.col(c).alias(f"_{c}")).agg(F.max(F.struct(F.col("citation_count").alias("c"), F.col("citations_per_year").alias("y"))).alias(f"_by_{c}"))
    d = d.join(fresh, F.col(key) == F.col("_k"), "left").join(one("doi"), F.col("doi") == F.col("_doi"), "left").join(one("pmid"), F.col("pmid") == F.col("_pmid"), "left")
    best = F.coalesce("_hit", "_by_doi", "_by_pmid")
    some = (F.coalesce(best["c"], F.lit(0)) > 0) | (F.coalesce(best["y"], F.lit(0.0)) > 0)
    d = d.withColumns({"available": F.coalesce(some, F.lit(False)), "citation_count": F.when(some, best["c"]), "citations_per_year": F.when(some, best["y"]), "origin": F.when(F.col("_hit").isNotNull(), "cache").otherwise("looked_up")})
    return d.drop("_k", "_hit", "_doi", "_pmid", "_by_doi", "_by_pmid")
