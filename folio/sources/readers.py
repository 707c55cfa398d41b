"""Readers of landed files: feeds, PubMed summaries, CSV with side files, seeds, ground truth, surveys, lines."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.functions.dates import best_date, clamp_future, feed_date
from folio.functions.identifiers import doi_in, doi_in_url, pmid_in, pubmed_url, record_id
from folio.functions.rules import map_rating, to_int
from folio.functions.text import blank_to_null, strip_html, title_key
from folio.operators.records import items_to_seeds

FEED_ITEM = "title string, link string, pubDate string, description string, author string"
SUMMARY = "struct<uid: string, title: string, source: string, fulljournalname: string, pubdate: string, sortpubdate: string, epubdate: string, authors: array<struct<name: string>>>"


def feed(spark: SparkSession, path: str, name: str, as_of) -> DataFrame:
    """Items of landed RSS files; a missing date becomes as_of and is marked."""
    d = spark.read.format("xml").option("rowTag", "item").schema(FEED_ITEM).load(path)
    day = feed_date(F.col("pubDate"))
    return d.select(
        record_id(F.col("title"), F.lit(name), F.col("link")).alias("id"), strip_html(F.col("title")).alias("title"), F.array_compact(F.array("author")).alias("authors"), F.lit(name).alias("source"),
        F.coalesce(day, F.lit(as_of).cast("timestamp")).alias("published_date"), F.col("link").alias("url"), strip_html(F.col("description")).alias("raw_text"), day.isNull().alias("missing_date"),
    )


def pubmed(spark: SparkSession, path: str, name: str, as_of) -> DataFrame:
    """Records of landed ESummary files (one object `result` keyed by id); far-future dates become null, rows stay."""
    d = spark.read.schema(f"result map<string, {SUMMARY}>").option("multiLine", True).json(path)
    r = d.select(F.explode("result").alias("pmid", "r")).where("pmid <> 'uids'")
    best = best_date(F.col("r.pubdate"), F.col("r.sortpubdate"), F.col("r.epubdate"))
    r = r.withColumn("b", best)
    url = pubmed_url(F.col("pmid"))
    title = F.regexp_replace("r.title", r"\.$", "")
    return r.select(
        record_id(title, F.lit(name), url).alias("id"), title.alias("title"), F.transform("r.authors", lambda a: a["name"]).alias("authors"), F.lit(name).alias("source"),
        clamp_future(F.col("b.day"), F.col("b.low_confidence"), as_of).cast("timestamp").alias("published_date"), url.alias("url"), F.lit("").alias("raw_text"), F.col("b").isNull().alias("missing_date"), F.col("r.fulljournalname").alias("venue"), F.col("b.date_source").alias("date_source"), F.col("b.date_raw").alias("date_raw"),
    )


def all_sources(spark: SparkSession, sources: list[dict], as_of, since=None) -> tuple[DataFrame, DataFrame]:
    """(rows, stats): the union of the sources; one that cannot be read is a row of stats with its error.

    Each source is read once on its own before it joins the union, so a malformed or missing file fails
    there and never the run; landed files are small beside what is made of them.
    """
    parts, failed = [], []
    for s in sources:
        try:
            part = {"rss": feed, "pubmed": pubmed}[s["type"]](spark, s["path"], s["name"], as_of)
            part.write.format("noop").mode("overwrite").save()
            parts.append(part)
        except Exception as e:
            failed.append((s["name"], "error", str(e)[:200]))
    if not parts:
        raise ValueError("no source can be read")
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    if since is not None:
        rows = rows.where(F.col("published_date").isNull() | (F.col("published_date") >= F.lit(since).cast("timestamp")))
    stats = rows.groupBy(F.col("source").alias("name")).agg(F.count(F.lit(1)).alias("kept"), F.count_if("missing_date").alias("missing_date_count")).withColumn("status", F.lit("ok")).withColumn("error", F.lit(None).cast("string"))
    if failed:
        stats = stats.unionByName(spark.createDataFrame(failed, "name string, status string, error string"), allowMissingColumns=True)
    return rows, stats


def papers_csv(spark: SparkSession, path: str, summaries: str | None = None, limit: int | None = None) -> DataFrame:
    """A CSV of new rows; a side file fills the summary, else the one-liner.

    The side file is {id: text}, {id: {summary, one_liner}}, a list of {id, summary, one_liner} or
    {"summaries": such a list}.
    """
    d = spark.read.csv(path, header=True, multiLine=True, quote='"', escape='"')
    if summaries:
        entry = lambda v: F.coalesce(blank_to_null(F.get_json_object(v, "$.summary")), blank_to_null(F.get_json_object(v, "$.one_liner")), F.when(~F.startswith(F.trim(v), F.lit("{")), v))
        whole = spark.read.option("wholetext", True).text(summaries).select(F.trim("value").alias("value"))
        items = whole.select(F.explode(F.from_json(F.when(F.startswith("value", F.lit("[")), F.col("value")).otherwise(F.get_json_object("value", "$.summaries")), "array<string>")).alias("v")).select(F.get_json_object("v", "$.id").alias("_id"), entry(F.col("v")).alias("_s"))
        by_id = whole.where(~F.startswith("value", F.lit("[")) & F.get_json_object("value", "$.summaries").isNull()).select(F.explode(F.from_json("value", "map<string,string>")).alias("_id", "v")).select("_id", entry(F.col("v")).alias("_s"))
        s = items.unionByName(by_id).groupBy("_id").agg(F.max("_s").alias("_s"))
        d = d.join(s, F.col("id") == F.col("_id"), "left").withColumn("summary", F.coalesce("_s", blank_to_null(F.col("one_liner")))).drop("_id", "_s")
    return d if limit is None else d.orderBy("id").limit(limit)


def lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select(F.trim("value").alias("value")).where("value <> '' AND value NOT LIKE '#%'")


def json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines; blank and malformed lines are dropped."""
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)


def format_of(path: str) -> str:
    end = path.rsplit(".", 1)[-1].lower()
    if end not in ("json", "csv", "tsv"):
        raise ValueError(f"unsupported file type: {path}")
    return end


def ground_truth(spark: SparkSession, path: str) -> DataFrame:
    """(key, title, doi, pmid, rating 0..3) from CSV, TSV or a JSON list of strings, {type, value} or full rows; rating 3 where none is given."""
    if format_of(path) == "json":
        d = spark.read.option("wholetext", True).text(path).select(F.explode(F.from_json("value", "array<string>")).alias("e"))
        full = F.from_json("e", "map<string,string>")
        plain = full.isNull()
        value = F.when(plain, F.col("e")).otherwise(F.coalesce(full["value"], full["title"], full["doi"], full["pmid"]))
        d = d.select(value.alias("value"), F.coalesce(full["title"], F.when(plain | (full["type"] == "title"), value)).alias("title"), F.coalesce(full["doi"], doi_in(value)).alias("doi"), F.coalesce(full["pmid"], pmid_in(value)).alias("pmid"), F.coalesce(full["rating"], full["rank"]).alias("r"))
    else:
        t = spark.read.csv(path, header=True, multiLine=True, escape='"', sep="\t" if format_of(path) == "tsv" else ",")
        col = lambda *names: F.coalesce(*[blank_to_null(F.col(n)) for n in names if n in t.columns], F.lit(None).cast("string"))
        d = t.select(col("title").alias("value"), col("title").alias("title"), col("doi").alias("doi"), col("pmid").alias("pmid"), col("rating", "rank").alias("r"))
    return d.withColumn("rating", F.coalesce(map_rating(to_int(F.col("r"))), F.lit(3))).drop("r")


def survey(spark: SparkSession, path: str) -> DataFrame:
    """One row a publication (id, else title key) with its labels; rows without a rating are dropped, identifiers filled from the first that has one."""
    t = spark.read.csv(path, header=True, multiLine=True, escape='"')
    r = t.withColumn("rating", map_rating(to_int(F.col("human_score")))).where("rating IS NOT NULL")
    key = F.coalesce(blank_to_null(F.col("publication_id")), title_key(F.col("title"), "eval"))
    fill = [F.first(blank_to_null(F.col(c)), ignorenulls=True).alias(c) for c in ("title", "source")]
    label = F.struct(F.lit("survey").alias("source"), F.col("evaluator").alias("rater"), "rating", F.col("reasoning").alias("rationale"))
    return r.groupBy(key.alias("key")).agg(*fill, F.sort_array(F.collect_list(label)).alias("labels"))


def seeds(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("multiLine", True).schema("type string, value string, comment string").json(path)


def snapshot(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("multiLine", True).schema("run_id string, publication_ids array<string>").json(path).select("run_id", F.explode("publication_ids").alias("id"))


LABEL = "struct<source: string, rater: string, rating_0_3: string, rating_raw: string, rationale: string, confidence: string>"
ITEM = f"publication_id string, title string, url string, canonical_url string, doi string, labels array<{LABEL}>"


def unified_dataset(spark: SparkSession, path: str) -> DataFrame:
    """Evaluation items with their labels: a JSON list, one wrapped in data, records or items, a single object, or a CSV with a row a label.

    A title that is a URL gives the URL and its DOI. Rows of a CSV are grouped by id, else by normalised title.
    """
    if format_of(path) == "json":
        whole = spark.read.option("wholetext", True).text(path).select(F.trim("value").alias("v"))
        wrapped = F.coalesce(*[F.get_json_object("v", f"$.{k}") for k in ("data", "records", "items")])
        listed = F.from_json(F.when(F.startswith("v", F.lit("[")), F.col("v")).otherwise(wrapped), "array<string>")
        d = whole.select(F.explode(F.coalesce(listed, F.array("v"))).alias("e")).select(F.from_json("e", ITEM).alias("i")).select("i.*")
        d = d.withColumn("labels", F.coalesce("labels", F.array().cast(f"array<{LABEL}>")))
    else:
        t = spark.read.csv(path, header=True, multiLine=True, escape='"', sep="\t" if format_of(path) == "tsv" else ",")
        have = lambda c: blank_to_null(F.trim(F.col(c))) if c in t.columns else F.lit(None).cast("string")
        label = F.struct(*[have(f"label_{n}").alias(a) for n, a in (("source", "source"), ("rater", "rater"), ("rating_0_3", "rating_0_3"), ("rating_raw", "rating_raw"), ("rationale", "rationale"), ("confidence", "confidence"))])
        key = F.coalesce(have("publication_id"), blank_to_null(title_key(have("title"), "eval")))
        first = [F.first(c, ignorenulls=True).alias(c) for c in ("publication_id", "title", "url", "canonical_url", "doi")]
        rows = t.select(key.alias("_key"), *[have(c).alias(c) for c in ("publication_id", "title", "url", "canonical_url", "doi")], label.alias("label")).where("_key IS NOT NULL")
        d = rows.groupBy("_key").agg(*first, F.sort_array(F.collect_list("label")).alias("labels")).drop("_key")
    link = F.when(F.rlike("title", F.lit("(?i)^https?://")), F.col("title"))
    d = d.withColumn("url", F.coalesce(blank_to_null(F.col("url")), link))
    return d.withColumn("doi", F.coalesce(blank_to_null(F.col("doi")), doi_in_url(F.col("url"))))


def benchmark_items(spark: SparkSession, path: str) -> DataFrame:
    """(type, value): a list, or one wrapped in data, items, records or publications, of seeds or of full items, each by its best identifier."""
    whole = spark.read.option("wholetext", True).text(path).select(F.trim("value").alias("v"))
    wrapped = F.coalesce(*[F.get_json_object("v", f"$.{k}") for k in ("data", "items", "records", "publications")])
    e = whole.select(F.explode(F.from_json(F.when(F.startswith("v", F.lit("[")), F.col("v")).otherwise(wrapped), "array<string>")).alias("e"))
    e = e.select(F.from_json("e", "type string, value string, doi string, pmid string, url string, publication_id string, id string, title string").alias("i")).select("i.*")
    seed = e.where("type IS NOT NULL AND value IS NOT NULL").select("type", "value")
    full = items_to_seeds(e.where("type IS NULL OR value IS NULL").drop("type", "value").withColumn("publication_id", F.coalesce("publication_id", "id")))
    return seed.unionByName(full.where("type IS NOT NULL").select("type", "value"))
