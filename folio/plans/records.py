"""Queries for record shapes, attachments, lanes and catalog scans."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from folio.operators import attachments, external, records
from folio.plans.documents import PUBS, pubs
from folio.plans.registry import query, table
from folio.sources import catalog


@query("newest_publications", f"WITH {PUBS} SELECT id, source, CAST(published_date AS VARCHAR) AS day FROM pubs WHERE published_date >= DATE '2024-02-10' - 30 ORDER BY published_date DESC, id LIMIT 100")
def newest_publications(spark, sf_dir):
    d = pubs(spark, sf_dir).withColumn("ts", F.col("published_date").cast("timestamp"))
    return catalog.newest(d, "ts", "id", 100, datetime(2024, 2, 10), 30).select("id", "source", F.col("published_date").cast("string").alias("day"))


@query("point_lookup", "SELECT doc_id, lang, source FROM documents WHERE doc_id = 42")
def point_lookup(spark, sf_dir):
    return catalog.by_id(table(spark, sf_dir, "documents"), "doc_id", 42).select("doc_id", "lang", "source")


@query("batch_hydrate", "SELECT doc_id, lang FROM documents WHERE doc_id IN (SELECT vec_id FROM embeddings WHERE label = 3)")
def batch_hydrate(spark, sf_dir):
    ids = table(spark, sf_dir, "embeddings").where("label = 3").select(F.col("vec_id").alias("doc_id"))
    return catalog.hydrate(table(spark, sf_dir, "documents"), ids, "doc_id").select("doc_id", "lang")


@query("events_with_documents", "SELECT event_id, coalesce(d.source, '-') AS source FROM events e LEFT JOIN documents d ON e.user_id = d.doc_id")
def events_with_documents(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_id", F.col("user_id").alias("doc_id"))
    d = catalog.events_with_publications(e, table(spark, sf_dir, "documents"), "doc_id", ("source",))
    return d.select("event_id", F.coalesce("source", F.lit("-")).alias("source"))


@query("missing_canonical", f"WITH {PUBS}, c AS (SELECT id, CASE WHEN id % 3 = 0 THEN NULL WHEN id % 3 = 1 THEN '' ELSE url END AS u, published_date AS d FROM pubs) SELECT id FROM c WHERE (u IS NULL OR u = '') AND d >= DATE '2024-02-10' - 14")
def missing_canonical(spark, sf_dir):
    i = F.col("id")
    d = pubs(spark, sf_dir).withColumn("canonical_url", F.when(i % 3 == 0, None).when(i % 3 == 1, "").otherwise(F.col("url"))).withColumn("created_at", F.col("published_date").cast("timestamp"))
    return catalog.missing_canonical(d, datetime(2024, 2, 10), 14).select("id")


@query("wire_rows", f"WITH {PUBS} SELECT id, title, source AS venue, CAST(published_date AS VARCHAR) AS published_date, md5(substring(raw_text, 1, 500)) AS summary FROM pubs")
def wire_rows(spark, sf_dir):
    d = pubs(spark, sf_dir).withColumn("venue", F.lit("")).withColumn("summary", F.lit(""))
    return records.wire(d).select("id", "title", "venue", "published_date", F.md5(F.col("summary").cast("binary")).alias("summary"))


@query("change_report", f"WITH {PUBS}, r AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY published_date DESC, id) AS place FROM pubs) SELECT source, place, '- [NEW] ' || title || ' (' || CAST(published_date AS VARCHAR) || ')' AS line FROM r WHERE place <= 5 UNION ALL SELECT source, 6, '- and ' || CAST(count(*) - 5 AS VARCHAR) || ' more' FROM pubs GROUP BY 1 HAVING count(*) > 5")
def change_report(spark, sf_dir):
    r = records.change_report(pubs(spark, sf_dir).withColumn("status", F.lit("NEW")), 5)
    return r.select("source", F.col("place").cast("long").alias("place"), "line")


@query("citation_lane", "WITH s AS (SELECT doc_id FROM documents WHERE doc_id % 2 = 0 ORDER BY n_chars DESC, doc_id LIMIT 20) SELECT DISTINCT 'd' || CAST((doc_id + x) % 300 AS VARCHAR) AS neighbour FROM s, (SELECT unnest([1, 2, 3, 4]) AS x)")
def citation_lane(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    seeds = d.select(F.col("doc_id").alias("id"), F.when(F.col("doc_id") % 2 == 0, "10.1/x").alias("doi"), F.lit(None).cast("string").alias("pmid"), F.col("n_chars").alias("score"))
    near = lambda *n: F.array(*[F.concat(F.lit("d"), ((F.col("doc_id") + k) % 300).cast("string")) for k in n])
    return records.citation_lane(seeds, d.select(F.col("doc_id").alias("id"), near(1, 2, 3).alias("cited_by"), near(3, 4).alias("references")))


@query("lane_counts", "SELECT 'odd' AS lane, count(*) AS n FROM documents WHERE doc_id % 2 = 1 UNION ALL SELECT 'long', count(*) FROM documents WHERE n_chars > 2000")
def lane_counts(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    return records.lanes(odd=d.where("doc_id % 2 = 1"), long=d.where("n_chars > 2000"))[1]


@query("run_funnel", f"WITH {PUBS} SELECT count(*) AS raw, count(*) FILTER (WHERE published_date >= DATE '2024-02-01') AS in_window, count(*) FILTER (WHERE length(raw_text) > 200) AS usable, count(*) FILTER (WHERE score >= 50) AS evaluated FROM pubs")
def run_funnel(spark, sf_dir):
    return records.funnel_counts(pubs(spark, sf_dir), {"in_window": F.expr("published_date >= date'2024-02-01'"), "usable": F.length("raw_text") > 200, "evaluated": F.coalesce(F.col("score") >= 50, F.lit(False))})


@query("pdf_finalize", "SELECT CASE WHEN doc_id % 4 = 0 THEN 'attached' WHEN doc_id % 3 = 2 THEN 'done' ELSE 'cutoff' END AS status, count(*) AS n FROM documents GROUP BY 1")
def pdf_finalize(spark, sf_dir):
    i = F.col("doc_id") % 3
    d = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.when(i == 0, "pending").when(i == 1, "uploaded").otherwise("done").alias("status"))
    return attachments.finalize(d, d.where("id % 4 = 0"))[1]


@query("review_pairs", "WITH r AS (SELECT conv_id, max(CASE WHEN role = 'user' THEN length(text) END) AS u, max(CASE WHEN role = 'assistant' THEN length(text) END) AS a FROM conversations GROUP BY 1) SELECT conv_id, u IS NOT NULL AND a IS NOT NULL AS complete FROM r")
def review_pairs(spark, sf_dir):
    c = table(spark, sf_dir, "conversations").select("conv_id", F.col("role").alias("reviewer"), F.length("text").alias("answer"))
    return external.pair_reviews(c, "conv_id", ("user", "assistant")).select("conv_id", "complete")


@query("summary_read_through", "WITH s AS (SELECT CASE WHEN l.doc_id IS NOT NULL THEN 'hit' WHEN d.n_chars > 500 THEN 'generated' ELSE 'failed' END AS origin FROM documents d LEFT JOIN labels l USING (doc_id)) SELECT origin, count(*) AS n FROM s GROUP BY 1")
def summary_read_through(spark, sf_dir):
    cache = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").cast("string").alias("summary"))
    return external.read_through(table(spark, sf_dir, "documents"), cache, "doc_id", "summary", F.when(F.col("n_chars") > 500, F.substring("text", 1, 50)))[1]
