"""Results that differed from their SQL, and steps that grew faster than their input, each against a plain version."""

import hashlib
import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from folio.functions import gate, jsonx, text
from folio.operators import external, match, nearest, runs
from folio.plans import documents, flows
from folio.streaming import events as streams


def over(spark, f, values):
    d = spark.createDataFrame(list(enumerate(values)), "i int, v string").coalesce(1)
    return [r["o"] for r in d.select("i", f(F.col("v")).alias("o")).orderBy("i").collect()]


def test_capital_is_one_letter(spark):
    assert over(spark, text.clean_reason, ["ßieung", "éa", "ŉa", "a"]) == ["ẞieung", "Éa", "ŉa", "A"]


def test_rerank_folds_letters_with_two_capitals(spark):
    c = spark.createDataFrame([(1, "Maß ßßß"), (2, "Other")], "id long, title string")
    r = spark.createDataFrame([(1, "MASS SSSSSS", 80, 2), (2, "zzzz", 99, 1)], "pub_id long, title string, llm_score int, llm_rank int")
    assert {x["id"]: (x["llm_score"], x["llm_rank"]) for x in match.rerank(c, r).collect()} == {1: (80, 2), 2: (0, 999)}


def test_quantiles_of_many_values_are_exact(spark):
    r = random.Random(3)
    rows = [(d, round(r.gauss(50, 20), 3)) for d in range(3) for _ in range(9000)] + [(0, None), (1, None)]
    d = spark.createDataFrame(rows, "run int, value double")
    counts = runs.run_counts(d, "run", "value").withColumn("by", F.when(F.col("run") < 2, "a").otherwise("b"))
    got = {x["by"]: (x["runs"], x["n"], x["p50"], x["p95"]) for x in runs.counted_quantiles(counts, "run", "by", {"p50": 0.5, "p95": 0.95}).collect()}
    for by, days in (("a", (0, 1)), ("b", (2,))):
        v = sorted(x for day, x in rows if day in days and x is not None)
        assert got[by] == (len(days), sum(day in days for day, _ in rows), v[-(-len(v) // 2) - 1], v[-(-len(v) * 95 // 100) - 1])


def test_papers_keep_line_breaks_blanks_and_odd_sources(spark, tmp_path):
    texts = ["a\nb", "  ", 'q"', None, "\\", "x\r\ny", "", '"', "c\rd", ",", "e\n", " f"] * 6
    d = spark.createDataFrame([(i, t, "en", None if i % 5 == 0 else 's"\\', 1) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    d.write.parquet(str(tmp_path / "documents.parquet"))
    got = {x["id"]: x["summary"] for x in flows.papers_from_csv(spark, str(tmp_path)).collect()}
    side = lambda i: None if i % 5 == 0 else "molw"[i % 6] + ' s"\\'
    assert got == {str(i): side(i) if i % 6 < 4 else t or None for i, t in enumerate(texts)}


def test_small_chunks_are_no_groups(spark):
    d = spark.createDataFrame([(i,) for i in range(200)], "id long")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")  # chunks go on from part to part
    try:
        told = external.deliver(d, "id", "long", ["id"], lambda rows, mark: None, size=5, marked=True)
        assert "FlatMapGroups" not in told._jdf.queryExecution().toString()
        got = {r["id"]: (r["chunk"], r["mark"], r["attempts"], r["error"]) for r in told.collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    mark = lambda c: hashlib.sha256("\n".join(str(i) for i in range(5 * c, 5 * c + 5)).encode()).hexdigest()
    assert got == {i: (i // 5, mark(i // 5), 1, None) for i in range(200)}


def test_a_batch_with_too_few_answers_is_an_error_of_its_rows(spark):
    d = spark.createDataFrame([(i,) for i in range(6)], "id long").coalesce(1)
    got = {r["id"]: (r["answer"], r["error"] is None) for r in external.call(d, "id", "long", ["id"], lambda rows: [x for x in rows if x["id"] != 3], batch=2).collect()}
    assert got == {i: (None, False) if i in (2, 3) else (f'{{"id": {i}}}', True) for i in range(6)}


def test_an_answer_is_searched_once(spark):
    d = spark.createDataFrame([('```\n{"final_relevancy_score": 7, "final_relevancy_rating_0_3": 1, "final_relevancy_reason": "r", "relevancy_score": 3, "relevancy_reason": "q",}\n```',)], "a string")
    for f in (jsonx.evaluation, jsonx.review, lambda c: jsonx.scored(c, "relevancy_score", "relevancy_reason")):
        plan = d.select(f(F.col("a")).alias("e"))
        assert plan._jdf.queryExecution().optimizedPlan().toString().count("regexp_extract") == 1
    assert d.select(jsonx.evaluation(F.col("a"))["final_score"]).first()[0] == 7


def test_audit_works_the_gate_out_once(spark):
    d = spark.createDataFrame([(i, f"title {i}", "text" * (i % 3), "src1") for i in range(50)], "id long, title string, raw_text string, source string")
    audited = gate.audit(gate.gate(d, venue=F.col("source")), "id", 0.1)
    assert "regexp_replace" not in audited._jdf.queryExecution().optimizedPlan().toString()
    assert audited.where("audit_selected").count() == int(audited.where("gate_bucket = 'low'").count() * 0.1)


def test_limit_of_keys_in_shards_with_a_null_key(spark, tmp_path):
    start = datetime(2024, 1, 1)
    rows = [(i, start + timedelta(minutes=7 * i), None if i % 4 == 0 else i % 3, "e", 1.0, "{}") for i in range(120)]
    for b in range(3):
        part = spark.createDataFrame(rows[40 * b : 40 * b + 40], streams.EVENTS.replace("timestamp_ntz", "timestamp")).withColumn("ts", F.col("ts").cast("timestamp_ntz"))
        part.coalesce(1).write.mode("append").parquet(str(tmp_path / "e"))
    s = streams.rate_limited(streams.event_stream(spark, str(tmp_path / "e"), 1), "user_id", 2, 3600, shards=2)
    got = {r["event_id"]: (r["user_id"], r["accepted"]) for r in streams.run_to_table(s, str(tmp_path / "o"), str(tmp_path / "c")).collect()}
    want, taken = {}, {}
    for i, t, u, *_ in rows:
        near = [x for x in taken.setdefault(u, []) if x > t - timedelta(hours=1)]
        want[i] = (u, len(near) < 2)
        taken[u] = near + [t] * want[i][1]
    assert got == want


def test_texts_are_cut_into_phrases_once(spark, sf):
    plan = documents.benchmark_in_documents(spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(") == 2  # once a table
    assert over(spark, text.trigrams, ["a b  C d", "a b", "", None]) == [["a b c", "b c d"], [], [], None]


def test_title_blocks_are_tasks_of_their_own(spark):
    d = spark.createDataFrame([(i, f"title {i} of many") for i in range(40)], "id long, title string")
    got = nearest.nearest_titles(d.where("id < 3").withColumnRenamed("id", "a"), d.withColumnRenamed("id", "b"), "a", "b", k=1)
    assert got._jdf.queryExecution().optimizedPlan().toString().count("RepartitionByExpression") == 2
    assert {(r["a"], r["b"], r["ratio"]) for r in got.collect()} == {(i, i, 1.0) for i in range(3)}
