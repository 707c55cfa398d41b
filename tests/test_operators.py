"""Joins, merges, rankings, metrics, search, streaming, sources and sinks."""

from __future__ import annotations

import json
from datetime import datetime

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from folio.operators import attachments, change, dedupe, external, match, metrics, rank, records, search
from folio.sources import catalog, readers, schema, writers
from folio.streaming import events as streams


def test_dedupe(spark):
    d = spark.createDataFrame(
        [
            (1, "A title", "https://doi.org/10.1000/X.", "", ["Ann"], "2024-01-01", "s1"), (2, "Other", "", "see 10.1000/x", ["Bob"], "2023", "s2"), (3, "Same one", "u", "", ["C. D"], "2024", "s1"),
            (4, "same, one!", "v", "", ["c d"], "2024-05", "s3"), (5, "solo", "https://site.org/abc", "", None, None, "s1"), (6, "SOLO", "", "", None, None, "s1"), (7, "x", "https://pubmed.ncbi.nlm.nih.gov/99", "", None, None, "s2"),
        ],
        "seq int, title string, url string, raw_text string, authors array<string>, date string, source string",
    )
    k = d.withColumn("key", dedupe.dedupe_key(*[F.col(c) for c in ("title", "url", "raw_text", "authors", "date")]))
    keys = {r["seq"]: r["key"] for r in k.collect()}
    assert keys == {1: "doi:10.1000/x", 2: "doi:10.1000/x", 3: "composite:same one|c d|2024", 4: "composite:same one|c d|2024", 5: "url:https://site.org/abc", 6: "title:solo", 7: "pmid:99"}
    out = {r["key"]: r for r in dedupe.deduplicate(k, "key", "seq").collect()}
    assert out["doi:10.1000/x"]["title"] == "A title" and out["doi:10.1000/x"]["source_names"] == ["s1", "s2"] and out["doi:10.1000/x"]["n_merged"] == 1
    s = dedupe.dedupe_stats(k, "key").first()
    assert (s["total_input"], s["total_output"], s["total_merged"]) == (7, 5, 2)


ids = st.sets(st.integers(0, 30), max_size=20)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(cur=ids, prev=ids)
def test_snapshot_counts(spark, cur, prev):
    f = lambda s: spark.createDataFrame([(x,) for x in s], "id int")
    r = change.snapshot_counts(change.merge_snapshot(f(cur), f(prev), "id")).first()
    assert r["kept"] + r["updated"] == len(prev) and r["added"] == len(cur - prev) and r["total"] == len(cur | prev)
    assert change.merge_snapshot(f(cur), f(prev), "id", "replace").count() == len(cur)


def test_upsert_is_idempotent(spark):
    old = spark.createDataFrame([(1, "a", 1), (2, "b", None)], "id int, u string, n int")
    new = spark.createDataFrame([(2, None, 5), (3, "c", 6)], "id int, u string, n int")
    once = change.upsert(old, new, ["id"], {"u": "fill", "n": "take"})
    got = {r["id"]: (r["u"], r["n"], r["merge_kind"]) for r in once.collect()}
    assert got == {1: ("a", 1, "untouched"), 2: ("b", 5, "updated"), 3: ("c", 6, "inserted")}
    twice = change.upsert(once.drop("merge_kind"), new, ["id"], {"u": "fill", "n": "take"}).drop("merge_kind")
    assert sorted(twice.collect()) == sorted(once.drop("merge_kind").collect())


def test_votes_and_status(spark):
    v = spark.createDataFrame([(1, "x", 1, 1), (1, "x", 2, 2), (1, None, 3, 3), (1, None, 4, 4)], "pub int, ip string, vote int, at int")
    assert sorted(r["vote"] for r in change.votes(v, ["pub"], "ip", "at").collect()) == [2, 3, 4]
    s = spark.createDataFrame([("pending",), ("attached",)], "status string")
    assert [r[0] for r in change.transition(s, "status", "cutoff", ("pending", "uploaded")).collect()] == ["cutoff", "attached"]


def test_cascade(spark):
    left = spark.createDataFrame([(1, "d1", "t1"), (2, None, "t1"), (3, "", "t9")], "k int, doi string, title string")
    right = spark.createDataFrame([("d1", "zz", 10, 1), ("d1", "t1", 11, 2), ("", "t9", 12, 3)], "doi string, title string, score int, at int")
    got = {r["k"]: (r["score"], r["match_key"]) for r in match.cascade(left, right, ["doi", "title"], "score", "at").collect()}
    assert got == {1: (11, "doi"), 2: (11, "title"), 3: (12, "title")}
    assert match.cascade(left, right, ["doi"], "score", "at", keep="oldest").where("k = 1").first()["score"] == 10
    assert "CartesianProduct" not in match.cascade(left, right, ["doi", "title"], "score", "at")._jdf.queryExecution().toString()


def test_similar_titles_against_all_pairs(spark):
    rng = np.random.default_rng(3)
    words = [f"w{k}" for k in range(30)]
    titles = []
    for _ in range(60):
        t = list(rng.choice(words, 14, replace=False))
        titles.append(" ".join(t))
        if rng.random() < 0.6:
            t[int(rng.integers(14))] = "new"
            titles.append(" ".join(t))
    d = spark.createDataFrame(list(enumerate(titles)), "id int, title string")
    got = {(r["a_id"], r["b_id"]) for r in match.similar_titles(d, d, "id", "id", least=0.7).collect()}
    sets = [set(t.split()) for t in titles]
    assert got == {(i, j) for i, a in enumerate(sets) for j, b in enumerate(sets) if len(a & b) / len(a | b) > 0.7}


def test_merge_items_by_components(spark):
    items = spark.createDataFrame([(1, None, [1]), (2, "t", [2]), (3, "u", []), (9, "z", [5])], "id int, title string, labels array<int>")
    edges = spark.createDataFrame([(2, 1), (2, 3)], "a_id int, b_id int")
    got = {r["id"]: (r["title"], r["labels"]) for r in match.merge_items(items, "id", edges).collect()}
    assert got == {1: ("t", [1, 2]), 9: ("z", [5])}


def test_rerank(spark):
    c = spark.createDataFrame([("a", "A study of things"), ("b", "Other work"), ("c", "Third")], "id string, title string")
    r = spark.createDataFrame([("a", "a  STUDY of things.", 50, 3), ("a", "A study of thingz", 60, 2), ("b", "Cross wired", 99, 1), ("x", "A study of things", 9, 9)], "pub_id string, title string, llm_score int, llm_rank int")
    got = {x["id"]: (x["llm_score"], x["llm_rank"]) for x in match.rerank(c, r).collect()}
    assert got == {"a": (60, 2), "b": (0, 999), "c": (0, 999)}


def test_digest_order(spark):
    d = spark.createDataFrame([(1, None, datetime(2024, 1, 2), "b"), (2, 0, datetime(2024, 1, 1), "a"), (3, 5, datetime(2024, 1, 1, 9), "B"), (4, 5, datetime(2024, 1, 1, 1), "a"), (5, 5, None, "a")], "id int, score int, ts timestamp, title string")
    r = rank.digest(d, "score", "ts", "title", "id", top=2, mentions=3)
    assert [x["id"] for x in r.orderBy("rank").collect()] == [4, 3, 5, 2, 1]
    assert [x["section"] for x in r.orderBy("rank").collect()] == ["must_read"] * 2 + ["honorable"] * 3
    assert rank.digest(d, "score", "ts", "title", "id", least=5).count() == 3
    assert "TakeOrderedAndProject" in d.orderBy("id").limit(2)._jdf.queryExecution().toString()


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(ranked=st.lists(st.integers(0, 12), max_size=12))
def test_repair_is_a_permutation(spark, ranked):
    c = spark.createDataFrame([(k, k) for k in range(8)], "id int, seq int")
    r = spark.createDataFrame(list(enumerate(ranked)), "pos int, id int")
    got = [x["id"] for x in rank.repair_ranking(c, r).orderBy("rank").collect()]
    known = list(dict.fromkeys(x for x in ranked if x < 8))
    assert got == known + [k for k in range(8) if k not in known]


def test_budget_caps_and_blend(spark):
    d = spark.createDataFrame([("w", 1, 50), ("w", 2, 60), ("w", 3, 40), ("w", 4, None), ("v", 1, 200)], "week string, r int, size int")
    got = {(x["week"], x["r"]): x["attached"] for x in rank.byte_budget(d, "week", "r", "size", 100).collect()}
    assert got == {("w", 1): True, ("w", 2): False, ("w", 3): True, ("w", 4): False, ("v", 1): False}
    s = spark.createDataFrame([(k, "a" if k < 5 else "b") for k in range(7)], "id int, source string")
    assert rank.per_source_cap(s, "source", [F.col("id").desc()], 2).count() == 4
    assert {r["source"]: r["overflow"] for r in rank.overflow(s, "source", 3).collect()} == {"a": 2, "b": 0}
    assert rank.cap_flag(s, [F.col("id").desc()], 3, "id").where("skipped").count() == 4
    b = spark.createDataFrame([(100, 5), (100, 50)], "h int, l int").select(rank.blend(F.col("h"), F.col("l")).alias("x"))
    assert [r["x"] for r in b.collect()] == [5.0, pytest.approx(220.0)]
    m = spark.createDataFrame([(1, 3.0), (2, 3.0)], "id int, s double")
    assert [r["normalized"] for r in rank.minmax(m, "s").collect()] == [50.0, 50.0]


def test_metrics(spark):
    rows = [(1, 10.0, 0), (2, 20.0, 1), (3, 20.0, 3), (4, 90.0, 3), (5, None, 2)]
    d = spark.createDataFrame(rows, "id int, score double, rating int")
    r = metrics.spearman(d, "score", "rating").first()
    a, b = [1, 2.5, 2.5, 4], [1, 2, 3.5, 3.5]
    assert r["n"] == 4 and r["rho"] == pytest.approx(np.corrcoef(a, b)[0, 1])
    assert metrics.spearman(d.limit(2), "score", "rating").first()["rho"] is None
    m = metrics.ranking_metrics(d, "score", "rating", "id", ks=(2,)).first()
    dcg, ideal = 7 + 1 / np.log2(3), 7 + 7 / np.log2(3)
    assert m["ndcg_2"] == pytest.approx(dcg / ideal) and m["recall_2"] == 0.5
    assert metrics.ranking_metrics(d.where("id = 1"), "score", "rating", "id", ks=(2,)).first()["recall_2"] is None
    l = spark.createDataFrame([(1, 3), (1, 3), (1, 0), (1, 0), (2, None)], "k int, r int")
    got = metrics.ratings(l, "k", "r").collect()
    assert [(x["k"], x["majority_rating"], x["mean_rating"]) for x in got] == [(1, 3, 1.5)]
    cats = spark.createDataFrame([("NCBI",), ("medRxiv",), ("Nature",), (None,)], "s string").select(metrics.source_category(F.col("s")).alias("c"))
    assert [r["c"] for r in cats.collect()] == ["pubmed", "preprint", "journal", "other"]


def test_calibration(spark):
    assert metrics.pool(np.array([5.0, 6, 1]), np.ones(3)).tolist() == [4, 4, 4]
    near = metrics.pool_pairwise(np.array([5.0, 6, 1]))
    assert near.tolist() != [4, 4, 4] and np.allclose(near, 4, atol=0.8)
    d = spark.createDataFrame([(10, 0), (30, 1), (50, 1), (60, 0), (80, 3), (None, 2)], "s int, r int")
    c = metrics.Calibrator.fit(d, "s", "r")
    assert c.monotone() and c.bounded() and metrics.Calibrator.from_json(c.to_json()).ys == c.ys
    t = [r["calibrated"] for r in c.table(d).orderBy("score").collect()]
    assert len(t) == 11 and t == sorted(t) and t[-1] == pytest.approx(100)
    assert spark.range(1).select(c.column(F.lit(None).cast("int")).alias("x")).first()["x"] is None
    with pytest.raises(ValueError, match="five"):
        metrics.Calibrator.fit(d.limit(2), "s", "r")


def test_search(spark):
    v = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, [1.0, 1.0]), (4, [0.0, 0.0])], "id long, v array<float>")
    got = search.top_k(v, [1.0, 0.0], "id", "v", 4).collect()
    assert [r["id"] for r in got] == [1, 3, 2, 4] and got[1]["similarity"] == pytest.approx(0.707107)
    rows = spark.createDataFrame([(1, "a"), (3, "b")], "id long, t string")
    assert [r["id"] for r in search.search(v, rows, [1.0, 0.0], "id", "v", 99, 0.5).collect()] == [1, 3]

    def embed(texts):
        if "bad text here" in texts:
            raise RuntimeError("no")
        return [[float(len(t))] for t in texts]

    t = spark.createDataFrame([(1, "has one"), (5, "long enough text"), (6, "short"), (7, "bad text here")], "id long, t string").coalesce(1)
    got = {r["id"]: r["embedding"] for r in search.backfill(t, v, "id", F.col("t"), embed, batch=1).collect()}
    assert got == {5: [16.0], 7: None}


def test_align_and_sheet(spark):
    d = spark.createDataFrame([("7", ["a", "b"])], "pub_id string, authors array<string>")
    got = schema.align(d, schema.PUBLICATION, {"id": schema.ID_NAMES}).first()
    assert got["id"] == "7" and got["authors"] == ["a", "b"] and got["title"] is None
    row = schema.sheet_row(d).first()
    assert len(row) == 24 and row["authors"] == "a; b" and row["id"] == ""
    with pytest.raises(ValueError, match="columns"):
        schema.check_header(d, schema.SHEET)


def test_sources_and_sinks(spark, tmp_path):
    as_of = datetime(2025, 2, 1)
    (tmp_path / "feed.xml").write_text("<rss><channel><item><title>A &lt;b&gt;x&lt;/b&gt;</title><link>https://x.org/1</link><pubDate>Mon, 06 Jan 2025 10:00:00 +0000</pubDate><description>d</description></item><item><title>B</title><link>https://x.org/2</link></item></channel></rss>")
    (tmp_path / "pm.json").write_text(json.dumps({"result": {"11111111": {"uid": "11111111", "title": "T.", "pubdate": "2025 Jan 5", "authors": [{"name": "Z"}], "fulljournalname": "J"}, "22222222": {"uid": "22222222", "title": "Far", "pubdate": "2031 Jan 5", "authors": []}}}))
    rows, stats = readers.all_sources(spark, [{"type": "rss", "path": str(tmp_path / "feed.xml"), "name": "feed"}, {"type": "pubmed", "path": str(tmp_path / "pm.json"), "name": "pm"}, {"type": "nope", "path": "", "name": "bad"}], as_of)
    got = {r["url"]: r for r in rows.collect()}
    assert got["https://x.org/1"]["title"] == "A x" and got["https://x.org/2"]["missing_date"] and got["https://pubmed.ncbi.nlm.nih.gov/11111111/"]["title"] == "T"
    assert got["https://pubmed.ncbi.nlm.nih.gov/22222222/"]["published_date"] is None
    by = {r["name"]: r for r in stats.collect()}
    assert by["feed"]["kept"] == 2 and by["feed"]["missing_date_count"] == 1 and by["bad"]["status"] == "error"
    changes = spark.createDataFrame([("1", "T", "NEW", ["a", "b"]), ("2", "U", "UNCHANGED", [])], "id string, title string, status string, source_names array<string>")
    writers.new_rows_csv(changes, str(tmp_path / "new"))
    back = readers.papers_csv(spark, str(tmp_path / "new"))
    assert [(r["id"], r["source_names"]) for r in back.collect()] == [("1", "a;b")] and tuple(back.columns) == writers.NEW_COLUMNS
    (tmp_path / "s.json").write_text(json.dumps({"1": "sum"}))
    assert readers.papers_csv(spark, str(tmp_path / "new"), str(tmp_path / "s.json")).first()["summary"] == "sum"
    (tmp_path / "l.jsonl").write_text('{"a": 1}\n\nbad\n{"a": 2}\n')
    assert sorted(r["a"] for r in readers.json_lines(spark, str(tmp_path / "l.jsonl"), "a int").collect()) == [1, 2]
    (tmp_path / "gt.json").write_text(json.dumps(["10.1000/x9", {"type": "title", "value": "My title", "rating": 2}, {"title": "F", "doi": "10.2000/y", "rank": 80}]))
    gt = readers.ground_truth(spark, str(tmp_path / "gt.json")).collect()
    assert [(r["title"], r["doi"], r["rating"]) for r in gt] == [("10.1000/x9", "10.1000/x9", 3), ("My title", None, 2), ("F", "10.2000/y", 3)]
    (tmp_path / "survey.csv").write_text('publication_id,title,source,human_score,reasoning,evaluator\np1,T,,3,"multi\nline",ann\np1,T,src,80,ok,bob\n,Only Title,s,1,,cy\np2,X,s,bad,,dd\n')
    s = {r["key"]: r for r in readers.survey(spark, str(tmp_path / "survey.csv")).collect()}
    assert set(s) == {"p1", "only title"} and s["p1"]["source"] == "src" and len(s["p1"]["labels"]) == 2
    good, bad = writers.quarantine(changes, {"title": F.col("title") != "U"})
    assert good.count() == 1 and bad.first()["reject_reason"] == "title"
    writers.manifest(changes.agg(F.count(F.lit(1)).alias("n")), str(tmp_path / "man"), run_id="r1")
    assert spark.read.json(str(tmp_path / "man")).first()["counts"]["n"] == 2
    with pytest.raises(ValueError, match="unsupported"):
        readers.format_of("x.xls")


def test_streams_equal_batch(spark, sf, tmp_path):
    path = str(tmp_path / "ev")
    batch = spark.read.parquet(f"{sf}/events.parquet")
    batch.unionByName(batch.limit(50)).repartition(3).write.parquet(path)
    s = lambda: streams.event_stream(spark, path)
    got = streams.run_to_memory(streams.deduplicated(s(), delay="60 days"), "dedup")
    assert got.count() == batch.count()
    weeks = streams.run_to_memory(streams.tumbling_weeks(s()), "weeks", "complete")
    want = batch.unionByName(batch.limit(50)).groupBy(F.window("ts", "7 days", startTime="4 days"), "event_type").count()
    assert {(r["event_type"], r["window"]["start"], r["n"]) for r in weeks.collect()} == {(r["event_type"], r["window"]["start"], r["count"]) for r in want.collect()}
    assert streams.run_to_memory(streams.new_ids(s()), "seen").count() == batch.select("user_id").distinct().count()


def test_rate_limit(spark, tmp_path):
    rows = [(k, datetime(2024, 1, 1, 0, 0, k), 1, "x", 1.0, "{}") for k in range(15)] + [(99, datetime(2024, 1, 1, 0, 1, 1), 1, "x", 1.0, "{}")]
    spark.createDataFrame(rows, streams.EVENTS).coalesce(1).write.parquet(str(tmp_path / "e"))
    got = streams.run_to_memory(streams.rate_limited(streams.event_stream(spark, str(tmp_path / "e"))), "limited").collect()
    assert sorted(r["event_id"] for r in got if r["accepted"]) == [*range(10), 99]


def test_records(spark):
    d = spark.createDataFrame([("1", "Breath screening", "text. " * 400, "Nature Reviews", 90), ("2", "", "x", "", 95), ("3", "low", "x", "", 10)], "id string, title string, raw_text string, venue string, score int")
    f = records.facts(d).collect()
    assert [r["source_id"] for r in f] == ["1"] and f[0]["tags"] == ["scientific", "breath-analysis", "early-detection", "nature", "high-relevancy"] and len(f[0]["fact"]) <= 1200
    item = records.canonical_item(spark.createDataFrame([("", " A-b ", "doi:10.1000/X", "PMID: 7")], "publication_id string, title string, doi string, pmid string")).first()
    assert (item["title_key"], item["doi"], item["pmid"], len(item["publication_id"])) == ("a-b", "10.1000/x", "7", 16)
    b = records.brief(spark.createDataFrame([(2, "b", "u", "s"), (1, "a", "u", "s")], "rank int, title string, url string, source string"), "science", 1).first()
    assert b["status"] == "ok" and [i["title"] for i in b["items"]] == ["a"]
    assert records.brief(spark.createDataFrame([], "rank int, title string, url string, source string"), "science").first()["status"] == "empty"
    off = spark.createDataFrame([("a stock market tale",), ("market screening",)], "t string").select(records.off_topic(F.col("t"), {"money": ("stock", "market")}, ("screening",)).alias("x"))
    assert [r["x"] for r in off.collect()] == [["money:stock"], []]
    r = records.reject_reasons(spark.createDataFrame([("d", None), (None, "u"), ("d", "u")], "day string, url string"), {"date": F.col("day").isNotNull(), "url": F.col("url").isNotNull()})
    assert {x["reason"]: x["n"] for x in r.collect()} == {"date": 1, "url": 1, "ok": 1}


def test_attachments(spark):
    locations = spark.createDataFrame([([("publisher", "p"), ("repository", "r")],), ([("publisher", "p")],), ([("repository", "")],)], "l array<struct<host_type:string,url:string>>")
    assert [r["u"] for r in locations.select(attachments.best_location(F.col("l"))["url"].alias("u")).collect()] == ["r", "p", None]
    lic = spark.createDataFrame([([("am", "x"), ("vor", "https://creativecommons.org/licenses/by/4.0")],)], "l array<struct<content_version:string,url:string>>")
    assert lic.select(attachments.best_licence(F.col("l")).alias("x")).first()["x"] == "cc-by"
    pdf = spark.createDataFrame([(bytearray(b"%PDF-" + b"x" * 2000),), (bytearray(b"<html>" + b"x" * 2000),), (bytearray(b"%PDF"),)], "c binary")
    assert [r["x"] for r in pdf.select(attachments.is_pdf(F.col("c")).alias("x")).collect()] == [True, False, False]


def test_external_calls(spark):
    def score(rows):
        if any(r["t"] == "bad" for r in rows):
            raise RuntimeError("refused")
        return [{"n": len(r["t"])} for r in rows]

    d = spark.createDataFrame([(1, "abc"), (2, "bad"), (3, "de")], "id long, t string").coalesce(1)
    got = external.call(d, "id", "long", ["t"], score, batch=1)
    assert {r["id"]: (r["answer"], r["error"]) for r in got.collect()} == {1: ('{"n": 3}', None), 2: (None, "refused"), 3: ('{"n": 2}', None)}
    assert [r["id"] for r in external.unanswered(d, got, ["id"]).collect()] == [2]


def test_catalog(spark):
    rows = [(1, None, datetime(2024, 1, 1)), (2, "", datetime(2024, 1, 1)), (3, "", datetime(2024, 1, 30)), (4, "u", datetime(2024, 1, 30))]
    d = spark.createDataFrame(rows, "id int, canonical_url string, created_at timestamp")
    find = lambda **k: {r["id"] for r in catalog.missing_canonical(d, datetime(2024, 2, 1), 7, **k).collect()}
    assert find() == {3} and find(legacy_precedence=True) == {1, 3}
    f = spark.createDataFrame([(1, '[{"id": "a", "n": 1}]'), (2, '[{"id": "a", "n": 2}, {"id": "b", "n": 3}]')], "at int, j string")
    assert {r["id"]: r["n"] for r in catalog.exploded_must_reads(f, "j", "at", "id: string, n: int").collect()} == {"a": 2, "b": 3}
