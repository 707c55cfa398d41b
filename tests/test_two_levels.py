"""Ranks, repairs, matches and deliveries against plain versions."""

from __future__ import annotations

import difflib

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from folio.functions import dates, identifiers, rules, text
from folio.functions.extract import sequence_ratio
from folio.operators import change, external, match, metrics, rank, records
from folio.sources import catalog, readers


@pytest.fixture(scope="module")
def numbers():
    rng = np.random.default_rng(2)
    return [(i, float(v)) for i, v in enumerate(rng.integers(0, 40, 300))]


def test_ranks_in_ranges(spark, numbers):
    d = spark.createDataFrame(numbers, "id long, v double").repartition(5)
    want = pd.Series([v for _, v in numbers]).rank().tolist()
    got = {r["id"]: r["r"] for r in metrics.average_ranks(d, "v", "r").collect()}
    assert [got[i] for i in range(300)] == want
    order = {i: k for k, (i, _) in enumerate(sorted(numbers, key=lambda x: (x[1], x[0])), 1)}
    assert {r["id"]: r["r"] for r in metrics.ordinal_ranks(d, "v", "id", "r").collect()} == order
    grouped = d.withColumn("g", F.col("id") % 3)
    got = {r["id"]: r["r"] for r in metrics.average_ranks(grouped, "v", "r", "g").collect()}
    for g in range(3):
        part = [(i, v) for i, v in numbers if i % 3 == g]
        assert [got[i] for i, _ in part] == pd.Series([v for _, v in part]).rank().tolist()
    assert metrics.average_ranks(d.limit(0), "v", "r").count() == 0


def test_repair_and_checks(spark, numbers):
    c = spark.createDataFrame([(i, i) for i in range(60)], "id long, seq long")
    pos = [(i, (i * 37) % 50) for i in range(0, 60, 2)]
    got = {r["id"]: (r["rank"], r["appended"]) for r in rank.repair_ranking(c, spark.createDataFrame(pos + pos[:3], "id long, pos long")).collect()}
    known = [i for i, _ in sorted(pos, key=lambda x: (x[1], x[0]))]
    assert [i for i, _ in sorted(got.items(), key=lambda x: x[1][0])] == known + list(range(1, 60, 2))
    assert all(got[i][1] == (i % 2 == 1) for i in range(60))
    d = spark.createDataFrame(numbers, "rank long, score double")
    v = [x for _, x in numbers]
    for ranges in (2, 7, 256):
        r = rank.ranking_checks(d, "rank", "score", 20, 35, ranges).first()
        assert r["out_of_order"] == sum(b > a for a, b in zip(v, v[1:], strict=False))
        assert r["high_excluded"] == sum(x >= 35 for i, x in numbers if i > 20)


def test_budget_walk(spark):
    rows = [("a", k, s) for k, s in enumerate([5, 9, 3, 1, 4, 2])] + [("b", 0, 11), ("b", 1, None), ("b", 2, 10)]
    got = {(r["g"], r["k"]): r["attached"] for r in rank.byte_budget(spark.createDataFrame(rows, "g string, k int, s long"), "g", "k", "s", 10).collect()}
    assert [got["a", k] for k in range(6)] == [True, False, True, True, False, False]
    assert [got["b", k] for k in range(3)] == [False, False, True]


def test_same_items_are_stars(spark):
    rows = [(1, "10.1/A", None, "x"), (2, "10.1/a", None, "y"), (3, None, "7", "a title of more than twenty letters"), (4, None, "7", None), (5, None, None, "A title, of more than twenty letters!")] + [(k, None, None, "the very same words again and again here") for k in range(10, 60)]
    d = spark.createDataFrame(rows, "id long, doi string, pmid string, title string")
    e = match.same_items(d, "id", "doi", "pmid")
    assert e.count() <= 60  # a value that fifty rows share is a star, not their pairs
    label = {r["id"]: r["label"] for r in match.components(e, "a_id", "b_id").collect()}
    assert {label[i] for i in (1, 2)} == {1} and {label[i] for i in (3, 4, 5)} == {3} and {label[i] for i in range(10, 60)} == {10}


def test_components_that_are_not_final_are_an_error(spark):
    chain = spark.createDataFrame([(k, k + 1) for k in range(64)], "a long, b long")
    with pytest.raises(RuntimeError):
        match.components(chain, "a", "b", rounds=2)


def test_short_words_stand_alone(spark):
    words = ("ai", "voc", "a1_b", "e-nose", "screening", "x-y")
    texts = ["said the ai.", "voc", "avoc", "no e-nose: rescreening", "a1_b!", "AI", "x-y", "ax-y", "ü ai-voc", ""]
    d = spark.createDataFrame([(t,) for t in texts], "t string")
    one = d.select(text.matches(F.col("t"), words).alias("m"), *[text.has_word(F.col("t"), w).alias(f"h{k}") for k, w in enumerate(words)]).collect()
    assert [r["m"] for r in one] == [[w for k, w in enumerate(words) if r[f"h{k}"]] for r in one]


def test_page_dates_and_identifiers(spark):
    cases = {"2024-03-05": "2024-03-05T00:00:00", "2024-03-05T10:00:00Z": "2024-03-05T10:00:00Z", "2023/7/4": "2023-07-04T00:00:00", "March 9, 2022": "2022-03-09T00:00:00", "Sep 1 2021": "2021-09-01T00:00:00", "7 dec 2020": "2020-12-07T00:00:00", "Smarch 1, 2020": None, "": None}
    d = spark.createDataFrame([(k,) for k in cases], "c string")
    assert [r[0] for r in d.select(dates.page_date(F.col("c"))).collect()] == list(cases.values())
    urls = ["https://doi.org/10.1/AB/", "https://x.org/doi/10.1/y z", "http://a.b/10.1234/c", "https://www.nature.com/articles/10.1038/s1?x", "no"]
    u = spark.createDataFrame([(k,) for k in urls], "u string")
    assert [r[0] for r in u.select(identifiers.doi_in_url(F.col("u"))).collect()] == ["10.1/ab", "10.1/y", "10.1234/c", "10.1038/s1?x", None]
    assert [r[0] for r in u.select(identifiers.publisher_doi(F.col("u"))).collect()] == [None, None, None, "10.1038/s1", None]
    s = spark.createDataFrame([(80, True), (None, True), (80, False), (10, True)], "s int, p boolean")
    assert [r[0] for r in s.select(rules.credibility(F.col("s"), F.col("p"))).collect()] == [65, None, 80, 10]


def test_sequence_ratio(spark):
    pairs = [("a title of a paper", "a title of the paper"), ("", "x"), ("same", "same"), ("abc", "xyz")]
    d = spark.createDataFrame([*pairs, (None, "a")], "a string, b string")
    assert [r[0] for r in d.select(sequence_ratio("a", "b")).collect()] == [difflib.SequenceMatcher(None, a, b).ratio() for a, b in pairs] + [0.0]


def test_delivery_retries(spark):
    def flaky(rows):
        if any(r["id"] == 3 for r in rows):
            raise external.Retry("busy")
        if any(r["id"] == 4 for r in rows):
            raise ValueError("bad")

    d = spark.createDataFrame([(i,) for i in range(6)], "id long").coalesce(1)
    got = {r["id"]: (r["attempts"], r["error"]) for r in external.deliver(d, "id", "long", ["id"], flaky, size=1, tries=3, wait=0).collect()}
    assert got == {i: (3, "busy") if i == 3 else (1, "bad") if i == 4 else (1, None) for i in range(6)}
    assert {r["chunk"] for r in external.deliver(d, "id", "long", ["id"], flaky, size=4, tries=1, wait=0).collect()} == {0, 1}


def test_a_record_is_asked_once_a_run(spark):
    items = spark.createDataFrame([(i, "t", "s", "early detection", {"cancer_type": "lung"}) for i in range(4)], "id long, title string, source string, raw_text string, signals map<string,string>")
    memo = spark.createDataFrame([("r1", 0, 7, "m", "low"), ("r0", 1, 9, "m", "low")], "run_id string, id long, score int, reason string, confidence string")
    asked = []

    def ask(d):
        asked.extend(r["id"] for r in d.select("id").collect())
        return spark.createDataFrame([(1, '{"relevancy_score": 50, "relevancy_reason": "good", "confidence": "high"}'), (2, "nonsense")], "id long, answer string")

    rows, new = external.score_records(items, memo, ask, "r1")
    got = {r["id"]: (r["origin"], r["score"]) for r in rows.collect()}
    assert sorted(set(asked)) == [1, 2, 3]
    assert got[0] == ("memo", 7) and got[1][0] == "asked" and got[2] == ("failed", None) and got[3] == ("failed", None)
    again, _ = external.score_records(items, memo.unionByName(new), ask, "r1")
    assert {r["id"]: r["score"] for r in again.collect()} == {i: s for i, (_, s) in got.items()}


def test_sheet_keeps_first_dates(spark):
    sheet = spark.createDataFrame([("1", "a", "d1", "true"), ("2", "b", "d1", "true")], "id string, title string, date_added string, is_new string")
    rows = spark.createDataFrame([("2", "B"), ("3", "C"), ("", "?"), (None, "?")], "id string, title string")
    out, counts = change.sheet_upsert(sheet, rows, "d2")
    assert {r["id"]: (r["title"], r["date_added"], r["is_new"]) for r in out.collect()} == {"1": ("a", "d1", "true"), "2": ("B", "d1", "false"), "3": ("C", "d2", "true")}
    assert counts.first().asDict() == {"added": 1, "updated": 1, "untouched": 1, "errors": 2}


def test_bounds_of_tool_calls(spark):
    d = spark.createDataFrame([(i, 50 + i, "2024-02-0%d" % (1 + i % 9)) for i in range(40)], "id long, score int, d string").withColumn("published_date", F.col("d").cast("timestamp"))
    from datetime import datetime

    assert catalog.must_reads(d, datetime(2024, 2, 10), 0, 0).count() == 1
    assert catalog.must_reads(d, datetime(2024, 2, 10), 999, 999).count() == 20
    with pytest.raises(ValueError):
        catalog.get(d, " ")


def test_a_malformed_source_never_fails_the_run(spark, tmp_path):
    (tmp_path / "good").mkdir()
    (tmp_path / "good" / "a.xml").write_text("<channel><item><title>T</title><link>l</link><pubDate>2024-01-01</pubDate></item></channel>")
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "a.json").write_bytes(b'{"result": {"1": {"uid": ')
    from datetime import datetime

    sources = [{"type": "rss", "path": str(tmp_path / "good"), "name": "good"}, {"type": "pubmed", "path": str(tmp_path / "absent"), "name": "absent"}, {"type": "other", "path": "x", "name": "kind"}]
    rows, stats = readers.all_sources(spark, sources, datetime(2024, 1, 2))
    assert rows.count() == 1 and {r["name"]: r["status"] for r in stats.collect()} == {"good": "ok", "absent": "error", "kind": "error"}


def test_pairwise_calibration_is_for_samples(spark, monkeypatch):
    d = spark.range(50).select((F.col("id") * 2).alias("score"), (F.col("id") % 4).alias("rating"))
    monkeypatch.setattr(metrics.Calibrator, "PAIRWISE_ROWS", 10)
    with pytest.raises(ValueError):
        metrics.Calibrator.fit(d, "score", "rating", mode="pairwise")
    c = metrics.Calibrator.fit(d.withColumn("score", F.col("score") + F.rand(1) / 1000), "score", "rating")
    assert len(c.xs) <= 100 * metrics.Calibrator.GRID + 2 and c.monotone()


def test_sections_from_garbled_answers(spark):
    d = spark.createDataFrame([('{"items": [{"title": "A", "meta": 5}, "x"], "tool_id": ""}',), ("not json",), (None,)], "j string")
    got = records.normalized_section(d, "j", {"tool_id": "t", "section_title": "s", "period_start": "a", "period_end": "b"}).collect()
    assert [(r["tool_id"], len(r["items"])) for r in got] == [("t", 1), ("t", 0), ("t", 0)]
    assert got[0]["items"][0]["meta"] == "{}"
