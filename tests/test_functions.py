"""Text, identifier, date, rule, gate and JSON functions on hand-made rows."""

from __future__ import annotations

import hashlib
import hmac
import json
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from folio.functions import dates, extract, gate, identifiers, jsonx, rules, text


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def over(spark, f, values, kind="string"):
    rows = spark.createDataFrame([(k, v) for k, v in enumerate(values)], f"k int, v {kind}")
    return [r["x"] for r in rows.select("k", f(F.col("v")).alias("x")).orderBy("k").collect()]


@pytest.mark.parametrize(
    ("style", "want"),
    [("dedupe", "a b cté 2nd"), ("eval", "a-b c té 2nd"), ("prep", "a b c t 2nd"), ("rerank", "a-b cté 2nd"), ("space", "a-b, c: té! 2nd")],
)
def test_title_styles(spark, style, want):
    title = "  A-B,  C: té!  2nd "
    want = {"dedupe": "ab c té 2nd", "rerank": "a-b c té 2nd"}.get(style, want)
    assert over(spark, lambda c: text.title_key(c, style), [title, None, ""]) == [want, "", ""]


def test_unknown_style(spark):
    with pytest.raises(ValueError, match="unknown"):
        text.title_key(F.lit("x"), "nope")


def test_html_and_control_characters(spark):
    assert over(spark, text.strip_html, ["<p>a&nbsp;&amp; <b>b</b>\n&#39;c&quot;</p>", None]) == ["a & b 'c\"", ""]
    assert over(spark, text.sanitize, ["a b c\r\nd\re\x00\x1f\tf", None]) == ["a\nb\n\nc\nd\ne\tf", ""]


def test_keywords(spark):
    got = over(spark, lambda c: text.matches(c, ("ctc", "ca-125", "biomarker")), ["the ctc and biomarkers", "octcs ca-125", "ca-125x"])
    assert got == [["ctc", "biomarker"], ["ca-125"], ["ca-125"]]


def test_findings_and_reasons(spark):
    assert over(spark, text.key_findings, ["• a • b•c • d", "x\n- y\n- z", "One. Two. Three. Four.", None]) == [["a", "b", "c"], ["x", "y", "z"], ["One.", "Two.", "Three."], []]
    assert over(spark, text.bullet_findings, ["- a\n* b", "A. B.", "No summary available."]) == [["a", "b"], ["A", "B"], []]
    assert over(spark, text.clean_reason, ["Claude's review found that it works. Fine! Third one.", "According to the reviewers, yes", ""]) == ["It works. Fine!.", "Yes", ""]
    assert over(spark, lambda c: text.fallback_reason(c, F.lit("src"), F.lit("")), ["Lung screening trial", "Breast study", "New biomarker", "x"]) == [
        "This study addresses lung cancer screening, a key area for early detection research.",
        "This research focuses on breast cancer, contributing to the early detection knowledge base.",
        "This study explores biomarker methods relevant to cancer early detection.",
        "From src, this publication may contain findings relevant to early detection efforts.",
    ]
    assert over(spark, text.ordinal_label, [80, 79, 65, 64, None], "int") == ["High", "Moderate", "Moderate", "Exploratory", "Exploratory"]


def test_truncation(spark):
    a, b = "x" * 700 + "." + "y" * 800, "z" * 1300
    got = over(spark, lambda c: text.truncated(c, 1200), [a, b, "short"])
    assert got[0] == "x" * 700 + "." and got[1].endswith("...") and len(got[1]) <= 1200 and got[2] == "short"


def test_trigrams(spark):
    assert over(spark, text.trigrams, ["A b  c d", "a b", ""]) == [["a b c", "b c d"], [], []]
    assert over(spark, lambda c: text.shares_trigram(c, F.lit("say one two three now")), ["One two three four", "two three four"]) == [True, False]


def test_identifiers(spark):
    assert over(spark, identifiers.doi_in, ["see https://doi.org/10.1038/s43018-025-01109-8whether", "DOI: 10.1000/ABC12).", "none", None]) == ["10.1038/s43018-025-01109-8", "10.1000/abc12", None, None]
    assert over(spark, identifiers.pmid_in, ["PMID: 12345678", "https://pubmed.ncbi.nlm.nih.gov/1234567/", "pmid 12"]) == ["12345678", "1234567", None]
    assert over(spark, identifiers.arxiv_in, ["arXiv:2401.01234v2", "https://arxiv.org/abs/2401.0123"]) == ["2401.01234v2", "2401.0123"]
    assert over(spark, identifiers.normalize_doi, ["https://doi.org/10.1/A", "doi: 10.2/b", "x"]) == ["10.1/a", "10.2/b", None]
    assert over(spark, identifiers.normalize_pmid, ["PMID: 12", "", None]) == ["12", None, None]
    assert over(spark, identifiers.pmid_in_url, ["https://www.ncbi.nlm.nih.gov/pubmed/77/"]) == ["77"]


def test_urls(spark):
    got = over(spark, identifiers.normalize_url, [" http://EX.org/a/?utm_source=x&q=1#f", "https://ex.org/", "javascript:alert(1)", "ftp://ex.org/a", "/no/host", "https://n.com/articles/s43018-025-01111-0we", "https://ex.org/p?q=", None])
    assert got == ["https://ex.org/a?q=1", "https://ex.org/", None, None, None, "https://n.com/articles/s43018-025-01111-0", "https://ex.org/p", None]
    kinds = over(spark, lambda c: identifiers.source_type(c, F.lit("")), ["https://www.biorxiv.org/x", "https://arxiv.org/abs/1", "https://pubmed.ncbi.nlm.nih.gov/1", "https://x.org"])
    assert kinds == ["biorxiv", "arxiv", "pubmed", "rss"]
    r = one(spark, identifiers.resolve(F.lit("http://x.org/a"), F.lit(None).cast("string"), F.lit(None).cast("string"), F.lit("feed"), F.lit("arXiv:2401.01234"), F.lit("t")))
    assert r["canonical_url"] == "https://arxiv.org/abs/2401.01234" and r["source_type"] == "rss"
    assert one(spark, identifiers.link(F.lit("javascript:x"), F.lit(""), F.lit("10.5/x9"), F.lit(None).cast("string"))) == "https://doi.org/10.5/x9"


def test_hashes(spark):
    assert one(spark, identifiers.record_id(F.lit("t"), F.lit(None).cast("string"), F.lit("u"))) == hashlib.sha256(b"t||u").hexdigest()
    for key in ("k", "long" * 40):
        assert one(spark, identifiers.hmac_sha256(key, F.lit("a=1&b=2"))) == hmac.new(key.encode(), b"a=1&b=2", hashlib.sha256).hexdigest()
    assert one(spark, identifiers.list_hash(F.array(F.lit("b"), F.lit("a")))) == hashlib.sha256(json.dumps(["a", "b"]).encode()).hexdigest()[:16]


def test_html_identifiers(spark):
    page = """<html><head><title> T </title><meta name="citation_doi" content="10.1038/x-1"><meta content="Journal" name="citation_journal_title"/>
    <script type="application/ld+json">{"headline": "H", "datePublished": "2024-01-02"}</script></head></html>"""
    assert over(spark, identifiers.html_doi, [page, "<a href='https://doi.org/10.5555/y2'>x</a>", ""]) == ["10.1038/x-1", "10.5555/y2", None]
    assert over(spark, identifiers.html_title, [page]) == ["T"]
    assert over(spark, identifiers.html_date, [page]) == ["2024-01-02T00:00:00"]
    assert over(spark, identifiers.html_journal, [page]) == ["Journal"]
    assert over(spark, identifiers.licence, ["https://creativecommons.org/licenses/by-nc-nd/4.0", "CC-BY", "x", None, "public domain"]) == ["cc-by-nc-nd", "cc-by", "unknown", "unknown", "public-domain"]


def test_dates(spark):
    got = over(spark, dates.record_date, ["2025/11/3", "2025", "2025 Nov", "2025 Nov-Dec", "2025 Winter", "2025 Nov 15", "2025 Feb 30", "soon", None])
    assert [r["day"] for r in got] == [date(2025, 11, 3), date(2025, 1, 1), date(2025, 11, 1), date(2025, 11, 1), date(2025, 1, 1), date(2025, 11, 15), None, None, None]
    assert got[1]["low_confidence"] and not got[2]["low_confidence"]
    best = one(spark, dates.best_date(F.lit("bad"), F.lit("2025/01/02 10:00"), F.lit("2024")))
    assert best["day"] == date(2025, 1, 2) and best["date_source"] == "sortpubdate"
    clamp = lambda d, low: one(spark, dates.clamp_future(F.lit(d), F.lit(low), date(2025, 1, 1)))
    assert clamp(date(2025, 4, 1), False) == date(2025, 4, 1) and clamp(date(2025, 4, 2), False) is None and clamp(date(2026, 1, 1), True) == date(2026, 1, 1)
    feed = over(spark, dates.feed_date, ["Mon, 06 Jan 2025 10:00:00 +0200", "2025-01-06T10:00:00Z", "nope"])
    assert feed == [datetime(2025, 1, 6, 8), datetime(2025, 1, 6, 10), None]
    assert dates.run_context(datetime(2026, 1, 12, 5), "weekly")["run_id"] == "weekly-2026-03"
    assert dates.brief_window(date(2026, 1, 14), "last") == (date(2026, 1, 5), date(2026, 1, 11))
    assert one(spark, dates.week_id(F.lit(date(2026, 1, 12)))) == "weekly-2026-03"
    assert one(spark, dates.week_start(F.lit(datetime(2026, 1, 12, 3)))) == date(2026, 1, 5)
    assert over(spark, lambda c: dates.recency_points(c, datetime(2025, 2, 1)), [datetime(2025, 1, 25, 1), datetime(2025, 1, 25), datetime(2025, 1, 18), datetime(2024, 1, 1)], "timestamp") == [200, 150, 100, 50]


def ruled(spark, body, score, **signals):
    d = spark.createDataFrame([("t", "s", body, score, {k: str(v).lower() for k, v in signals.items()})], "title string, source string, raw_text string, score int, signals map<string,string>")
    return rules.apply_rules(d).first()


def test_rules(spark):
    assert ruled(spark, "zzz", 90, cancer_type="other")["adjusted_score"] == 60
    r = ruled(spark, "zzz", 90, cancer_type="colorectal")
    assert r["adjusted_score"] == 87 and r["target_match"]  # 85 + round(5 * .35)
    r = ruled(spark, "zzz", 72, cancer_type="ovarian")
    assert r["adjusted_score"] == 48 and "non-target" in " ".join(r["adjustments"])
    r = ruled(spark, "adjuvant chemotherapy", 95, cancer_type="lung")
    assert r["adjusted_score"] == 20 and r["treatment_only"] and r["adjustments"][-1] == "treatment-only cap at 20"
    r = ruled(spark, "omics. Screening program for mced", 50, cancer_type="multi")
    assert not r["broad_genomics"] and r["screening_impact"]
    r = ruled(spark, "he said so", 50, cancer_type="lung")
    assert r["adjusted_score"] == 42  # the letters "ai" inside a word count
    r = ruled(spark, "machine learning for screening", 50, cancer_type="lung")
    assert r["ai_linked"] and r["adjusted_score"] == 55
    assert over(spark, rules.compressed, [100, 85, 84, 70, 69], "int") == [90, 85, 79, 65, 69]
    assert over(spark, rules.map_rating, [2, 4, 80, -1, None], "int") == [2, 0, 3, None, None]
    assert over(spark, rules.to_int, ["7", " 3.9 ", "x", None]) == [7, 3, None, None]


def test_signals_and_agreement(spark):
    m = one(spark, rules.merge_signals(F.create_map(F.lit("breath_voc"), F.lit("true"), F.lit("cancer_type"), F.lit("other")), F.create_map(F.lit("cancer_type"), F.lit("Colorectal"))))
    assert m["breath_based"] == m["detection_methodology"] == "true" and m["cancer_type"] == "colorectal" and m["urine_based"] == "false"
    pairs = spark.createDataFrame([(10, 25), (10, 40), (10, 41), (10, None)], "a int, b int")
    assert [r[0] for r in pairs.select(rules.agreement(F.col("a"), F.col("b"))).collect()] == ["high", "moderate", "low", None]
    rows = spark.createDataFrame([(1, 70, "high", "", 1), (1, 71, "low", "second", 2), (2, 10, "medium", "s", 1)], "pub_id int, score int, confidence string, summary string, reviewer int")
    got = {r["pub_id"]: r for r in rules.fallback_evaluation(rows).collect()}
    assert (got[1]["final_score"], got[1]["confidence"], got[1]["summary"]) == (70, "low", "second")


def test_gate(spark):
    d = spark.createDataFrame(
        [
            (1, "MCED liquid biopsy screening", "ctdna methylation", "Nature Medicine"), (2, "x", "early detection", "z"), (3, "x", "y", "Cancer Epidemiology, Biomarkers & Prevention"),
            (4, "x", "surgery therapy", "z"), (5, "urine", "case report", "The Lancet"), (6, None, None, None),
        ],
        "id int, title string, raw_text string, venue string",
    )
    got = {r["id"]: r for r in gate.gate(d).collect()}
    assert got[1]["gate_bucket"] == "high" and "multi_signal" in got[1]["gate_reason"]
    assert got[2]["gate_bucket"] == "maybe" and "safety_net:early detection" in got[2]["gate_reason"]
    assert got[3]["venue_match"] and got[3]["gate_score"] == 40 and got[3]["gate_bucket"] == "maybe"
    assert got[4]["gate_bucket"] == "low" and got[4]["gate_score"] == 0
    assert got[5]["gate_bucket"] == "high"
    assert got[6]["gate_reason"] == "no_signals"
    audited = gate.audit(gate.gate(d), "id", rate=0.02)
    s = gate.gate_stats(audited).first()
    assert s["audited_low"] == 1 and s["total"] == 6 and s["to_evaluate"] == s["high"] + s["maybe"] + 1
    assert gate.to_evaluate(audited).count() == s["to_evaluate"]


def test_json(spark):
    raw = ["```json\n{\"relevancy_score\": 70, \"relevancy_reason\": \"r\", \"concerns\": [\" a \", \"\"],}\n```", "text {\"relevancy_score_0_100\": 5, \"key_reasons\": [\"x\", \"y\"], \"uncertainty\": \"high\"} more", "none", "{bad", None]
    got = over(spark, jsonx.review, raw)
    assert [(g["relevancy_score"], g["relevancy_reason"], g["confidence"], g["concerns"], g["valid"]) for g in got[:2]] == [(70, "r", "medium", ["a"], True), (5, "x; y", "low", [], True)]
    assert [g["valid"] for g in got] == [True, True, False, False, False]
    assert over(spark, lambda c: jsonx.review(c, "v1"), ['{"relevancy_rating_0_3": 2, "summary": "s"}'])[0]["relevancy_score"] == 66
    evals = over(spark, jsonx.evaluation, ['{"final_relevancy_score": 80, "final_relevancy_rating_0_3": 3, "final_relevancy_reason": "r", "confidence": 140}', '{"final_relevancy_score": 101, "final_relevancy_rating_0_3": 3, "final_relevancy_reason": "r"}', '{"final_relevancy_score": 1}', "x"])
    assert [e["error"] for e in evals] == [None, "score out of range", "missing field", "no object"] and evals[0]["confidence"] == 100
    assert over(spark, jsonx.ranked_ids, ['{"ranked_ids": ["a", "b"]}', '```json\n{"ranked_ids": ["c"]}\n```', '{"ranked_ids": ["d", "e", "f', "nothing"]) == [["a", "b"], ["c"], ["d", "e"], None]
    assert over(spark, jsonx.confidence_label, ["0.2", "0.4", "0.7", "very low", "high", "x"]) == ["high", "medium", "low", "high", "low", "medium"]
    assert over(spark, jsonx.as_list, [None, '["a"]', "plain"]) == [[], ["a"], ["plain"]]


def test_commercial(spark):
    got = over(spark, extract.commercial_signals, ["Work funded by Acme Labs. He is an employee of Beta Inc. and more", None])
    assert got[0]["sponsor_names"][0].startswith("Acme Labs") and got[0]["company_names"][0].startswith("Beta Inc") and len(got[0]["snippets"]) == 2
    assert got[1]["sponsor_names"] == []


def test_signed_urls_and_scores(spark):
    url = one(spark, identifiers.signed_url("https://x.org/v", "k", week=F.lit("2026-01-05"), pub=F.lit("a b")))
    assert url.startswith("https://x.org/v?pub=a+b&week=2026-01-05&sig=")
    assert over(spark, lambda c: identifiers.signature_ok(c, "k"), [url, url.replace("a+b", "c"), "x"]) == [True, False, False]
    got = over(spark, jsonx.scored, ['{"credibility_score": 70, "credibility_reason": "ok", "confidence": "HIGH"}', '{"credibility_score": 170, "credibility_reason": "ok"}', "no"])
    assert [(g["score"], g["confidence"], g["valid"]) for g in got] == [(70, "high", True), (None, None, False), (None, None, False)]
