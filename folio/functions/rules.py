"""The deterministic score rules: keyword families, penalties, bonuses and caps, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folio.functions.text import any_of, blank_to_null

# Keyword families of the rules, matched as plain substrings of the lower-cased text.
DETECTION = (
    "early detection", "early diagnosis", "screening", "screen", "diagnostic",
    "diagnosis", "mced", "multi-cancer early detection", "liquid biopsy",
    "ctdna", "cfdna", "cell-free dna", "methylation", "biomarker",
    "breath", "voc", "urine", "sensor", "electronic nose", "e-nose",
    "sensitivity", "specificity", "auc", "predictive value",
    "psa", "prostate-specific antigen", "colorectal", "colonoscopy",
    "canine", "olfaction", "cancer-sniffing",
)
GENERIC_AI = ("artificial intelligence", "ai", "machine learning", "deep learning", "neural network", "llm", "large language model")
MARKET = ("market", "market size", "market growth", "market forecast", "competitive landscape", "investor", "funding", "valuation", "commercial strategy", "go-to-market", "gtm")
GENOMICS = ("genomics", "multi-omics", "omics", "transcriptomics", "proteomics", "epigenomics", "genomic profiling", "single-cell", "rna-seq", "whole genome", "wgs", "wes", "ngs")
TREATMENT = (
    "neoadjuvant", "adjuvant", "chemotherapy", "immunotherapy", "targeted therapy",
    "treatment response", "predicting the efficacy", "pathological response",
    "overall survival", "progression-free survival", "metastatic", "advanced stage",
    "stage iv", "drug resistance", "refractory", "relapsed", "combination therapy",
)
BASIC_BIOLOGY = ("single-cell atlas", "fibroblast phenotypes", "tumor microenvironment", "mechanistic", "pathway", "signaling pathway", "cell lines", "xenograft", "murine model", "molecular mechanism", "transcriptomic landscape")
SCREENING_IMPACT = ("population health impact", "complement existing screening", "population-level screening", "asymptomatic population", "screening program", "public health impact", "multi-cancer early detection", "mced", "genomic blood test", "blood-based screening")
BREATH = ("breath", "exhaled", "voc", "volatile organic", "breathomics", "olfaction", "canine")
TARGETS = ("breast", "lung", "prostate", "colon")
# The three lists of which the blood-test bonus needs one word each.
MULTI_TEST = ("multi-cancer early detection", "mced")
BLOOD_TEST = ("blood test", "blood-based", "genomic blood test")
BESIDE_SCREENING = ("complement existing screening", "existing screening")

FAMILIES = {"detection": DETECTION, "ai": GENERIC_AI, "market": MARKET, "genomics": GENOMICS, "treatment": TREATMENT, "biology": BASIC_BIOLOGY, "impact": SCREENING_IMPACT, "breath": BREATH}


def cancer_type(c: Column) -> Column:
    c = F.lower(F.trim(F.coalesce(c, F.lit(""))))
    return F.when(c == "colorectal", "colon").otherwise(c)


def targets_from(text: str | None) -> tuple[str, ...]:
    """Target types from a comma-separated setting; the usual ones where it is empty."""
    names = [x.strip().lower() for x in (text or "").split(",") if x.strip()]
    return tuple(dict.fromkeys("colon" if x == "colorectal" else x for x in names)) or TARGETS


def compressed(score: Column) -> Column:
    """Scores of 85 and more are drawn together, those from 70 lose 5."""
    return F.when(score >= 85, F.least(F.lit(100), 85 + F.bround((score - 85) * F.lit(0.35)))).when(score >= 70, score - 5).otherwise(score).cast("int")


def _flag(signals: str, name: str) -> Column:
    return F.coalesce(F.try_element_at(F.col(signals), F.lit(name)) == "true", F.lit(False))


def apply_rules(df: DataFrame, score: str = "score", text: tuple[str, ...] = ("title", "source", "raw_text"), signals: str = "signals", families: dict[str, tuple[str, ...]] = FAMILIES, targets: tuple[str, ...] = TARGETS) -> DataFrame:
    """Adds adjusted_score, adjustments (array) and the predicates that led to it.

    signals is a map of strings; absent keys count as false. All predicates are columns of one
    projection, so the lower-cased text is made once.
    """
    fam = {k: families.get(k, ()) for k in FAMILIES}
    low = F.lower(F.concat_ws("\n", *[F.coalesce(F.col(c), F.lit("")) for c in text]))
    d = df.withColumn("_low", low)
    hit = {f"_{k}": any_of(F.col("_low"), words) for k, words in fam.items()}
    d = d.withColumns(hit)
    kind = cancer_type(F.try_element_at(F.col(signals), F.lit("cancer_type")))
    mced = any_of(F.col("_low"), MULTI_TEST) & any_of(F.col("_low"), BLOOD_TEST) & any_of(F.col("_low"), BESIDE_SCREENING)
    near = F.exists(F.split("_low", r"[.!?;\n]+"), lambda s: any_of(s, fam["ai"]) & any_of(s, fam["detection"]))
    flags = [_flag(signals, k) for k in ("detection_methodology", "breath_based", "animal_model", "ngs_genomics")]
    method = flags[0] | flags[1] | flags[2] | flags[3] | F.col("_detection")
    d = d.withColumns({
        "cancer_type": kind,
        "target_match": kind.isin(*targets, "multi"),
        "method_link": method,
        "market_only": _flag(signals, "market_only") | (F.col("_market") & ~F.col("_detection")),
        "mced_combo": mced,
        "treatment_only": F.col("_treatment") & ~F.col("_detection"),
        "biology_only": F.col("_biology") & ~F.col("_detection"),
        "ai_linked": _flag(signals, "ai_diagnostics_linked") | (F.col("_ai") & near),
        "_broad": _flag(signals, "broad_genomics_without_detection") | (F.col("_genomics") & ~F.col("_detection")),
    })
    d = d.withColumn("_waived", F.col("_broad") & (F.col("_impact") | F.col("mced_combo"))).withColumn("broad_genomics", F.col("_broad") & ~F.col("_waived"))
    capped = ~F.col("target_match") & ~F.col("method_link") & (F.col(score) > 60)
    # Fixed values: (condition, points, note), in the order in which notes are given.
    steps = [
        (~F.col("cancer_type").isin("", "none", "other", "multi") & ~F.col("target_match"), -12, "non-target cancer penalty (-12)"),
        (F.col("market_only"), -20, "market-only content penalty (-20)"),
        (F.col("broad_genomics"), -15, "broad genomics without detection link penalty (-15)"),
        (F.col("treatment_only"), -35, "treatment-only context penalty (-35)"),
        (F.col("biology_only"), -20, "basic biology without detection link penalty (-20)"),
        (F.col("_ai") & ~F.col("ai_linked"), -8, "generic AI mention de-biased (-8)"),
        (F.col("_ai") & F.col("ai_linked"), 5, "AI tied to diagnostics bonus (+5)"),
        (F.col("_impact") & F.col("method_link"), 20, "population-screening impact boost (+20)"),
        (F.col("mced_combo"), 15, "MCED + existing-screening strategic boost (+15)"),
        (F.col("_breath") & F.col("method_link") & ~F.col("treatment_only"), 10, "breath/VOC bridge boost (+10)"),
    ]
    points = F.when(capped, F.lit(60)).otherwise(F.col(score)).cast("int")
    for when, n, _ in steps:
        points = points + F.when(when, n).otherwise(0)
    d = d.withColumn("_sum", F.greatest(F.lit(0), F.least(F.lit(100), points)))
    d = d.withColumn("_held", F.when(F.col("treatment_only"), F.least(F.col("_sum"), F.lit(20))).otherwise(F.col("_sum")))
    d = d.withColumn("adjusted_score", compressed(F.col("_held")))
    notes = [
        F.when(F.col("_waived"), F.lit("broad genomics penalty waived (screening-impact context)")),
        F.when(capped, F.lit("hard cap at 60 (non-target and no direct detection-method link)")),
        *[F.when(when, F.lit(note)) for when, _, note in steps],
        F.when(F.col("_held") != F.col("_sum"), F.lit("treatment-only cap at 20")),
        F.when(F.col("adjusted_score") != F.col("_held"), F.format_string("top-end normalization (%d→%d)", F.col("_held"), F.col("adjusted_score"))),
    ]
    d = d.withColumn("adjustments", F.array_compact(F.array(*notes)))
    renamed = d.withColumnsRenamed({"_impact": "screening_impact", "_breath": "breath_bridge"})
    return renamed.drop("_low", "_sum", "_held", "_broad", "_waived", *[f"_{k}" for k in fam])


def with_reason(reason: Column, adjustments: Column) -> Column:
    noted = F.concat(F.trim(F.coalesce(reason, F.lit(""))), F.lit(" | V3 adjustments: "), F.array_join(adjustments, "; "))
    return F.when(F.size(adjustments) > 0, F.regexp_replace(noted, r"^[ |]+", "")).otherwise(reason)


#: Boolean signals that two reviews are merged on.
SIGNALS = ("early_detection_focus", "screening_study", "risk_stratification", "biomarker_discovery", "ctdna_cfdna", "imaging_based", "prospective_cohort", "breath_voc", "urine_based", "sensor_based", "canine_detection", "human_subjects")
TYPE_ORDER = ("breast", "lung", "prostate", "colon", "colorectal", "multi", "other", "none")


def merge_signals(a: Column, b: Column) -> Column:
    """A map of strings: each signal true if either review has it, aliases, and one cancer type by priority."""
    yes = lambda k: F.coalesce(F.try_element_at(a, F.lit(k)) == "true", F.lit(False)) | F.coalesce(F.try_element_at(b, F.lit(k)) == "true", F.lit(False))
    method = yes("early_detection_focus") | yes("screening_study") | yes("breath_voc") | yes("sensor_based") | yes("canine_detection") | yes("ctdna_cfdna") | yes("imaging_based")
    made = {k: yes(k) for k in SIGNALS} | {"breath_based": yes("breath_voc"), "animal_model": yes("canine_detection"), "ngs_genomics": yes("biomarker_discovery") | yes("ngs_genomics"), "detection_methodology": method}
    ta, tb = (blank_to_null(F.lower(F.try_element_at(m, F.lit("cancer_type")))) for m in (a, b))
    first = F.coalesce(*[F.when((ta == t) | (tb == t), F.lit(t)) for t in TYPE_ORDER], ta, tb)
    kind = F.when(ta.isNull() & tb.isNull(), "none").when(F.coalesce(ta, tb) == F.coalesce(tb, ta), F.coalesce(ta, tb)).otherwise(first)
    pairs = [F.lit(x) if isinstance(x, str) else x.cast("string") for k, v in made.items() for x in (k, v)]
    return F.create_map(*pairs, F.lit("cancer_type"), kind)


def agreement(a: Column, b: Column) -> Column:
    gap = F.abs(a - b)
    return F.when(gap <= 15, "high").when(gap <= 30, "moderate").when(gap.isNotNull(), "low")


def disagreement_note(a: Column, b: Column, names: tuple[str, str]) -> Column:
    gap = F.abs(a - b)
    return F.when(gap > 30, F.format_string(f"Reviewer relevancy scores diverge by %d points ({names[0]}=%d, {names[1]}=%d)", gap, a, b))


CONFIDENCE = ("low", "medium", "high")


def fallback_evaluation(reviews: DataFrame, key: str = "pub_id", score: str = "score", confidence: str = "confidence", summary: str = "summary", order: str = "reviewer") -> DataFrame:
    """Without an evaluator: mean score (half to even), least confidence, first summary."""
    place = F.array_position(F.array(*[F.lit(x) for x in CONFIDENCE]), F.col(confidence))
    return reviews.where(F.col(score).isNotNull()).groupBy(key).agg(
        F.bround(F.avg(score)).cast("int").alias("final_score"),
        F.min_by(F.col(confidence), F.when(place > 0, place)).alias("confidence"),
        F.min_by(F.col(summary), F.when(F.coalesce(F.col(summary), F.lit("")) != "", F.col(order))).alias("summary"),
        F.count(F.lit(1)).alias("n_reviews"),
    )


def rating_of(score: Column) -> Column:
    return F.when(score < 25, 0).when(score < 50, 1).when(score < 75, 2).otherwise(3)


def rating_range(rating: Column) -> Column:
    return F.when(rating == 0, F.struct(F.lit(0).alias("low"), F.lit(24).alias("high"))).when(rating == 1, F.struct(F.lit(25).alias("low"), F.lit(49).alias("high"))).when(rating == 2, F.struct(F.lit(50).alias("low"), F.lit(74).alias("high"))).when(rating == 3, F.struct(F.lit(75).alias("low"), F.lit(100).alias("high")))


def to_int(c: Column) -> Column:
    """Whole part of a number in text, else null."""
    return F.when(F.rlike(F.trim(c), F.lit(r"^[+-]?\d{1,15}(\.\d*)?$")), F.trim(c)).cast("double").cast("int")


def map_rating(c: Column) -> Column:
    """0 to 3 stays; larger values are taken as 0 to 100."""
    return F.when(c.isNull() | (c < 0), None).when(c <= 3, c.cast("int")).when(c <= 100, rating_of(c))


def is_preprint(source: Column, venue: Column, url: Column) -> Column:
    low = F.lower(F.concat_ws(" ", source, venue, url))
    return F.rlike(low, F.lit("biorxiv|medrxiv|arxiv|preprint"))


def credibility(score: Column, preprint: Column) -> Column:
    """Credibility, at most 65 for preprints; unscored stays unscored."""
    return F.when(preprint & (score > 65), 65).otherwise(score)


def citation_context(count: Column, per_year: Column) -> Column:
    """Citation features as text; a count of zero is not available."""
    n = F.nullif(count, F.lit(0))
    return F.when(n.isNull(), "Citation data: not available").otherwise(F.concat_ws(", ", F.format_string("Citation count: %d", n), F.when(per_year.isNotNull(), F.concat(F.lit("citations per year: "), F.format_number(per_year, 1)))))
