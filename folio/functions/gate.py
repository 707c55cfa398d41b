"""The keyword gate before expensive reviews: venues, title and abstract keywords, negatives, promotions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from folio.functions.text import any_of, matches, title_key
from folio.operators.titles import stored

# Words that lower a gate score.
NEGATIVE = (
    "treatment", "therapy", "therapeutic", "chemotherapy",
    "surgery", "surgical", "resection",
    "metastatic", "advanced stage", "stage iv", "stage 4",
    "palliative", "end-stage", "terminal",
    "in vitro", "cell line", "cell lines", "mouse model", "mice",
    "retrospective review", "case report", "case series",
    "editorial", "commentary", "letter to editor", "correspondence",
    "erratum", "correction", "retraction",
)
# Words that are never left in the low bucket.
STRONG = (
    "multi-cancer early detection", "mced", "liquid biopsy",
    "cancer screening", "early detection", "screening study",
    "prospective screening", "population screening",
    "ctdna", "cfdna", "circulating tumor dna", "circulating free dna",
    "cell-free dna", "cell free dna",
    "canine detection", "dog detection", "trained dogs",
    "breath analysis", "exhaled breath", "volatile organic",
    "electronic nose", "e-nose",
    "biomarker validation", "diagnostic accuracy",
)
# Keywords of the gate.
KEYWORDS = (
    "early detection", "early diagnosis", "early-stage",
    "screening", "cancer screening", "population screening",
    "early cancer", "precancerous", "premalignant",
    "biomarker", "biomarkers", "tumor marker", "tumour marker",
    "liquid biopsy", "liquid biopsies",
    "ctdna", "cfdna", "circulating tumor dna", "circulating tumour dna",
    "circulating free dna", "cell-free dna", "cell free dna",
    "circulating tumor cells", "ctc", "ctcs",
    "methylation", "dna methylation", "epigenetic",
    "methylation biomarker", "methylation signature",
    "mced", "multi-cancer", "multicancer", "pan-cancer",
    "multi-cancer early detection", "galleri",
    "urine", "urinary", "urine-based",
    "stool", "fecal", "faecal", "stool-based",
    "breath", "exhaled breath", "breath analysis",
    "voc", "volatile organic compounds",
    "saliva", "salivary",
    "canine detection", "cancer-sniffing dogs", "olfactory",
    "electronic nose", "e-nose",
    "ai-assisted", "machine learning", "deep learning",
    "colonoscopy", "mammography", "mammogram",
    "low-dose ct", "ldct", "lung cancer screening",
    "psa", "prostate-specific antigen",
    "ca-125", "ca125", "ovarian cancer screening",
    "cologuard", "fit test", "fobt",
    "sensitivity", "specificity", "auc", "roc",
    "positive predictive value", "ppv",
    "negative predictive value", "npv",
    "validation cohort", "validation study",
    "prospective", "prospective study", "prospective cohort",
    "pancreatic cancer", "pancreatic", "pdac",
    "ovarian cancer", "ovarian",
    "lung cancer", "nsclc", "sclc",
    "colorectal cancer", "colon cancer", "crc",
    "liver cancer", "hepatocellular", "hcc",
)
# Venues that count as high-impact.
VENUES = (
    "nejm", "new england journal of medicine", "lancet", "the lancet",
    "jama", "journal of the american medical association", "bmj", "british medical journal",
    "annals of internal medicine", "nature", "nature medicine", "nature cancer", "nature communications",
    "science", "science translational medicine", "cell", "cell reports medicine", "cancer cell",
    "cancer discovery", "journal of clinical oncology", "jco", "clinical cancer research", "cancer research",
    "annals of oncology", "lancet oncology", "jama oncology", "jama network open",
    "cancer epidemiology biomarkers prevention", "cancer epidemiol biomarkers prev",
    "cancer prevention research", "international journal of cancer", "gut", "gastroenterology",
    "journal of the national cancer institute", "jnci", "j natl cancer inst",
    "ca a cancer journal for clinicians", "ca cancer j clin",
    "journal of breath research", "j breath res", "sci transl med", "nat commun",
    "biorxiv", "medrxiv", "arxiv",
)


def gate(df: DataFrame, title: str = "title", abstract: str = "raw_text", venue: Column | None = None, venues: tuple[str, ...] = VENUES, keywords: tuple[str, ...] = KEYWORDS, negative: tuple[str, ...] = NEGATIVE, strong: tuple[str, ...] = STRONG) -> DataFrame:
    """Adds gate_bucket, gate_score, gate_reason, venue_match and keyword_matches (ten at most).

    40 points for a venue; 15 for each title keyword up to 45; 5 for each further abstract keyword up to
    25; 5 off for each negative up to 20; 10 for a venue with three keywords.
    """
    norm = lambda c: title_key(c, "space")
    v = title_key(F.col("venue") if venue is None else venue, "venue")
    known = [w for w in venues if w]
    d = df.withColumns({"_t": norm(F.col(title)), "_a": norm(F.coalesce(F.col(abstract), F.lit(""))), "_v": v})
    hit = F.coalesce(*[F.when(F.contains("_v", title_key(F.lit(w), "venue")), F.lit(w)) for w in known], F.lit(None).cast("string"))
    d = d.withColumns({"_both": F.concat_ws(" ", "_t", "_a"), "_venue": hit, "_kt": matches(F.col("_t"), keywords), "_ka": matches(F.col("_a"), keywords)})
    neg = F.lit(0)
    for w in negative:
        neg = neg + F.contains("_both", F.lit(w)).cast("int")
    first_strong = F.coalesce(*[F.when(F.contains("_both", F.lit(w)), F.lit(w)) for w in strong], F.lit(None).cast("string"))
    d = d.withColumns({"_new": F.array_except("_ka", "_kt"), "_neg": F.least(5 * neg, F.lit(20)), "_strong": first_strong})
    d = d.withColumn("_all", F.concat("_kt", "_new")).withColumn("venue_match", F.col("_venue").isNotNull())
    gained = F.when(F.col("venue_match"), 40).otherwise(0) + F.least(15 * F.size("_kt"), F.lit(45)) + F.least(5 * F.size("_new"), F.lit(25))
    many = F.col("venue_match") & (F.size("_all") >= 3)
    score = F.least(F.lit(100), F.greatest(F.lit(0), gained - F.col("_neg")) + F.when(many, 10).otherwise(0))
    d = d.withColumn("gate_score", score)
    plain = F.when(F.col("gate_score") >= 50, "high").when(F.col("gate_score") >= 25, "maybe").otherwise("low")
    saved = (plain == "low") & F.col("_strong").isNotNull()
    pushed = F.col("venue_match") & (F.size("_all") > 0) & (plain != "high")
    d = d.withColumn("gate_bucket", F.when(pushed, "high").when(saved, "maybe").otherwise(plain))
    notes = F.array_compact(F.array(
        F.concat(F.lit("venue:"), F.col("_venue")),
        F.when(F.size("_kt") > 0, F.format_string("title_kw:%d", F.size("_kt"))),
        F.when(F.size("_new") > 0, F.format_string("abstract_kw:%d", F.size("_new"))),
        F.when(F.col("_neg") > 0, F.format_string("neg_kw:-%d", F.col("_neg"))),
        F.when(many, F.lit("multi_signal")),
        F.when(saved, F.concat(F.lit("safety_net:"), F.col("_strong"))),
        F.when(pushed, F.lit("venue+kw_promotion")),
    ))
    d = d.withColumn("gate_reason", F.when(F.size(notes) > 0, F.array_join(notes, "; ")).otherwise("no_signals")).withColumn("keyword_matches", F.slice("_all", 1, 10))
    return d.drop("_t", "_a", "_v", "_both", "_venue", "_kt", "_ka", "_new", "_neg", "_strong", "_all")


#: Hexadecimal digits of the hash that one histogram tells apart, and rows of one digit group that are ranked at once.
DIGITS, RANKED = 4, 100_000


def audit(gated: DataFrame, key: str, rate: float = 0.02, seed: str = "audit") -> DataFrame:
    """Adds audit_selected: max(1, floor(n * rate)) of the n low rows, chosen by a hash order of seed and key.

    The chosen rows are those with the smallest md5 of seed and key. The last of them is found first: a
    histogram of the leading digits of the hashes, 16 ** DIGITS numbers at most, says in which range
    the cut lies, further digits narrow the range until it holds few rows, and these are ranked. The rest is a
    filter, so the sample may be as large as the table allows. The gated rows are written once and read in
    each of these passes, so the gate is not worked out again: give the columns that are needed.
    """
    gated = stored(gated.withColumn("_h", F.md5(F.concat(F.lit(seed + ":"), F.col(key).cast("string")).cast("binary"))))
    low = gated.where("gate_bucket = 'low'")
    n = low.count()
    left = min(n, max(1, int(n * rate))) if n and rate > 0 else 0
    if not left:
        return gated.withColumn("audit_selected", F.lit(False)).drop("_h")
    within, rows, known = low, n, 0
    while rows > RANKED and known < 32:
        counts = within.groupBy(F.substring("_h", known + 1, DIGITS).alias("d")).agg(F.count(F.lit(1)).alias("n"))
        upto = counts.withColumn("upto", F.sum("n").over(Window.orderBy("d"))).where(F.col("upto") >= left)
        d, rows, upto = upto.agg(F.min(F.struct("d", "n", "upto")).alias("x")).first()["x"]
        left -= upto - rows
        within = within.where(F.substring("_h", known + 1, DIGITS) == d)
        known += DIGITS
    placed = within.select(F.struct("_h", F.col(key).alias("k")).alias("at"), F.row_number().over(Window.orderBy("_h", key)).alias("place"))
    h, k = placed.where(F.col("place") == left).first()["at"]
    chosen = (F.col("gate_bucket") == "low") & ((F.col("_h") < h) | ((F.col("_h") == h) & (F.col(key) <= F.lit(k))))
    return gated.withColumn("audit_selected", F.coalesce(chosen, F.lit(False))).drop("_h")


def to_evaluate(gated: DataFrame) -> DataFrame:
    return gated.where(F.col("gate_bucket").isin("high", "maybe") | F.col("audit_selected"))


def gate_stats(gated: DataFrame) -> DataFrame:
    b = F.col("gate_bucket")
    return gated.agg(
        F.count(F.lit(1)).alias("total"), F.count_if(b == "high").alias("high"), F.count_if(b == "maybe").alias("maybe"), F.count_if(b == "low").alias("low"),
        F.count_if("audit_selected").alias("audited_low"), F.count_if("venue_match").alias("venue_promoted"), F.count_if(F.size("keyword_matches") > 0).alias("keyword_promoted"),
        F.count_if(b.isin("high", "maybe") | F.col("audit_selected")).alias("to_evaluate"),
    )


def trusted_venues(listed: tuple[str, ...], found: tuple[str, ...], untrusted: tuple[str, ...] = ()) -> tuple[str, ...]:
    """The list, then venues found in the sources, without repeats and without excluded ones."""
    out = set(x.lower() for x in untrusted)
    return tuple(dict.fromkeys(v for v in (*listed, *found) if v.lower() not in out))


def journal_sources(sources: DataFrame) -> DataFrame:
    """Venues from PubMed sources whose query names a journal."""
    return sources.where((F.col("type") == "pubmed") & F.contains(F.lower("query"), F.lit("[journal]"))).select(F.lower(F.trim(F.regexp_extract("query", r'"?([^"\[]+)"?\s*\[', 1))).alias("venue")).distinct()


def any_term(text: Column, words: tuple[str, ...]) -> Column:
    return any_of(F.lower(F.coalesce(text, F.lit(""))), words)


