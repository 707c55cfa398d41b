"""Queries over documents, pages, labels, conversations and embeddings standing in for publications."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.functions import gate, identifiers, rules, text
from folio.functions.extract import sequence_ratio
from folio.operators import change, match, metrics, rank, records, search
from folio.plans.registry import query, table
from folio.sources import writers

AS_OF = datetime(2024, 2, 10)

PUBS = """pubs AS (SELECT doc_id AS id, substring(split_part(text, '.', 1), 1, 80) AS title, text AS raw_text, source, lang,
 DATE '2024-01-01' + CAST(doc_id % 60 AS INTEGER) AS published_date,
 'http://Example.org/articles/' || CAST(doc_id % 700 AS VARCHAR) || 'ab/?utm_source=x&p=' || CAST(doc_id % 3 AS VARCHAR) || '#top' AS url,
 CASE WHEN doc_id % 11 = 0 THEN NULL ELSE CAST((doc_id * 37 + n_chars) % 101 AS INTEGER) END AS score FROM documents)"""


def pubs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents as publications: title from the first sentence, a date, a URL and a score from the id."""
    d = table(spark, sf_dir, "documents")
    url = F.concat(F.lit("http://Example.org/articles/"), (F.col("doc_id") % 700).cast("string"), F.lit("ab/?utm_source=x&p="), (F.col("doc_id") % 3).cast("string"), F.lit("#top"))
    return d.select(
        F.col("doc_id").alias("id"), F.substring(F.split_part("text", F.lit("."), F.lit(1)), 1, 80).alias("title"), F.col("text").alias("raw_text"), "source", "lang",
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("doc_id") % 60).cast("int")).alias("published_date"), url.alias("url"),
        F.when(F.col("doc_id") % 11 == 0, None).otherwise(((F.col("doc_id") * 37 + F.col("n_chars")) % 101).cast("int")).alias("score"),
    )


def list_of(words: tuple[str, ...], expr: str) -> str:
    return "(" + " OR ".join(f"contains({expr}, '{w}')" for w in words) + ")"


def count_of(words: tuple[str, ...], expr: str) -> str:
    return "(" + " + ".join(f"CAST(contains({expr}, '{w}') AS INTEGER)" for w in words) + ")"


def _digest_sql(where: str, top: int = 5, more: int = 5) -> str:
    return f"""WITH {PUBS}, r AS (SELECT id, title, published_date, score, row_number() OVER (ORDER BY coalesce(score, -1) DESC, published_date DESC, lower(title), id) AS rk FROM pubs WHERE {where})
SELECT id, title, CAST(published_date AS VARCHAR) AS day, score, CAST(rk AS BIGINT) AS rank, CASE WHEN rk <= {top} THEN 'must_read' ELSE 'honorable' END AS section,
 CASE WHEN score >= 80 THEN 'High' WHEN score >= 65 THEN 'Moderate' ELSE 'Exploratory' END AS label FROM r WHERE rk <= {top + more}"""


def _digest(d: DataFrame, least: float | None = None) -> DataFrame:
    r = rank.digest(d, "score", "published_date", "title", "id", least=least)
    return r.select("id", "title", F.col("published_date").cast("string").alias("day"), "score", F.col("rank").cast("long").alias("rank"), "section", text.ordinal_label(F.col("score")).alias("label"))


@query("digest_topn_week", _digest_sql("published_date >= DATE '2024-01-15' AND published_date < DATE '2024-01-22'"))
def digest_topn_week(spark, sf_dir):
    return _digest(pubs(spark, sf_dir).where("published_date >= date'2024-01-15' AND published_date < date'2024-01-22'"))


@query("digest_threshold", _digest_sql("score >= 70"))
def digest_threshold(spark, sf_dir):
    return _digest(pubs(spark, sf_dir), least=70)


@query("score_distribution", f"WITH {PUBS} SELECT count(*) FILTER (WHERE coalesce(score,0) >= 80) AS high, count(*) FILTER (WHERE coalesce(score,0) BETWEEN 65 AND 79) AS moderate, count(*) FILTER (WHERE coalesce(score,0) < 65) AS exploratory FROM pubs")
def score_distribution(spark, sf_dir):
    s = F.coalesce("score", F.lit(0))
    return pubs(spark, sf_dir).agg(F.count_if(s >= 80).alias("high"), F.count_if(s.between(65, 79)).alias("moderate"), F.count_if(s < 65).alias("exploratory"))


def _title_sql(body: str) -> str:
    return f"WITH {PUBS} SELECT id, {body} AS key, md5({body.replace('title', 'raw_text')}) AS of_text FROM pubs"


SQUEEZE = "trim(regexp_replace({}, '\\s+', ' ', 'g'))"
TITLE_SQL = {
    "dedupe": SQUEEZE.format("regexp_replace(lower(title), '[^\\p{L}\\p{N}_\\s]', '', 'g')"),
    "eval": SQUEEZE.format("regexp_replace(lower(title), '[^\\p{L}\\p{N}_\\s-]', ' ', 'g')"),
    "prep": "trim(regexp_replace(lower(title), '[^a-z0-9]+', ' ', 'g'))",
    "rerank": f"trim(regexp_replace({SQUEEZE.format('lower(title)')}, '[^\\p{{L}}\\p{{N}}_\\s-]', '', 'g'))",
    "space": SQUEEZE.format("lower(title)"),
}
for _style, _body in TITLE_SQL.items():
    query(f"title_norm_{_style}", _title_sql(_body))(lambda spark, sf_dir, s=_style: pubs(spark, sf_dir).select("id", text.title_key(F.col("title"), s).alias("key"), F.md5(text.title_key(F.col("raw_text"), s).cast("binary")).alias("of_text")))


@query("record_id_sha256", f"WITH {PUBS} SELECT id, sha256(title || '|' || source || '|' || url) AS record_id, substring(sha256({TITLE_SQL['eval']}), 1, 16) AS title_hash, sha256(lower(trim(raw_text))) AS content_hash FROM pubs")
def record_id_sha256(spark, sf_dir):
    return pubs(spark, sf_dir).select("id", identifiers.record_id(F.col("title"), F.col("source"), F.col("url")).alias("record_id"), identifiers.title_hash(text.title_key(F.col("title"), "eval")).alias("title_hash"), identifiers.content_hash(F.col("raw_text")).alias("content_hash"))


_KEPT = "list_filter(string_split(regexp_extract(rest, '^[^?#]*\\?([^#]*)', 1), '&'), lambda p: regexp_matches(p, '^[^=]+=.') AND lower(split_part(p, '=', 1)) NOT IN ({}))".format(", ".join(f"'{t}'" for t in identifiers.TRACKING))


@query("page_url_normalize", f"""WITH a AS (SELECT page_id, trim(url) AS u FROM pages), b AS (SELECT page_id, lower(regexp_extract(u, '^([A-Za-z][A-Za-z0-9+.-]*):', 1)) AS scheme, lower(regexp_extract(u, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)', 1)) AS host, regexp_replace(u, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//[^/?#]*', '') AS rest FROM a),
c AS (SELECT *, regexp_replace(regexp_extract(rest, '^([^?#]*)', 1), '(\\d)[A-Za-z]{{2,}}$', '\\1') AS path, {_KEPT} AS kept FROM b)
SELECT page_id, CASE WHEN scheme IN ('', 'http', 'https') AND host <> '' THEN 'https://' || host || CASE WHEN path = '/' THEN path ELSE rtrim(path, '/') END || CASE WHEN len(kept) > 0 THEN '?' || array_to_string(kept, '&') ELSE '' END END AS normalized FROM c""")
def page_url_normalize(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", identifiers.normalize_url(F.col("url")).alias("normalized"))


_TYPE_SQL = "CASE " + " ".join(f"WHEN contains(lower(url || ' '), '{p}') THEN '{k}'" for p, k in identifiers.SOURCE_TYPES) + " ELSE 'rss' END"


@query("source_type", f"SELECT page_id, {_TYPE_SQL} AS source_type FROM pages")
def source_type(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", identifiers.source_type(F.col("url"), F.lit("")).alias("source_type"))


@query("html_title", "SELECT page_id, nullif(trim(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)), '') AS title FROM pages")
def html_title(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", text.blank_to_null(identifiers.html_title(F.col("html"))).alias("title"))


@query("html_strip", "SELECT page_id, trim(regexp_replace(replace(replace(replace(replace(replace(replace(regexp_replace(html, '<[^>]+>', '', 'g'), '&nbsp;', ' '), '&amp;', '&'), '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&#39;', ''''), '\\s+', ' ', 'g')) AS plain FROM pages")
def html_strip(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", text.strip_html(F.col("html")).alias("plain"))


@query("sanitize_text", f"WITH {PUBS} SELECT id, md5(regexp_replace(regexp_replace(raw_text, '\\r\\n?', chr(10), 'g'), '[\\x00-\\x08\\x0B-\\x1F]', '', 'g')) AS digest FROM pubs")
def sanitize_text(spark, sf_dir):
    return pubs(spark, sf_dir).select("id", F.md5(text.sanitize(F.col("raw_text")).cast("binary")).alias("digest"))


@query("snapshot_new", "SELECT status, count(*) AS n FROM (SELECT CASE WHEN p.doc_id IS NULL THEN 'NEW' ELSE 'UNCHANGED' END AS status FROM documents d LEFT JOIN (SELECT doc_id FROM documents WHERE n_chars % 3 <> 0) p ON d.doc_id = p.doc_id) GROUP BY 1")
def snapshot_new(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    return change.detect_changes(d, d.where("n_chars % 3 <> 0"), "doc_id").groupBy("status").agg(F.count(F.lit(1)).alias("n"))


@query("snapshot_merge_counts", "WITH c AS (SELECT doc_id FROM documents WHERE n_chars % 2 = 0), p AS (SELECT doc_id FROM documents WHERE n_chars % 3 <> 0) SELECT (SELECT count(*) FROM c WHERE doc_id NOT IN (SELECT doc_id FROM p)) AS added, (SELECT count(*) FROM c WHERE doc_id IN (SELECT doc_id FROM p)) AS updated, (SELECT count(*) FROM p WHERE doc_id NOT IN (SELECT doc_id FROM c)) AS kept, (SELECT count(*) FROM (SELECT doc_id FROM c UNION SELECT doc_id FROM p)) AS total")
def snapshot_merge_counts(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    return change.snapshot_counts(change.merge_snapshot(d.where("n_chars % 2 = 0"), d.where("n_chars % 3 <> 0"), "doc_id"))


@query("missing_labels_anti", "SELECT doc_id, lang FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def missing_labels_anti(spark, sf_dir):
    return change.missing_in(table(spark, sf_dir, "documents").select("doc_id", "lang"), table(spark, sf_dir, "labels"), "doc_id")


@query("cache_hit_semi", "SELECT 'hit' AS side, count(*) AS n FROM documents WHERE doc_id IN (SELECT doc_id FROM labels) UNION ALL SELECT 'miss', count(*) FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def cache_hit_semi(spark, sf_dir):
    hit, miss = match.split_cached(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), "doc_id")
    one = lambda d, n: d.agg(F.count(F.lit(1)).alias("n")).select(F.lit(n).alias("side"), "n")
    return one(hit, "hit").unionByName(one(miss, "miss"))


@query("left_join_fallback", f"WITH {PUBS} SELECT p.id, coalesce(l.quality * 100, p.score, -1) AS value FROM pubs p LEFT JOIN labels l ON p.id = l.doc_id")
def left_join_fallback(spark, sf_dir):
    p, l = pubs(spark, sf_dir), table(spark, sf_dir, "labels")
    return p.join(l, p["id"] == l["doc_id"], "left").select("id", F.coalesce(F.col("quality") * 100, F.col("score"), F.lit(-1)).alias("value"))


@query("cascade_match", f"""WITH {PUBS}, i AS (SELECT id AS item, CASE WHEN id % 3 = 0 THEN id END AS k1, CASE WHEN id % 3 = 1 THEN url END AS k2, title AS k3 FROM pubs WHERE id % 2 = 0), r AS (SELECT id, id AS k1, url AS k2, title AS k3 FROM pubs WHERE id % 5 <> 0)
SELECT i.item, coalesce(a.v, b.v, c.v) AS v, CASE WHEN a.v IS NOT NULL THEN 'k1' WHEN b.v IS NOT NULL THEN 'k2' WHEN c.v IS NOT NULL THEN 'k3' END AS match_key FROM i LEFT JOIN (SELECT k1, max(id) AS v FROM r GROUP BY 1) a ON i.k1 = a.k1 LEFT JOIN (SELECT k2, max(id) AS v FROM r GROUP BY 1) b ON i.k2 = b.k2 LEFT JOIN (SELECT k3, max(id) AS v FROM r WHERE k3 <> '' GROUP BY 1) c ON i.k3 = c.k3""")
def cascade_match(spark, sf_dir):
    p = pubs(spark, sf_dir)
    i = p.where("id % 2 = 0").select(F.col("id").alias("item"), F.when(F.col("id") % 3 == 0, F.col("id")).alias("k1"), F.when(F.col("id") % 3 == 1, F.col("url")).alias("k2"), F.col("title").alias("k3"))
    r = p.where("id % 5 <> 0").select(F.col("id").alias("v"), F.col("id").alias("k1"), F.col("url").alias("k2"), F.col("title").alias("k3"))
    return match.cascade(i, r, ["k1", "k2", "k3"], "v", "v").select("item", "v", "match_key")


@query("title_sequence_ratio")
def title_sequence_ratio(spark, sf_dir):
    """Each title against the one it would have from its last sentence."""
    p = pubs(spark, sf_dir)
    last = F.substring(F.trim(F.element_at(F.split(F.rtrim(F.coalesce("raw_text", F.lit("")), F.lit(". \n")), r"\."), -1)), 1, 80)
    return p.select("id", F.round(sequence_ratio(F.lower("title"), F.lower(last)), 6).alias("ratio"))


@query("rerank_merge", f"WITH {PUBS} SELECT id, CASE WHEN id % 3 = 0 AND trim({TITLE_SQL['rerank']}) <> '' THEN 90 - id % 50 ELSE 0 END AS llm_score, CASE WHEN id % 3 = 0 AND trim({TITLE_SQL['rerank']}) <> '' THEN id % 7 ELSE 999 END AS llm_rank FROM pubs")
def rerank_merge(spark, sf_dir):
    p = pubs(spark, sf_dir).select("id", "title")
    good = p.where("id % 3 = 0").select(F.col("id").alias("pub_id"), F.upper("title").alias("title"), (90 - F.col("id") % 50).alias("llm_score"), (F.col("id") % 7).alias("llm_rank"))
    twice = good.withColumn("llm_score", F.col("llm_score") - 5)
    wrong = p.where("id % 3 = 1").select(F.col("id").alias("pub_id"), F.lit("zzzz qqqq").alias("title"), F.lit(99).cast("long").alias("llm_score"), F.lit(1).cast("long").alias("llm_rank"))
    return match.rerank(p, good.unionByName(twice).unionByName(wrong)).select("id", "llm_score", "llm_rank")


G_VENUES, G_WORDS, G_NEG, G_STRONG = ("src1", "src7"), ("anth", "tion", "the", "keit", "para"), ("ingst", "oush", "eaux"), ("erheit", "ciónes")


def _kw(expr: str, w: str) -> str:
    return f"contains({expr}, '{w}')" if len(w) > 4 else f"regexp_matches({expr}, '(^|[^\\p{{L}}\\p{{N}}_]){w}($|[^\\p{{L}}\\p{{N}}_])')"


_GATE = f"""WITH {PUBS}, n AS (SELECT id, trim(regexp_replace(lower(title), '\\s+', ' ', 'g')) AS t, trim(regexp_replace(lower(raw_text), '\\s+', ' ', 'g')) AS a, trim(regexp_replace(lower(source), '[^a-z0-9]+', ' ', 'g')) AS v FROM pubs),
f AS (SELECT id, {list_of(G_VENUES, 'v')} AS vm, {" + ".join(f"CAST({_kw('t', w)} AS INTEGER)" for w in G_WORDS)} AS kt, {" + ".join(f"CAST({_kw('a', w)} AND NOT {_kw('t', w)} AS INTEGER)" for w in G_WORDS)} AS ka, least(5 * {count_of(G_NEG, "(t || ' ' || a)")}, 20) AS neg, {list_of(G_STRONG, "(t || ' ' || a)")} AS st FROM n),
s AS (SELECT *, least(100, greatest(0, CASE WHEN vm THEN 40 ELSE 0 END + least(15 * kt, 45) + least(5 * ka, 25) - neg) + CASE WHEN vm AND kt + ka >= 3 THEN 10 ELSE 0 END) AS score FROM f),
g AS (SELECT id, score AS gate_score, vm AS venue_match, CASE WHEN vm AND kt + ka > 0 THEN 'high' WHEN score >= 50 THEN 'high' WHEN score >= 25 THEN 'maybe' WHEN st THEN 'maybe' ELSE 'low' END AS gate_bucket, kt + ka AS n_keywords FROM s)"""


def _gated(spark, sf_dir):
    return gate.gate(pubs(spark, sf_dir), venue=F.col("source"), venues=G_VENUES, keywords=G_WORDS, negative=G_NEG, strong=G_STRONG)


@query("gate_bucket", f"{_GATE} SELECT id, CAST(gate_score AS BIGINT) AS gate_score, venue_match, gate_bucket, CAST(n_keywords AS BIGINT) AS n_keywords FROM g")
def gate_bucket(spark, sf_dir):
    return _gated(spark, sf_dir).select("id", F.col("gate_score").cast("long").alias("gate_score"), "venue_match", "gate_bucket", F.size("keyword_matches").cast("long").alias("n_keywords"))


@query("audit_rows", f"{_GATE}, l AS (SELECT id, row_number() OVER (ORDER BY md5('audit:' || CAST(id AS VARCHAR)), id) AS n, count(*) OVER () AS all_low FROM g WHERE gate_bucket = 'low') SELECT id FROM l WHERE n <= greatest(1, CAST(floor(all_low * 0.05) AS BIGINT)) UNION ALL SELECT id FROM g WHERE gate_bucket IN ('high', 'maybe')")
def audit_rows(spark, sf_dir):
    return gate.to_evaluate(gate.audit(_gated(spark, sf_dir).select("id", "gate_bucket"), "id", 0.05)).select("id")


@query("gate_stats", f"{_GATE}, c AS (SELECT count(*) AS total, count(*) FILTER (WHERE gate_bucket = 'high') AS high, count(*) FILTER (WHERE gate_bucket = 'maybe') AS maybe, count(*) FILTER (WHERE gate_bucket = 'low') AS low, count(*) FILTER (WHERE venue_match) AS venue_promoted, count(*) FILTER (WHERE n_keywords > 0) AS keyword_promoted FROM g) SELECT *, CASE WHEN low = 0 THEN 0 ELSE greatest(1, CAST(floor(low * 0.02) AS BIGINT)) END AS audited_low, high + maybe + CASE WHEN low = 0 THEN 0 ELSE greatest(1, CAST(floor(low * 0.02) AS BIGINT)) END AS to_evaluate FROM c")
def gate_stats(spark, sf_dir):
    return gate.gate_stats(gate.audit(_gated(spark, sf_dir).select("id", "gate_bucket", "venue_match", "keyword_matches"), "id"))


_LOW = "lower(title || chr(10) || source || chr(10) || raw_text)"
R_FAMILIES = {"detection": ("tionth", "keitver"), "ai": ("ai", "neural network"), "market": ("atwh", "market"), "genomics": ("ngs", "omics"), "treatment": ("ereddo", "adjuvant", "ingeaou"), "biology": ("ererer", "pathway"), "impact": ("onthe on", "mced"), "breath": ("breath", "voc")}
_FAM = ", ".join(f"{list_of(w, 'low')} AS f_{k}" for k, w in R_FAMILIES.items())


@query("rule_adjust", f"""WITH {PUBS}, l AS (SELECT id, coalesce(score, 0) AS base, CASE WHEN id % 4 = 0 THEN 'colon' WHEN id % 4 = 1 THEN 'ovarian' WHEN id % 4 = 2 THEN 'multi' ELSE 'none' END AS kind, {_LOW} AS low FROM pubs), f AS (SELECT *, {_FAM} FROM l),
p AS (SELECT *, kind IN ('breast', 'lung', 'prostate', 'colon', 'multi') AS target, f_market AND NOT f_detection AS market, f_genomics AND NOT f_detection AND NOT f_impact AS broad, f_treatment AND NOT f_detection AS treat, f_biology AND NOT f_detection AS bio, f_ai AND len(list_filter(regexp_split_to_array(low, '[.!?;\\n]+'), lambda s: {list_of(R_FAMILIES['ai'], 's')} AND {list_of(R_FAMILIES['detection'], 's')})) > 0 AS linked FROM f),
q AS (SELECT *, greatest(0, least(100, CASE WHEN NOT target AND NOT f_detection AND base > 60 THEN 60 ELSE base END - CASE WHEN kind NOT IN ('none', 'multi') AND NOT target THEN 12 ELSE 0 END - CASE WHEN market THEN 20 ELSE 0 END - CASE WHEN broad THEN 15 ELSE 0 END - CASE WHEN treat THEN 35 ELSE 0 END - CASE WHEN bio THEN 20 ELSE 0 END - CASE WHEN f_ai AND NOT linked THEN 8 ELSE 0 END + CASE WHEN f_ai AND linked THEN 5 ELSE 0 END + CASE WHEN f_impact AND f_detection THEN 20 ELSE 0 END + CASE WHEN f_breath AND f_detection AND NOT treat THEN 10 ELSE 0 END)) AS s FROM p),
h AS (SELECT id, CASE WHEN treat THEN least(s, 20) ELSE s END AS s FROM q)
SELECT id, CAST(CASE WHEN s >= 85 THEN least(100, 85 + round_even((s - 85) * 0.35, 0)) WHEN s >= 70 THEN s - 5 ELSE s END AS BIGINT) AS adjusted FROM h""")
def rule_adjust(spark, sf_dir):
    i = F.col("id")
    kind = F.when(i % 4 == 0, "colorectal").when(i % 4 == 1, "ovarian").when(i % 4 == 2, "multi").otherwise("none")
    d = pubs(spark, sf_dir).withColumn("score", F.coalesce("score", F.lit(0))).withColumn("signals", F.create_map(F.lit("cancer_type"), kind))
    return rules.apply_rules(d, families=R_FAMILIES).select("id", F.col("adjusted_score").cast("long").alias("adjusted"))


@query("heuristic_rank", f"""WITH {PUBS}, a AS (SELECT id, CASE WHEN contains(source, 'src1') THEN 100 ELSE 10 END AS sp, CAST(floor(date_diff('second', CAST(published_date AS TIMESTAMP), TIMESTAMP '2024-02-10') / 86400.0) AS BIGINT) AS age, least(300, 100 * {count_of(('tionth', 'keitver', 'ererer', 'osque'), "lower(title || ' ' || raw_text)")}) AS kp FROM pubs)
SELECT id, CAST(sp + CASE WHEN age < 7 THEN 200 WHEN age < 14 THEN 150 WHEN age < 30 THEN 100 ELSE 50 END + kp AS BIGINT) AS heuristic FROM a""")
def heuristic_rank(spark, sf_dir):
    d = rank.heuristic(pubs(spark, sf_dir), AS_OF, text=("title", "raw_text"), words=("tionth", "keitver", "ererer", "osque"), sources={"src1": 100})
    return d.select("id", F.col("heuristic").cast("long").alias("heuristic"))


@query("must_reads_blend", f"WITH {PUBS}, h AS (SELECT id, 10 + coalesce(score, 0) * 5 AS heuristic, CASE WHEN id % 4 = 0 THEN 999 ELSE id % 25 END AS llm_rank, CASE WHEN id % 4 = 0 THEN 0 ELSE 100 - id % 25 END AS llm_score FROM pubs), s AS (SELECT * FROM h ORDER BY heuristic DESC, id LIMIT 25) SELECT id, llm_rank, CASE WHEN llm_score < 10 THEN CAST(llm_score AS DOUBLE) ELSE round(0.4 * heuristic + 0.6 * llm_score * 6, 6) END AS score_total FROM s ORDER BY llm_rank, heuristic DESC, id LIMIT 5")
def must_reads_blend(spark, sf_dir):
    i = F.col("id")
    d = pubs(spark, sf_dir).select("id", (10 + F.coalesce("score", F.lit(0)) * 5).alias("heuristic"), F.when(i % 4 == 0, 999).otherwise(i % 25).alias("llm_rank"), F.when(i % 4 == 0, 0).otherwise(100 - i % 25).alias("llm_score"))
    return rank.must_reads(d).select("id", "llm_rank", F.round("score_total", 6).alias("score_total"))


@query("per_source_cap", f"WITH {PUBS}, r AS (SELECT id, source, row_number() OVER (PARTITION BY source ORDER BY published_date DESC, id) AS place FROM pubs) SELECT id, source, place FROM r WHERE place <= 3")
def per_source_cap(spark, sf_dir):
    return rank.per_source_cap(pubs(spark, sf_dir), "source", [F.col("published_date").desc(), F.col("id")], 3).select("id", "source", F.col("place").cast("long").alias("place"))


@query("per_source_overflow", "SELECT source, count(*) AS total, greatest(0, count(*) - 40) AS overflow FROM documents GROUP BY 1")
def per_source_overflow(spark, sf_dir):
    return rank.overflow(table(spark, sf_dir, "documents"), "source", 40)


@query("two_stage_funnel", f"WITH {PUBS} SELECT id, score FROM (SELECT * FROM pubs ORDER BY score DESC NULLS LAST, id LIMIT 200) ORDER BY score DESC NULLS LAST, id LIMIT 50")
def two_stage_funnel(spark, sf_dir):
    return rank.funnel(pubs(spark, sf_dir).select("id", "score"), "score", "id")


@query("rank_repair", f"WITH {PUBS}, c AS (SELECT id, id AS seq FROM pubs), p AS (SELECT id, min(pos) AS pos FROM (SELECT id, (id * 7919) % 1009 AS pos FROM pubs WHERE id % 2 = 0) GROUP BY 1) SELECT c.id, row_number() OVER (ORDER BY p.pos NULLS LAST, c.seq) AS rank, p.pos IS NULL AS appended FROM c LEFT JOIN p USING (id)")
def rank_repair(spark, sf_dir):
    p = pubs(spark, sf_dir)
    ranked = p.where("id % 2 = 0").select("id", ((F.col("id") * 7919) % 1009).alias("pos"))
    r = rank.repair_ranking(p.select("id", F.col("id").alias("seq")), ranked.unionByName(ranked.withColumn("pos", F.col("pos") + 5000)))
    return r.select("id", F.col("rank").cast("long").alias("rank"), "appended")


@query("minmax_norm", f"WITH {PUBS}, e AS (SELECT min(score) AS lo, max(score) AS hi FROM pubs) SELECT id, round_even((score - lo) / CAST(hi - lo AS DOUBLE) * 100, 0) AS normalized FROM pubs, e")
def minmax_norm(spark, sf_dir):
    return rank.minmax(pubs(spark, sf_dir).select("id", F.col("score").cast("double").alias("score")), "score").select("id", "normalized")


def _items(spark, sf_dir):
    p, l = pubs(spark, sf_dir), table(spark, sf_dir, "labels")
    return p.join(l, p["id"] == l["doc_id"]).select("id", "source", "score", (F.col("quality") * 2 + F.col("toxic")).alias("rating"))


ITEMS = f"{PUBS}, items AS (SELECT p.id, p.source, p.score, l.quality * 2 + l.toxic AS rating FROM pubs p JOIN labels l ON p.id = l.doc_id)"
_RANKS = "v AS (SELECT * FROM items WHERE score IS NOT NULL AND rating IS NOT NULL), k AS (SELECT source, rank() OVER ({w} ORDER BY score) + (count(*) OVER ({p} score) - 1) / 2.0 AS a, rank() OVER ({w} ORDER BY rating) + (count(*) OVER ({p} rating) - 1) / 2.0 AS b FROM v)"


@query("spearman", f"WITH {ITEMS}, {_RANKS.format(w='', p='PARTITION BY')} SELECT round(corr(a, b), 6) AS rho, count(*) AS n FROM k")
def spearman(spark, sf_dir):
    return metrics.spearman(_items(spark, sf_dir), "score", "rating").select(F.round("rho", 6).alias("rho"), "n")


@query("spearman_ordinal", f"WITH {ITEMS}, k AS (SELECT row_number() OVER (ORDER BY score, id) AS a, row_number() OVER (ORDER BY rating, id) AS b FROM items WHERE score IS NOT NULL) SELECT round(1 - 6 * sum((a - b) * (a - b)) / (count(*) * (CAST(count(*) AS DOUBLE) * count(*) - 1)), 6) AS rho, count(*) AS n FROM k")
def spearman_ordinal(spark, sf_dir):
    return metrics.spearman_ordinal(_items(spark, sf_dir), "score", "rating", "id").select(F.round("rho", 6).alias("rho"), "n")


@query("metrics_by_category", f"WITH {ITEMS}, g AS (SELECT CASE WHEN CAST(substring(source, 4) AS INTEGER) % 2 = 0 THEN 'pubmed' ELSE 'preprint' END AS source, score, rating, id FROM items), v AS (SELECT * FROM g WHERE score IS NOT NULL), k AS (SELECT source, rank() OVER (PARTITION BY source ORDER BY score) + (count(*) OVER (PARTITION BY source, score) - 1) / 2.0 AS a, rank() OVER (PARTITION BY source ORDER BY rating) + (count(*) OVER (PARTITION BY source, rating) - 1) / 2.0 AS b FROM v) SELECT source, round(corr(a, b), 6) AS rho, count(*) AS n FROM k GROUP BY 1")
def metrics_by_category(spark, sf_dir):
    name = F.when(F.substring("source", 4, 9).cast("int") % 2 == 0, "PubMed feed").otherwise("bioRxiv feed")
    d = _items(spark, sf_dir).withColumn("source", metrics.source_category(name))
    return metrics.spearman(d, "score", "rating", "source").select("source", F.round("rho", 6).alias("rho"), "n")


_NDCG = ", ".join(f"round(coalesce((SELECT sum((pow(2, rating) - 1) / log2(r + 1)) FROM m WHERE r <= {k}) / nullif((SELECT sum((pow(2, rating) - 1) / log2(r + 1)) FROM i WHERE r <= {k}), 0), 0), 6) AS ndcg_{k}, round((SELECT count(*) FROM m WHERE r <= {k} AND rating >= 2) / CAST(nullif((SELECT count(*) FROM m WHERE rating >= 2), 0) AS DOUBLE), 6) AS recall_{k}" for k in (5, 10, 20))


@query("ndcg_recall", f"WITH {ITEMS}, m AS (SELECT rating, row_number() OVER (ORDER BY score DESC, id) AS r FROM items WHERE score IS NOT NULL), i AS (SELECT rating, row_number() OVER (ORDER BY rating DESC, id) AS r FROM items WHERE score IS NOT NULL) SELECT {_NDCG}, (SELECT count(*) FROM m) AS n_items")
def ndcg_recall(spark, sf_dir):
    d = metrics.ranking_metrics(_items(spark, sf_dir), "score", "rating", "id", relevant=2)
    return d.select(*[F.round(c, 6).alias(c) for c in d.columns if c != "n_items"], "n_items")


_RATING = "CASE WHEN score < 25 THEN 0 WHEN score < 50 THEN 1 WHEN score < 75 THEN 2 ELSE 3 END"


@query("confusion", f"WITH {ITEMS} SELECT rating AS actual, {_RATING} AS predicted, count(*) AS n FROM items WHERE score IS NOT NULL GROUP BY 1, 2")
def confusion(spark, sf_dir):
    return metrics.confusion(_items(spark, sf_dir), "score", "rating", rules.rating_of(F.col("score")))


@query("accuracy", f"WITH {ITEMS} SELECT count(*) FILTER (WHERE rating = {_RATING}) AS correct, count(*) AS total, round(count(*) FILTER (WHERE rating = {_RATING}) / CAST(count(*) AS DOUBLE), 6) AS accuracy FROM items WHERE score IS NOT NULL")
def accuracy(spark, sf_dir):
    return metrics.accuracy(confusion(spark, sf_dir)).withColumn("accuracy", F.round("accuracy", 6))


@query("top_disagreements", f"WITH {ITEMS} SELECT id, score, rating, round(abs(score / 100.0 * 3.0 - rating), 6) AS error FROM items WHERE score IS NOT NULL ORDER BY error DESC, id LIMIT 20")
def top_disagreements(spark, sf_dir):
    return metrics.disagreements(_items(spark, sf_dir), "score", "rating", "id").select("id", "score", "rating", "error")


@query("majority_rating", "WITH l AS (SELECT doc_id % 40 AS item, quality * 2 + toxic AS r FROM labels), c AS (SELECT item, r, count(*) AS n FROM l GROUP BY 1, 2) SELECT item, round(sum(r * n) / CAST(sum(n) AS DOUBLE), 6) AS mean_rating, CAST(arg_max(r, n * 10 + r) AS INTEGER) AS majority_rating, CAST(sum(n) AS BIGINT) AS n_labels FROM c GROUP BY 1")
def majority_rating(spark, sf_dir):
    l = table(spark, sf_dir, "labels").select((F.col("doc_id") % 40).alias("item"), (F.col("quality") * 2 + F.col("toxic")).alias("r"))
    return metrics.ratings(l, "item", "r").withColumn("mean_rating", F.round("mean_rating", 6))


def _query_vector(d: DataFrame) -> list[float]:
    return [float(x) for x in d.where("vec_id = 7").select("embedding").first()[0]]


_COS = "list_inner_product(CAST(e.embedding AS DOUBLE[]), CAST(q.v AS DOUBLE[])) / (sqrt(list_inner_product(CAST(e.embedding AS DOUBLE[]), CAST(e.embedding AS DOUBLE[]))) * sqrt(list_inner_product(CAST(q.v AS DOUBLE[]), CAST(q.v AS DOUBLE[]))))"


@query("cosine_topk", f"WITH q AS (SELECT embedding AS v FROM embeddings WHERE vec_id = 7) SELECT vec_id, round(s, 6) AS similarity FROM (SELECT vec_id, {_COS} AS s FROM embeddings e, q ORDER BY s DESC, vec_id LIMIT 25)")
def cosine_topk(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    return search.top_k(e, _query_vector(e), "vec_id", "embedding", 25)


@query("search_threshold_hydrate", f"WITH q AS (SELECT embedding AS v FROM embeddings WHERE vec_id = 7), h AS (SELECT vec_id, {_COS} AS s FROM embeddings e, q), t AS (SELECT * FROM h WHERE s >= 0.2 ORDER BY s DESC, vec_id LIMIT 40) SELECT t.vec_id, d.source, round(s, 4) AS similarity FROM t JOIN documents d ON t.vec_id = d.doc_id ORDER BY s DESC, t.vec_id LIMIT 10")
def search_threshold_hydrate(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    rows = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("vec_id"), "source")
    return search.search(e, rows, _query_vector(e), "vec_id", "embedding", 10, 0.2).select("vec_id", "source", "similarity")


@query("missing_embeddings", "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT vec_id FROM embeddings)")
def missing_embeddings(spark, sf_dir):
    return search.missing(table(spark, sf_dir, "documents").select("doc_id"), table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("doc_id")), "doc_id")


@query("embedding_text", f"WITH {PUBS} SELECT id, sha256(concat_ws(chr(10) || chr(10), nullif(trim(title), ''), nullif(trim(raw_text), ''), 'Source: ' || source, 'Published: ' || CAST(published_date AS VARCHAR))) AS digest FROM pubs")
def embedding_text(spark, sf_dir):
    t = search.embedding_text(F.col("title"), F.col("raw_text"), F.lit(""), F.lit(""), F.col("source"), F.col("published_date").cast("string"))
    return pubs(spark, sf_dir).select("id", F.sha2(t, 256).alias("digest"))


@query("coverage_counters", f"WITH {PUBS}, n AS (SELECT * FROM pubs ORDER BY published_date DESC, id LIMIT 50) SELECT count(*) AS n, count(score) AS scored, count(*) FILTER (WHERE raw_text <> '') AS with_text FROM n")
def coverage_counters(spark, sf_dir):
    d = pubs(spark, sf_dir).orderBy(F.col("published_date").desc(), "id").limit(50)
    return d.agg(F.count(F.lit(1)).alias("n"), F.count("score").alias("scored"), F.count_if(F.col("raw_text") != "").alias("with_text"))


@query("future_dates", f"WITH {PUBS} SELECT id, CAST(published_date AS VARCHAR) AS day FROM pubs WHERE published_date > DATE '2024-02-20' + 2")
def future_dates(spark, sf_dir):
    return pubs(spark, sf_dir).where("published_date > date_add(date'2024-02-20', 2)").select("id", F.col("published_date").cast("string").alias("day"))


@query("conversation_reviews", "WITH t AS (SELECT conv_id, count(*) FILTER (WHERE role = 'user') AS u, count(*) FILTER (WHERE role = 'assistant') AS a, CAST(sum(length(text)) % 101 AS INTEGER) AS s1, CAST(max(length(text)) % 101 AS INTEGER) AS s2 FROM conversations GROUP BY 1) SELECT conv_id, u, a, CASE WHEN abs(s1 - s2) <= 15 THEN 'high' WHEN abs(s1 - s2) <= 30 THEN 'moderate' ELSE 'low' END AS agreement FROM t")
def conversation_reviews(spark, sf_dir):
    n = F.length("text")
    d = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.count_if(F.col("role") == "user").alias("u"), F.count_if(F.col("role") == "assistant").alias("a"), (F.sum(n) % 101).cast("int").alias("s1"), (F.max(n) % 101).cast("int").alias("s2"))
    return d.select("conv_id", "u", "a", rules.agreement(F.col("s1"), F.col("s2")).alias("agreement"))


@query("trigram_check", f"WITH {PUBS}, w AS (SELECT id, string_split(trim(regexp_replace(lower(title), '\\s+', ' ', 'g')), ' ') AS t, trim(regexp_replace(lower(CASE WHEN id % 2 = 0 THEN reverse(raw_text) ELSE raw_text END), '\\s+', ' ', 'g')) AS x FROM pubs) SELECT id, coalesce(len(list_filter(range(1, len(t) - 1), lambda i: contains(x, array_to_string(t[i:i + 2], ' ')))) > 0, FALSE) AS ok FROM w")
def trigram_check(spark, sf_dir):
    whole = F.when(F.col("id") % 2 == 0, F.reverse("raw_text")).otherwise(F.col("raw_text"))
    return pubs(spark, sf_dir).select("id", text.shares_trigram(F.col("title"), whole).alias("ok"))


@query("required_field_rejects", f"WITH {PUBS}, r AS (SELECT CASE WHEN id % 13 = 0 THEN 'date' WHEN id % 17 = 0 THEN 'url' WHEN trim(title) = '' THEN 'title' ELSE 'ok' END AS reason FROM pubs) SELECT reason, count(*) AS n FROM r GROUP BY 1")
def required_field_rejects(spark, sf_dir):
    d = pubs(spark, sf_dir).withColumn("day", F.when(F.col("id") % 13 != 0, F.col("published_date"))).withColumn("url", F.when(F.col("id") % 17 != 0, F.col("url")))
    return records.reject_reasons(d, {"date": F.col("day").isNotNull(), "url": F.col("url").isNotNull(), "title": F.trim("title") != ""})


@query("quarantined_rows", f"WITH {PUBS} SELECT id, CASE WHEN id % 13 = 0 THEN 'date' WHEN trim(title) = '' THEN 'title' END AS reject_reason FROM pubs WHERE id % 13 = 0 OR trim(title) = ''")
def quarantined_rows(spark, sf_dir):
    d = pubs(spark, sf_dir).withColumn("day", F.when(F.col("id") % 13 != 0, F.col("published_date")))
    return writers.quarantine(d, {"date": F.col("day").isNotNull(), "title": F.trim("title") != ""})[1].select("id", "reject_reason")


#: Titles of fourteen words of which some are near copies of others: a word is replaced or dropped.
NEAR_TITLE = "CASE id % 4 WHEN 0 THEN w || ' final report' WHEN 1 THEN w || ' final reports' WHEN 2 THEN upper(w) || ', final report' ELSE title END"
_NEAR_WORDS = "'study ' || CAST(id % 90 AS STRING) || ' of ' || source || ' k' || CAST(id % 7 AS STRING) || ' one two three four five six seven eight nine ten'"
NEAR = f"{PUBS}, near AS (SELECT id, {NEAR_TITLE} AS title, CASE WHEN id % 10 = 0 THEN '10.1/x' || CAST(id % 30 AS VARCHAR) END AS doi, CASE WHEN id % 15 = 5 THEN CAST(id % 45 AS VARCHAR) END AS pmid FROM (SELECT *, {_NEAR_WORDS} AS w FROM pubs))"
_SIMILAR = f"""{NEAR}, k AS (SELECT {TITLE_SQL['eval']} AS k, min(id) AS id FROM near GROUP BY 1 HAVING k <> ''), s AS (SELECT k, id, list_distinct(string_split(k, ' ')) AS w FROM k),
sim AS (SELECT a.id AS a_id, b.id AS b_id, len(list_intersect(a.w, b.w)) / CAST(len(list_distinct(list_concat(a.w, b.w))) AS DOUBLE) AS similarity FROM s a JOIN s b ON a.id < b.id AND len(a.w) >= 0.85 * len(b.w) AND len(b.w) >= 0.85 * len(a.w) AND len(list_intersect(a.w, b.w)) >= 0.85 * len(a.w))"""


def near_titles(spark, sf_dir) -> DataFrame:
    d = pubs(spark, sf_dir).withColumn("w", F.expr(_NEAR_WORDS))
    return d.select("id", F.expr(NEAR_TITLE).alias("title"), F.expr("CASE WHEN id % 10 = 0 THEN '10.1/x' || CAST(id % 30 AS STRING) END").alias("doi"), F.expr("CASE WHEN id % 15 = 5 THEN CAST(id % 45 AS STRING) END").alias("pmid"))


@query("similar_titles", f"WITH {_SIMILAR} SELECT a_id, b_id, round(similarity, 6) AS similarity FROM sim WHERE similarity > 0.85")
def similar_titles(spark, sf_dir):
    p = near_titles(spark, sf_dir)
    return match.similar_titles(p, p, "id", "id").where("a_id < b_id").select("a_id", "b_id", F.round("similarity", 6).alias("similarity"))


@query("merged_items", f"""WITH RECURSIVE {_SIMILAR}, star AS (SELECT min(id) OVER (PARTITION BY doi) AS a, id AS b FROM near WHERE doi IS NOT NULL UNION SELECT min(id) OVER (PARTITION BY pmid), id FROM near WHERE pmid IS NOT NULL UNION SELECT min(id) OVER (PARTITION BY {TITLE_SQL['eval']}), id FROM near WHERE {TITLE_SQL['eval']} <> '' UNION SELECT a_id, b_id FROM sim WHERE similarity > 0.85),
e AS (SELECT a, b FROM star WHERE a <> b UNION SELECT b, a FROM star WHERE a <> b), r AS (SELECT DISTINCT a AS id, a AS l FROM e UNION SELECT e.b, r.l FROM r JOIN e ON e.a = r.id WHERE r.l < e.b), g AS (SELECT id, min(l) AS l FROM r GROUP BY 1), m AS (SELECT p.id, coalesce(least(g.l, p.id), p.id) AS item, q.quality FROM pubs p LEFT JOIN g ON p.id = g.id LEFT JOIN labels q ON p.id = q.doc_id)
SELECT item AS id, count(quality) AS n_labels, count(*) AS n_rows FROM m GROUP BY 1""")
def merged_items(spark, sf_dir):
    p = near_titles(spark, sf_dir)
    edges = match.same_items(p, "id", "doi", "pmid")
    l = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"), F.array("quality").alias("labels"))
    items = p.select("id", F.array(F.lit(1)).alias("one")).join(l, "id", "left").withColumn("labels", F.array(F.struct(F.col("id").alias("i"), F.coalesce("labels", F.array().cast("array<int>")).alias("q"))))
    merged = match.merge_items(items.select("id", "labels"), "id", edges)
    return merged.select("id", F.size(F.flatten(F.transform("labels", lambda x: x["q"]))).cast("long").alias("n_labels"), F.size("labels").cast("long").alias("n_rows"))


_ISO = f"""{ITEMS}, x AS (SELECT CAST(score AS DOUBLE) AS x, avg(rating * (100 / 3.0::DOUBLE)) AS y, count(*) AS w FROM items WHERE score IS NOT NULL GROUP BY 1), c AS (SELECT x, sum(y * w) OVER o AS s, sum(w) OVER o AS n, row_number() OVER (ORDER BY x) AS i FROM x WINDOW o AS (ORDER BY x ROWS UNBOUNDED PRECEDING)),
lo AS (SELECT k.i, j.i AS j, min((z.s - coalesce(b.s, 0)) / (z.n - coalesce(b.n, 0))) AS m FROM c k JOIN c j ON j.i <= k.i JOIN c z ON z.i >= k.i LEFT JOIN c b ON b.i = j.i - 1 GROUP BY 1, 2), f AS (SELECT c.i, c.x, max(m) AS y FROM c JOIN lo ON lo.i = c.i GROUP BY 1, 2),
p AS (SELECT x, y FROM (SELECT *, lag(y) OVER (ORDER BY i) AS py FROM f) WHERE py IS NULL OR abs(y - py) > 1e-9), q AS (SELECT x, y FROM p UNION ALL SELECT 0, (SELECT y FROM p ORDER BY x LIMIT 1) WHERE (SELECT min(x) FROM p) > 0 UNION ALL SELECT 100, (SELECT y FROM p ORDER BY x DESC LIMIT 1) WHERE (SELECT max(x) FROM p) < 100), t AS (SELECT CAST(unnest(range(0, 101, 10)) AS INTEGER) AS score)"""


@query("calibration_table", f"WITH {_ISO}, a AS (SELECT score, arg_max(x, x) FILTER (WHERE x < score) AS x0, arg_max(y, x) FILTER (WHERE x < score) AS y0, arg_min(x, x) FILTER (WHERE x >= score) AS x1, arg_min(y, x) FILTER (WHERE x >= score) AS y1 FROM t, q GROUP BY 1) SELECT score, round(coalesce(y0 + (score - x0) / (x1 - x0) * (y1 - y0), y1), 6) AS calibrated FROM a")
def calibration_table(spark, sf_dir):
    d = _items(spark, sf_dir)
    c = metrics.Calibrator.fit(d, "score", "rating")
    again = metrics.Calibrator.from_json(c.to_json())
    if not (again.monotone() and again.bounded(0, 100) and again.xs == c.xs):
        raise ValueError("a stored calibrator differs from the fitted one")
    return again.table(d).withColumn("calibrated", F.round("calibrated", 6))


_GRAMS = "list_distinct(list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' ')))"
_WORDS = "string_split(trim(regexp_replace(lower(text), '\\s+', ' ', 'g')), ' ')"


@query("benchmark_in_documents", f"""WITH b AS (SELECT item_id, {_WORDS} AS w FROM benchmark), d AS (SELECT doc_id, {_WORDS} AS w FROM documents WHERE text IS NOT NULL), bg AS (SELECT item_id, unnest({_GRAMS}) AS g, len({_GRAMS}) AS n FROM b WHERE len(w) >= 3), dg AS (SELECT doc_id, unnest({_GRAMS}) AS g FROM d WHERE len(w) >= 3),
h AS (SELECT item_id, doc_id, count(*) AS hits, any_value(n) AS n FROM bg JOIN dg USING (g) GROUP BY 1, 2) SELECT item_id, count(*) AS n_touched, count(*) FILTER (WHERE 2 * hits >= n) AS n_documents FROM h GROUP BY 1""")
def benchmark_in_documents(spark, sf_dir):
    """Documents that share trigrams of words with a benchmark item, and those that hold half of its trigrams or more: an equi-join on the trigrams themselves."""
    grams = F.array_distinct(text.trigrams(F.col("text")))
    # the outer form adds no filter on the number of phrases, for which the texts would be cut up again
    b = table(spark, sf_dir, "benchmark").select("item_id", grams.alias("g")).select("item_id", F.size("g").alias("n"), F.explode_outer("g").alias("gram"))
    d = table(spark, sf_dir, "documents").select("doc_id", F.explode_outer(grams).alias("gram"))
    hits = d.join(b, "gram").groupBy("item_id", "doc_id").agg(F.count(F.lit(1)).alias("hits"), F.first("n").alias("n"))
    return hits.groupBy("item_id").agg(F.count(F.lit(1)).alias("n_touched"), F.count_if(2 * F.col("hits") >= F.col("n")).alias("n_documents"))
