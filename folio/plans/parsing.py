"""Queries for pages, dates and model answers: several forms of each, parsed by the SQL too."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import functions as F

from folio.functions import dates, extract, identifiers, jsonx, rules, text
from folio.operators import attachments, metrics, records
from folio.plans.documents import PUBS, pubs
from folio.plans.identify import DOI_RAW, ID, text_doi
from folio.plans.registry import query, table

AS_OF = datetime(2024, 2, 10)

# ---- pages: heads with meta tags and JSON-LD of several forms before the page itself
PAGE_DATE = """CASE page_id % 8 WHEN 0 THEN '2024-03-0' || CAST(1 + page_id % 9 AS STRING) WHEN 1 THEN '2023/7/' || CAST(1 + page_id % 28 AS STRING) WHEN 2 THEN 'January ' || CAST(1 + page_id % 28 AS STRING) || ', 2022' WHEN 3 THEN CAST(1 + page_id % 28 AS STRING) || ' Sep 2021'
 WHEN 4 THEN '2024-01-02T03:04:05Z' WHEN 5 THEN 'Smarch 3, 2020' WHEN 6 THEN 'Dec 9 2019' ELSE 'in spring' END"""
LD = """CASE page_id % 9 WHEN 0 THEN '{"@type": "Article", "headline": "Head ' || CAST(page_id AS STRING) || '", "datePublished": "' || day || '", "doi": "10.1000/ld.' || CAST(page_id AS STRING) || '"}'
 WHEN 1 THEN '{"name": "Name ' || CAST(page_id AS STRING) || '", "dateCreated": "' || day || '", "publisher": {"name": "House"}, "identifier": {"@type": "PropertyValue", "propertyID": "doi", "value": "https://doi.org/10.2000/pv.' || CAST(page_id AS STRING) || '."}}'
 WHEN 2 THEN '{"publisher": "Press", "sameAs": ["https://x.example/1", "https://doi.org/10.3000/sa.' || CAST(page_id AS STRING) || ';"]}' WHEN 3 THEN '[{"isPartOf": {"name": "Journal of Parts"}, "url": "https://x.example"}, {"@id": "doi:10.4000/id_' || CAST(page_id AS STRING) || '"}]'
 WHEN 4 THEN '{"identifier": [{"@type": "PropertyValue", "propertyID": "issn", "value": "10.9999/no"}, {"@type": "PropertyValue", "propertyID": "doi", "value": "10.5000/l' || CAST(page_id AS STRING) || '"}]}' WHEN 5 THEN '{"identifier": {"@value": "10.6000/v' || CAST(page_id AS STRING) || '"}}'
 WHEN 6 THEN '{broken' ELSE '' END"""
HEAD = """CASE page_id % 7 WHEN 0 THEN '<meta name="citation_doi" content="10.7000/CD.' || CAST(page_id AS STRING) || '"><meta content="' || day || '" name="citation_publication_date">' WHEN 1 THEN '<meta property="og:title" content=" Og ' || CAST(page_id AS STRING) || ' "><meta property="og:site_name" content="Site">'
 WHEN 2 THEN '<meta name="dc.identifier" content="doi:10.7100/dc' || CAST(page_id AS STRING) || '"><meta name="citation_title" content="Cited"><meta name="citation_journal_title" content="J. Cit.">' WHEN 3 THEN '<a href="https://dx.doi.org/10.7200/link.' || CAST(page_id AS STRING) || '">x</a>'
 WHEN 4 THEN '<meta property="article:published_time" content="' || day || '">' WHEN 5 THEN '<meta property="og:url" content="https://a.example/10.7300/og-' || CAST(page_id AS STRING) || '">' ELSE '' END"""
FULL = """head || CASE WHEN ld <> '' THEN '<script type="application/ld+json">' || ld || '</script>' ELSE '' END || CASE WHEN page_id % 5 = 0 THEN replace(html, 'title>', 'titel>') ELSE html END"""
PAGES = f"pg AS (SELECT *, {FULL} AS whole FROM (SELECT *, {LD} AS ld, {HEAD} AS head FROM (SELECT *, {PAGE_DATE} AS day FROM pages)))"


def full_pages(spark, sf_dir):
    """pages with heads (column whole): meta tags of the usual names, JSON-LD, links and several forms of date."""
    d = table(spark, sf_dir, "pages").withColumn("day", F.expr(PAGE_DATE))
    return d.withColumns({"ld": F.expr(LD), "head": F.expr(HEAD)}).withColumn("whole", F.expr(FULL))


def meta(name: str) -> str:
    n = name.replace(".", r"\.")
    q = "[\"'']"
    a = f"nullif(regexp_extract(whole, '(?is)<meta[^>]*(?:name|property)={q}{n}{q}[^>]*content={q}([^\"'']*){q}', 1), '')"
    b = f"nullif(regexp_extract(whole, '(?is)<meta[^>]*content={q}([^\"'']*){q}[^>]*(?:name|property)={q}{n}{q}', 1), '')"
    return f"nullif(trim(coalesce({a}, {b})), '')"


def page_date(c: str) -> str:
    mon = lambda w: "CASE " + " ".join(f"WHEN {w} IN ('{m}', '{m[:3]}') THEN '{k:02d}'" for k, m in enumerate(dates.MONTHS, 1)) + " END"
    part = lambda p, k: f"nullif(regexp_extract(lower({c}), '{p}', {k}), '')"
    one, two, sl = r"^([\p{L}]+)\s+(\d{1,2}),?\s+(\d{4})", r"^(\d{1,2})\s+([\p{L}]+)\s+(\d{4})", r"^(\d{4})/(\d{1,2})/(\d{1,2})"
    made = lambda y, m, d: f"{y} || '-' || lpad({m}, 2, '0') || '-' || lpad({d}, 2, '0') || 'T00:00:00'"
    return f"CASE WHEN regexp_matches({c}, '^\\d{{4}}-\\d{{2}}-\\d{{2}}') THEN CASE WHEN contains({c}, 'T') THEN {c} ELSE {c} || 'T00:00:00' END WHEN regexp_matches({c}, '{sl}') THEN {made(part(sl, 1), part(sl, 2), part(sl, 3))} ELSE coalesce({made(part(one, 3), mon(part(one, 1)), part(one, 2))}, {made(part(two, 3), mon(part(two, 2)), part(two, 1))}) END"


@query("page_dates", f"WITH {PAGES} SELECT page_id, {page_date('day')} AS iso FROM pg")
def page_dates(spark, sf_dir):
    return full_pages(spark, sf_dir).select("page_id", dates.page_date(F.col("day")).alias("iso"))


_LD_DOI = r"10\.\d{4,}/[^\s\"''<>)}\]]+[^\s\"''<>)}\].,;:]"


def _doi_of(c: str) -> str:
    return f"rtrim(nullif(regexp_extract(coalesce({c}, ''), '{_LD_DOI}', 0), ''), '.,;:')"


def ld_doi(o: str) -> str:
    fields = []
    for f in identifiers.LD_DOI_FIELDS:
        at = f'$."{f}"'
        v, kind = f"json_extract({o}, '{at}')", f"json_type({o}, '{at}')"
        s = f"json_extract_string({o}, '{at}')"
        named = lambda x: f"json_extract_string({x}, '$.\"@type\"') = 'PropertyValue' AND json_extract_string({x}, '$.propertyID') = 'doi'"
        inner = f"coalesce(CASE WHEN {named(v)} THEN {_doi_of(f'json_extract_string({v}, {chr(39)}$.value{chr(39)})')} END, {_doi_of(f'coalesce(json_extract_string({v}, {chr(39)}$.value{chr(39)}), json_extract_string({v}, {chr(39)}$.' + chr(34) + '@value' + chr(34) + f'{chr(39)}))')})"
        item = f"CASE WHEN json_type(y) = 'OBJECT' THEN CASE WHEN {named('y')} THEN {_doi_of('json_extract_string(y, ' + chr(39) + '$.value' + chr(39) + ')')} END ELSE {_doi_of('(y ->> ' + chr(39) + '$' + chr(39) + ')')} END"
        items = f"list_filter(list_transform(CAST({v} AS JSON[]), lambda y: {item}), lambda z: z IS NOT NULL)[1]"
        fields.append(f"CASE {kind} WHEN 'OBJECT' THEN {inner} WHEN 'ARRAY' THEN {items} ELSE {_doi_of(s)} END")
    return "coalesce(" + ", ".join(fields) + ")"


#: One row a JSON-LD object of a page, in order.
LDS = f"{PAGES}, lj AS (SELECT page_id, CASE WHEN json_valid(ld) AND ld <> '' THEN CAST(ld AS JSON) END AS j FROM pg), lo AS (SELECT page_id, CASE WHEN json_type(j) = 'ARRAY' THEN CAST(j AS JSON[]) ELSE [j] END AS os FROM lj WHERE j IS NOT NULL), li AS (SELECT page_id, generate_subscripts(os, 1) AS n, unnest(os) AS o FROM lo)"


@query("html_identifiers", f"""WITH {LDS}, ld AS (SELECT page_id, arg_min(doi, n) FILTER (WHERE doi IS NOT NULL) AS doi FROM (SELECT page_id, n, {ld_doi('o')} AS doi FROM li) GROUP BY 1)
SELECT pg.page_id, coalesce({text_doi(meta('citation_doi'))}, {text_doi(meta('dc.identifier'))}, {text_doi(meta('og:url'))}, {text_doi("nullif(regexp_extract(whole, '(?i)href=[" + '"' + "''](https?://(?:dx\\.)?doi\\.org/[^" + '"' + "'']+)', 1), '')")}, ld.doi) AS doi, ld.doi AS ld_doi FROM pg LEFT JOIN ld USING (page_id)""")
def html_identifiers(spark, sf_dir):
    h = F.col("whole")
    found = F.filter(F.transform(identifiers.ld_objects(h), identifiers.ld_doi), lambda x: x.isNotNull())
    return full_pages(spark, sf_dir).select("page_id", identifiers.html_doi(h).alias("doi"), F.try_element_at(found, F.lit(1)).alias("ld_doi"))


_js = lambda o, p: f"nullif(json_extract_string({o}, '{p}'), '')"


@query("html_metadata", f"""WITH {LDS}, m AS (SELECT page_id, n, coalesce({_js('o', '$.headline')}, {_js('o', '$.name')}) AS title, coalesce({_js('o', '$.datePublished')}, {_js('o', '$.dateCreated')}) AS day, coalesce(CASE json_type(o, '$.publisher') WHEN 'OBJECT' THEN {_js('o', '$.publisher.name')} WHEN 'VARCHAR' THEN {_js('o', '$.publisher')} END, {_js('o', '$.isPartOf.name')}) AS source FROM li),
d AS (SELECT page_id, n, title, source, {page_date('day')} AS day FROM m), l AS (SELECT page_id, arg_min(title, n) FILTER (WHERE title IS NOT NULL) AS title, arg_min(day, n) FILTER (WHERE day IS NOT NULL) AS day, arg_min(source, n) FILTER (WHERE source IS NOT NULL) AS source FROM d GROUP BY 1),
p AS (SELECT page_id, {meta('og:title')} AS t1, {meta('citation_title')} AS t2, nullif(trim(regexp_extract(whole, '(?is)<title[^>]*>(.*?)</title>', 1)), '') AS t3, {meta('citation_publication_date')} AS d1, {meta('article:published_time')} AS d2, {meta('dc.date')} AS d3, {meta('citation_journal_title')} AS s1, {meta('og:site_name')} AS s2 FROM pg)
SELECT p.page_id, coalesce(t1, t2, t3, l.title) AS title, coalesce({page_date('d1')}, {page_date('d2')}, {page_date('d3')}, l.day) AS day, coalesce(s1, s2, l.source) AS journal FROM p LEFT JOIN l USING (page_id)""")
def html_metadata(spark, sf_dir):
    h = F.col("whole")
    return full_pages(spark, sf_dir).select("page_id", identifiers.html_title(h).alias("title"), identifiers.html_date(h).alias("day"), identifiers.html_journal(h).alias("journal"))


# ---- dates
RAW_DATE = """CASE id % 7 WHEN 0 THEN '2024/3/' || CAST(1 + id % 28 AS STRING) WHEN 1 THEN CAST(2015 + id % 15 AS STRING) WHEN 2 THEN '2024 Nov-Dec' WHEN 3 THEN CAST(2020 + id % 6 AS STRING) || ' Spring' WHEN 4 THEN '2024 Nov ' || CAST(1 + id % 28 AS STRING) WHEN 5 THEN '2024-0' || CAST(1 + id % 9 AS STRING) || '-15 10:00' ELSE 'soon' END"""
SORT_DATE = "CASE id % 3 WHEN 0 THEN '2023/12/' || CAST(10 + id % 20 AS STRING) || ' 00:00' WHEN 1 THEN 'none' ELSE NULL END"
EPUB = "CASE id % 2 WHEN 0 THEN '2026 Feb ' || CAST(1 + id % 28 AS STRING) ELSE NULL END"
_SEASON = "CASE " + " ".join(f"WHEN w = '{k}' THEN {m}" for k, m in dates.SEASONS.items()) + " " + " ".join(f"WHEN w IN ('{n}', '{n[:3]}') THEN {m}" for m, n in enumerate(dates.MONTHS, 1)) + " END"


def record_date(c: str) -> str:
    """The day of a record's date in DuckDB."""
    low = f"lower(trim({c}))"
    month = _SEASON.replace("w =", f"regexp_extract({low}, '^[0-9]{{4}} ([a-z]+)', 1) =").replace("w IN", f"regexp_extract({low}, '^[0-9]{{4}} ([a-z]+)', 1) IN")
    day = lambda y, m, d: f"TRY_CAST({y} || '-' || lpad(CAST({m} AS VARCHAR), 2, '0') || '-' || lpad({d}, 2, '0') AS DATE)"
    p = lambda k: f"regexp_extract({low}, '^([0-9]{{4}})/([0-9]{{1,2}})/([0-9]{{1,2}})$', {k})"
    y = f"regexp_extract({low}, '^([0-9]{{4}})', 1)"
    return f"CASE WHEN regexp_matches({low}, '^[0-9]{{4}}/[0-9]{{1,2}}/[0-9]{{1,2}}$') THEN {day(p(1), p(2), p(3))} WHEN regexp_matches({low}, '^[0-9]{{4}}$') THEN {day(y, '1', chr(39) + '1' + chr(39))} WHEN regexp_matches({low}, '^[0-9]{{4}} [a-z]+(-[a-z]+)?$') THEN {day(y, month, chr(39) + '1' + chr(39))} WHEN regexp_matches({low}, '^[0-9]{{4}} [a-z]+ [0-9]{{1,2}}$') THEN {day(y, month, f'regexp_extract({low}, {chr(39)}([0-9]{{1,2}})${chr(39)}, 1)')} ELSE TRY_CAST(substring({low}, 1, 10) AS DATE) END"


_YEAR_ONLY = "regexp_matches(trim({0}), '^[0-9]{{4}}$')"


@query("record_dates", f"WITH {PUBS}, r AS (SELECT id, {RAW_DATE} AS r FROM pubs) SELECT id, CAST({record_date('r')} AS VARCHAR) AS day, {_YEAR_ONLY.format('r')} AS low_confidence FROM r")
def record_dates(spark, sf_dir):
    d = pubs(spark, sf_dir).select("id", dates.record_date(F.expr(RAW_DATE)).alias("d"))
    return d.select("id", F.col("d.day").cast("string").alias("day"), "d.low_confidence")


@query("best_dates", f"""WITH {PUBS}, r AS (SELECT id, {RAW_DATE} AS a, {SORT_DATE} AS b, {EPUB} AS c FROM pubs), p AS (SELECT *, {record_date('a')} AS da, {record_date("regexp_extract(b, '^([^ ]+)', 1)")} AS db, {record_date('c')} AS dc FROM r),
q AS (SELECT id, coalesce(da, db, dc) AS day, CASE WHEN da IS NOT NULL THEN 'pubdate' WHEN db IS NOT NULL THEN 'sortpubdate' WHEN dc IS NOT NULL THEN 'epubdate' END AS date_source, CASE WHEN da IS NOT NULL THEN a WHEN db IS NOT NULL THEN regexp_extract(b, '^([^ ]+)', 1) WHEN dc IS NOT NULL THEN c END AS date_raw, da IS NOT NULL AND {_YEAR_ONLY.format('a')} AS low FROM p)
SELECT id, CAST(day AS VARCHAR) AS day, date_source, date_raw, CAST(CASE WHEN day <= DATE '2024-02-10' + CASE WHEN low THEN 365 ELSE 90 END THEN day END AS VARCHAR) AS clamped FROM q""")
def best_dates(spark, sf_dir):
    b = dates.best_date(F.expr(RAW_DATE), F.expr(SORT_DATE), F.expr(EPUB))
    d = pubs(spark, sf_dir).select("id", b.alias("b"))
    return d.select("id", F.col("b.day").cast("string").alias("day"), "b.date_source", "b.date_raw", dates.clamp_future(F.col("b.day"), F.coalesce("b.low_confidence", F.lit(False)), AS_OF.date()).cast("string").alias("clamped"))


FEED_DATE = """CASE id % 5 WHEN 0 THEN 'Mon, ' || CAST(1 + id % 28 AS STRING) || ' Jan 2024 10:30:00 GMT' WHEN 1 THEN '2024-01-' || CAST(10 + id % 20 AS STRING) || 'T08:15:00Z' WHEN 2 THEN CAST(1 + id % 28 AS STRING) || ' Feb 2024 23:05:09 +0200' WHEN 3 THEN '2024-02-0' || CAST(1 + id % 9 AS STRING) ELSE 'yesterday' END"""


@query("feed_dates", f"WITH {PUBS}, r AS (SELECT id, {FEED_DATE} AS r FROM pubs), s AS (SELECT id, r, try_strptime(regexp_replace(regexp_replace(r, '^[A-Za-z]{{3}}, *', ''), ' +GMT$', ''), ['%d %b %Y %H:%M:%S', '%d %b %Y %H:%M:%S +0200']) AS mail FROM r) SELECT id, strftime(CASE WHEN r LIKE '%Z' THEN TRY_CAST(replace(rtrim(r, 'Z'), 'T', ' ') AS TIMESTAMP) WHEN r LIKE '2024-%' THEN TRY_CAST(r AS TIMESTAMP) WHEN r LIKE '%+0200' THEN mail - INTERVAL 2 HOUR ELSE mail END, '%Y-%m-%d %H:%M:%S') AS utc FROM s")
def feed_dates(spark, sf_dir):
    return pubs(spark, sf_dir).select("id", F.date_format(dates.feed_date(F.expr(FEED_DATE)), "yyyy-MM-dd HH:mm:ss").alias("utc"))


@query("date_labels", """SELECT event_id, coalesce(date_diff('second', ts, TIMESTAMP '2024-02-10') <= 86400 * 21 - 1, FALSE) AS recent, strftime(ts, '%b ') || CAST(day(ts) AS VARCHAR) || strftime(ts, ', %Y') AS shown, 'weekly-' || CAST(isoyear(ts) AS VARCHAR) || '-' || lpad(CAST(week(ts) AS VARCHAR), 2, '0') AS week_id,
 CAST(CAST(date_trunc('week', ts - INTERVAL 5 HOUR) AS DATE) AS VARCHAR) AS monday, substring(CAST(ts AS VARCHAR), 1, 4) AS year FROM events""")
def date_labels(spark, sf_dir):
    t = F.col("ts").cast("timestamp")
    return table(spark, sf_dir, "events").select("event_id", dates.is_recent(t, AS_OF, 20).alias("recent"), dates.display(t).alias("shown"), dates.week_id(t).alias("week_id"), dates.week_start(t).cast("string").alias("monday"), F.substring(t.cast("string"), 1, 4).alias("year"))


@query("run_windows", """SELECT 'daily-2024-02-10' AS run_id, count(*) FILTER (WHERE ts >= TIMESTAMP '2024-02-10' - INTERVAL 48 HOUR AND ts <= TIMESTAMP '2024-02-10') AS n FROM events UNION ALL
 SELECT 'weekly-' || CAST(isoyear(DATE '2024-01-17') AS VARCHAR) || '-' || lpad(CAST(week(DATE '2024-01-17') AS VARCHAR), 2, '0'), count(*) FILTER (WHERE ts >= TIMESTAMP '2024-01-17' - INTERVAL 7 DAY AND ts <= TIMESTAMP '2024-01-17') FROM events UNION ALL
 SELECT 'brief-this', count(*) FILTER (WHERE CAST(ts AS DATE) BETWEEN date_trunc('week', DATE '2024-01-17') AND date_trunc('week', DATE '2024-01-17') + INTERVAL 6 DAY) FROM events UNION ALL
 SELECT 'brief-last', count(*) FILTER (WHERE CAST(ts AS DATE) BETWEEN date_trunc('week', DATE '2024-01-17') - INTERVAL 7 DAY AND date_trunc('week', DATE '2024-01-17') - INTERVAL 1 DAY) FROM events UNION ALL
 SELECT 'brief-trailing', count(*) FILTER (WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-10' AND DATE '2024-01-17') FROM events""")
def run_windows(spark, sf_dir):
    e, today = table(spark, sf_dir, "events"), date(2024, 1, 17)
    daily, weekly = dates.run_context(AS_OF, "daily"), dates.run_context(datetime(2024, 1, 17), "weekly")
    frames = [(w["run_id"], F.col("ts").between(F.lit(w["start"]).cast("timestamp_ntz"), F.lit(w["end"]).cast("timestamp_ntz"))) for w in (daily, weekly)]
    briefs = {"this": dates.brief_window(today, "this"), "last": dates.brief_window(today, "last"), "trailing": dates.brief_window(today)}
    frames += [(f"brief-{k}", F.to_date("ts").between(F.lit(a), F.lit(b))) for k, (a, b) in briefs.items()]
    counts = e.agg(*[F.count_if(c).alias(n) for n, c in frames])
    return counts.unpivot([], [f"`{n}`" for n, _ in frames], "run_id", "n")


# ---- model answers
ANSWER = f"""CASE doc_id % 10 WHEN 0 THEN 'Here:' || chr(10) || '{{"relevancy_score": ' || CAST(doc_id % 140 AS STRING) || ', "relevancy_reason": "r' || source || '", "concerns": ["a", " ", "b"],}} done' WHEN 1 THEN '```json' || chr(10) || '{{"relevancy_score_0_100": ' || CAST(doc_id % 101 AS STRING) || ', "key_reasons": ["x", "' || source || '"], "uncertainty": 0.' || CAST(doc_id % 10 AS STRING) || '}}' || chr(10) || '```'
 WHEN 2 THEN '{{"relevancy_rating_0_3": ' || CAST(doc_id % 5 AS STRING) || ', "summary": "s' || source || '", "confidence": "high", "concerns": "None"}}' WHEN 3 THEN '{{"relevancy_score": "high", "summary": "no number"}}' WHEN 4 THEN 'no object at all' WHEN 5 THEN '{{"relevancy_score": ' || CAST(doc_id % 90 AS STRING) || ', "summary": "only", "concerns": "one worry", "uncertainty": "Low"}}'
 WHEN 6 THEN '{{"relevancy_score": 12' WHEN 7 THEN '{{"relevancy_score": ' || CAST(doc_id % 101 AS STRING) || ', "relevancy_reason": "n", "confidence": "low", "signals": {{"breath": true}}, "credibility_score": ' || CAST(doc_id % 120 AS STRING) || ', "credibility_reason": "c' || source || '"}}'
 WHEN 8 THEN '{{"final_relevancy_score": ' || CAST(doc_id % 130 AS STRING) || ', "final_relevancy_rating_0_3": ' || CAST(doc_id % 5 AS STRING) || ', "final_relevancy_reason": "f", "confidence": ' || CAST(doc_id % 150 AS STRING) || ', "final_summary": "fs' || source || '"}}' ELSE '{{"final_relevancy_score": 50, "final_relevancy_rating_0_3": 2, "final_relevancy_reason": "f2"}}' END"""
_OBJ = "regexp_replace(nullif(regexp_extract(regexp_replace(regexp_replace(trim(a), '^```[^\\n]*\\n?', ''), '\\n\\s*```[^\\n]*$', ''), '(?s)\\{.*\\}', 0), ''), ',\\s*([}\\]])', '\\1', 'g')"
ANSWERS = f"an AS (SELECT doc_id, {ANSWER} AS a FROM documents), ob AS (SELECT doc_id, a, {_OBJ} AS t FROM an), js AS (SELECT doc_id, a, t, coalesce(json_valid(t), FALSE) AS good, CASE WHEN json_valid(t) THEN CAST(t AS JSON) END AS j FROM ob)"
_g = lambda n: f"json_extract_string(j, '$.{n}')"
_int = lambda n: f"CASE WHEN regexp_matches({_g(n)}, '^-?[0-9]+$') THEN CAST({_g(n)} AS INTEGER) END"
_SURE = f"CASE WHEN {_g('uncertainty')} IS NULL THEN NULL WHEN regexp_matches({_g('uncertainty')}, '^-?[0-9]+([.][0-9]+)?$') THEN CASE WHEN 1 - CAST({_g('uncertainty')} AS DOUBLE) < 0.4 THEN 'low' WHEN 1 - CAST({_g('uncertainty')} AS DOUBLE) < 0.7 THEN 'medium' ELSE 'high' END WHEN contains(lower({_g('uncertainty')}), 'low') THEN 'high' WHEN contains(lower({_g('uncertainty')}), 'high') THEN 'low' ELSE 'medium' END"


def answers(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", "source", F.expr(ANSWER).alias("a"))


@query("review_answers", f"""WITH {ANSWERS}, r AS (SELECT doc_id, good, coalesce({_int('relevancy_score')}, {_int('relevancy_score_0_100')}, least(100, greatest(0, {_int('relevancy_rating_0_3')} * 33))) AS score, coalesce({_g('relevancy_reason')}, nullif(array_to_string(CAST(json_extract(j, '$.key_reasons') AS VARCHAR[]), '; '), ''), {_g('summary')}) AS reason, coalesce({_g('confidence')}, {_SURE}, 'medium') AS confidence, coalesce({_g('summary')}, '') AS summary,
 CASE WHEN json_type(j, '$.concerns') = 'ARRAY' THEN len(list_filter(CAST(json_extract(j, '$.concerns') AS VARCHAR[]), lambda x: trim(x) <> '')) WHEN lower(trim({_g('concerns')})) IN ('', 'none') OR {_g('concerns')} IS NULL THEN 0 ELSE 1 END AS n_concerns FROM js)
SELECT doc_id, score, reason, confidence, summary, CAST(n_concerns AS INTEGER) AS n_concerns, good AND coalesce(score BETWEEN 0 AND 100, FALSE) AND reason IS NOT NULL AS valid FROM r WHERE good""")
def review_answers(spark, sf_dir):
    d = answers(spark, sf_dir).where(F.coalesce(jsonx.parses(F.col("a")), F.lit(False))).select("doc_id", jsonx.review(F.col("a"), "v1").alias("r"))
    return d.select("doc_id", F.col("r.relevancy_score").alias("score"), F.col("r.relevancy_reason").alias("reason"), "r.confidence", "r.summary", F.size("r.concerns").alias("n_concerns"), "r.valid")


@query("robust_json", f"WITH {ANSWERS} SELECT doc_id, t AS object, good AS parses, CASE WHEN good THEN coalesce({_g('relevancy_score')}, {_g('final_relevancy_score')}) END AS score, CASE WHEN good THEN coalesce(nullif({_g('summary')}, ''), nullif({_g('final_summary')}, '')) END AS summary FROM js")
def robust_json(spark, sf_dir):
    a = F.col("a")
    ok = F.coalesce(jsonx.parses(a), F.lit(False))
    return answers(spark, sf_dir).select("doc_id", jsonx.object_text(a).alias("object"), ok.alias("parses"), F.when(ok, F.coalesce(jsonx.field(a, "relevancy_score"), jsonx.field(a, "final_relevancy_score"))).alias("score"), F.when(ok, jsonx.first_field(a, "summary", "final_summary")).alias("summary"))


@query("evaluator_answers", f"""WITH {ANSWERS}, e AS (SELECT doc_id, j, CASE WHEN NOT good THEN 'no object' WHEN {_g('final_relevancy_score')} IS NULL OR {_g('final_relevancy_rating_0_3')} IS NULL OR {_g('final_relevancy_reason')} IS NULL THEN 'missing field' WHEN {_int('final_relevancy_score')} IS NULL OR {_int('final_relevancy_rating_0_3')} IS NULL THEN 'wrong type'
 WHEN {_int('final_relevancy_score')} NOT BETWEEN 0 AND 100 THEN 'score out of range' WHEN {_int('final_relevancy_rating_0_3')} NOT BETWEEN 0 AND 3 THEN 'rating out of range' END AS error FROM js)
SELECT doc_id, error, CASE WHEN error IS NULL THEN {_int('final_relevancy_score')} END AS score, CASE WHEN error IS NULL THEN {_int('final_relevancy_rating_0_3')} END AS rating, CASE WHEN error IS NULL THEN coalesce(greatest(0, least(100, {_int('confidence')})), 60) END AS confidence, CASE WHEN error IS NULL THEN coalesce({_g('final_summary')}, {_g('final_relevancy_reason')}) END AS summary FROM e""")
def evaluator_answers(spark, sf_dir):
    d = answers(spark, sf_dir).select("doc_id", jsonx.evaluation(F.col("a")).alias("e"))
    return d.select("doc_id", "e.error", F.col("e.final_score").alias("score"), F.col("e.final_rating").alias("rating"), "e.confidence", F.col("e.final_summary").alias("summary"))


def _scored_sql(score: str, reason: str) -> str:
    ok = f"good AND coalesce({_int(score)} BETWEEN 0 AND 100, FALSE) AND nullif({_g(reason)}, '') IS NOT NULL"
    return f"WITH {ANSWERS}, s AS (SELECT doc_id, j, {ok} AS valid FROM js) SELECT doc_id, valid, CASE WHEN valid THEN {_int(score)} END AS score, CASE WHEN valid THEN {_g(reason)} END AS reason, CASE WHEN valid THEN CASE WHEN lower({_g('confidence')}) IN ('low', 'medium', 'high') THEN lower({_g('confidence')}) ELSE 'medium' END END AS confidence FROM s"


def _scored(spark, sf_dir, score, reason):
    return answers(spark, sf_dir).select("doc_id", jsonx.scored(F.col("a"), score, reason).alias("s")).select("doc_id", "s.valid", "s.score", "s.reason", "s.confidence")


@query("relevancy_answers", _scored_sql("relevancy_score", "relevancy_reason"))
def relevancy_answers(spark, sf_dir):
    return _scored(spark, sf_dir, "relevancy_score", "relevancy_reason")


@query("credibility_answers", _scored_sql("credibility_score", "credibility_reason"))
def credibility_answers(spark, sf_dir):
    return _scored(spark, sf_dir, "credibility_score", "credibility_reason")


NESTED = "CASE id % 4 WHEN 0 THEN '{\"review\": {\"relevancy_score\": ' || CAST(id % 101 AS STRING) || '}}' WHEN 1 THEN '{\"relevancy_score\": ' || CAST(id % 77 AS STRING) || '}' WHEN 2 THEN '{\"review\": {}}' ELSE NULL END"
LISTED = "CASE id % 5 WHEN 0 THEN '[\"' || source || '\", \"b\"]' WHEN 1 THEN 'plain ' || source WHEN 2 THEN '' WHEN 3 THEN '[broken' ELSE NULL END"


@query("review_fields", f"WITH {PUBS}, n AS (SELECT id, {NESTED} AS n, {LISTED} AS l FROM pubs) SELECT id, CAST(coalesce(json_extract_string(n, '$.review.relevancy_score'), json_extract_string(n, '$.relevancy_score')) AS INTEGER) AS score, array_to_string(CASE WHEN l IS NULL OR trim(l) = '' THEN [] WHEN starts_with(l, '[') AND json_valid(l) THEN CAST(CAST(l AS JSON) AS VARCHAR[]) ELSE [l] END, '|') AS listed FROM n")
def review_fields(spark, sf_dir):
    return pubs(spark, sf_dir).select("id", jsonx.review_score(F.expr(NESTED)).alias("score"), F.array_join(jsonx.as_list(F.expr(LISTED)), "|").alias("listed"))


@query("any_to_text", "SELECT doc_id, '[\"' || source || '\",\"' || coalesce(lang, '-') || '\"]' AS list, '{\"n\":' || CAST(n_chars AS VARCHAR) || ',\"s\":\"' || source || '\"}' AS object, CAST(n_chars AS VARCHAR) AS number, lang AS words FROM documents")
def any_to_text(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", F.array("source", F.coalesce("lang", F.lit("-"))).alias("list"), F.struct(F.col("n_chars").alias("n"), F.col("source").alias("s")).alias("object"), F.col("n_chars").alias("number"), F.col("lang").alias("words"))
    return d.select("doc_id", *[text.as_text(F.col(f.name), f.dataType).alias(f.name) for f in d.schema if f.name != "doc_id"])


RANKED = """CASE doc_id % 5 WHEN 0 THEN 'ok {"ranked_ids": ["a' || CAST(doc_id AS STRING) || '", "b", "' || source || '"]} end' WHEN 1 THEN '{"ranked_ids": ["a' || CAST(doc_id AS STRING) || '", "b", "c' WHEN 2 THEN '```' || chr(10) || '{"ranked_ids": []}' || chr(10) || '```' WHEN 3 THEN 'nothing' ELSE '{"other": 1, "ranked_ids" : [ "' || source || '" ] }' END"""


@query("ranked_ids", f"WITH r AS (SELECT doc_id, {RANKED} AS a FROM documents), o AS (SELECT doc_id, a, nullif(regexp_extract(a, '(?s)\\{{.*\\}}', 0), '') AS o, regexp_extract_all(regexp_extract(a, '(?s)\"ranked_ids\"\\s*:\\s*\\[([^\\]]*)', 1), '\"([^\"]+)\"', 1) AS f FROM r) SELECT doc_id, array_to_string(coalesce(CASE WHEN json_valid(o) THEN CAST(json_extract(o, '$.ranked_ids') AS VARCHAR[]) END, CASE WHEN len(f) > 0 THEN f END), ',') AS ids FROM o")
def ranked_ids(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.array_join(jsonx.ranked_ids(F.expr(RANKED)), ",").alias("ids"))


# ---- ratings
NUMBER = "CASE id % 8 WHEN 0 THEN CAST(id % 4 AS STRING) WHEN 1 THEN ' ' || CAST(id % 101 AS STRING) || '.7 ' WHEN 2 THEN 'high' WHEN 3 THEN '-2' WHEN 4 THEN CAST(id % 300 AS STRING) WHEN 5 THEN '' WHEN 6 THEN '+3' ELSE NULL END"
_TO_INT = "CASE WHEN regexp_matches(trim(n), '^[+-]?[0-9]{1,15}([.][0-9]*)?$') THEN CAST(trunc(CAST(ltrim(trim(n), '+') AS DOUBLE)) AS INTEGER) END"


@query("rating_maps", f"WITH {PUBS}, n AS (SELECT id, {NUMBER} AS n, score FROM pubs), v AS (SELECT id, score, {_TO_INT} AS v FROM n), m AS (SELECT *, CASE WHEN v IS NULL OR v < 0 THEN NULL WHEN v <= 3 THEN v WHEN v < 25 THEN 0 WHEN v < 50 THEN 1 WHEN v < 75 THEN 2 WHEN v <= 100 THEN 3 END AS r FROM v) SELECT id, v AS number, r AS rating, CAST(r * 25 AS INTEGER) AS low, CASE r WHEN 0 THEN 24 WHEN 1 THEN 49 WHEN 2 THEN 74 WHEN 3 THEN 100 END AS high FROM m")
def rating_maps(spark, sf_dir):
    d = pubs(spark, sf_dir).select("id", rules.to_int(F.expr(NUMBER)).alias("number")).withColumn("rating", rules.map_rating(F.col("number")))
    return d.withColumn("_r", rules.rating_range(F.col("rating"))).select("id", "number", "rating", "_r.low", "_r.high")




def structs(names: tuple[str, ...], *rows: tuple[str, ...]) -> str:
    """A Spark list of structs from expressions."""
    return "array(" + ", ".join("named_struct(" + ", ".join(f"'{n}', {x}" for n, x in zip(names, r, strict=True)) + ")" for r in rows) + ")"


def duck_structs(names: tuple[str, ...], *rows: tuple[str, ...]) -> str:
    """The same list in DuckDB."""
    return "[" + ", ".join("{" + ", ".join(f"'{n}': {x}" for n, x in zip(names, r, strict=True)) + "}" for r in rows) + "]"


_LABEL_ROWS = (
    ("CASE WHEN id % 2 = 0 THEN 'udi' ELSE 'survey' END", "'r1'", "CASE WHEN id % 3 <> 0 THEN CAST(id % 4 AS INT) END", "title"),
    ("'survey'", "'r2'", "CASE WHEN id % 5 <> 0 THEN CAST(id % 3 AS INT) END", "CASE WHEN id % 7 = 0 THEN '' ELSE 'why ' || source END"),
    ("'udi'", "source", "CASE WHEN id % 11 = 0 THEN 3 END", "CAST(NULL AS STRING)"),
)
_LABEL_NAMES = ("source", "rater", "rating", "rationale")
LABELS = structs(_LABEL_NAMES, *_LABEL_ROWS)
_LAB = f"{PUBS}, lab AS (SELECT id, {duck_structs(_LABEL_NAMES, *_LABEL_ROWS)} AS labels FROM pubs)"


def labelled(spark, sf_dir):
    return pubs(spark, sf_dir).select("id", F.expr(LABELS).alias("labels"))


@query("label_arrays", f"WITH {_LAB} SELECT id, round(list_avg(list_filter(list_transform(labels, lambda l: l.rating), lambda r: r IS NOT NULL)), 6) AS mean, (list_filter(labels, lambda l: l.source = 'udi')[1]).rating AS udi, array_to_string(list_transform(list_filter(labels, lambda l: coalesce(l.rationale, '') <> ''), lambda l: '[' || l.source || '/' || l.rater || '] ' || l.rationale), ' | ') AS rationale FROM lab WHERE len(list_filter(labels, lambda l: l.rating IS NOT NULL)) >= 2")
def label_arrays(spark, sf_dir):
    d = metrics.enough_ratings(labelled(spark, sf_dir), "labels", 2)
    l = F.col("labels")
    return d.select("id", F.round(metrics.mean_rating(l), 6).alias("mean"), metrics.label_of(l, "udi").alias("udi"), text.rationale(l).alias("rationale"))


@query("long_labels", f"WITH {_LAB}, u AS (SELECT id, unnest(labels) AS l FROM lab) SELECT id, l.source AS source, l.rater AS rater, l.rating AS rating, l.rationale AS rationale FROM u")
def long_labels(spark, sf_dir):
    return records.long_labels(labelled(spark, sf_dir), "id", "labels")


@query("label_summary", "WITH l AS (SELECT doc_id % 40 AS item, quality * 2 + toxic AS rating, (doc_id * 7 + quality) % 101 AS score FROM labels), p AS (SELECT item, avg(score) AS m FROM l GROUP BY 1) SELECT count(*) AS n_labels, count(DISTINCT item) AS n_publications, count(*) FILTER (WHERE rating = 0) AS rating_0, count(*) FILTER (WHERE rating = 1) AS rating_1, count(*) FILTER (WHERE rating = 2) AS rating_2, count(*) FILTER (WHERE rating = 3) AS rating_3, round((SELECT avg(m) FROM p), 6) AS mean_of_means FROM l")
def label_summary(spark, sf_dir):
    l = table(spark, sf_dir, "labels").select((F.col("doc_id") % 40).alias("item"), (F.col("quality") * 2 + F.col("toxic")).alias("rating"), ((F.col("doc_id") * 7 + F.col("quality")) % 101).alias("score"))
    return metrics.label_summary(l, "item", "rating", "score").withColumn("mean_of_means", F.round("mean_of_means", 6))


# ---- attachments
LOCATIONS = structs(
    ("host_type", "url", "license"),
    ("'publisher'", "CASE WHEN id % 3 = 0 THEN '' ELSE 'p' || CAST(id AS STRING) END", "'cc-by'"),
    ("CASE WHEN id % 2 = 0 THEN 'repository' ELSE 'publisher' END", "CASE WHEN id % 5 = 0 THEN NULL ELSE 'r' || CAST(id AS STRING) END", "'cc0'"),
    ("'repository'", "CASE WHEN id % 4 = 0 THEN 'z' || CAST(id AS STRING) ELSE '' END", "'closed'"),
)
LICENCES = structs(
    ("content_version", "url"),
    ("'am'", "CASE WHEN id % 3 = 0 THEN 'https://creativecommons.org/licenses/by-nc-nd/4.0/' ELSE 'CC-BY' END"),
    ("CASE WHEN id % 4 < 2 THEN 'vor' ELSE 'tdm' END", "CASE id % 5 WHEN 0 THEN 'http://creativecommons.org/publicdomain/zero/1.0/' WHEN 1 THEN 'https://creativecommons.org/licenses/by-sa/3.0' WHEN 2 THEN 'all rights' WHEN 3 THEN 'Public Domain work' ELSE 'bronze' END"),
)
_LIC = "CASE WHEN low IN (" + ", ".join(f"'{x}'" for x in (*identifiers.ATTACHABLE, "bronze", "closed", "unknown")) + ") THEN low " + " ".join(f"WHEN contains(low, '{p}') THEN '{n}'" for p, n in identifiers.LICENCE_URLS) + " WHEN regexp_matches(low, 'public ?domain') THEN 'public-domain' ELSE 'unknown' END"
_ATT = ", ".join(f"'{x}'" for x in identifiers.ATTACHABLE)


@query("licence_mapping", f"""WITH {PUBS}, l AS (SELECT id, CASE WHEN id % 3 = 0 THEN 'https://creativecommons.org/licenses/by-nc-nd/4.0/' ELSE 'CC-BY' END AS am, id % 4 < 2 AS vor, CASE id % 5 WHEN 0 THEN 'http://creativecommons.org/publicdomain/zero/1.0/' WHEN 1 THEN 'https://creativecommons.org/licenses/by-sa/3.0' WHEN 2 THEN 'all rights' WHEN 3 THEN 'Public Domain work' ELSE 'bronze' END AS second FROM pubs),
n AS (SELECT id, lower(trim(CASE WHEN vor THEN second ELSE am END)) AS low FROM l), m AS (SELECT id, {_LIC} AS licence FROM n) SELECT id, licence, licence IN ({_ATT}) AS attachable FROM m""")
def licence_mapping(spark, sf_dir):
    d = pubs(spark, sf_dir).select("id", attachments.best_licence(F.expr(LICENCES)).alias("licence"))
    return d.withColumn("attachable", identifiers.attachable(F.col("licence")))


@query("best_locations", f"""WITH {PUBS}, c AS (SELECT id, CASE WHEN id % 3 <> 0 THEN 'p' || CAST(id AS VARCHAR) END AS p, id % 2 = 0 AS repo, CASE WHEN id % 5 <> 0 THEN 'r' || CAST(id AS VARCHAR) END AS r, CASE WHEN id % 4 = 0 THEN 'z' || CAST(id AS VARCHAR) END AS z FROM pubs) SELECT id, coalesce(CASE WHEN repo THEN r END, z, p, r) AS url, id % 4 <> 1 AND id % 3 <> 0 AS open_pdf, 'v' || CAST(1 + id % 3 AS VARCHAR) AS version FROM c""")
def best_locations(spark, sf_dir):
    versions = F.transform(F.sequence(F.lit(1), (1 + F.col("id") % 3).cast("int")), lambda x: F.concat(F.lit("v"), x.cast("string")))
    d = pubs(spark, sf_dir).select("id", attachments.best_location(F.expr(LOCATIONS))["url"].alias("url"), attachments.latest_version(versions).alias("version"), F.expr("id % 4 <> 1").alias("is_open"), F.expr("array(named_struct('style', CASE WHEN id % 3 = 0 THEN 'html' ELSE 'pdf' END))").alias("urls"))
    good = attachments.open_with_pdf(d).select(F.col("id").alias("_g"))
    return d.join(good, F.col("id") == F.col("_g"), "left").select("id", "url", F.col("_g").isNotNull().alias("open_pdf"), "version")


@query("pdf_bytes", "WITH b AS (SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN '%PDF-1.4 ' ELSE '<html> ' END || coalesce(text, '') AS c FROM documents) SELECT doc_id, octet_length(encode(c)) >= 1024 AND starts_with(c, '%PDF') AS ok FROM b")
def pdf_bytes(spark, sf_dir):
    c = F.concat(F.when(F.col("doc_id") % 3 == 0, "%PDF-1.4 ").otherwise("<html> "), F.coalesce("text", F.lit(""))).cast("binary")
    return table(spark, sf_dir, "documents").select("doc_id", attachments.is_pdf(c).alias("ok"))


DOI_OR_BLANK = f"CASE WHEN id % 5 = 0 THEN ' ' ELSE {DOI_RAW} END"


@query("pdf_classes", f"""WITH {PUBS}, c AS (SELECT id, nullif(trim(coalesce({DOI_OR_BLANK}, '')), '') AS doi, CASE WHEN id % 4 = 0 THEN {ID} END AS pmid, EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = pubs.id AND l.toxic = 1) AS stored, e.licence FROM pubs LEFT JOIN (SELECT vec_id, CASE WHEN label % 3 = 0 THEN 'closed' WHEN label % 3 = 1 THEN 'CC-BY' ELSE 'http://creativecommons.org/licenses/by-nd/4.0' END AS licence FROM embeddings) e ON e.vec_id = pubs.id)
SELECT id, CASE WHEN stored THEN 'cached' WHEN doi IS NULL AND pmid IS NULL THEN 'no_identifiers' WHEN licence IS NULL THEN 'miss' WHEN licence <> 'CC-BY' THEN 'licence_blocked' ELSE 'fetched' END AS reason FROM c""")
def pdf_classes(spark, sf_dir):
    d = pubs(spark, sf_dir).select("id", F.expr(DOI_OR_BLANK).alias("doi"), F.expr(f"CASE WHEN id % 4 = 0 THEN {ID} END").alias("pmid"))
    stored = table(spark, sf_dir, "labels").where("toxic = 1").select(F.col("doc_id").alias("id"))
    kind = F.col("label") % 3
    found = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.when(kind == 0, "closed").when(kind == 1, "CC-BY").otherwise("http://creativecommons.org/licenses/by-nd/4.0").alias("license"))
    return attachments.classify(d, stored, found).select("id", "reason")


@query("preprint_caps", f"WITH {PUBS}, v AS (SELECT id, score, CASE id % 6 WHEN 0 THEN 'bioRxiv' WHEN 1 THEN 'Nature' WHEN 2 THEN '' ELSE source END AS venue, CASE WHEN id % 4 = 0 THEN 'https://www.medRxiv.org/x' ELSE url END AS u FROM pubs), p AS (SELECT id, score, regexp_matches(lower(venue || ' ' || u), 'biorxiv|medrxiv|arxiv|preprint') AS preprint FROM v) SELECT id, preprint, CASE WHEN preprint AND score > 65 THEN 65 ELSE score END AS credibility FROM p")
def preprint_caps(spark, sf_dir):
    venue = F.expr("CASE id % 6 WHEN 0 THEN 'bioRxiv' WHEN 1 THEN 'Nature' WHEN 2 THEN '' ELSE source END")
    d = pubs(spark, sf_dir).withColumn("preprint", rules.is_preprint(F.lit(""), venue, F.expr("CASE WHEN id % 4 = 0 THEN 'https://www.medRxiv.org/x' ELSE url END")))
    return d.select("id", "preprint", rules.credibility(F.col("score"), F.col("preprint")).alias("credibility"))


ATTRIBUTED = """CASE id % 6 WHEN 0 THEN 'Claude''s review found that ' || title || '. Second one! Third? Fourth.' WHEN 1 THEN 'according to the reviewers, ' || title WHEN 2 THEN 'Both models agree that it works. It is ' || source WHEN 3 THEN 'the AI analysis suggests ' || title || '. More. And more' WHEN 4 THEN title || '. One. Two' ELSE NULL END""".replace("''", "")


@query("clean_reasons", f"""WITH {PUBS}, r AS (SELECT id, trim(coalesce({ATTRIBUTED}, '')) AS r FROM pubs), c AS (SELECT id, {"".join("regexp_replace(" for _ in text.ATTRIBUTION)}r, {", ''), ".join("'" + p.replace("'", "''") + "'" for p in text.ATTRIBUTION)}, '') AS c FROM r), u AS (SELECT id, upper(substring(c, 1, 1)) || substring(c, 2) AS c FROM c),
s AS (SELECT id, c, string_split_regex(regexp_replace(c, '([.!?])\\s+', '\\1' || chr(1), 'g'), chr(1)) AS p FROM u) SELECT id, trim(CASE WHEN len(p) > 2 THEN p[1] || ' ' || p[2] || CASE WHEN ends_with(p[2], '.') THEN '' ELSE '.' END ELSE c END) AS reason FROM s""")
def clean_reasons(spark, sf_dir):
    return pubs(spark, sf_dir).select("id", text.clean_reason(F.expr(ATTRIBUTED)).alias("reason"))


SUMMARY = """CASE id % 5 WHEN 0 THEN replace(raw_text, '. ', chr(10) || '- ') WHEN 1 THEN '• ' || replace(raw_text, '. ', '• ') WHEN 2 THEN 'No summary available.' WHEN 3 THEN NULL ELSE raw_text END"""
_SENT = "list_filter(list_transform(string_split(s, '.'), lambda x: trim(x)), lambda x: x <> '')"


@query("key_findings", f"""WITH {PUBS}, q AS (SELECT id, coalesce({SUMMARY}, '') AS s FROM pubs) SELECT id, array_to_string(CASE WHEN contains(s, '•') THEN list_filter(list_transform(string_split(s, '•'), lambda x: trim(x)), lambda x: x <> '') WHEN contains(s, chr(10) || '-') THEN list_filter(list_transform(string_split(s, chr(10) || '-'), lambda x: trim(x)), lambda x: x <> '') ELSE list_transform({_SENT}, lambda x: x || '.') END[1:3], '|') AS findings FROM q""")
def key_findings(spark, sf_dir):
    return pubs(spark, sf_dir).select("id", F.array_join(text.key_findings(F.expr(SUMMARY)), "|").alias("findings"))


@query("bullet_findings", f"""WITH {PUBS}, q AS (SELECT id, CASE WHEN {SUMMARY} = 'No summary available.' THEN '' ELSE coalesce({SUMMARY}, '') END AS s FROM pubs), b AS (SELECT id, s, regexp_extract_all(s, '[•\\-*][ \\t]*([^\\n]+)', 1) AS b FROM q) SELECT id, array_to_string(CASE WHEN len(b) > 0 THEN b ELSE {_SENT} END[1:3], '|') AS findings FROM b""")
def bullet_findings(spark, sf_dir):
    return pubs(spark, sf_dir).select("id", F.array_join(text.bullet_findings(F.expr(SUMMARY)), "|").alias("findings"))


@query("why_it_matters", f"WITH {PUBS}, q AS (SELECT id, title, {SUMMARY} AS s FROM pubs), w AS (SELECT id, s, trim(split_part(coalesce(s, ''), '.', 1)) AS f FROM q) SELECT id, CASE WHEN length(f) > 20 AND s <> 'No summary available.' THEN f || '.' ELSE 'Flagged as must-read: rank ' || CAST(id AS VARCHAR) || '.' END AS why FROM w")
def why_it_matters(spark, sf_dir):
    return pubs(spark, sf_dir).select("id", text.why_it_matters(F.expr(SUMMARY), F.concat(F.lit("rank "), F.col("id").cast("string"))).alias("why"))


TOPICAL = """CASE id % 6 WHEN 0 THEN title || ' Lung screening' WHEN 1 THEN 'Liquid biopsy of the liver: ' || title WHEN 2 THEN 'New biomarker ' || title WHEN 3 THEN title || ' in prostate' ELSE title END"""
TOPIC_VENUE = "CASE id % 4 WHEN 0 THEN 'Nature' WHEN 1 THEN '' ELSE NULL END"


def _first_of(words: tuple[str, ...], expr: str) -> str:
    return "CASE " + " ".join(f"WHEN contains({expr}, '{w}') THEN '{w}'" for w in words) + " END"


@query("fallback_reason", f"""WITH {PUBS}, t AS (SELECT id, source, lower({TOPICAL}) AS low, {TOPIC_VENUE} AS venue FROM pubs), w AS (SELECT *, {_first_of(text.TOPIC_CANCERS, 'low')} AS c, {_first_of(text.TOPIC_TERMS, 'low')} AS k FROM t)
SELECT id, CASE WHEN c IS NOT NULL AND k IS NOT NULL THEN 'This study addresses ' || c || ' cancer ' || k || ', a key area for early detection research.' WHEN c IS NOT NULL THEN 'This research focuses on ' || c || ' cancer, contributing to the early detection knowledge base.' WHEN k IS NOT NULL THEN 'This study explores ' || k || ' methods relevant to cancer early detection.'
 WHEN coalesce(venue, '') <> '' THEN 'Published in ' || venue || ', this study may offer insights relevant to cancer early detection research.' ELSE 'From ' || source || ', this publication may contain findings relevant to early detection efforts.' END AS why FROM w""")
def fallback_reason(spark, sf_dir):
    return pubs(spark, sf_dir).select("id", text.fallback_reason(F.expr(TOPICAL), F.col("source"), F.expr(TOPIC_VENUE)).alias("why"))


@query("text_forms", f"WITH {PUBS} SELECT id, substring(regexp_replace(raw_text, '[\\r\\n\\t]+', ' ', 'g'), 1, 200) AS preview, trim(regexp_replace(lower(title), '[^a-z0-9]+', '-', 'g'), '-') AS slug, array_to_string(list_distinct_in_order, ',') AS tags FROM (SELECT *, list_filter([CASE WHEN contains(lower(title), 'the') THEN 'english' END, CASE WHEN contains(lower(title), 'der') THEN 'german' END, nullif(trim(regexp_replace(lower(source), '[^a-z0-9]+', '-', 'g'), '-'), '')], lambda x: x IS NOT NULL) AS list_distinct_in_order FROM pubs)")
def text_forms(spark, sf_dir):
    t = F.col("title")
    return pubs(spark, sf_dir).select("id", text.preview(F.col("raw_text")).alias("preview"), text.slug(t).alias("slug"), F.array_join(text.tags(t, {"the": "english", "der": "german"}, F.col("source")), ",").alias("tags"))


OFF = {"sport": ("tennis", "the th", "ingst"), "food": ("recipe", "und die"), "law": ("nicht", "court")}


@query("off_topic", f"WITH {PUBS}, l AS (SELECT id, lower(raw_text) AS low FROM pubs) SELECT id, CASE WHEN contains(low, 'ention') OR contains(low, 'cancer') THEN '' ELSE array_to_string(list_filter([" + ", ".join("CASE " + " ".join(f"WHEN contains(low, '{w}') THEN '{k}:{w}'" for w in ws) + " END" for k, ws in OFF.items()) + "], lambda x: x IS NOT NULL), ',') END AS hits FROM l")
def off_topic(spark, sf_dir):
    return pubs(spark, sf_dir).select("id", F.array_join(records.off_topic(F.col("raw_text"), OFF, ("ention", "cancer")), ",").alias("hits"))


#: Whole texts with each of the twelve phrases before or behind them, and names that end at different signs.
GRANT = """CASE id % 7 WHEN 0 THEN 'This work was funded by ' || upper(source) || ' Labs; one author is an employee of Acme Corp: thanks. ' || raw_text WHEN 1 THEN raw_text || ' Supported by The ' || upper(source) || ' Fund / supported by The ' || upper(source) || ' Fund / grant from Zeta_'
 WHEN 2 THEN 'He is a consultant for Beta & Co. (x) and affiliated with Delta,(y) ' || raw_text WHEN 3 THEN raw_text || ' Disclosure: (1) ' || upper(source) || ' Inc; conflict of interest: none for Omega Ltd/ research supported by Kappa Trust;'
 WHEN 4 THEN 'Sponsored by ' || source || ' and Sons! Funding provided by Theta.; ' || raw_text || ' received compensation from Iota, Ltd' WHEN 5 THEN 'a conflict of interest ' || raw_text ELSE raw_text END"""


def _found_sql(patterns: tuple[str, ...]) -> str:
    """List of (name, start, end) of all matches of the patterns, in order: starts from the pieces between the matches."""
    one = lambda p: f"""(SELECT list_transform(range(1, len(m) + 1), lambda i: {{'n': regexp_replace(regexp_replace(n[i], '^\\s+|\\s+$', '', 'g'), '[,;.]$', ''), 's': CAST(list_sum(list_transform(q[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) AS BIGINT), 'l': length(m[i])}}) FROM (SELECT regexp_extract_all(g, '(?i){p}', 0) AS m, regexp_extract_all(g, '(?i){p}', 1) AS n, regexp_split_to_array(g, '(?i){p}') AS q))"""
    return f"list_filter(flatten([{', '.join(one(p) for p in patterns)}]), lambda x: x.n <> '')"


_FIRST = "list_filter({0}, lambda x, i: list_position(list_transform({0}, lambda y: y.n), x.n) = i)"
_PIECE = "regexp_replace(substring(g, CAST(greatest(0, x.s - 20) AS BIGINT) + 1, CAST(x.s + x.l + 80 - greatest(0, x.s - 20) AS BIGINT)), '^\\s+|\\s+$', '', 'g')"


@query("commercial_signals", f"""WITH {PUBS}, g AS (SELECT id, coalesce({GRANT}, '') AS g FROM pubs), f AS (SELECT id, g, {_found_sql(extract.SPONSOR_PATTERNS)} AS s, {_found_sql(extract.COMPANY_PATTERNS)} AS c FROM g), d AS (SELECT id, g, {_FIRST.format("s")} AS s, {_FIRST.format("c")} AS c FROM f),
p AS (SELECT id, s, c, list_transform(list_concat(s, c), lambda x: CASE WHEN length({_PIECE}) > 160 THEN substring({_PIECE}, 1, 157) || '...' ELSE {_PIECE} END) AS p FROM d)
SELECT id, array_to_string(list_transform(s, lambda x: x.n)[1:5], '|') AS sponsors, array_to_string(list_transform(c, lambda x: x.n)[1:5], '|') AS companies, array_to_string(list_filter(p, lambda x, i: list_position(p, x) = i)[1:2], '|') AS snippets, len(s) > 0 AS has_sponsor_signal, len(c) > 0 AS company_affiliation_signal FROM p""")
def commercial_signals(spark, sf_dir):
    d = pubs(spark, sf_dir).select("id", extract.commercial_signals(F.coalesce(F.expr(GRANT), F.lit(""))).alias("c"))
    lists = [F.array_join(f"c.{c}", "|").alias(name) for c, name in (("sponsor_names", "sponsors"), ("company_names", "companies"), ("snippets", "snippets"))]
    return d.select("id", *lists, "c.has_sponsor_signal", "c.company_affiliation_signal")


@query("target_types", f"WITH {PUBS} SELECT id, list_contains(['lung', 'colon', 'breast'], CASE lower(trim(k)) WHEN 'colorectal' THEN 'colon' ELSE lower(trim(k)) END) AS target FROM (SELECT id, CASE id % 4 WHEN 0 THEN ' Colorectal' WHEN 1 THEN 'LUNG' WHEN 2 THEN 'other' ELSE '' END AS k FROM pubs)")
def target_types(spark, sf_dir):
    k = F.expr("CASE id % 4 WHEN 0 THEN ' Colorectal' WHEN 1 THEN 'LUNG' WHEN 2 THEN 'other' ELSE '' END")
    return pubs(spark, sf_dir).select("id", rules.cancer_type(k).isin(*rules.targets_from("Lung, colorectal, breast")).alias("target"))
