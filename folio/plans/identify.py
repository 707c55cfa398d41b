"""Queries for identifiers, pages and hashes: each form of URL, text and page occurs, and the SQL parses them too."""

from __future__ import annotations

from pyspark.sql import functions as F

from folio.functions import identifiers
from folio.operators import dedupe
from folio.plans.documents import PUBS, TITLE_SQL, pubs
from folio.plans.registry import query

#: Input expressions over pubs and pages; they are the same text in Spark and in DuckDB.
ID = "CAST(id AS STRING)"
REF_URL = f"""CASE id % 17 WHEN 0 THEN 'https://doi.org/10.1000/ABC.' || {ID} || '.' WHEN 1 THEN 'http://dx.doi.org/10.5555/' || source || '-' || {ID} || ';)' WHEN 2 THEN 'https://pubmed.ncbi.nlm.nih.gov/' || CAST(10000000 + id AS STRING) || '/'
 WHEN 3 THEN 'https://www.nature.com/articles/10.1038/s41586-' || {ID} || '?x=1#top' WHEN 4 THEN 'https://www.biorxiv.org/content/early/10.1101/2024.01.' || {ID} || 'v2' WHEN 5 THEN 'https://arxiv.org/abs/2401.0' || CAST(1000 + id % 9000 AS STRING)
 WHEN 6 THEN 'https://example.org/a/' || {ID} || '#' WHEN 7 THEN 'short' WHEN 8 THEN 'ftp://host.example/' || {ID} WHEN 9 THEN 'https://onlinelibrary.example/doi/10.1002/x' || {ID} || '/' WHEN 10 THEN 'https://PubMed.ncbi.nlm.nih.gov/pubmed/' || CAST(id AS STRING) || '?term=y'
 WHEN 11 THEN 'https://www.science.org/doi/10.1126/sci.' || {ID} || ',' WHEN 12 THEN 'HTTPS://Example.ORG/Path/' || {ID} || 'html?utm_source=a&q=' || source || '&ref=b' WHEN 13 THEN 'https://www.cell.com/x/y/10.1016/j.cell.' || {ID} || ':' WHEN 14 THEN 'x.example/PMID: ' || CAST(20000000 + id AS STRING)
 WHEN 15 THEN 'https://pubmed.ncbi.nlm.nih.gov/abs/' || CAST(30000000 + id AS STRING) || '/?a=1' ELSE NULL END"""
REF_TEXT = f"""CASE id % 7 WHEN 0 THEN 'see doi:10.' || CAST(1000 + id % 50 AS STRING) || '/S4-' || {ID} || 'whether ' || raw_text WHEN 1 THEN raw_text || ' PMID: ' || CAST(10000000 + id AS STRING) || ' and more' WHEN 2 THEN raw_text || ' arXiv:2401.' || CAST(10000 + id % 9000 AS STRING) || 'v2 (' || source || ')'
 WHEN 3 THEN raw_text || ' [10.1234/a_' || {ID} || '] "10.9/x"' WHEN 4 THEN raw_text || ' pubmed.ncbi.nlm.nih.gov/' || CAST(10000000 + id AS STRING) || ' 10.5555/late.' || {ID} || ';' WHEN 5 THEN raw_text ELSE NULL END"""
DOI_RAW = f"CASE id % 6 WHEN 0 THEN 'https://doi.org/10.1/A' || {ID} WHEN 1 THEN ' DOI: 10.2/b' || {ID} WHEN 2 THEN 'http://dx.doi.org/10.3/C' WHEN 3 THEN '10.4/' || source WHEN 4 THEN 'abc' || {ID} ELSE NULL END"
PMID_RAW = f"CASE id % 5 WHEN 0 THEN 'PMID ' || {ID} WHEN 1 THEN {ID} WHEN 2 THEN 'none' WHEN 3 THEN ' 12-34-' || {ID} ELSE NULL END"
REFS = f"{PUBS}, refs AS (SELECT *, {REF_URL} AS u, {REF_TEXT} AS x, {DOI_RAW} AS d, {PMID_RAW} AS p FROM pubs)"


def refs(spark, sf_dir):
    """Publications with a URL (u), a text (x), a raw DOI (d) and a raw PMID (p) of many forms."""
    return pubs(spark, sf_dir).withColumns({"u": F.expr(REF_URL), "x": F.expr(REF_TEXT), "d": F.expr(DOI_RAW), "p": F.expr(PMID_RAW)})


def ex(col: str, pattern: str, group: int = 1) -> str:
    return f"nullif(regexp_extract(coalesce({col}, ''), '{pattern.replace(chr(39), chr(39) * 2)}', {group}), '')"


NORM_DOI = "CASE WHEN starts_with(regexp_replace(lower(trim({0})), '^(https?://(dx\\.)?doi\\.org/|doi:\\s*)', ''), '10.') THEN regexp_replace(lower(trim({0})), '^(https?://(dx\\.)?doi\\.org/|doi:\\s*)', '') END"
URL_DOI_SQL = "coalesce(" + ", ".join(ex("u", f"(?i){p}") for p in identifiers.URL_DOI) + ")"
PUBLISHER_SQL = "coalesce(" + ", ".join(ex("u", rf"(?i){p}(10\.\d{{4,}}/[^\s?#]+)") for p in identifiers.PUBLISHER_PLACES) + ")"
PLAIN = "rtrim(lower({0}), '.,;)')"
IN_TEXT = "regexp_replace(rtrim(lower({0}), '.,;:)'), '([^a-z])[a-z]{{2,}}$', '\\1')"


@query("doi_forms", f"WITH {REFS} SELECT id, {PLAIN.format(ex('u', r'(10\.\d{4,}/\S+)'))} AS of_url, {PLAIN.format(ex('x', r'(10\.\d{4,}/\S+)'))} AS of_text, {NORM_DOI.format('d')} AS normalized, {NORM_DOI.format(f'''regexp_replace({URL_DOI_SQL}, '[/\\s]+$', '')''')} AS by_form, regexp_replace({PUBLISHER_SQL}, '[.,;:]+$', '') AS by_publisher FROM refs")
def doi_forms(spark, sf_dir):
    i = identifiers
    return refs(spark, sf_dir).select("id", i.plain_doi(F.col("u")).alias("of_url"), i.plain_doi(F.col("x")).alias("of_text"), i.normalize_doi(F.col("d")).alias("normalized"), i.doi_in_url(F.col("u")).alias("by_form"), i.publisher_doi(F.col("u")).alias("by_publisher"))


PMID_URL = f"coalesce({ex('u', '(?i)pubmed.*?/([0-9]+)')}, {ex('u', '(?i)PMID:?[ ]*([0-9]+)')})"


@query("pmid_forms", f"WITH {REFS} SELECT id, {PMID_URL} AS of_url, nullif(regexp_replace(coalesce(p, ''), '[^0-9]', '', 'g'), '') AS normalized, {ex('u', '(?i)pubmed[.]ncbi[.]nlm[.]nih[.]gov/([0-9]+)')} AS by_host, CASE WHEN contains(u, 'pubmed.ncbi.nlm.nih.gov') THEN {ex('u', '/([0-9]{7,8})/?(?:[?]|$)')} END AS by_end FROM refs")
def pmid_forms(spark, sf_dir):
    i = identifiers
    return refs(spark, sf_dir).select("id", i.pmid_in_url(F.col("u")).alias("of_url"), i.normalize_pmid(F.col("p")).alias("normalized"), i.pubmed_path_pmid(F.col("u")).alias("by_host"), i.pubmed_end_pmid(F.col("u")).alias("by_end"))


def text_doi(col: str) -> str:
    return "regexp_replace(rtrim(lower(" + f"nullif(regexp_extract(coalesce({col}, ''), '(10\\.\\d{{4,}}/[^\\s''\"<>\\[\\]]+)', 1), '')" + "), '.,;:)'), '([^a-z])[a-z]{2,}$', '\\1')"


def text_pmid(col: str) -> str:
    return ex(col, r"(?i)(?:pmid[:\s]*|pubmed\.ncbi\.nlm\.nih\.gov/)(\d{7,8})")


def text_arxiv(col: str) -> str:
    return ex(col, r"(?i)(?:arxiv[:\s]*|arxiv\.org/abs/)(\d{4}\.\d{4,5}(?:v\d+)?)")


@query("identifiers_from_text", f"WITH {REFS} SELECT id, {text_doi('x')} AS doi, {text_pmid('x')} AS pmid, {text_arxiv('x')} AS arxiv, {text_arxiv('u')} AS url_arxiv FROM refs")
def identifiers_from_text(spark, sf_dir):
    i = identifiers
    return refs(spark, sf_dir).select("id", i.doi_in(F.col("x")).alias("doi"), i.pmid_in(F.col("x")).alias("pmid"), i.arxiv_in(F.col("x")).alias("arxiv"), i.arxiv_in(F.col("u")).alias("url_arxiv"))


def norm_url(col: str) -> str:
    """normalize_url in DuckDB, of an expression."""
    u = f"trim({col})"
    rest = f"regexp_replace({u}, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//[^/?#]*', '')"
    path = f"regexp_replace(regexp_extract({rest}, '^([^?#]*)', 1), '(\\d)[A-Za-z]{{2,}}$', '\\1')"
    tracking = ", ".join(f"'{t}'" for t in identifiers.TRACKING)
    kept = f"list_filter(string_split(regexp_extract({rest}, '^[^?#]*\\?([^#]*)', 1), '&'), lambda q: regexp_matches(q, '^[^=]+=.') AND lower(split_part(q, '=', 1)) NOT IN ({tracking}))"
    host = f"lower(regexp_extract({u}, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)', 1))"
    scheme = f"lower(regexp_extract({u}, '^([A-Za-z][A-Za-z0-9+.-]*):', 1))"
    return f"CASE WHEN {scheme} IN ('', 'http', 'https') AND {host} <> '' THEN 'https://' || {host} || CASE WHEN {path} = '/' THEN '/' ELSE rtrim({path}, '/') END || CASE WHEN len({kept}) > 0 THEN '?' || array_to_string({kept}, '&') ELSE '' END END"


@query("url_normalize", f"WITH {REFS} SELECT id, {norm_url('u')} AS normalized, {norm_url('url')} AS own FROM refs")
def url_normalize(spark, sf_dir):
    return refs(spark, sf_dir).select("id", identifiers.normalize_url(F.col("u")).alias("normalized"), identifiers.normalize_url(F.col("url")).alias("own"))


@query("link_chain", f"""WITH {REFS}, c AS (SELECT id, CASE WHEN id % 3 = 0 THEN u WHEN id % 3 = 1 THEN '' END AS canonical, CASE WHEN id % 5 < 3 THEN u END AS l, {NORM_DOI.format('d')} AS doi, CASE WHEN id % 4 = 0 THEN CAST(id AS VARCHAR) ELSE '' END AS pmid FROM refs)
SELECT id, coalesce({norm_url("nullif(canonical, '')")}, {norm_url("nullif(l, '')")}, {norm_url("'https://doi.org/' || doi")}, {norm_url("'https://pubmed.ncbi.nlm.nih.gov/' || nullif(pmid, '') || '/'")}) AS link, rtrim(lower(trim(l)), '/') AS comparable FROM c""")
def link_chain(spark, sf_dir):
    c = refs(spark, sf_dir).select("id", F.expr("CASE WHEN id % 3 = 0 THEN u WHEN id % 3 = 1 THEN '' END").alias("canonical"), F.expr("CASE WHEN id % 5 < 3 THEN u END").alias("l"), identifiers.normalize_doi(F.col("d")).alias("doi"), F.expr("CASE WHEN id % 4 = 0 THEN CAST(id AS STRING) ELSE '' END").alias("pmid"))
    return c.select("id", identifiers.link(F.col("canonical"), F.col("l"), F.col("doi"), F.col("pmid")).alias("link"), identifiers.comparable_url(F.col("l")).alias("comparable"))


_TYPE = "CASE WHEN b = ' ' THEN NULL " + " ".join(f"WHEN contains(b, '{p}') THEN '{k}'" for p, k in identifiers.SOURCE_TYPES) + " ELSE 'rss' END"


@query("canonical_url", f"""WITH {REFS}, t AS (SELECT id, u, source, {NORM_DOI.format('d')} AS doi, CASE WHEN id % 4 = 1 THEN CAST(20000000 + id AS VARCHAR) END AS pmid, coalesce(x, '') AS x, lower(coalesce(u, '') || ' ' || source) AS b FROM refs),
a AS (SELECT *, coalesce(u, '') || ' ' || coalesce(doi, '') || ' ' || coalesce(pmid, '') || ' ' || x || ' ' AS every FROM t), f AS (SELECT id, u, b, coalesce(doi, {text_doi('every')}) AS doi, coalesce(pmid, {text_pmid('every')}) AS pmid, {text_arxiv('every')} AS arxiv FROM a)
SELECT id, coalesce({norm_url("'https://doi.org/' || doi")}, {norm_url("'https://pubmed.ncbi.nlm.nih.gov/' || pmid || '/'")}, {norm_url("'https://arxiv.org/abs/' || arxiv")}, {norm_url('u')}) AS canonical_url, doi, pmid, {_TYPE} AS source_type FROM f""")
def canonical_url(spark, sf_dir):
    d = refs(spark, sf_dir).withColumns({"doi": identifiers.normalize_doi(F.col("d")), "pmid": F.expr("CASE WHEN id % 4 = 1 THEN CAST(20000000 + id AS STRING) END")})
    r = identifiers.resolve(F.col("u"), F.col("doi"), F.col("pmid"), F.col("source"), F.col("x"), F.lit(""))
    return d.select("id", r.alias("r")).select("id", "r.*")


KEY_URL = "CASE WHEN id % 3 = 0 THEN u WHEN id % 3 = 1 THEN '' END"
KEY_TEXT = "CASE WHEN id % 4 = 0 THEN x ELSE '' END"
KEY_DAY = "CASE WHEN id % 2 = 0 THEN CAST(published_date AS STRING) END"
AUTHOR = "CASE WHEN id % 5 < 2 THEN 'O''Neil, ' || source END".replace("''", "-")
_T = TITLE_SQL["dedupe"].replace("title", "t")
_A = TITLE_SQL["dedupe"].replace("title", "a")
DEDUPE_SQL = f"""k AS (SELECT id, source, title AS t, {KEY_URL} AS u, {KEY_TEXT} AS x, {KEY_DAY} AS day, {AUTHOR} AS a FROM refs),
f AS (SELECT id, source, coalesce('doi:' || coalesce({PLAIN.format(ex('u', r'(10\.\d{4,}/\S+)'))}, {PLAIN.format(ex("(coalesce(t, '') || ' ' || x)", r'(10\.\d{4,}/\S+)'))}), 'pmid:' || {PMID_URL}, 'composite:' || nullif({_T}, '') || '|' || nullif({_A}, '') || '|' || {ex('day', '([0-9]{4})')}, 'url:' || CASE WHEN NOT ends_with(u, '#') AND length(u) > 10 THEN lower(trim(u)) END, 'title:' || coalesce(nullif({_T}, ''), '')) AS key FROM k)"""


def keyed(spark, sf_dir):
    """Publications of which some have a DOI, a PMID, authors and a year, or a URL; key is their dedupe key."""
    d = refs(spark, sf_dir).withColumns({"u": F.expr(KEY_URL), "x": F.expr(KEY_TEXT), "day": F.expr(KEY_DAY), "a": F.expr(AUTHOR)})
    authors = F.when(F.col("a").isNotNull(), F.array("a")).otherwise(F.array().cast("array<string>"))
    return d.select("id", "source", dedupe.dedupe_key(F.col("title"), F.col("u"), F.col("x"), authors, F.col("day")).alias("key"))


@query("dedupe_documents", f"""WITH {REFS}, {DEDUPE_SQL}, s AS (SELECT key, source, min(id) AS first_id FROM f GROUP BY 1, 2)
SELECT f.key, min(f.id) AS id, count(*) - 1 AS n_merged, any_value(n.names) AS source_names FROM f JOIN (SELECT key, string_agg(source, ',' ORDER BY first_id, source) AS names FROM s GROUP BY 1) n USING (key) GROUP BY 1""")
def dedupe_documents(spark, sf_dir):
    return dedupe.deduplicate(keyed(spark, sf_dir), "key", "id").select("key", "id", "n_merged", F.array_join("source_names", ",").alias("source_names"))


@query("dedupe_stats", f"WITH {REFS}, {DEDUPE_SQL} SELECT count(*) AS total_input, count(DISTINCT key) AS total_output, count(*) - count(DISTINCT key) AS total_merged FROM f")
def dedupe_stats(spark, sf_dir):
    return dedupe.dedupe_stats(keyed(spark, sf_dir), "key")


@query("dedupe_parts", f"WITH {REFS}, k AS (SELECT id, {KEY_DAY} AS day, {AUTHOR} AS a FROM refs) SELECT id, nullif({_A}, '') AS author, {ex('day', '([0-9]{4})')} AS year FROM k")
def dedupe_parts(spark, sf_dir):
    d = refs(spark, sf_dir).withColumns({"day": F.expr(KEY_DAY), "a": F.expr(AUTHOR)})
    return d.select("id", dedupe.first_author(F.array("a")).alias("author"), dedupe.year_of(F.col("day")).alias("year"))


@query("seed_hashes", f"WITH {REFS}, s AS (SELECT id, {NORM_DOI.format('d')} AS doi, nullif(regexp_replace(coalesce(p, ''), '[^0-9]', '', 'g'), '') AS pmid, u, title, raw_text, source FROM refs) SELECT id, sha256('seed:' || coalesce(nullif(doi, ''), nullif(pmid, ''), nullif(u, ''), nullif(title, ''))) AS seed, sha256(coalesce(title, '') || '||' || coalesce(raw_text, '')) AS fingerprint, substring(sha256('[\"' || array_to_string(list_sort([source, coalesce(pmid, '-')]), '\", \"') || '\"]'), 1, 16) AS list_hash, sha256(sha256(source) || '|' || sha256(title)) AS prompt_hash FROM s")
def seed_hashes(spark, sf_dir):
    d = refs(spark, sf_dir).withColumns({"doi": identifiers.normalize_doi(F.col("d")), "pmid": identifiers.normalize_pmid(F.col("p"))})
    words = F.array("source", F.coalesce("pmid", F.lit("-")))
    prompt = identifiers.sha256(F.sha2("source", 256), F.sha2("title", 256))
    return d.select("id", identifiers.seed_id(F.col("doi"), F.col("pmid"), F.col("u"), F.col("title")).alias("seed"), identifiers.sha256(F.col("title"), F.col("raw_text"), sep="||").alias("fingerprint"), identifiers.list_hash(words).alias("list_hash"), prompt.alias("prompt_hash"))


_IPAD, _OPAD = ("".join(f"\\x{b ^ m:02X}" for b in b"folio-key".ljust(64, b"\0")) for m in (0x36, 0x5C))


@query("signed_links", f"""WITH {PUBS}, q AS (SELECT id, 'id=' || CAST(id AS VARCHAR) || '&src=' || replace(url_encode(source || ' &' || lang), '%20', '+') || '&vote=' || CASE WHEN id % 2 = 0 THEN 'up' ELSE 'down' END AS m, lang FROM (SELECT id, source, coalesce(lang, '') AS lang FROM pubs)),
s AS (SELECT id, m, sha256('{_OPAD}'::BLOB || unhex(sha256('{_IPAD}'::BLOB || encode(m)))) AS sig FROM q) SELECT id, 'https://host.example/f?' || m || '&sig=' || sig AS url, id % 3 <> 0 AS ok FROM s""")
def signed_links(spark, sf_dir):
    i = F.col("id")
    src = F.concat("source", F.lit(" &"), F.coalesce("lang", F.lit("")))
    d = pubs(spark, sf_dir).select("id", identifiers.signed_url("https://host.example/f", "folio-key", id=i, src=src, vote=F.when(i % 2 == 0, "up").otherwise("down")).alias("url"))
    sent = F.when(i % 3 == 0, F.replace("url", F.lit("vote="), F.lit("vote=x"))).otherwise(F.col("url"))
    return d.select("id", "url", identifiers.signature_ok(sent, "folio-key").alias("ok"))
