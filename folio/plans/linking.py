"""Queries that link titles: the closest ones to titles without a match, and groups of similar ones."""

from __future__ import annotations

from pyspark.sql import functions as F

from folio.functions import identifiers, text
from folio.operators import match, nearest
from folio.plans.documents import _SIMILAR, PUBS, TITLE_SQL, near_titles, pubs
from folio.plans.identify import norm_url
from folio.plans.registry import query, table


@query("nearest_titles")
def nearest_titles(spark, sf_dir):
    """For the items of the evaluation set that no title matches, the ten closest titles of all publications."""
    index = pubs(spark, sf_dir).select(F.col("id").alias("found"), "title")
    asked = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("id"), F.substring(F.split_part("text", F.lit("."), F.lit(1)), 1, 80).alias("title"))
    missed = match.cascade(asked, index.withColumn("o", F.col("found")), ["title"], "found", "o").where("found IS NULL").select("id", "title")
    return nearest.nearest_titles(missed, index, "id", "found", k=10).select("id", F.col("place").cast("long").alias("place"), "found", F.round("ratio", 6).alias("ratio"))


@query("title_groups", f"""WITH RECURSIVE {_SIMILAR}, n AS (SELECT id, {TITLE_SQL['eval']} AS k FROM near), c AS (SELECT id, min(id) OVER (PARTITION BY k) AS class FROM n WHERE k <> ''), l AS (SELECT a_id AS a, b_id AS b FROM sim WHERE similarity > 0.85), e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
r AS (SELECT DISTINCT a AS id, a AS l FROM e UNION SELECT e.b, r.l FROM r JOIN e ON e.a = r.id WHERE r.l < e.b), g AS (SELECT id, min(l) AS l FROM r GROUP BY 1) SELECT c.id, coalesce(least(g.l, c.class), c.class) AS "group" FROM c LEFT JOIN g ON g.id = c.class""")
def title_groups(spark, sf_dir):
    return match.title_groups(near_titles(spark, sf_dir), "id")


#: Keys of one article under an id of its own; an item offers one of them beside its title, as it may be found in a list.
_STEPS = ("pid", "doi", "pmid", "url_key", "title_key")
_OFFERED = f"""i AS (SELECT id, CASE WHEN id % 7 = 0 THEN id + 5 END AS pid, CASE WHEN id % 7 < 2 THEN '10.1/a' || CAST(id AS VARCHAR) END AS doi, CASE WHEN id % 7 = 2 THEN CAST(id AS VARCHAR) END AS pmid, CASE WHEN id % 7 IN (1, 3) THEN {norm_url('url')} END AS url_key, {TITLE_SQL['eval']} AS title_key FROM pubs),
r AS (SELECT id, id AS pid, '10.1/a' || CAST(id AS VARCHAR) AS doi, CAST(id AS VARCHAR) AS pmid, CASE WHEN id % 2 = 0 THEN {norm_url('url')} END AS url_key, {TITLE_SQL['eval']} AS title_key FROM pubs WHERE id % 5 <> 0)"""


@query("match_steps", f"""WITH {PUBS}, {_OFFERED} SELECT i.id, coalesce({', '.join(f'{k}_.v' for k in _STEPS)}) AS found, CASE {' '.join(f"WHEN {k}_.v IS NOT NULL THEN '{k}'" for k in _STEPS)} END AS match_key
FROM i {' '.join(f"LEFT JOIN (SELECT {k}, max(id) AS v FROM r WHERE CAST({k} AS VARCHAR) <> '' GROUP BY 1) {k}_ ON {k}_.{k} = i.{k}" for k in _STEPS)}""")
def match_steps(spark, sf_dir):
    """All five steps from id to title, each with keys in the forms in which they come."""
    p = pubs(spark, sf_dir)
    n = F.col("id").cast("string")
    keys = {"doi": identifiers.normalize_doi(F.concat(F.lit("https://doi.org/10.1/A"), n)), "pmid": identifiers.normalize_pmid(F.concat(F.lit("PMID: "), n)), "url_key": identifiers.normalize_url(F.col("url")), "title_key": text.title_key(F.col("title"), "eval")}
    at = F.col("id") % 7
    given = {"pid": F.when(at == 0, F.col("id") + 5), "doi": F.when(at < 2, keys["doi"]), "pmid": F.when(at == 2, keys["pmid"]), "url_key": F.when(at.isin(1, 3), keys["url_key"]), "title_key": keys["title_key"]}
    items = p.select("id", *[c.alias(k) for k, c in given.items()])
    index = p.where("id % 5 <> 0").select(F.col("id").alias("found"), F.col("id").alias("pid"), keys["doi"].alias("doi"), keys["pmid"].alias("pmid"), F.when(F.col("id") % 2 == 0, keys["url_key"]).alias("url_key"), keys["title_key"].alias("title_key"))
    return match.cascade(items, index.withColumn("o", F.col("found")), list(_STEPS), "found", "o").select("id", "found", "match_key")
