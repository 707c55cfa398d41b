"""Joins that resolve entities: cascading keys, similar titles, neighbour lanes and validated reranks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from folio.functions.extract import sequence_ratio
from folio.functions.text import jaccard, title_key
from folio.operators.titles import components, linked_keys, may_be_alike, prefixes, stored


def latest(df: DataFrame, keys: list[str], order: str, keep: str = "latest") -> DataFrame:
    """One row a key: the last by `order`, or the first with keep='oldest'. Combines before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    pick = F.max_by if keep == "latest" else F.min_by
    return df.groupBy(*keys).agg(pick(F.struct(*rest), F.col(order)).alias("_r")).select(*keys, "_r.*")


def cascade(left: DataFrame, right: DataFrame, keys: list[str], value: str, order: str, keep: str = "latest") -> DataFrame:
    """left with `value` of the row of right that matches on the first key in `keys` that finds one, and match_key.

    Each key is one left join with a table of one row a key value, so an OR of keys never becomes a
    nested loop. Null and empty keys match nothing.
    """
    out = left
    for k in keys:
        side = right.where(F.col(k).isNotNull() & (F.col(k).cast("string") != "")).groupBy(F.col(k).alias(f"_k_{k}"))
        pick = F.max_by if keep == "latest" else F.min_by
        out = out.join(side.agg(pick(F.struct(F.col(value).alias("v")), F.col(order)).alias(f"_m_{k}")), out[k] == F.col(f"_k_{k}"), "left")
    found = [F.col(f"_m_{k}") for k in keys]
    name = reduce(lambda a, k: F.when(F.col(f"_m_{k}").isNotNull(), k).otherwise(a), reversed(keys), F.lit(None).cast("string"))
    return out.withColumn(value, F.coalesce(*found)["v"]).withColumn("match_key", name).drop(*[f"_{p}_{k}" for k in keys for p in "km"])


def similar_keys(keys: DataFrame, least: float = 0.85) -> DataFrame:
    """(ka, kb, similarity), ka < kb: keys (k) whose word sets have a Jaccard similarity over `least`.

    Keys are joined on the rare words of their prefixes only, with a length and a positional filter in
    the join, so frequent words build few pairs. All similar pairs come out; where groups are what is
    asked for, `linked_keys` gives them without the pairs.
    """
    prefix = stored(prefixes(keys, least))
    l, r = prefix.alias("l"), prefix.alias("r")
    pairs = l.join(r, (F.col("l.word") == F.col("r.word")) & (F.col("l.k") < F.col("r.k")) & may_be_alike(F.col("l.n"), F.col("l.p"), F.col("r.n"), F.col("r.p"), least))
    return pairs.select(F.col("l.k").alias("ka"), F.col("r.k").alias("kb")).distinct().withColumn("similarity", jaccard(F.col("ka"), F.col("kb"))).where(F.col("similarity") > least)


def similar_titles(a: DataFrame, b: DataFrame, a_id: str, b_id: str, title: str = "title", least: float = 0.85, style: str = "eval") -> DataFrame:
    """(a_id, b_id, similarity): titles of two tables that are alike; equal ones are 1.0 alike.

    Titles meet as distinct keys and each key is named by its smallest id on either side, so a title
    that a thousand rows share is one link and not a million; `title_classes` says which rows share it.
    """
    key = title_key(F.col(title), style).alias("k")
    x, y = (df.select(F.col(i).alias("id"), key).where("k <> ''").groupBy("k").agg(F.min("id").alias("id")) for df, i in ((a, a_id), (b, b_id)))
    keys = x.select("k").unionByName(y.select("k"))
    near = similar_keys(keys, least)
    both = near.unionByName(near.select(F.col("kb").alias("ka"), F.col("ka").alias("kb"), "similarity"))
    equal = x.join(y.select("k", F.col("id").alias("b_id")), "k").select(F.col("id").alias("a_id"), "b_id", F.lit(1.0).alias("similarity"))
    near = both.join(x.select(F.col("k").alias("ka"), F.col("id").alias("a_id")), "ka").join(y.select(F.col("k").alias("kb"), F.col("id").alias("b_id")), "kb").select("a_id", "b_id", "similarity")
    return equal.unionByName(near)


def title_classes(df: DataFrame, key: str, title: str = "title", style: str = "eval") -> DataFrame:
    """(id, class): rows and the smallest id with their title; rows without a title are left out."""
    t = df.select(F.col(key).alias("id"), title_key(F.col(title), style).alias("k")).where("k <> ''")
    return t.join(t.groupBy("k").agg(F.min("id").alias("class")), "k").select("id", "class")


def same_items(df: DataFrame, key: str = "id", doi: str | None = None, pmid: str | None = None, title: str = "title", least: float = 0.85, equal_from: int = 20) -> DataFrame:
    """Edges (a_id, b_id) of rows that are one item: equal DOI, equal PMID, equal titles of more than `equal_from` characters, or titles with similar words.

    Rows that share a value are linked to the smallest id that has it, so a value makes a star.
    """
    norm = title_key(F.col(title), "eval")
    stars = [F.lower(F.trim(F.col(doi)))] if doi else []
    stars += [F.trim(F.col(pmid).cast("string"))] if pmid else []
    stars.append(F.when(F.length(norm) > equal_from, norm))
    edges = None
    for value in stars:
        t = df.select(F.col(key).alias("b_id"), value.alias("v")).where("v IS NOT NULL AND v <> ''")
        e = t.join(t.groupBy("v").agg(F.min("b_id").alias("a_id")), "v").where("a_id < b_id").select("a_id", "b_id")
        edges = e if edges is None else edges.unionByName(e)
    # a title is named by its smallest id; the rows that share it (also a short one, which is 1.0 alike) hang on that
    shared = title_classes(df, key, title).where("class < id").select(F.col("class").alias("a_id"), F.col("id").alias("b_id"))
    return edges.unionByName(shared).unionByName(title_links(df, key, title, least)).distinct()


def title_links(df: DataFrame, key: str, title: str = "title", least: float = 0.85, style: str = "eval") -> DataFrame:
    """(a_id, b_id), a_id < b_id: links between similar titles, named by their smallest ids, that join the same rows as all similar pairs; at most a few a title."""
    named = df.select(F.col(key).alias("id"), title_key(F.col(title), style).alias("k")).where("k <> ''").groupBy("k").agg(F.min("id").alias("id"))
    links = linked_keys(named.select("k"), least)
    a, b = named.select(F.col("k").alias("ka"), F.col("id").alias("x")), named.select(F.col("k").alias("kb"), F.col("id").alias("y"))
    return links.join(a, "ka").join(b, "kb").select(F.least("x", "y").alias("a_id"), F.greatest("x", "y").alias("b_id"))


def title_groups(df: DataFrame, key: str, title: str = "title", least: float = 0.85, style: str = "eval") -> DataFrame:
    """(id, group): each row with a title and the smallest id that equal and similar titles lead to."""
    classes = title_classes(df, key, title, style)
    label = components(title_links(df, key, title, least, style), "a_id", "b_id").select(F.col("id").alias("class"), "label")
    return classes.join(label, "class", "left").select("id", F.coalesce("label", "class").alias("group"))


def merge_items(items: DataFrame, key: str, edges: DataFrame) -> DataFrame:
    """Items joined by match edges: the smallest key names the group; labels are joined, other columns filled from the first that has one.

    A chain of matches is one group (the reference order of arrival does not matter here).
    """
    group = components(edges, "a_id", "b_id").select(F.col("id").alias("_n"), F.col("label").alias("_l"))
    d = items.join(group, F.col(key) == F.col("_n"), "left").withColumn("_g", F.coalesce("_l", key)).drop("_n", "_l")
    rest = [c for c in items.columns if c not in (key, "labels")]
    first = [F.min_by(F.col(c), F.when(F.col(c).isNotNull(), F.col(key))).alias(c) for c in rest]
    return d.groupBy(F.col("_g").alias(key)).agg(*first, F.flatten(F.transform(F.array_sort(F.collect_list(F.struct(F.col(key).alias("k"), "labels"))), lambda x: x["labels"])).alias("labels"))


def rerank(candidates: DataFrame, results: DataFrame, least: float = 0.92) -> DataFrame:
    """candidates (id, title, ...) with llm_score, llm_rank of the best valid result (pub_id, title, llm_score, llm_rank).

    Valid: the id is known and the title is equal after normalising, or at least `least` alike. Case does
    not count: titles are compared by their capitals, of which ß has two. Twice the same id: the higher
    score stays. Without a valid result 0 and 999.
    """
    folded = title_key(F.upper("title"), "rerank")
    own = candidates.select("id", folded.alias("_want"))
    got = results.withColumn("_got", folded).where("_got <> ''").join(own, F.col("pub_id") == F.col("id"))
    valid = got.where((F.col("_got") == F.col("_want")) | (sequence_ratio("_want", "_got") >= least))
    best = valid.groupBy("pub_id").agg(F.max_by(F.struct("llm_score", "llm_rank"), F.struct(F.col("llm_score"), -F.col("llm_rank"))).alias("_b"))
    out = candidates.join(best, F.col("id") == F.col("pub_id"), "left")
    return out.select(*candidates.columns, F.coalesce("_b.llm_score", F.lit(0)).alias("llm_score"), F.coalesce("_b.llm_rank", F.lit(999)).alias("llm_rank"), F.col("_b").isNotNull().alias("reranked"))


def neighbour_lane(seeds: DataFrame, edges: DataFrame, top: int = 20, first: int = 10, each: int = 10) -> DataFrame:
    """Distinct neighbour ids: the `top` seeds by score, the first of those, at most `each` neighbours of each."""
    s = seeds.where("pmid IS NOT NULL").orderBy(F.col("score").desc_nulls_last(), "pmid").limit(top).limit(first)
    n = edges.join(s.select("pmid"), "pmid").withColumn("_r", F.row_number().over(Window.partitionBy("pmid").orderBy("place", "neighbour")))
    return n.where(F.col("_r") <= each).select("neighbour").distinct()


def split_cached(df: DataFrame, cache: DataFrame, key: str, as_of=None, days: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(hits, misses) against a cache; with days, older entries do not count."""
    c = cache if days is None else cache.where(F.col("cached_at") >= F.lit(as_of).cast("timestamp") - F.make_dt_interval(F.lit(days)))
    return df.join(c.select(key), key, "left_semi"), df.join(c.select(key), key, "left_anti")


def routed(seeds: DataFrame, tables: dict[str, DataFrame]) -> DataFrame:
    """Seeds (type, value) looked up in the table of their type (key `value`); unknown ones carry resolution_error."""
    parts = []
    for kind, t in tables.items():
        parts.append(seeds.where(F.col("type") == kind).join(t.select(F.col("value"), F.col("id").alias("resolved_id")), "value", "left"))
    other = seeds.where(~F.col("type").isin(*tables)).withColumn("resolved_id", F.lit(None).cast("long"))
    out = reduce(lambda x, y: x.unionByName(y), [*parts, other.select("value", *[c for c in seeds.columns if c != "value"], "resolved_id")])
    error = F.when(~F.col("type").isin(*tables), F.concat(F.lit("unknown type "), F.col("type"))).when(F.col("resolved_id").isNull(), F.concat(F.lit("not found by "), F.col("type")))
    return out.withColumn("resolution_error", error)
