"""Mixing sources to target weights by weighted fair queueing."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from folio.llm.common import bucketed_running_sum, materialize, table

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
BUDGET = 1.5
MOST = 2
RANGES = 1024
STEP = 4096


def source_targets(sizes: DataFrame, budget: float = BUDGET, most: int = MOST, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """(src, source_size, source_rows, weight, target) from rows (src, source, size): one row a source.

    Sources stand in code point order, null last, and take the weights in turn. A target is
    min(most * size, level * weight) with one level for all, chosen so that targets sum to
    budget * all sizes: what is left when excess is reshared by weight until no target is above its
    limit. The table has a row a source, not a row a document.
    """
    n = len(weights)
    by = sizes.groupBy("src", "source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("source_rows"))
    place = (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % n
    pick = F.element_at(F.array(*[F.lit(int(x)) for x in weights]), (place + 1).cast("int"))
    by = by.withColumn("weight", pick.cast("long"))
    every = Window.partitionBy(F.lit(0))
    upto = Window.orderBy((F.col("cap") / F.col("weight")).asc(), F.col("src")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = upto.rowsBetween(Window.unboundedPreceding, -1)
    c = by.withColumn("cap", most * F.col("source_size"))
    c = c.withColumn("total", F.sum("source_size").over(every) * F.lit(float(budget))).withColumn("all_weight", F.sum("weight").over(every))
    c = c.withColumn("cap_before", F.coalesce(F.sum("cap").over(before), F.lit(0))).withColumn("weight_before", F.coalesce(F.sum("weight").over(before), F.lit(0)))
    # sources are filled in order of cap / weight; the level is that of the first source left below its cap
    c = c.withColumn("level_here", (F.col("total") - F.col("cap_before")) / (F.col("all_weight") - F.col("weight_before")))
    c = c.withColumn("open", F.col("level_here") * F.col("weight") < F.col("cap"))
    c = c.withColumn("level", F.min(F.when(F.col("open"), F.struct(F.col("cap") / F.col("weight"), F.col("src"), F.col("level_here").alias("level")))).over(every)["level"])
    target = F.when(F.col("level").isNull(), F.col("cap").cast("double")).otherwise(F.least(F.col("cap").cast("double"), F.col("level") * F.col("weight")))
    return c.select("src", "source_size", "source_rows", "weight", target.alias("target"))


def keyed(docs: DataFrame, id_col: str, text_col: str, source_col: str, seed: str) -> DataFrame:
    """docs with _size (words), _src (the source, null told from '') and _key (its place in the shuffled order).

    The key hashes id and text, so rows of one id or of none are spread like any others; only rows
    equal in both share a key.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    size = F.regexp_count(text, F.lit(WORD)).cast("long")
    src = F.coalesce(F.concat(F.lit("="), F.col(source_col).cast("string")), F.lit(""))
    key = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit(":"), text).cast("binary"))
    return docs.withColumns({"_size": size, "_src": src, "_key": key})


def copies_of(groups: DataFrame, step: int = STEP) -> DataFrame:
    """A row for each of the n equal rows of a group, numbered 1 to n in `copy`; groups of more than `step` rows are dealt in parts."""
    parts = groups.withColumn("_from", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"), F.lit(step).cast("long"))))
    few, many = parts.where(F.col("n") <= step), parts.where(F.col("n") > step)
    both = few.unionByName(many.repartition("src", "key", "_from"))
    return both.withColumn("copy", F.explode(F.sequence(F.col("_from"), F.least(F.col("n"), F.col("_from") + (step - 1))))).drop("_from", "n")


def budget_end(passes: DataFrame, budget: float, ranges: int = RANGES, most_rows: int = STEP) -> tuple[float, float, float]:
    """(from, to, words before from): the range of finish times [from, to) in which the words reach the budget.

    All rows are cut into `ranges` ranges whose words are summed in tasks; the one that passes the
    budget is cut again until it holds few rows or is as narrow as a double allows.
    """
    low, high, before = 0.0, 2.0 * MOST, 0.0
    while True:
        width = (high - low) / ranges
        place = F.least(F.floor((F.col("vft") - F.lit(low)) / F.lit(width)), F.lit(ranges - 1)).cast("int")
        inside = passes.where((F.col("vft") >= low) & (F.col("vft") < high))
        at, rows = -1, 0
        for r in inside.groupBy(place.alias("r")).agg(F.sum("size").alias("words"), F.count(F.lit(1)).alias("rows"), F.min("vft").alias("lo"), F.max("vft").alias("hi")).orderBy("r").collect():  # at most `ranges` rows
            if before + r["words"] > budget:
                at, rows, low, high = r["r"], r["rows"], r["lo"], math.nextafter(r["hi"], math.inf)
                break
            before += r["words"]
        if at < 0:
            return high, high, before
        if rows <= most_rows or high <= math.nextafter(low, math.inf):
            return low, high, before


def mix_cuts(d: DataFrame) -> DataFrame:
    """One row a source from rows (source, src, key, size): source_size, target, and for each pass the last key that the mix takes and how many of its rows.

    Documents of a source stand in a fixed shuffled order (md5 of seed, id and text). In pass p = 0, 1 a
    document's virtual finish time is (p * source_size + words up to its middle) / target, so each
    source reaches 1 just when it has given its target. Documents of all sources are ranged by finish
    time and cut where their words reach the whole budget: the words of all targets. Within a source
    and a pass finish times rise with the key, so what is taken is all keys up to a last one, and of
    the equal rows of that last key the first few. Equal rows are one group with a count until their
    finish times are needed, so no range of keys grows with them. Documents without words weigh nothing
    and follow the keys around them.
    """
    targets = materialize(source_targets(d))
    groups = materialize(d.where("size > 0").groupBy("src", "key").agg(F.first("size").alias("size"), F.count(F.lit(1)).alias("n")))
    share = F.conv(F.substring("key", 1, 12), 16, 10).cast("double") / F.lit(float(1 << 48))
    run = bucketed_running_sum(groups.withColumn("words", F.col("size") * F.col("n")), "src", [F.col("key")], share, "words", groups.count())
    run = run.join(targets.select(F.col("src").alias("_t"), "source_size", "target"), F.col("src") == F.col("_t")).drop("_t", "words")
    passes = copies_of(run).withColumn("pass", F.explode(F.sequence(F.lit(0), F.lit(MOST - 1))))
    middle = F.col("pass") * F.col("source_size") + F.col("run_before") + (F.col("copy") - 1) * F.col("size") + F.col("size") / 2
    passes = materialize(passes.select("src", "key", "copy", "size", "pass", (middle / F.col("target")).alias("vft")))
    budget = targets.agg(F.sum("target")).first()[0] or 0.0
    low, high, before = budget_end(passes, budget)
    inside = Window.orderBy("vft", "key", "src", "copy", "pass").rowsBetween(Window.unboundedPreceding, -1)  # the few rows of one range
    edge = passes.where((F.col("vft") >= low) & (F.col("vft") < high)).withColumn("at", F.lit(before) + F.coalesce(F.sum("size").over(inside), F.lit(0)) + F.col("size") / 2)
    kept = passes.where(F.col("vft") < low).select("src", "pass", "key", "copy").unionByName(edge.where(F.col("at") <= budget).select("src", "pass", "key", "copy"))
    ends = [F.max(F.when(F.col("pass") == p, F.struct("key", "copy"))).alias(f"last_{p}") for p in range(MOST)]
    last = kept.groupBy(F.col("src").alias("_t")).agg(*ends)
    return materialize(targets.join(last, F.col("src") == F.col("_t"), "left").select("src", "source_size", "target", *[f"last_{p}" for p in range(MOST)]))


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: str = "mix") -> DataFrame:
    """The rows of docs with _size, _source_size, _target, _copies and _taken (copies times size).

    The decision for a row needs its own key and its source's row of mix_cuts only, so texts stay where
    they are: they are joined with a table of one row a source.

    Null text has size 0; a null source is a source of its own; rows that repeat an id are documents of
    their own with keys of their own; rows equal in id and text are taken one by one, so they never
    overshoot a target together; a null id is an id like any other; a source without words gives
    nothing; ties in finish time go by key, then source; an empty table gives an empty result. Texts of
    any length are counted in the JVM. Added columns begin with '_', so others can bear any usual name.
    """
    d = keyed(docs, id_col, text_col, source_col, seed)
    return decided(d, mix_cuts(slim(d, source_col))).drop("_key", "_src")


def slim(d: DataFrame, source_col: str, *more: str) -> DataFrame:
    """What the mix needs of keyed rows, written once: no texts."""
    return materialize(d.select(*more, F.col(source_col).cast("string").alias("source"), F.col("_src").alias("src"), F.col("_key").alias("key"), F.col("_size").alias("size")))


def decided(d: DataFrame, cuts: DataFrame) -> DataFrame:
    """Rows with _src, _key and _size joined with their source's cuts.

    Only rows of a last key have to be numbered: they are written once, counted by the task that wrote
    them, and numbered inside it.
    """
    cuts = cuts.select(*[F.col(c).alias(f"_{c}" if c != "src" else "_t") for c in cuts.columns])
    joined = d.join(cuts, F.col("_src") == F.col("_t"))
    passes, done = range(MOST), ["_t", *[f"_last_{p}" for p in range(MOST)]]
    at_end = F.coalesce(F.greatest(*[(F.col("_key") == F.col(f"_last_{p}.key")) & (F.col("_size") > 0) for p in passes]), F.lit(False))

    def taken(rows: DataFrame, number: Column) -> DataFrame:
        before = [(F.col("_key") < F.col(f"_last_{p}.key")) | ((F.col("_key") == F.col(f"_last_{p}.key")) & (number <= F.col(f"_last_{p}.copy"))) for p in passes]
        copies = sum((F.when(b, 1).otherwise(0) for b in before), F.lit(0))
        return rows.withColumn("_copies", copies.cast("long")).withColumn("_taken", F.col("_copies") * F.col("_size")).drop(*done)

    edge = materialize(joined.where(at_end).withColumns({"_task": F.spark_partition_id(), "_row": F.monotonically_increasing_id()}))
    counts = edge.groupBy("_src", "_key", "_task").agg(F.count(F.lit(1)).alias("_n"))
    counts = counts.select(F.col("_src").alias("_s"), F.col("_key").alias("_k"), F.col("_task").alias("_j"), F.coalesce(F.sum("_n").over(Window.partitionBy("_src", "_key").orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_base"))
    numbered = edge.withColumn("_in", F.row_number().over(Window.partitionBy("_src", "_key", "_task").orderBy("_row")))
    numbered = numbered.join(counts, (F.col("_src") == F.col("_s")) & (F.col("_key") == F.col("_k")) & (F.col("_task") == F.col("_j")))
    last = taken(numbered, F.col("_base") + F.col("_in")).drop("_task", "_row", "_in", "_base", "_s", "_k", "_j")
    return taken(joined.where(~at_end), F.lit(0)).unionByName(last)


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    small = slim(keyed(docs, "doc_id", "text", "source", "mix"), "source", "doc_id")
    m = decided(small.select("doc_id", F.col("src").alias("_src"), F.col("key").alias("_key"), F.col("size").alias("_size")), mix_cuts(small))
    return m.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("_size").alias("size"), F.col("_source_size").alias("source_size"), F.col("_target").alias("target"), F.col("_taken").alias("taken"))


#: The same mix in DuckDB: one global order by finish time, cut where the middle of a document passes the budget.
SQL = r"""
WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size, CASE WHEN source IS NULL THEN '' ELSE '=' || source END AS src, md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')) AS key FROM documents),
s AS (SELECT src, source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY 1, 2),
w AS (SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight, 2 * source_size AS cap FROM s),
c AS (SELECT *, CAST(sum(source_size) OVER () AS DOUBLE) * 1.5::DOUBLE AS total, CAST(sum(weight) OVER () AS BIGINT) AS all_weight, CAST(coalesce(sum(cap) OVER o, 0) AS BIGINT) AS cap_before, CAST(coalesce(sum(weight) OVER o, 0) AS BIGINT) AS weight_before FROM w WINDOW o AS (ORDER BY cap / weight, src ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (SELECT *, (total - cap_before) / (all_weight - weight_before) AS level_here FROM c),
v AS (SELECT level_here AS level FROM l WHERE level_here * weight < cap ORDER BY cap / weight, src LIMIT 1),
t AS (SELECT src, source_size, CASE WHEN (SELECT count(*) FROM v) = 0 THEN CAST(cap AS DOUBLE) ELSE least(CAST(cap AS DOUBLE), (SELECT level FROM v) * weight) END AS target FROM l),
r AS (SELECT d.*, t.source_size, t.target, row_number() OVER (PARTITION BY d.src, key ORDER BY size) AS copy, coalesce(sum(size) OVER (PARTITION BY d.src ORDER BY key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS run_before FROM d JOIN t ON d.src = t.src),
p AS (SELECT r.*, pass, (pass * source_size + run_before + size / 2) / target AS vft FROM r, (SELECT unnest([0, 1]) AS pass) WHERE size > 0),
g AS (SELECT *, coalesce(sum(size) OVER (ORDER BY vft, key, src, copy, pass ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + size / 2 AS place FROM p),
k AS (SELECT src, key, copy, CAST(sum(CASE WHEN place <= (SELECT sum(target) FROM t) THEN size ELSE 0 END) AS BIGINT) AS taken FROM g GROUP BY 1, 2, 3)
SELECT r.doc_id, r.size, r.source_size, r.target, coalesce(k.taken, 0) AS taken FROM r LEFT JOIN k USING (src, key, copy)
"""
