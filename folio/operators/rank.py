"""Rankings with a total order: digests, heuristic scores, caps, funnels, blends and repairs."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from folio.functions.dates import day_ordinal, recency_points
from folio.operators.metrics import ordinal_ranks
from folio.operators.titles import stored

# Words and sources that raise the heuristic rank.
PRIORITY_WORDS = ("biomarker", "early detection", "ctdna", "cell-free dna", "methylation", "liquid biopsy", "diagnostic", "detection method", "sensitivity", "specificity")
PRIORITY_SOURCES = {"nature cancer": 100, "science": 90, "the lancet": 80, "bmj": 70, "biorxiv (all)": 60, "medrxiv (all)": 60}


def digest_order(score: str, ts: str, title: str, key: str) -> list[Column]:
    """Score (null below 0) down, day down (null last), title up without case, then the key."""
    return [F.coalesce(F.col(score), F.lit(-1)).desc(), day_ordinal(F.col(ts)).desc(), F.lower(F.coalesce(F.col(title), F.lit(""))).asc(), F.col(key).asc()]


def digest(df: DataFrame, score: str, ts: str, title: str, key: str, top: int = 5, mentions: int = 5, least: float | None = None) -> DataFrame:
    """The first `top` rows as 'must_read' and the next as 'honorable', with rank.

    orderBy and limit give a top-k without a full sort; only the kept rows are numbered.
    """
    d = df if least is None else df.where(F.col(score) >= least)
    d = d.orderBy(*digest_order(score, ts, title, key)).limit(top + mentions)
    rank = F.row_number().over(Window.orderBy(*digest_order(score, ts, title, key)))
    return d.withColumn("rank", rank).withColumn("section", F.when(F.col("rank") <= top, "must_read").otherwise("honorable"))


def heuristic(df: DataFrame, as_of: datetime, text: tuple[str, ...] = ("title", "summary", "raw_text"), source: str = "source", ts: str = "published_date", words: tuple[str, ...] = PRIORITY_WORDS, sources: dict[str, int] = PRIORITY_SOURCES) -> DataFrame:
    """Adds source_points (10 to 100), recency_points (50 to 200), keyword_points (0 to 300) and heuristic."""
    low = F.lower(F.col(source))
    points = F.when(F.lit(False), 0)
    for name, n in sources.items():
        points = points.when(F.contains(low, F.lit(name)), n)
    both = F.lower(F.concat_ws(" ", *[F.coalesce(F.col(c), F.lit("")) for c in text]))
    hits = F.lit(0)
    for w in words:
        hits = hits + F.contains(F.col("_both"), F.lit(w)).cast("int")
    d = df.withColumn("_both", both).withColumns({"source_points": points.otherwise(10), "recency_points": F.when(F.col(ts).isNull(), 50).otherwise(recency_points(F.col(ts), as_of)), "keyword_points": F.least(F.lit(300), 100 * hits)})
    return d.withColumn("heuristic", F.col("source_points") + F.col("recency_points") + F.col("keyword_points")).drop("_both")


def funnel(df: DataFrame, score: str, key: str, wide: int = 200, narrow: int = 50) -> DataFrame:
    """The first `narrow` of the first `wide`; the outer limit is enough, the inner one bounds what a costly step sees."""
    order = [F.col(score).desc_nulls_last(), F.col(key)]
    return df.orderBy(*order).limit(wide).orderBy(*order).limit(narrow)


def per_source_cap(df: DataFrame, source: str, order: list[Column], cap: int) -> DataFrame:
    """At most `cap` rows a source; the group limit runs before the shuffle."""
    return df.withColumn("place", F.row_number().over(Window.partitionBy(source).orderBy(*order))).where(F.col("place") <= cap)


def overflow(df: DataFrame, source: str, cap: int) -> DataFrame:
    return df.groupBy(source).agg(F.count(F.lit(1)).alias("total")).withColumn("overflow", F.greatest(F.lit(0), F.col("total") - cap))


def cap_flag(df: DataFrame, order: list[Column], cap: int, key: str) -> DataFrame:
    """Adds skipped: false for the first `cap` rows."""
    kept = df.orderBy(*order, F.col(key)).limit(cap).select(F.col(key).alias("_k"))
    return df.join(kept, F.col(key) == F.col("_k"), "left").withColumn("skipped", F.col("_k").isNull()).drop("_k")


def rank_score(rank: Column) -> Column:
    return F.greatest(F.lit(4), 100 - (rank - 1) * 4)


def blend(heuristic: Column, llm: Column) -> Column:
    """Below 10 the model's score alone, else 0.4 of the heuristic and 0.6 of six times the model's score."""
    return F.when(llm < 10, llm.cast("double")).otherwise(0.4 * heuristic + 0.6 * llm * 6)


def must_reads(reranked: DataFrame, n: int = 5, shortlist: int = 25) -> DataFrame:
    """Shortlist by heuristic, order by model rank, heuristic and id."""
    s = reranked.orderBy(F.col("heuristic").desc(), "id").limit(shortlist)
    return s.orderBy("llm_rank", F.col("heuristic").desc(), "id").limit(n).withColumn("score_total", blend(F.col("heuristic"), F.col("llm_score")))


def repair_ranking(candidates: DataFrame, ranked: DataFrame) -> DataFrame:
    """(id, rank): known ids in the order of `ranked` (pos, id), without repeats, then missing ones in their own order (seq).

    Places are made in two levels, by ranges of pos and of seq, so no task sorts all rows.
    """
    first = ranked.groupBy("id").agg(F.min("pos").alias("pos"))
    d = candidates.join(first, "id", "left")
    known, rest = d.where(F.col("pos").isNotNull()), d.where(F.col("pos").isNull())
    n = known.agg(F.count(F.lit(1)).alias("_known"))
    top = ordinal_ranks(known, "pos", "seq", "rank").select("id", "rank", F.lit(False).alias("appended"))
    more = ordinal_ranks(rest.select("id", "seq", F.lit(0).alias("_z")), "_z", "seq", "_r").crossJoin(F.broadcast(n))  # one row
    return top.unionByName(more.select("id", (F.col("_r") + F.col("_known")).alias("rank"), F.lit(True).alias("appended")))


def minmax(df: DataFrame, score: str, out: str = "normalized") -> DataFrame:
    """0 to 100 by the least and largest score; 50 where all are equal. One aggregate row is joined, no global window."""
    ends = df.agg(F.min(score).alias("_lo"), F.max(score).alias("_hi"))
    d = df.crossJoin(F.broadcast(ends))  # one row
    return d.withColumn(out, F.when(F.col("_lo") == F.col("_hi"), F.lit(50.0)).otherwise(F.bround((F.col(score) - F.col("_lo")) / (F.col("_hi") - F.col("_lo")) * 100))).drop("_lo", "_hi")


#: Items that one range of ranks holds about, and the largest number of ranges.
RANGE_ROWS, MOST_RANGES = 8192, 4096
#: Steps of a budget that are planned as one job.
STEPS = 3


def _log2(c: Column) -> Column:
    """The place of the highest bit of a positive number."""
    return F.length(F.bin(c)) - 1


def _sums_below(items: DataFrame, classes: int) -> DataFrame:
    """items (_g, _r, _s, _c) with _below: for each class m the sum of the sizes of the earlier items of the group that are in classes under m.

    Sums run inside ranges of ranks, and over the sums of the ranges, so a group of any size is many tasks.
    """
    n = items.count()
    ranges = min(MOST_RANGES, -(-n // RANGE_ROWS))
    small = [F.when(F.col("_c") < m, F.col("_s")).otherwise(0) for m in range(1, classes + 1)]
    if ranges <= 1:
        before = Window.partitionBy("_g").orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)
        return items.withColumn("_below", F.array(F.lit(0).cast("long"), *[F.coalesce(F.sum(x).over(before), F.lit(0)) for x in small]))
    ends = items.agg(F.percentile_approx("_r", [i / ranges for i in range(1, ranges)], 4 * ranges)).first()[0]
    cut = items.withColumn("_b", F.size(F.filter(F.lit(sorted(set(ends))), lambda x: x < F.col("_r"))))
    sums = cut.groupBy("_g", "_b").agg(*[F.sum(x).alias(f"_{m}") for m, x in enumerate(small)])
    before = Window.partitionBy("_g").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(F.col("_g").alias("_g2"), F.col("_b").alias("_b2"), *[F.coalesce(F.sum(f"_{m}").over(before), F.lit(0)).alias(f"_{m}") for m in range(classes)])
    before = Window.partitionBy("_g", "_b").orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)
    inside = cut.withColumns({f"_in{m}": F.coalesce(F.sum(x).over(before), F.lit(0)) for m, x in enumerate(small)})
    both = inside.join(sums, (F.col("_g").eqNullSafe(F.col("_g2"))) & (F.col("_b") == F.col("_b2")))
    return both.select("_g", "_r", "_s", "_c", F.array(F.lit(0).cast("long"), *[F.col(f"_{m}") + F.col(f"_in{m}") for m in range(classes)]).alias("_below"))


def _next_step(now: DataFrame, items: DataFrame, kind: str) -> DataFrame:
    """Each group taken on to the item at which the room left gets into a lower class, or to its end."""
    now = now.withColumns({"_m": _log2(F.col("_room")), "_after": F.try_element_at("_steps", F.lit(-1))["upto"]})
    d = items.join(now.select(F.col("_g").alias("_g2"), "_room", "_base", "_m", "_after"), F.col("_g").eqNullSafe(F.col("_g2"))).where("(_after IS NULL OR _r > _after) AND _c <= _m")
    d = d.withColumn("_took", F.element_at("_below", F.col("_m") + 1) - F.col("_base"))
    d = d.where("(_c < _m AND _took + _s > _room - shiftleft(1L, int(_m))) OR (_c = _m AND _took + _s <= _room)")
    event = d.groupBy(F.col("_g").alias("_g3")).agg(F.min_by(F.struct("_r", "_s", "_c", "_took", "_below"), "_r").alias("_e"))
    both = now.join(event, F.col("_g").eqNullSafe(F.col("_g3")), "left")
    room = F.when(F.col("_e").isNull(), 0).otherwise(F.col("_room") - F.col("_e._took") - F.col("_e._s")).cast("long")
    step = F.struct(F.col("_after").alias("after"), F.col("_e._r").alias("upto"), F.col("_m").cast("int").alias("m"), F.col("_e._r").alias("one"))
    both = both.withColumns({"_room": room, "_steps": F.concat("_steps", F.array(step).cast(kind))}).withColumn("_m", _log2(F.col("_room")))
    base = F.element_at("_e._below", F.col("_m") + 1) + F.when(F.col("_e._c") < F.col("_m"), F.col("_e._s")).otherwise(0)
    return both.select("_g", "_least", "_room", F.when(F.col("_room") > 0, base).otherwise(0).alias("_base"), "_steps", ((F.col("_room") > 0) & (F.col("_m") >= F.col("_least"))).alias("_open"))


def byte_budget(df: DataFrame, group: str, rank: str, size: str, budget: int) -> DataFrame:
    """Adds attached: in rank order each item is taken if it still fits; a later smaller one may fit after one that did not.

    Sizes fall into classes by their highest bit. While the room left has its highest bit at m, items of
    lower classes all fit, those of higher ones never will again, and one item of class m at most is
    taken, as that brings the room below. So the room changes its class at the first item where the
    running sum of the lower classes goes over the edge or one of class m fits; all groups go on to
    that item at once, in at most as many steps as the budget has bits. Running sums of all classes are made once.
    Ranks are unique in a group; a null, negative or larger size than the budget never fits, an empty item always does.
    """
    slim = df.select(F.col(group).alias("_g"), F.col(rank).alias("_r"), F.floor(F.col(size)).cast("long").alias("_s"))
    items = slim.where(f"_s BETWEEN 1 AND {int(budget)}").withColumn("_c", _log2(F.col("_s")))
    items = stored(_sums_below(items, int(budget).bit_length()))
    kind = f"array<struct<after:{df.schema[rank].dataType.simpleString()},upto:{df.schema[rank].dataType.simpleString()},m:int,one:{df.schema[rank].dataType.simpleString()}>>"
    state = items.groupBy("_g").agg(F.min("_c").alias("_least")).select("_g", "_least", F.lit(int(budget)).cast("long").alias("_room"), F.lit(0).cast("long").alias("_base"), F.array().cast(kind).alias("_steps"), F.lit(True).alias("_open"))
    while True:
        for _ in range(STEPS):
            state = state.where("NOT _open").unionByName(_next_step(state.where("_open"), items, kind))
        seen = Observation()
        state = stored(state.observe(seen, F.count_if("_open").alias("open")))
        if not seen.get["open"]:
            break
    d = df.join(state.select("_g", "_steps"), F.col(group).eqNullSafe(F.col("_g")), "left")
    r, s = F.col(rank), F.floor(F.col(size)).cast("long")
    inside = lambda t: (t["after"].isNull() | (r > t["after"])) & (t["upto"].isNull() | (r <= t["upto"]))
    fits = F.exists("_steps", lambda t: inside(t) & ((_log2(s) < t["m"]) | F.coalesce(r == t["one"], F.lit(False))))
    attached = F.when(s == 0, True).when((s > 0) & (s <= budget), F.coalesce(fits, F.lit(False))).otherwise(False)
    return d.withColumn("attached", attached).drop("_g", "_steps")


def ranking_checks(df: DataFrame, rank: str, score: str, top: int, least: float, ranges: int = 256) -> DataFrame:
    """Data-quality counts: rows whose successor has a higher score, and high scores left out of the first `top`.

    Rows are compared inside ranges of the rank; the last row of a range meets the first of the next one.
    """
    s = F.coalesce(F.col(score), F.lit(-1))
    ends = df.agg(F.percentile_approx(rank, [i / ranges for i in range(1, ranges)], 4 * ranges).alias("_ends"))
    d = df.crossJoin(F.broadcast(ends))  # one row of at most `ranges` numbers
    d = d.select(F.col(rank).alias("_r"), s.alias("_s"), F.size(F.filter("_ends", lambda x: x < F.col(rank))).alias("_range"))
    inside = d.withColumn("_next", F.lead("_s").over(Window.partitionBy("_range").orderBy("_r")))
    ends = d.groupBy("_range").agg(F.min_by("_s", "_r").alias("_first"), F.max_by("_s", "_r").alias("_last")).withColumn("_next", F.lead("_first").over(Window.orderBy("_range")))
    falls = inside.agg(F.count_if(F.col("_next") > F.col("_s")).alias("a"), F.count_if((F.col("_r") > top) & (F.col("_s") >= least)).alias("high_excluded"))
    seams = ends.agg(F.count_if(F.col("_next") > F.col("_last")).alias("b"))
    return falls.crossJoin(F.broadcast(seams)).select((F.col("a") + F.col("b")).alias("out_of_order"), "high_excluded")  # one row each
