"""Agreement of model scores with human ratings: rank correlation, NDCG, recall, confusion, calibration.

Ranks over a whole table need a total order. They are made from counts: rows are counted by distinct
score first and the running sum goes over those sums, so no task sorts all rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from folio.operators.titles import stored

#: Distinct values of a range, about, and cut points at most: a sketch of bounded size.
RANGE_ROWS, RANGES = 1 << 16, 4096


def running_rows(counts: DataFrame, value: str, group: str | None, ranges: int | None = None) -> DataFrame:
    """counts (value, _n, maybe group) with _before, the rows of smaller values.

    Values are cut into ranges at approximate quantiles, as many as their number asks for; rows are
    summed by range, ranges are accumulated, then the values inside each range on their own, so no
    task holds more than about RANGE_ROWS values. Few values are one range. The counts are written once.
    """
    keys = [] if group is None else [group]
    counts = stored(counts)
    ranges = ranges or min(RANGES, -(-counts.count() // RANGE_ROWS))
    if ranges <= 1:
        before = Window.partitionBy(*keys).orderBy(value).rowsBetween(Window.unboundedPreceding, -1) if keys else Window.orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
        return counts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    ends = F.percentile_approx(value, [i / ranges for i in range(1, ranges)], 4 * ranges)
    cut = counts.crossJoin(F.broadcast(counts.agg(ends.alias("_ends"))))  # one row of at most `ranges` numbers
    cut = cut.withColumn("_range", F.size(F.filter("_ends", lambda x: x < F.col(value)))).drop("_ends")
    first = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1) if keys else Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sums = cut.groupBy(*keys, "_range").agg(F.sum("_n").alias("_all")).withColumn("_base", F.coalesce(F.sum("_all").over(first), F.lit(0))).drop("_all")
    inside = Window.partitionBy(*keys, "_range").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    both = cut.withColumn("_in", F.coalesce(F.sum("_n").over(inside), F.lit(0))).join(sums, [*keys, "_range"])
    return both.withColumn("_before", F.col("_base") + F.col("_in")).drop("_range", "_base", "_in")


def average_ranks(df: DataFrame, value: str, out: str, group: str | None = None) -> DataFrame:
    """Adds the rank of `value`, ties sharing their mean rank."""
    keys = [value] if group is None else [group, value]
    counts = running_rows(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")), value, group)
    return df.join(counts.withColumn(out, F.col("_before") + (F.col("_n") + 1) / 2).drop("_n", "_before"), keys)


def ordinal_ranks(df: DataFrame, value: str, key: str, out: str) -> DataFrame:
    """Adds the place of each row by value, ties in the order of `key`; only rows of one value and hash range of keys meet in a task."""
    counts = running_rows(df.groupBy(value).agg(F.count(F.lit(1)).alias("_n")), value, None)
    tied = df.join(counts, value)
    ties = running_rows(df.groupBy(value, key).agg(F.count(F.lit(1)).alias("_n")), key, value).select(F.col(value).alias("_v"), F.col(key).alias("_k"), F.col("_before").alias("_ties"))
    return tied.join(ties, (F.col(value) == F.col("_v")) & (F.col(key) == F.col("_k"))).withColumn(out, F.col("_before") + F.col("_ties") + 1).drop("_n", "_before", "_v", "_k", "_ties")


def spearman(df: DataFrame, score: str, rating: str, group: str | None = None) -> DataFrame:
    """(rho, n): correlation of average ranks; null for fewer than three rows or no spread."""
    d = df.where(F.col(score).isNotNull() & F.col(rating).isNotNull())
    d = average_ranks(average_ranks(d, score, "_rs", group), rating, "_rr", group)
    n = F.count(F.lit(1))
    spread = (F.min(score) < F.max(score)) & (F.min(rating) < F.max(rating))
    return (d if group is None else d.groupBy(group)).agg(F.when((n >= 3) & spread, F.try_divide(F.covar_pop("_rs", "_rr"), F.stddev_pop("_rs") * F.stddev_pop("_rr"))).alias("rho"), n.alias("n"))


def spearman_ordinal(df: DataFrame, score: str, rating: str, key: str) -> DataFrame:
    """1 - 6 * sum d^2 / (n (n^2 - 1)) with ordinal ranks, ties in the order of `key`, which is unique and orders by number."""
    d = df.where(F.col(score).isNotNull() & F.col(rating).isNotNull())
    d = ordinal_ranks(ordinal_ranks(d, score, key, "_a"), rating, key, "_b")
    n = F.count(F.lit(1)).cast("double")
    return d.agg(F.when(n >= 3, 1 - 6 * F.sum(F.pow(F.col("_a").cast("double") - F.col("_b").cast("double"), 2)) / (n * (n * n - 1))).alias("rho"), F.count(F.lit(1)).alias("n"))


def ranking_metrics(df: DataFrame, score: str, relevance: str, key: str, ks: tuple[int, ...] = (5, 10, 20), relevant: int = 3) -> DataFrame:
    """One row: ndcg_k and recall_k for each k, and n_items. Top-k rows by limit, never a full sort.

    Gain 2^relevance - 1, discount log2(place + 1); model ties in the order of `key`.
    """
    d = df.where(F.col(score).isNotNull() & F.col(relevance).isNotNull())
    most = max(ks)
    by_model = d.orderBy(F.col(score).desc(), key).limit(most).withColumn("_r", F.row_number().over(Window.orderBy(F.col(score).desc(), key)))
    ideal = d.orderBy(F.col(relevance).desc(), key).limit(most).withColumn("_r", F.row_number().over(Window.orderBy(F.col(relevance).desc(), key)))
    gain = lambda k: F.sum(F.when(F.col("_r") <= k, (F.pow(F.lit(2.0), F.col(relevance)) - 1) / F.log2(F.col("_r") + F.lit(1.0))))
    m = by_model.agg(*[gain(k).alias(f"dcg_{k}") for k in ks], *[F.count_if((F.col("_r") <= k) & (F.col(relevance) >= relevant)).alias(f"hits_{k}") for k in ks])
    i = ideal.agg(*[gain(k).alias(f"idcg_{k}") for k in ks])
    t = d.agg(F.count(F.lit(1)).alias("n_items"), F.count_if(F.col(relevance) >= relevant).alias("n_relevant"))
    one = m.crossJoin(F.broadcast(i)).crossJoin(F.broadcast(t))  # one row each
    ndcg = [F.when(F.col("n_items") > 0, F.coalesce(F.col(f"dcg_{k}") / F.nullif(F.col(f"idcg_{k}"), F.lit(0.0)), F.lit(0.0))).alias(f"ndcg_{k}") for k in ks]
    recall = [(F.col(f"hits_{k}") / F.nullif(F.col("n_relevant"), F.lit(0))).alias(f"recall_{k}") for k in ks]
    return one.select(*ndcg, *recall, "n_items")


def source_category(source: Column) -> Column:
    low = F.lower(F.coalesce(source, F.lit("unknown")))
    return F.when(F.rlike(low, F.lit("pubmed|ncbi")), "pubmed").when(F.rlike(low, F.lit("medrxiv|biorxiv")), "preprint").when(F.rlike(low, F.lit("nature|lancet|nejm")), "journal").otherwise("other")


def confusion(df: DataFrame, score: str, rating: str, predicted: Column) -> DataFrame:
    """(actual, predicted, n): actual is the mean rating rounded half to even, clamped to 0..3."""
    actual = F.greatest(F.lit(0), F.least(F.lit(3), F.bround(F.col(rating)).cast("int")))
    return df.where(F.col(score).isNotNull() & F.col(rating).isNotNull()).groupBy(actual.alias("actual"), predicted.alias("predicted")).agg(F.count(F.lit(1)).alias("n"))


def accuracy(matrix: DataFrame) -> DataFrame:
    return matrix.agg(F.sum(F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(0)).alias("correct"), F.sum("n").alias("total")).withColumn("accuracy", F.col("correct") / F.nullif(F.col("total"), F.lit(0)))


def disagreements(df: DataFrame, score: str, rating: str, key: str, n: int = 20) -> DataFrame:
    error = F.abs(F.col(score) / 100.0 * 3.0 - F.col(rating))
    return df.where(F.col(score).isNotNull() & F.col(rating).isNotNull()).withColumn("error", F.round(error, 6)).orderBy(F.desc("error"), key).limit(n)


def ratings(labels: DataFrame, key: str, rating: str) -> DataFrame:
    """mean_rating, majority_rating (count, then the higher rating) and n_labels a key."""
    by = labels.where(F.col(rating).isNotNull()).groupBy(key, rating).agg(F.count(F.lit(1)).alias("_n"))
    return by.groupBy(key).agg((F.sum(F.col(rating) * F.col("_n")) / F.sum("_n")).alias("mean_rating"), F.max_by(F.col(rating), F.struct("_n", rating)).alias("majority_rating"), F.sum("_n").alias("n_labels"))


def label_summary(labels: DataFrame, key: str, rating: str, score: str) -> DataFrame:
    """One row: labels and publications, labels of each rating 0 to 3, and the mean over publications of their mean score."""
    per = labels.where(F.col(score).isNotNull()).groupBy(key).agg(F.avg(score).alias("_m"))
    counts = labels.agg(F.count(F.lit(1)).alias("n_labels"), F.count_distinct(key).alias("n_publications"), *[F.count_if(F.col(rating) == r).alias(f"rating_{r}") for r in range(4)])
    return counts.crossJoin(F.broadcast(per.agg(F.avg("_m").alias("mean_of_means"))))  # one row each


def enough_ratings(df: DataFrame, labels: str, n: int) -> DataFrame:
    return df.where(F.size(F.filter(labels, lambda l: l["rating"].isNotNull())) >= n)


def mean_rating(labels: Column) -> Column:
    r = F.transform(F.filter(labels, lambda l: l["rating"].isNotNull()), lambda l: l["rating"].cast("double"))
    return F.when(F.size(r) > 0, F.aggregate(r, F.lit(0.0), lambda a, x: a + x) / F.size(r))


def label_of(labels: Column, source: str) -> Column:
    return F.try_element_at(F.filter(labels, lambda l: l["source"] == source), F.lit(1))["rating"]


BLOCK = "x_lo double, x_hi double, y double, w double"
#: Neighbouring ranges whose blocks are joined at once.
FAN_IN = 16


def join_blocks(pdf: pd.DataFrame) -> pd.DataFrame:
    """Pools neighbouring blocks whose means fall; blocks of one range, or those of several ranges joined at their seams."""
    pdf = pdf.sort_values("x_lo")
    stack: list[list[float]] = []
    for lo, hi, y, w in zip(*(pdf[c].tolist() for c in ("x_lo", "x_hi", "y", "w")), strict=True):
        stack.append([lo, hi, y * w, w])
        while len(stack) > 1 and stack[-2][2] / stack[-2][3] >= stack[-1][2] / stack[-1][3]:
            _, hi, s, w = stack.pop()
            stack[-1] = [stack[-1][0], hi, stack[-1][2] + s, stack[-1][3] + w]
    return pd.DataFrame([(lo, hi, s / w, w) for lo, hi, s, w in stack], columns=["x_lo", "x_hi", "y", "w"])


def isotonic_blocks(df: DataFrame, score: str, value: str) -> DataFrame:
    """(x_lo, x_hi, y, w): the isotonic regression of value on the score as it stands, a row a block of equal fitted values with its rows.

    Rows are counted by distinct score, scores are cut into ranges of about RANGE_ROWS, and each range is
    fitted on its own. A block is a sum, a weight and its ends, so fits can be joined: FAN_IN
    neighbouring ranges at a time, only what falls at a seam is pooled further, until one is left. What
    goes on from a range are its blocks, not its scores; noisy values leave few of them.
    """
    d = df.where(F.col(score).isNotNull() & F.col(value).isNotNull())
    counts = stored(d.groupBy(F.col(score).cast("double").alias("x_lo")).agg(F.avg(value).alias("y"), F.count(F.lit(1)).cast("double").alias("w")))
    ranges = max(1, min(RANGES, -(-counts.count() // RANGE_ROWS)))
    ends = sorted(set(counts.agg(F.percentile_approx("x_lo", [i / ranges for i in range(1, ranges)], 4 * ranges)).first()[0] or [])) if ranges > 1 else []
    place = F.size(F.filter(F.lit(ends), lambda e: e < F.col("x_lo"))) if ends else F.lit(0)
    blocks, groups = counts.select("x_lo", F.col("x_lo").alias("x_hi"), "y", "w", place.alias("r")), len(ends) + 1
    while True:
        blocks = blocks.groupBy("r").applyInPandas(lambda key, pdf: join_blocks(pdf).assign(r=key[0]), f"{BLOCK}, r int")
        if groups == 1:
            return blocks.drop("r")
        groups = -(-groups // FAN_IN)
        blocks = stored(blocks.withColumn("r", F.floor(F.col("r") / FAN_IN).cast("int")))


class Calibrator:
    """A monotone map of scores 0..100 by isotonic regression.

    The fit pools rows by score in Spark: scores lie in 0..100 and are told apart to `grid` of a point, so
    the driver sees no more rows than the grid has places, whatever the table; with grid=None scores are
    taken as they stand, and the driver sees the blocks of `isotonic_blocks`. mode='exact' is isotonic
    regression; mode='pairwise' repeats passes that pool each run of falling values until nothing falls
    or twice as many passes as rows are done. It works on single rows, so it is for samples and refuses
    more than `PAIRWISE_ROWS`.
    """

    GRID = 100
    PAIRWISE_ROWS = 100_000

    def __init__(self, xs: list[float], ys: list[float]):
        self.xs, self.ys = xs, ys

    @classmethod
    def fit(cls, df: DataFrame, score: str, rating: str, scale: float = 100 / 3, mode: str = "exact", grid: int | None = GRID) -> Calibrator:
        d = df.where(F.col(score).isNotNull() & F.col(rating).isNotNull())
        place = F.least(F.lit(100.0), F.greatest(F.lit(0.0), F.col(score).cast("double")))
        if grid is None and mode == "exact":
            fitted = isotonic_blocks(d.select(place.alias("x"), (F.col(rating) * F.lit(scale)).alias("y")), "x", "y").orderBy("x_lo").toPandas()
            if fitted["w"].sum() < 5:
                raise ValueError("at least five rows are needed")
            return cls._between(fitted["x_lo"].tolist(), fitted["y"].tolist())
        place = F.bround(place * (grid or cls.GRID)) / (grid or cls.GRID)
        rows = d.groupBy(place.alias("x")).agg(F.avg(F.col(rating) * F.lit(scale)).alias("y"), F.count(F.lit(1)).alias("w")).orderBy("x").toPandas()
        if rows["w"].sum() < 5:
            raise ValueError("at least five rows are needed")
        if mode == "pairwise" and rows["w"].sum() > cls.PAIRWISE_ROWS:
            raise ValueError(f"mode='pairwise' is for samples of up to {cls.PAIRWISE_ROWS} rows")
        x, y, w = (rows[c].to_numpy(float) for c in "xyw")
        fitted = pool(y, w) if mode == "exact" else pool_pairwise(np.repeat(y, w.astype(int)))[np.cumsum(w.astype(int)) - 1]
        keep = np.concatenate([[True], fitted[1:] != fitted[:-1]])
        return cls._between(x[keep].tolist(), fitted[keep].tolist())

    @classmethod
    def _between(cls, xs: list[float], ys: list[float]) -> Calibrator:
        """Thresholds from 0 to 100."""
        if xs[0] > 0:
            xs, ys = [0.0, *xs], [ys[0], *ys]
        if xs[-1] < 100:
            xs, ys = [*xs, 100.0], [*ys, ys[-1]]
        return cls(xs, ys)

    def column(self, score: Column) -> Column:
        """Linear between thresholds; null stays null."""
        s = F.greatest(F.lit(0.0), F.least(F.lit(100.0), score.cast("double")))
        points = F.array(*[F.struct(F.lit(a).alias("x0"), F.lit(b).alias("x1"), F.lit(c).alias("y0"), F.lit(d).alias("y1")) for a, b, c, d in zip(self.xs, self.xs[1:], self.ys, self.ys[1:], strict=False)])
        hit = F.try_element_at(F.filter(points, lambda p: s <= p["x1"]), F.lit(1))
        value = F.when(hit["x1"] == hit["x0"], hit["y0"]).otherwise(hit["y0"] + F.try_divide(s - hit["x0"], hit["x1"] - hit["x0"]) * (hit["y1"] - hit["y0"]))
        return F.when(score.isNotNull(), value)

    def table(self, df: DataFrame, step: int = 10) -> DataFrame:
        return df.sparkSession.range(0, 101, step).select(F.col("id").cast("int").alias("score"), self.column(F.col("id")).alias("calibrated"))

    def monotone(self) -> bool:
        return all(a <= b + 1e-9 for a, b in zip(self.ys, self.ys[1:], strict=False))

    def bounded(self, low: float = 0, high: float = 100) -> bool:
        return all(low <= y <= high for y in self.ys)

    def to_json(self) -> dict:
        return {"x_thresholds": self.xs, "y_values": self.ys, "n_thresholds": len(self.xs)}

    @classmethod
    def from_json(cls, d: dict) -> Calibrator:
        return cls(d["x_thresholds"], d["y_values"])


def pool(y: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Weighted isotonic regression by a stack of pooled blocks."""
    stack: list[list[float]] = []
    for v, n in zip(y, w, strict=True):
        stack.append([v * n, n, 1])
        while len(stack) > 1 and stack[-2][0] / stack[-2][1] > stack[-1][0] / stack[-1][1]:
            s, m, c = stack.pop()
            stack[-1] = [stack[-1][0] + s, stack[-1][1] + m, stack[-1][2] + c]
    return np.concatenate([np.full(int(c), s / n) for s, n, c in stack])


def pool_pairwise(y: np.ndarray) -> np.ndarray:
    """Passes that replace each strictly falling run by its mean; at most 2n passes."""
    y = y.astype(float).copy()
    for _ in range(2 * len(y)):
        falls = np.concatenate([y[:-1] > y[1:], [False]])
        if not falls.any():
            break
        starts = np.flatnonzero(falls & ~np.concatenate([[False], falls[:-1]]))
        for a in starts:
            z = a + 1
            while falls[z]:
                z += 1
            y[a : z + 1] = y[a : z + 1].mean()
    return y
