"""Groups of similar titles by a spanning forest: enough links to join what is similar, never all pairs."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from folio.functions.text import jaccard
from folio.session import scratch_path

#: Titles that share a word of their prefixes are compared pair by pair up to SMALL of them, in blocks of BLOCK beyond.
SMALL, BLOCK, SALTS = 32, 512, 32


def stored(df: DataFrame) -> DataFrame:
    """df written once to the shared folder and read back, so nothing is computed twice."""
    path = scratch_path(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def prefixes(keys: DataFrame, least: float) -> DataFrame:
    """(k, n, p, word): the first n - ceil(least * n) + 1 words of each key (k), rare words first, with their place p.

    Two keys of a similarity of `least` or more share one of these words.
    """
    keys = keys.where("k <> ''").select("k").distinct().withColumn("w", F.array_distinct(F.split("k", " ")))
    words = keys.select("k", F.size("w").alias("n"), F.explode("w").alias("word"))
    ranked = words.join(words.groupBy("word").agg(F.count(F.lit(1)).alias("df")), "word")
    place = F.row_number().over(Window.partitionBy("k").orderBy("df", "word"))
    return ranked.withColumn("p", place).where(F.col("p") <= F.col("n") - F.ceil(F.col("n") * least) + 1).select("k", "n", "p", "word")


def may_be_alike(n: Column, p: Column, m: Column, q: Column, least: float) -> Column:
    """Length filter and positional filter: sets of n and m words whose first common word stands at p and q share 1 + min(n - p, m - q) words at most."""
    most = F.least(n - p, m - q) + 1
    return (n >= least * m) & (m >= least * n) & (most * (1 + least) >= least * (n + m))


def _block_links(members: DataFrame, least: float) -> DataFrame:
    """Edges (ka, kb) inside the crowded words of members (word, k, label, size).

    The titles of a word are cut into blocks, and each pair of blocks is one task of bounded size: a
    product of 0/1 matrices over words says which are similar, and a tree over those of different
    labels comes out, not the pairs. Crowded words are dealt by salt, so none is one task.
    """
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    cut = members.withColumn("blocks", blocks).withColumn("mine", F.pmod(F.xxhash64("k"), F.col("blocks")).cast("int"))
    cut = cut.repartition(F.col("word"), F.pmod(F.xxhash64("k"), F.lit(SALTS))).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    cut = cut.select("word", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), "k", "label")

    def link(pdf: pd.DataFrame) -> pd.DataFrame:
        keys = pdf["k"].tolist()
        label = pd.factorize(pdf["label"])[0].astype(np.int64)
        words = [list(dict.fromkeys(k.split(" "))) for k in keys]
        size = np.array([len(w) for w in words])
        column = pd.factorize(np.array([x for w in words for x in w], object))[0]
        row = np.repeat(np.arange(len(keys)), size)
        both = np.zeros((len(keys), len(keys)), np.float32)
        order = np.argsort(column, kind="stable")
        row, column = row[order], column[order]
        for first in range(0, int(column.max()) + 1, 2048):
            a, z = np.searchsorted(column, [first, first + 2048])
            m = np.zeros((len(keys), 2048), np.float32)
            m[row[a:z], column[a:z] - first] = 1
            both += m @ m.T
        x, y = np.nonzero(both > least * (size[:, None] + size[None, :] - both))
        tree = []
        for a, b in zip(x.tolist(), y.tolist(), strict=True):
            if label[a] != label[b]:
                tree.append((keys[a], keys[b]))
                label[label == label[a]] = label[b]
        return pd.DataFrame(tree, columns=["ka", "kb"])

    return cut.groupBy("word", "i", "j").applyInPandas(link, "ka string, kb string")


def components(edges: DataFrame, a: str, b: str, rounds: int = 50) -> DataFrame:
    """(id, label): smallest id that can be reached, by min-label steps with pointer jumping; each round is written to the shared folder.

    The folder is spark.checkpoint.dir. Where none is set a temporary one serves, but only if
    driver and executors are one process. Labels that are not final after `rounds` are an error.
    """
    e = edges.select(F.col(a).alias("x"), F.col(b).alias("y")).where("x <> y")
    e = stored(e.unionByName(e.select(F.col("y").alias("x"), F.col("x").alias("y"))).distinct())
    label = stored(e.groupBy(F.col("x").alias("id")).agg(F.least(F.min("y"), F.col("x")).alias("label")))
    for _ in range(rounds):
        near = e.join(label, e["y"] == label["id"]).groupBy("x").agg(F.min("label").alias("m"))
        step = label.join(near, label["id"] == near["x"]).select("id", F.least("label", "m").alias("low"), F.col("label").alias("was"))
        jump = label.select(F.col("id").alias("_i"), F.col("label").alias("_l"))
        seen = Observation()
        step = step.join(jump, F.col("low") == F.col("_i"), "left").select("id", F.least("low", F.coalesce("_l", "low")).alias("label"), "was")
        label = stored(step.observe(seen, F.count_if(F.col("label") != F.col("was")).alias("moved")).select("id", "label"))
        if not seen.get["moved"]:
            return label
    raise RuntimeError(f"components are not final after {rounds} rounds")


def linked_keys(keys: DataFrame, least: float = 0.85) -> DataFrame:
    """(ka, kb): pairs of similar keys that join the same groups as all pairs with a Jaccard similarity over `least`.

    Keys that share a word of their prefixes (see `prefixes`) may be similar. First each key is compared
    with the smallest key of each of its words, so a word of m keys makes m pairs; the groups that
    gives are found, and only words that still hold several of them are looked at again, small ones
    pair by pair with a length and a positional filter, crowded ones in blocks. Pairs inside a group are not needed.
    """
    p = stored(prefixes(keys, least))
    words = p.groupBy("word").agg(F.min("k").alias("rep"), F.max("k").alias("top"), F.min_by(F.struct("n", "p"), "k").alias("of")).where("rep < top").select("word", "rep", "of")
    members = stored(p.join(words, "word"))
    star = members.where((F.col("k") != F.col("rep")) & may_be_alike(F.col("n"), F.lit(0), F.col("of.n"), F.lit(0), least)).select(F.col("rep").alias("ka"), F.col("k").alias("kb")).distinct()
    star = stored(star.where(jaccard(F.col("ka"), F.col("kb")) > least))
    label = components(star, "ka", "kb")
    named = members.join(label.withColumnRenamed("id", "k"), "k", "left").select("word", "k", "n", "p", "rep", F.coalesce("label", "k").alias("label"))
    mixed = named.groupBy("word").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.count(F.lit(1)).alias("size")).where("lo < hi AND size > 2").select("word", "size")
    left = stored(named.join(mixed, "word"))
    few = left.where(F.col("size") <= SMALL)
    x, y = few.alias("x"), few.alias("y")
    near = may_be_alike(F.col("x.n"), F.col("x.p"), F.col("y.n"), F.col("y.p"), least)
    pairs = x.join(y, (F.col("x.word") == F.col("y.word")) & (F.col("x.k") < F.col("y.k")) & (F.col("x.label") != F.col("y.label")) & near)
    pairs = pairs.select(F.col("x.k").alias("ka"), F.col("y.k").alias("kb")).distinct().where(jaccard(F.col("ka"), F.col("kb")) > least)
    many = _block_links(left.where(F.col("size") > SMALL).select("word", "k", "label", "size"), least)
    return star.unionByName(pairs).unionByName(many).distinct()
