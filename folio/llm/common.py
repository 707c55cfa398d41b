"""Shared pieces: scratch tables, table reading, prefix sums and connected components."""

from __future__ import annotations

import math
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window


BATCH_ROWS = 2000
MAP_BITS = 25


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of at most BATCH_ROWS rows, unless the session sets its own number.

    At Spark's default of 10 000 rows a batch of texts takes tens of megabytes on both sides of each
    Python worker; the operators work through a batch in chunks anyway, so small ones cost nothing.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key) == "10000":
        spark.conf.set(key, str(BATCH_ROWS))


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder of the cluster, spark.checkpoint.dir.

    Where none is set, a temporary one of our own, but only if driver and executors are one process:
    on a cluster a folder of one machine loses data with it, so there the setting is required.
    """
    conf = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not conf:
        conf = spark.conf.get("folio.scratch", None)
    if not conf:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        conf = "file://" + tempfile.mkdtemp(prefix="folio-scratch-")
        spark.conf.set("folio.scratch", conf)
    return conf


def scratch_folder(spark: SparkSession) -> str:
    """A new, empty folder in the shared one; it goes when the application ends."""
    path = f"{scratch_dir(spark)}/folio-{uuid.uuid4().hex}"
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    store = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    store.mkdirs(where)
    store.deleteOnExit(where)
    return path


def qualified(spark: SparkSession, path: str) -> str:
    """The path as Spark lists it."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(where).toString()


def materialize(df: DataFrame) -> DataFrame:
    """Write df once as Parquet in the shared folder and read it back.

    Cuts the lineage so that a lost executor never recomputes it; the files go when the application ends.
    """
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/folio-{uuid.uuid4().hex}"
    df.write.parquet(path)
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(where)
    return spark.read.schema(df.schema).parquet(path)


def marked(df: DataFrame, key: Column, keys: DataFrame) -> DataFrame:
    """df with _marked: false only if `key` is none of `keys` (their only column), without a shuffle of df.

    The keys go into a bitmap of 2**MAP_BITS places, made by Spark and broadcast: at most 2**(MAP_BITS - 6)
    rows of 16 bytes however many keys there are. Some other rows are marked too; joins drop them.
    """
    place = lambda c: F.pmod(F.xxhash64(F.lit("mark"), c), F.lit(1 << MAP_BITS))
    p = keys.select(place(F.col(keys.columns[0])).alias("_p"))
    words = p.groupBy(F.shiftright("_p", 6).alias("_word")).agg(F.bit_or(F.expr("shiftleft(1L, int(_p & 63))")).alias("_bits"))
    found = df.withColumn("_p", place(key)).join(F.broadcast(words), F.shiftright("_p", 6) == F.col("_word"), "left")
    return found.withColumn("_marked", F.coalesce(F.expr("_bits & shiftleft(1L, int(_p & 63))") != 0, F.lit(False))).drop("_p", "_word", "_bits")


def valid_id(col: str) -> Column:
    return F.col(col).cast("long")


def crc_mod(col: Column, n: int) -> Column:
    """crc32 of the id written as text, modulo n."""
    return F.crc32(col.cast("string").cast("binary")) % n


def bounded_fraction(rows: int, bound: int) -> float:
    return 1.0 if rows <= bound else bound / rows


def hash_share(col: Column, salt: str) -> Column:
    """A fixed pseudo-random number in [0, 1) for each value."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(salt), col), 11) / F.lit(float(1 << 53))


def bucketed_running_sum(df: DataFrame, group: str, order: list[Column], share: Column, value: str, rows: int, per_bucket: int = 1024, fan: int = 4096) -> DataFrame:
    """Adds `run_before`, the sum of `value` over the rows that come earlier in the group.

    `share` is a number in [0, 1) that agrees with the order of `order`; being a hash, it spreads the rows
    of a group evenly. All groups are cut into the same rows / per_bucket ranges of it; the sums of `fan`
    neighbouring ranges are accumulated first, then the ranges in them, then each range on its own, so no
    task holds a whole group. Rows are dealt by group and range together.
    """
    cut = df.withColumn("_bucket", F.floor(share * max(1, math.ceil(rows / per_bucket))).cast("long"))
    sums = cut.groupBy(group, "_bucket").agg(F.sum(value).alias("_sum")).withColumn("_part", F.floor(F.col("_bucket") / fan).cast("long"))
    outer = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = sums.groupBy(group, "_part").agg(F.sum("_sum").alias("_all")).select(F.col(group).alias("_h"), F.col("_part").alias("_q"), F.coalesce(F.sum("_all").over(outer), F.lit(0)).alias("_first"))
    inner = Window.partitionBy(group, "_part").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("_rest", F.coalesce(F.sum("_sum").over(inner), F.lit(0))).join(parts, (F.col(group) == F.col("_h")) & (F.col("_part") == F.col("_q")))
    bases = sums.select(F.col(group).alias("_g"), F.col("_bucket").alias("_b"), (F.col("_first") + F.col("_rest")).alias("_base"))
    inner = Window.partitionBy(group, "_bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    inside = cut.withColumn("_in", F.coalesce(F.sum(value).over(inner), F.lit(0)))
    joined = inside.join(bases, (F.col(group) == F.col("_g")) & (F.col("_bucket") == F.col("_b")))
    return joined.withColumn("run_before", F.col("_base") + F.col("_in")).drop("_g", "_b", "_bucket", "_in", "_base")


def dealt_in_blocks(members: DataFrame, key: str, item: str, block: int, salts: int = 32, weight: str | None = None, heavy: int = 0) -> DataFrame:
    """members with mine (block of the item) and, a row each, i <= j: the pairs of blocks of its group that it belongs to.

    A group of m items has ceil(m / block) blocks; with a `weight` it has more, so that a block weighs about
    `heavy` at most where its items allow. Only groups of several blocks are named, once for each
    salt; rows meet them by group and salt together, so a crowded group is many tasks.
    """
    blocks = F.ceil(F.count(F.lit(1)) / block)
    if weight:
        blocks = F.least(F.count(F.lit(1)), F.greatest(blocks, F.ceil(F.sum(weight) / heavy)))
    sizes = members.groupBy(F.col(key).alias("_k")).agg(blocks.cast("int").alias("_blocks")).where("_blocks > 1")
    sizes = sizes.withColumn("_s", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    salted = members.withColumn("_salt", F.pmod(F.xxhash64(F.lit("salt"), item), F.lit(salts)).cast("int"))
    cut = salted.join(sizes, (F.col(key) == F.col("_k")) & (F.col("_salt") == F.col("_s")), "left").withColumn("_blocks", F.coalesce("_blocks", F.lit(1))).drop("_k", "_s", "_salt")
    cut = cut.withColumn("mine", F.pmod(F.xxhash64(item), F.col("_blocks")).cast("int")).withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
    return cut.withColumns({"i": F.least("mine", "_other"), "j": F.greatest("mine", "_other")}).drop("_other", "_blocks")


def are_stars(e: DataFrame) -> bool:
    """Does each end u of edges (u, v) have one edge, to a v that has none of its own? Then every component is a star and v its label."""
    out, into = e.select(F.col("u").alias("x"), F.lit(1).alias("o"), F.lit(0).alias("i")), e.select(F.col("v").alias("x"), F.lit(0).alias("o"), F.lit(1).alias("i"))
    ends = out.unionByName(into).groupBy("x").agg(F.sum("o").alias("o"), F.max("i").alias("i"))
    return ends.where("o > 1 OR (o > 0 AND i > 0)").isEmpty()


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(id, label) for each end of an edge (a, b); label is the smallest id that can be reached.

    Alternates large-star and small-star steps, which keep the number of edges linear and end in
    O(log^2) rounds; each round is a few shuffles, and its edges are written to the shared folder. It
    ends as soon as all components are stars. Components that are not final after max_rounds are an
    error, never a partial result.
    """
    e = materialize(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    for _ in range(max_rounds):
        if are_stars(e):
            break
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        large = large.unionByName(low.where("m < u").select("u", F.col("m").alias("v"))).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        e = materialize(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct())
    else:
        if not are_stars(e):
            raise RuntimeError(f"components are not final after {max_rounds} rounds")
    roots = e.select(F.col("v").alias("id"), F.col("v").alias("label")).distinct()
    return e.select(F.col("u").alias("id"), F.col("v").alias("label")).unionByName(roots)
