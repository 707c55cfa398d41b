"""A keyed table in buckets: a merge reads and rewrites only the parts that its rows fall into."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from folio.operators.change import upsert


class BucketedTable:
    """A Parquet table `name` at `path`, partitioned by a hash of its keys and bucketed by the keys inside each partition.

    Partitions are what a merge may leave alone: those that none of its rows fall into keep their
    files. Buckets are what spares the table a shuffle: it is read in the partitioning of its keys, so
    in a merge only the new rows move. Keys are unique; one with a null is equal to none.
    """

    def __init__(self, spark: SparkSession, name: str, path: str, keys: list[str], parts: int = 64, buckets: int = 8):
        self.spark, self.name, self.path, self.keys, self.parts, self.buckets = spark, name, path, keys, parts, buckets

    def part(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.parts)).cast("int")

    def create(self, df: DataFrame) -> BucketedTable:
        placed = df.withColumn("_part", self.part()).repartition(self.buckets, *self.keys)
        placed.write.mode("overwrite").option("path", self.path).partitionBy("_part").bucketBy(self.buckets, *self.keys).sortBy(*self.keys).format("parquet").saveAsTable(self.name)
        return self

    def read(self) -> DataFrame:
        return self.spark.table(self.name).drop("_part")

    def touched(self, new: DataFrame) -> list[int]:
        """Partitions that rows of new fall into; no more numbers than the table has partitions."""
        return sorted(r[0] for r in new.select(self.part().alias("p")).distinct().collect())

    def merged(self, new: DataFrame, parts: list[int], policy=None, default: str = "keep") -> DataFrame:
        """The rows of these partitions with new merged in, see `upsert`."""
        old = self.spark.table(self.name).where(F.col("_part").isin(parts)).drop("_part")
        return upsert(old, new.repartition(self.buckets, *self.keys), self.keys, policy, default)

    def merge(self, new: DataFrame, policy=None, default: str = "keep") -> dict[str, int]:
        """Merges new into the table; counts of inserted, updated and untouched rows of the partitions it rewrites, made as they are written.

        Spark puts the new files of the touched partitions in place of the old ones when all are written.
        """
        parts = self.touched(new)
        if not parts:
            return {"inserted": 0, "updated": 0, "untouched": 0}
        columns = self.spark.table(self.name).columns
        kind, seen = F.col("merge_kind"), Observation()
        rows = self.merged(new, parts, policy, default).observe(seen, *[F.count_if(kind == k).alias(k) for k in ("inserted", "updated", "untouched")])
        rows = rows.withColumn("_part", self.part()).select(*columns)
        before = self.spark.conf.get("spark.sql.sources.partitionOverwriteMode")
        self.spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
        try:
            rows.write.mode("overwrite").insertInto(self.name)
        finally:
            self.spark.conf.set("spark.sql.sources.partitionOverwriteMode", before)
        self.spark.catalog.refreshTable(self.name)
        return dict(seen.get)

    def drop(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")
