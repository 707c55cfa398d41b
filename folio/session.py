"""Session factory with the settings the library is written for."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def session(master: str | None = None, shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution; on a cluster leave master and shuffle_partitions to the submitter."""
    b = SparkSession.builder.appName("folio").config("spark.sql.adaptive.enabled", "true").config("spark.sql.adaptive.skewJoin.enabled", "true")
    b = b.config("spark.sql.session.timeZone", "UTC").config("spark.sql.execution.arrow.pyspark.enabled", "true")
    if master:
        b = b.master(master).config("spark.ui.enabled", "false")
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in conf.items():
        b = b.config(k.replace("__", "."), v)
    return b.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder for checkpoints and scratch files that all executors share; set as checkpoint directory if none is.

    It is spark.checkpoint.dir; where that is unset, a temporary one of our own on a local master, else an error.
    """
    if not spark.sparkContext.getCheckpointDir():
        conf = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
        if not conf:
            if not spark.sparkContext.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            conf = "file://" + tempfile.mkdtemp(prefix="folio-")
        spark.sparkContext.setCheckpointDir(conf)
    return spark.sparkContext.getCheckpointDir()


def scratch_path(spark: SparkSession) -> str:
    """A new path in the shared folder; it goes when the application ends."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{shared_folder(spark)}/folio-{uuid.uuid4().hex}")
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(where)
    return where.toString()
