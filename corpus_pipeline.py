"""The corpus pipeline: each stage takes what its predecessor kept and its decisions take effect.

1 quality classifier, 2 MinHash near-dedup, 3 secret scans, 4 mixing to target weights, 5 packing.
All stages but the last return the columns of documents, whatever other columns come in; an empty
table passes through all of them. Each stage reads whole texts, a task one at a time where they are
long: features, shingles and tokens of a text of any length are made in the task that holds its row. A document that the mix takes twice is two
rows with one doc_id from stage 4 on.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.llm import op02_packing, op04_quality, op05_mixing, op06_minhash, op08_secrets
from folio.llm.common import materialize, small_batches, table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go; learnt from labels, scored on whole texts.

    Each row is judged on its own: a null text as an empty one, rows that repeat an id or have none like any other.
    A very long text is scored from counts made in windows.
    """
    model = op04_quality.train(docs, op04_quality.learnable(table(spark, sf_dir, "labels")))
    return op04_quality.keep_good(docs, model).select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies stays, the one with the smallest doc_id (null last); of equal rows one.

    A text that shares its id with a copy stays; rows without words stay. A very long text is hashed in
    windows, and its set weighs in how crowded groups are cut.
    """
    return op06_minhash.without_near_duplicates(docs.select(*COLUMNS)).select(*COLUMNS)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by their kinds; n_chars follows the text. No row goes; null and empty texts stay as they are, a very long one is scanned whole."""
    clean = op08_secrets.redact(docs.select(*COLUMNS))
    return clean.withColumn("n_chars", F.when(F.col("text").isNotNull(), F.length("text")).cast("long")).select(*COLUMNS)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: not at all, once or twice.

    A very long text is a document like others: it is taken whole or not, and none exceeds 2 times its size.
    Rows equal in id and text are taken one by one; documents without words follow their neighbours in the shuffled order.
    """
    m = op05_mixing.mixed_documents(docs.select(*COLUMNS)).where(F.col("_copies") > 0)
    return m.withColumn("_n", F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int")))).select(*COLUMNS)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixed documents in sequences of 1024 tokens; each row is packed as a document of its own, a null text as an empty one; a very long one is cut into pieces of 1024."""
    return op02_packing.pack_documents(docs).withColumnRenamed("id", "doc_id")


def _stage(f):
    """A stage in a session with small Arrow batches."""

    @wraps(f)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        small_batches(spark)
        return f(spark, docs, sf_dir)

    return run_stage


STAGES = [(f.__name__, _stage(f)) for f in (quality, near_dedup, secrets, mixing, packing)]

#: Tokenising and the trained classifier are not expressible in SQL; tests/llm holds each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialize(docs)
    return docs
