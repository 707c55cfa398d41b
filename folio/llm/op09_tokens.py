"""Token counts of flat unindexed token files by a separator scan."""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from folio.llm.common import materialize, qualified, scratch_folder, table
from folio.llm.op02_packing import encoder, vocabulary

SEPARATOR = 50256
BLOCK = 1 << 16
WIDTH = "<u2"
SUPER = 1024
#: Blocks that one task reads of a file: 64 MB of two-byte ids.
RANGE = 512
BLOCKS = "file long, block long, data binary, ids array<long>"


def token_blocks(docs: DataFrame, id_col: str, text_col: str, separator: int = SEPARATOR, block: int = BLOCK, path: str | None = None) -> DataFrame:
    """Token files in blocks of `block` ids: each partition is one file, its texts one after another, each closed by the separator.

    ids lists the documents that end in a block, for reports only; the scan does not look at it.
    """
    path = path or vocabulary()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        enc, file = encoder(path), TaskContext.get().partitionId()
        held: list[np.ndarray] = []
        size, number, ends = 0, 0, []

        def flush(all_of_it: bool):
            nonlocal held, size, number, ends
            t = np.concatenate(held) if held else np.zeros(0, WIDTH)
            while len(t) >= block or (all_of_it and len(t)):
                part, t = t[:block], t[block:]
                n = int((part == separator).sum())
                yield pa.RecordBatch.from_arrays([pa.array([file], pa.int64()), pa.array([number], pa.int64()), pa.array([part.tobytes()], pa.binary()), pa.array([ends[:n]], pa.list_(pa.int64()))], names=["file", "block", "data", "ids"])
                ends, number = ends[n:], number + 1
            held, size = [t], len(t)

        for batch in batches:
            for doc, value in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                held.append(np.array([*enc.encode_ordinary(value.as_py() or ""), separator], WIDTH))
                ends.append(doc)
                size += len(held[-1])
                if size >= block:
                    yield from flush(False)
        yield from flush(True)

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(write, BLOCKS)


def write_token_files(docs: DataFrame, id_col: str, text_col: str, folder: str, separator: int = SEPARATOR, path: str | None = None) -> DataFrame:
    """Writes flat token files to a folder, one a partition whose number its name begins with; (name, ordinal, id) says which document stands where, for reports only.

    An attempt of a task writes a file of its own name, and the rows of the attempt that counts name
    it, so files of failed attempts are known by no row. An empty partition writes no file.
    """
    path = path or vocabulary()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        enc, name, ordinal = encoder(path), f"{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}.bin", 0
        store, at = opened(folder)
        with contextlib.ExitStack() as stack:
            out = None
            for batch in batches:
                if out is None and batch.num_rows:
                    out = stack.enter_context(store.open_output_stream(f"{at}/{name}"))
                for value in batch.column(1):
                    out.write(np.array([*enc.encode_ordinary(value.as_py() or ""), separator], WIDTH).tobytes())
                n = batch.num_rows
                yield pa.RecordBatch.from_arrays([pa.array([name] * n, pa.string()), pa.array(np.arange(ordinal, ordinal + n)), batch.column(0)], names=["name", "ordinal", "id"])
                ordinal += n

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(write, "name string, ordinal long, id long")


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """(file system, path in it) of a path as Spark writes it."""
    scheme = path.split(":", 1)[0] if ":" in path.split("/", 1)[0] else "file"
    if scheme == "file":
        return fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(path)


def read_token_files(spark: SparkSession, path: str, block: int = BLOCK, width: str = WIDTH, names: DataFrame | None = None) -> DataFrame:
    """Blocks of flat binary files of token ids; with names (column name) only of files of these names.

    Spark lists the files with their lengths and opens none of them. Each is cut into ranges of
    RANGE blocks, the ranges are dealt evenly, and a task seeks its range and reads it block by
    block, so a file of any size is many tasks and no task holds more than a block. Tasks open local
    and shared folders and the stores that pyarrow knows (hdfs, s3, gs, abfs).
    """
    size = block * np.dtype(width).itemsize

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, name, first, blocks in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                store, at = opened(name)
                with store.open_input_file(at) as f:
                    f.seek(first * size)
                    for k in range(first, first + blocks):
                        yield pa.RecordBatch.from_arrays([pa.array([file], pa.int64()), pa.array([k], pa.int64()), pa.array([f.read(size)], pa.binary()), pa.array([None], pa.list_(pa.int64()))], names=["file", "block", "data", "ids"])

    files = spark.read.format("binaryFile").load(path).select("path", "length").where("length > 0")
    if names is not None:
        files = files.join(names.select(F.col("name").alias("_n")).distinct(), F.element_at(F.split("path", "/"), -1) == F.col("_n"), "left_semi")
    total = F.ceil(F.col("length") / size)
    pieces = files.withColumn("total", total).withColumn("first", F.explode(F.sequence(F.lit(0).cast("long"), F.col("total") - 1, F.lit(RANGE).cast("long"))))
    pieces = pieces.select(F.xxhash64("path").alias("file"), "path", "first", F.least(F.lit(RANGE), F.col("total") - F.col("first")).alias("blocks"))
    return pieces.repartition(max(1, pieces.count())).mapInArrow(cut, BLOCKS)


def scan(blocks: DataFrame, separator: int = SEPARATOR, width: str = WIDTH) -> DataFrame:
    """(file, block, n, seps, ids): the number of ids of each block and the places of its separators."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, seps = [], []
            for value in batch.column(2):
                t = np.frombuffer(value.as_py(), width)
                n.append(len(t))
                seps.append(np.flatnonzero(t == separator).astype(np.int32))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n, pa.int64()), pa.array([x.tolist() for x in seps], pa.list_(pa.int32())), batch.column(3)], names=["file", "block", "n", "seps", "ids"])

    return blocks.mapInArrow(run, "file long, block long, n long, seps array<int>, ids array<long>")


def stitched(scanned: DataFrame, part: int = SUPER) -> DataFrame:
    """scanned with base (ids before the block), docs_before and prev_end (place of the last separator before it, or -1).

    A prefix scan in two levels: `part` neighbouring blocks are summed up, those sums are scanned for
    each file, then the blocks of each part on their own; no task holds all blocks of a large file.
    """
    b = scanned.withColumn("part", F.floor(F.col("block") / part).cast("long")).withColumn("k", F.size("seps").cast("long")).withColumn("last", F.when(F.col("k") > 0, F.element_at("seps", -1).cast("long")))
    inner = Window.partitionBy("file", "part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    b = b.withColumn("in_base", F.coalesce(F.sum("n").over(inner), F.lit(0))).withColumn("in_docs", F.coalesce(F.sum("k").over(inner), F.lit(0)))
    b = b.withColumn("in_prev", F.max(F.col("in_base") + F.col("last")).over(inner))
    sums = b.groupBy("file", "part").agg(F.sum("n").alias("pn"), F.sum("k").alias("pk"), F.max(F.col("in_base") + F.col("last")).alias("pl"))
    outer = Window.partitionBy("file").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("ob", F.coalesce(F.sum("pn").over(outer), F.lit(0))).withColumn("od", F.coalesce(F.sum("pk").over(outer), F.lit(0)))
    sums = sums.withColumn("op", F.max(F.col("ob") + F.col("pl")).over(outer)).select(F.col("file").alias("_f"), F.col("part").alias("_p"), "ob", "od", "op")
    j = b.join(sums, (F.col("file") == F.col("_f")) & (F.col("part") == F.col("_p")))
    prev = F.coalesce(F.col("ob") + F.col("in_prev"), F.col("op"), F.lit(-1))
    return j.select("file", "block", "n", "seps", "ids", (F.col("ob") + F.col("in_base")).alias("base"), (F.col("od") + F.col("in_docs")).alias("docs_before"), prev.cast("long").alias("prev_end"))


def token_counts(blocks: DataFrame, separator: int = SEPARATOR, width: str = WIDTH) -> DataFrame:
    """file, ordinal, id, start, n_tokens, closed: one row a document of the token files.

    Separators are searched in whole blocks at once; a document that crosses blocks gets its length
    from the prefix scan. Its separator is not counted. Ids after the last separator of a file are a
    document that is not closed. Two separators in a row hold a document of no tokens. An empty file
    or table gives no rows; id is null where a block names none. Documents of any length are counted, as
    no task holds more than a block of ids.
    """
    s = stitched(materialize(scan(blocks, separator, width)))
    ends = s.where(F.size("seps") > 0).select("file", "base", "docs_before", "prev_end", "seps", "ids", F.posexplode("seps").alias("p", "sep"))
    before = F.when(F.col("p") > 0, F.col("base") + F.expr("try_element_at(seps, p)")).otherwise(F.col("prev_end"))
    closed = ends.select("file", (F.col("docs_before") + F.col("p")).alias("ordinal"), F.expr("try_element_at(ids, p + 1)").alias("id"), (before + 1).alias("start"), (F.col("base") + F.col("sep") - before - 1).alias("n_tokens"), F.lit(True).alias("closed"))
    tail = s.groupBy("file").agg(F.max(F.col("base") + F.col("n")).alias("size"), F.max(F.col("docs_before") + F.size("seps")).alias("ordinal"), F.max(F.greatest(F.col("prev_end"), F.when(F.size("seps") > 0, F.col("base") + F.element_at("seps", -1)))).alias("last"))
    open_ = tail.where("size > last + 1").select("file", "ordinal", F.lit(None).cast("long").alias("id"), (F.col("last") + 1).alias("start"), (F.col("size") - F.col("last") - 1).alias("n_tokens"), F.lit(False).alias("closed"))
    return closed.unionByName(open_)


def op9_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, null texts as empty ones, written as token files of one partition each; then counted from the files alone.

    The ids of the documents are joined to the counts by file and ordinal afterwards. Ids may be null or
    repeat and equal rows stand twice: each row is a document of its own in the files. A text is
    tokenised whole, one at a time. An empty table gives an empty result.
    """
    folder = scratch_folder(spark)
    index = materialize(write_token_files(table(spark, sf_dir, "documents"), "doc_id", "text", folder))
    if index.isEmpty():
        blocks = spark.createDataFrame([], BLOCKS)
    else:
        blocks = read_token_files(spark, folder, names=index)
    counts = token_counts(blocks).drop("id")
    paths = F.xxhash64(F.concat(F.lit(qualified(spark, folder) + "/"), F.col("name")))
    named = index.select(paths.alias("_file"), F.substring_index("name", "-", 1).cast("long").alias("number"), F.col("ordinal").alias("_ordinal"), F.col("id").alias("doc_id"))
    joined = counts.join(named, (F.col("file") == F.col("_file")) & (F.col("ordinal") == F.col("_ordinal")), "left")
    return joined.select(F.col("number").alias("file"), "ordinal", "doc_id", "start", "n_tokens", "closed")
