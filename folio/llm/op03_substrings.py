"""Repeated passages by content-defined chunking with a gear rolling hash."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from folio.llm import kernels
from folio.llm.common import materialize, table
from folio.llm.kernels import IS_SEP, span_hashes, text_chunks

REACH = 20
GUARD = 12
MIN_WORDS = 20
MARGIN = 64
NEVER = np.uint32(2**32 - 1)
GEAR = np.random.default_rng(611953).integers(0, 2**32, 256, dtype=np.uint32)


def boundaries(b: np.ndarray, off: np.ndarray) -> np.ndarray:
    """True where a chunk begins: at the first byte of each text and where the content says so.

    A place is a boundary if no place up to REACH bytes before or after it has a smaller gear hash of
    the 16 bytes before it (each step shifts left by two bits in 32); places inside a character do not
    count. So there is one in 2 * REACH + 1 places, long stretches without one are as good as
    impossible, and text of any period has one at least in each period, where its smallest hash
    stands. Equal hashes less than GUARD bytes apart are such a period; its boundaries are taken in
    steps of at least GUARD bytes, and as all of them begin the same words, the chunks are equal
    wherever the steps start. Besides that no more than 36 bytes before a place and 20 after it are
    looked at, so an insertion moves no boundary but those beside it. Hashes and minima of windows
    are built by doubling.
    """
    n = len(b)
    cut = np.zeros(n, bool)
    if n:
        h = GEAR[b]
        for k in (1, 2, 4, 8):
            w = h.copy()
            w[k:] += h[:-k] << np.uint32(2 * k)
            h = w
        # key[REACH + i] is the hash before place i; the first bytes of a text see bytes of the text before it
        key = np.full(n + 2 * REACH, NEVER)
        key[REACH + 1 : REACH + n] = h[:-1]
        key[REACH : REACH + n][(b & 0xC0) == 0x80] = NEVER
        for k in range(REACH):
            p = off[:-1] + k
            key[REACH + p[p < off[1:]]] = NEVER
        low = key
        for k in (1, 2, 4, 8, 16):
            low = np.minimum(low[k:], low[:-k])  # of 2 * k places from here on
        low = np.minimum(low[:n], low[2 * REACH - 31 : 2 * REACH - 31 + n])
        key = key[REACH : REACH + n]
        at = np.flatnonzero((key == low) & (key != NEVER))
        step = np.diff(at, prepend=-n)
        near = step < GUARD
        # runs of boundaries at one short distance: every m-th of them stays, counted from the first
        first = ~(near & np.concatenate([[False], (step[1:] == step[:-1]) | ~near[:-1]]))
        head = np.maximum.accumulate(np.where(first, np.arange(len(at)), 0))
        apart = step[np.minimum(head + 1, len(at) - 1)] if len(at) else step
        m = np.where(near, -(-GUARD // np.maximum(apart, 1)), 1)
        cut[at[(np.arange(len(at)) - head) % m == 0]] = True
        cut[off[:-1][off[:-1] < off[1:]]] = True
    return cut


def chunk_table(column: pa.Array) -> Iterator[tuple[np.ndarray, ...]]:
    """Arrays (row, ordinal, start, end, words, digest) of the chunks of texts; starts and ends in code points."""
    for i, _, b, off in text_chunks(column):
        if len(off) == 2 and len(b) > kernels.WINDOW:
            yield from long_chunks(i, b)
            continue
        s = np.flatnonzero(boundaries(b, off))
        if not len(s):
            continue
        e = np.append(s[1:], len(b))
        row = np.searchsorted(off, s, "right") - 1
        first = np.searchsorted(s, off[row])
        chars = np.concatenate([[0], np.cumsum((b & 0xC0) != 0x80)])
        body = ~IS_SEP[b]
        begins = body.copy()
        begins[1:] &= ~body[:-1]
        words = np.concatenate([[0], np.cumsum(begins)])
        yield i + row, np.arange(len(s)) - first, chars[s] - chars[off[row]], chars[e] - chars[off[row]], words[e] - words[s], span_hashes(b, s, e)


def long_chunks(row: int, b: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """The chunks of one long text, window by window. A window begins at a boundary and sees MARGIN bytes on either side, more than any boundary looks at."""
    i, k, chars = 0, 0, 0
    while i < len(b):
        lo, hi, z = max(0, i - MARGIN), min(len(b), i + kernels.WINDOW + MARGIN), min(len(b), i + kernels.WINDOW)
        s = np.flatnonzero(boundaries(b[lo:hi], np.array([0, hi - lo]))) + lo
        inside = s[(s > i) & (s <= z)]
        if z < len(b) and len(inside):
            z = int(inside[-1])
        s = np.concatenate([[i], s[(s > i) & (s < z)]]) - i
        part = b[i:z]
        e = np.append(s[1:], len(part))
        at = np.concatenate([[0], np.cumsum((part & 0xC0) != 0x80)])
        body = ~IS_SEP[part]
        begins = body.copy()
        begins[1:] &= ~body[:-1]
        begins[0] &= i == 0 or bool(IS_SEP[b[i - 1]])
        words = np.concatenate([[0], np.cumsum(begins)])
        yield np.full(len(s), row), k + np.arange(len(s)), chars + at[s], chars + at[e], words[e] - words[s], span_hashes(part, s, e)
        i, k, chars = z, k + len(s), chars + int(at[-1])


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """id, text_key, start, end, words, chunks, first_id, copy: one row a repeated passage of a text; text_key is a hash of the text.

    A chunk repeats if its digest occurs in two documents or more. Neighbouring repeated chunks make a
    passage; passages of `min_words` words or more are returned. A chunk is some six words on average
    and the two at the rim of a passage are lost, so passages of more than 50 words are found, those of
    repeated words or lines too, and short common lines are not. first_id is the smallest id that holds a chunk of it; copy says that the
    document is another one. Digests have 64 bits and the length; one false match alone makes no passage.

    Digests are counted with their smallest and largest id, combined in the tasks before the shuffle,
    so a chunk that all documents share is one row a task. The chunks then meet the repeated digests
    in a join that Spark may split where it is skewed.

    Null and empty texts have no chunks. A null id is left out; rows that repeat an id are one
    document, so equal rows repeat nothing and other texts of an id do not repeat each other, but each text has
    passages of its own; a passage that stands twice in one document only is none.
    Texts of any length are cut whole, long ones in windows; an empty table gives an empty result. Only the two named columns are read.
    """
    d = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("text_key"), F.col(text_col).alias("text")).where("id IS NOT NULL")

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy()
            for row, *_, h in chunk_table(batch.column(2)):
                of = ids[row]
                s = np.lexsort((of, h))
                h, of = h[s], of[s]
                first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
                last = np.append(first[1:], len(h)) - 1
                yield pa.RecordBatch.from_arrays([pa.array(h[first].view(np.int64)), pa.array(of[first]), pa.array(of[last])], names=["digest", "lo", "hi"])

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, keys = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for row, k, s, e, n, h in chunk_table(batch.column(2)):
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(ids[row]), pa.array(keys[row]), *[pa.array(x.astype(np.int32)) for x in (k, s, e, n)]], names=["digest", "id", "text_key", "k", "start", "end", "words"])

    shared = materialize(d.mapInArrow(digests, "digest long, lo long, hi long").groupBy("digest").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).where("lo < hi").select("digest", "lo"))
    found = d.mapInArrow(chunks, "digest long, id long, text_key long, k int, start int, end int, words int").join(shared, "digest").dropDuplicates(["id", "text_key", "k"])
    found = materialize(found.select("id", "text_key", "k", "start", "end", "words", "lo"))
    run = F.col("k") - F.row_number().over(Window.partitionBy("id", "text_key").orderBy("k"))
    spans = found.withColumn("run", run).groupBy("id", "text_key", "run").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.sum("words").alias("words"), F.count(F.lit(1)).alias("chunks"), F.min("lo").alias("first_id"))
    return spans.where(F.col("words") >= min_words).select("id", "text_key", "start", "end", "words", "chunks", "first_id", (F.col("first_id") < F.col("id")).alias("copy"))


def without_copies(docs: DataFrame, spans: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with the passages marked copy cut out of text_col; the first document keeps its own.

    A null text stays null; rows without spans, and rows without an id, stay as they are; each text of an
    id that rows repeat is cut at its own places. An empty table gives an empty result; other columns
    pass through.
    """

    @F.pandas_udf("string")
    def cut(texts, cuts):
        import pandas as pd

        def one(text, spans):
            if text is None or spans is None:
                return text
            out, at = [], 0
            for s in sorted((x["start"], x["end"]) for x in spans):
                out.append(text[at : s[0]])
                at = max(at, s[1])
            return "".join(out) + text[at:]

        return pd.Series([one(t, c) for t, c in zip(texts, cuts, strict=True)])

    by = spans.where("copy").groupBy(F.col("id").alias("_cut_id"), F.col("text_key").alias("_cut_key")).agg(F.collect_list(F.struct("start", "end")).alias("_cuts"))  # no more than a document has
    both = docs.join(by, (F.col(id_col) == F.col("_cut_id")) & (F.xxhash64(text_col) == F.col("_cut_key")), "left")
    return both.withColumn(text_col, cut(F.col(text_col), F.col("_cuts"))).drop("_cut_id", "_cut_key", "_cuts")


def op3_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")
