"""Alignment of the tokens of two tokenizers by a string of end labels, one a byte."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.llm.common import materialize, table
from folio.llm.kernels import list_array
from folio.llm.op02_packing import encoder, vocabulary

#: Labels of a byte: no token ends there, one of A, one of B, both.
NONE, A_END, B_END, BOTH = b"0123"
SPAN = re.compile(rb"[^3]*3")
#: Bytes of text whose pairs are told apart and looked up together.
BLOCK_BYTES = 8 << 20
_models: dict = {}


def pieces_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class Pieces:
    """The bytes and the decimals of each id of one tokenizer; decimals end with a comma, those of the last token of a group with `end`, and are numbers of eight bytes, padded with zeros."""

    def __init__(self, pieces: list[bytes], end: str):
        self.pieces = np.array(pieces, object)
        self.sizes = np.array([len(p) for p in pieces], np.int64)
        self.inner, self.last = (np.array([f"{k}{x}".encode() for k in range(len(pieces))], "S8").view(np.uint64) for x in (",", end))


class Pair:
    """Tokenizers A (byte-level ranks) and B (sentence pieces), from their files."""

    def __init__(self, a_path: str, b_path: str):
        import sentencepiece

        self.a = encoder(a_path)
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        self.of_a = Pieces([self.a.decode_single_token_bytes(k) if self._has(k) else b"" for k in range(self.a.n_vocab)], "|")
        self.of_b = Pieces([bytes([int(p[3:5], 16)]) if self.b.is_byte(k) else p.replace("▁", " ").encode() for k, p in enumerate(map(self.b.id_to_piece, range(self.b.get_piece_size())))], ";")

    def _has(self, k: int) -> bool:
        try:
            self.a.decode_single_token_bytes(k)
        except KeyError:
            return False
        return True

    def tokens(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of A and of B, whose joined bytes are those of a space and the text; empty if they are not."""
        none = np.zeros(0, np.int64), np.zeros(0, np.int64)
        if not text:
            return none
        a, b = np.array(self.a.encode_ordinary(f" {text}"), np.int64), np.array(self.b.encode(text), np.int64)
        whole = f" {text}".encode()
        if b"".join(self.of_a.pieces[a].tolist()) != whole or b"".join(self.of_b.pieces[b].tolist()) != whole:
            return none
        return a, b


def pair(a_path: str, b_path: str) -> Pair:
    if (a_path, b_path) not in _models:
        _models[a_path, b_path] = Pair(a_path, b_path)
    return _models[a_path, b_path]


def spans(size_a: np.ndarray, size_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each group its end in bytes and the number of tokens of A and of B up to there.

    Each byte has a label; a span runs up to the next byte where tokens of both end, and the labels in it say how many of each it holds.
    """
    end_a, end_b = np.cumsum(size_a), np.cumsum(size_b)
    labels = np.full(int(end_a[-1]) if len(end_a) else 0, NONE, np.uint8)
    labels[end_a - 1] += A_END - NONE
    labels[end_b - 1] += B_END - NONE
    ends = np.cumsum(np.fromiter(map(len, SPAN.findall(labels.tobytes())), np.int64))
    return ends, *(np.flatnonzero(labels[e - 1] == BOTH) + 1 for e in (end_a, end_b))


def written(p: Pair, a: np.ndarray, b: np.ndarray, upto_a: np.ndarray, upto_b: np.ndarray) -> bytes:
    """`a1,a2|b1;a3|b2,b3`: the ids of each group."""
    if not len(upto_a):
        return b""
    out = np.empty(len(a) + len(b), np.uint64)
    at_a = np.arange(len(a)) + np.repeat(np.concatenate([[0], upto_b[:-1]]), np.diff(upto_a, prepend=0))
    at_b = np.arange(len(b)) + np.repeat(upto_a, np.diff(upto_b, prepend=0))
    out[at_a], out[at_b] = p.of_a.inner[a], p.of_b.inner[b]
    out[at_a[upto_a - 1]], out[at_b[upto_b - 1]] = p.of_a.last[a[upto_a - 1]], p.of_b.last[b[upto_b - 1]]
    flat = out.view(np.uint8)
    return flat[flat != 0].tobytes()[:-1]


GROUPS = "id long, grp int, start long, end long, a_ids array<int>, b_ids array<int>"


def token_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", a_path: str | None = None, b_path: str | None = None) -> DataFrame:
    """One row a group of a document: the bytes [start, end) of a space and the text, the ids of A and of B in them.

    Between two ends that A and B share stands no other such end, so groups are the smallest parts that both spell
    with whole tokens. Documents without tokens (see `aligned`) have no rows.
    """
    a_path, b_path = a_path or vocabulary(), b_path or pieces_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = pair(a_path, b_path)
        for batch in batches:
            for k in range(batch.num_rows):
                a, b = p.tokens(batch.column(1)[k].as_py())
                ends, upto_a, upto_b = spans(p.of_a.sizes[a], p.of_b.sizes[b])
                if len(ends):
                    lists = [pa.ListArray.from_arrays(pa.array(np.concatenate([[0], u]).astype(np.int32)), pa.array(x.astype(np.int32))) for u, x in ((upto_a, a), (upto_b, b))]
                    ids = pa.array([batch.column(0)[k].as_py()] * len(ends), pa.int64())
                    yield pa.RecordBatch.from_arrays([ids, pa.array(np.arange(len(ends), dtype=np.int32)), pa.array(np.concatenate([[0], ends[:-1]])), pa.array(ends), *lists], names=["id", "grp", "start", "end", "a_ids", "b_ids"])

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(run, GROUPS)


ENCODED = "id long, n_a long, n_b long, n_groups long, groups_sha256 string, block long, links array<int>, times array<int>, pairs array<long>, totals array<long>"


def encoded(docs: DataFrame, id_col: str, text_col: str, a_path: str, b_path: str) -> DataFrame:
    """A row a document with its links, as numbers in the list of distinct pairs of its block, and how often it has each.

    The first row of a block also holds that list (a pair is a's id times the size of B's vocabulary plus b's id, in order) and the totals.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p, wide = pair(a_path, b_path), pair(a_path, b_path).b.get_piece_size()
        part, blocks, held = TaskContext.get().partitionId(), 0, 0
        rows: list[tuple] = []
        links: list[np.ndarray] = []
        times: list[np.ndarray] = []

        def flush() -> pa.RecordBatch:
            nonlocal blocks, held
            found, at = np.unique(np.concatenate(links), return_inverse=True)
            totals = np.bincount(at, np.concatenate(times), len(found)).astype(np.int64)
            numbers = np.split(at.astype(np.int32), np.cumsum([len(x) for x in links])[:-1])
            n = len(rows)
            off = pa.array([0] + [len(found)] * n, pa.int32())
            own = [pa.ListArray.from_arrays(off, pa.array(x)) for x in (found, totals)]
            columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), [pa.int64()] * 4 + [pa.string()], strict=True)]
            out = pa.RecordBatch.from_arrays([*columns, pa.array(np.full(n, part << 32 | blocks, np.int64)), list_array(numbers, pa.int32()), list_array(times, pa.int32()), *own], names=[f.split(" ")[0] for f in ENCODED.split(", ")])
            rows.clear(), links.clear(), times.clear()
            blocks, held = blocks + 1, 0
            return out

        for batch in batches:
            for key, value in zip(batch.column(0), batch.column(1), strict=True):
                text = value.as_py()
                a, b = p.tokens(text)
                _, upto_a, upto_b = spans(p.of_a.sizes[a], p.of_b.sizes[b])
                sha = hashlib.sha256(written(p, a, b, upto_a, upto_b)).hexdigest() if len(a) else ""
                own, n = np.unique(a[upto_a - 1] * wide + b[upto_b - 1], return_counts=True)
                rows.append((key.as_py(), len(a), len(b), len(upto_a), sha))
                links.append(own)
                times.append(n.astype(np.int32))
                held += len(text or "") + 64
                if held >= BLOCK_BYTES:
                    yield flush()
        if rows:
            yield flush()

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(run, ENCODED)


def pair_counts(rows: DataFrame, wide: int) -> DataFrame:
    """(pair, n, best): how many links corpus-wide hold a pair, and whether no pair of the same id of B has more.

    `rows` are those of `encoded`. The largest counts are one row an id of B, so at most as many as its vocabulary has; they are broadcast.
    """
    n = rows.where(F.size("pairs") > 0).select(F.explode(F.arrays_zip("pairs", "totals")).alias("p")).groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.totals").alias("n"))
    n = materialize(n)
    most = n.groupBy(F.pmod("pair", F.lit(wide)).alias("b")).agg(F.max("n").alias("most"))
    return n.join(F.broadcast(most), F.pmod("pair", F.lit(wide)) == F.col("b")).select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


SCORED = "id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def aligned(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", a_path: str | None = None, b_path: str | None = None) -> DataFrame:
    """One row a row of docs: numbers of tokens, groups and links, and how common its links are.

    A encodes a space and the text, B the text, to which it adds the space; special tokens' strings are
    plain text. Groups are those of `token_groups`. A link is an occurrence of a token of A and one of B
    that end at the same byte, the last two of each group, as no token is empty. n_best are the links whose pair of
    ids is the most frequent one of its id of B (ties too), count_sum adds up their counts over the corpus.

    Documents of about BLOCK_BYTES bytes of text make a block, which sends each of its distinct pairs once
    to be counted and gets each count once, whatever the number of its documents; a pair that all
    documents share is a row a block, and joins by pair are split by Spark where they are skewed. Counts
    cover all rows, those of repeated ids and equal rows too. Null and empty texts, and those that a
    tokenizer does not give back byte for byte, have no tokens: zeros and an empty hash. Long texts are
    encoded whole; an empty table gives an empty result. Only the two named columns are read.
    """
    a_path, b_path = a_path or vocabulary(), b_path or pieces_path()
    wide = pair(a_path, b_path).b.get_piece_size()
    rows = materialize(encoded(docs, id_col, text_col, a_path, b_path))
    of_block = rows.where(F.size("pairs") > 0).select("block", F.explode("pairs").alias("pair"))
    scored = of_block.join(pair_counts(rows, wide), "pair").select(F.col("block").alias("of_block"), "pair", "n", "best")

    def score(of: pa.Table, pairs: pa.Table) -> pa.Table:
        order = np.argsort(pairs.column("pair").to_numpy())
        n, best = pairs.column("n").to_numpy()[order], pairs.column("best").to_numpy(zero_copy_only=False)[order]
        at, m = (of.column(c).combine_chunks() for c in ("links", "times"))
        sizes = np.diff(at.offsets.to_numpy())
        at, m = at.flatten().to_numpy(), m.flatten().to_numpy().astype(np.int64)
        row = np.repeat(np.arange(len(sizes)), sizes)
        sums = [np.zeros(len(sizes), np.int64) for _ in range(3)]
        for total, what in zip(sums, (m, m * best[at], m * n[at]), strict=True):
            np.add.at(total, row, what)
        return pa.table({**{c: of.column(c) for c in ("id", "n_a", "n_b", "n_groups")}, **dict(zip(("n_links", "n_best", "count_sum"), map(pa.array, sums), strict=True)), "groups_sha256": of.column("groups_sha256")})

    return rows.drop("pairs", "totals").groupBy("block").cogroup(scored.groupBy("of_block")).applyInArrow(score, SCORED)


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aligned(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")
