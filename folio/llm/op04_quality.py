"""Quality scores by a generalised additive model with pairwise interactions."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.llm import kernels
from folio.llm.common import bounded_fraction, crc_mod, hash_share, table
from folio.llm.kernels import sequence_hashes, span_hashes, text_chunks, word_hashes, word_spans

FEATURES = ("log_words", "word_bytes", "longest_word", "distinct_words", "distinct_pairs", "top_word", "repeats_before", "upper", "digits", "stops", "bangs", "bars", "symbols", "non_ascii", "lines_a_word", "repeated_lines", "short_words", "sentence_words")
SAMPLE = 20_000
BINS = 48
PAIR_BINS = 8
PAIRS = 10
ROUNDS, PAIR_ROUNDS = 250, 80
RATE = 0.08
THRESHOLD = 0.3


def _class(chars: str) -> np.ndarray:
    t = np.zeros(256, np.int64)
    for ch in chars.encode():
        t[ch] = 1
    return t


UPPER, DIGIT, STOP, BANG, BAR, NEWLINE = (_class(x) for x in ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", ".?!", "!", "|", "\n"))
SYMBOL = _class("#$%&*+/<=>@\\^_`{}~[]")
HIGH = (np.arange(256) >= 128).astype(np.int64)


def document_features(column: pa.Array) -> np.ndarray:
    """A row of FEATURES for each whole text; a text without words has zeros."""
    out = np.zeros((len(column), len(FEATURES)))
    for i, j, b, off in text_chunks(column):
        if j == i + 1 and len(b) > kernels.WINDOW:
            out[i] = long_features(b)
            continue
        s, e, at = word_spans(b, off)
        w = span_hashes(b, s, e)
        pairs = sequence_hashes(w, 2)

        def per_text(t: np.ndarray) -> np.ndarray:
            sums = np.zeros(len(b) + 1, np.int64)
            np.cumsum(t[b], out=sums[1:])
            return (sums[off[1:]] - sums[off[:-1]]).astype(float)

        n = np.diff(at).astype(float)
        size = np.maximum(np.diff(off).astype(float), 1)
        words = np.maximum(n, 1)
        length = np.concatenate([[0], np.cumsum(e - s)])
        short = np.concatenate([[0], np.cumsum(e - s <= 2)])
        same = np.zeros(len(w) + 1, np.int64)
        if len(w) > 1:
            same[2:] = np.cumsum(w[1:] == w[:-1])
        body = (length[at[1:]] - length[at[:-1]]).astype(float)
        f = out[i:j]
        f[:, 0] = np.log1p(n)
        f[:, 1] = body / words
        bang, stop = per_text(BANG), per_text(STOP)
        f[:, 6] = np.where(n > 1, (same[at[1:]] - same[np.minimum(at[:-1] + 1, len(w))]) / words, 0)
        f[:, 7], f[:, 8], f[:, 9], f[:, 10] = per_text(UPPER) / size, per_text(DIGIT) / size, stop / words, bang / words
        f[:, 11], f[:, 12], f[:, 13] = per_text(BAR) / words, per_text(SYMBOL) / size, per_text(HIGH) / size
        lines = per_text(NEWLINE)
        f[:, 14] = lines / words
        f[:, 16] = (short[at[1:]] - short[at[:-1]]) / words
        f[:, 17] = np.log1p(n / (stop + 1))
        cut = np.flatnonzero(b == 10)
        for k in range(j - i):
            a, z = at[k], at[k + 1]
            if a == z:
                f[k] = 0
                continue
            u, c = np.unique(w[a:z], return_counts=True)
            f[k, 2] = np.log1p((e[a:z] - s[a:z]).max())
            f[k, 3], f[k, 5] = len(u) / (z - a), c.max() / (z - a)
            f[k, 4] = len(np.unique(pairs[a : z - 1])) / (z - a - 1) if z - a > 1 else 1.0
            if lines[k]:
                marks = cut[np.searchsorted(cut, off[k]) : np.searchsorted(cut, off[k + 1])]
                ls, le = np.concatenate([[off[k]], marks + 1]), np.concatenate([marks, [off[k + 1]]])
                full = le > ls
                h = span_hashes(b[off[k] : off[k + 1]], ls[full] - off[k], le[full] - off[k])
                f[k, 15] = 1 - len(np.unique(h)) / max(1, len(h))
    return out


def long_features(b: np.ndarray) -> np.ndarray:
    """The same of one long text: bytes and lines are counted in windows, then its words by their hashes."""
    f = np.zeros(len(FEATURES))
    w, sizes = word_hashes(b)
    n = len(w)
    if not n:
        return f
    counts, lines, known, rest = np.zeros(256, np.int64), 0, set(), b""
    for i in range(0, len(b), kernels.WINDOW):
        part = b[i : i + kernels.WINDOW]
        counts += np.bincount(part, minlength=256)
        *whole, rest = (rest + part.tobytes()).split(b"\n")
        full = [x for x in whole if x]
        lines += len(full)
        known.update(map(hash, full))
    lines += bool(rest)
    known |= {hash(rest)} if rest else set()
    of = lambda t: float((counts * t).sum())
    stop, breaks = of(STOP), of(NEWLINE)
    top = np.unique(w, return_counts=True)[1]
    f[:7] = np.log1p(n), sizes.sum() / n, np.log1p(sizes.max()), len(top) / n, len(np.unique(sequence_hashes(w, 2))) / (n - 1) if n > 1 else 1.0, top.max() / n, (w[1:] == w[:-1]).sum() / n
    f[7:15] = of(UPPER) / len(b), of(DIGIT) / len(b), stop / n, of(BANG) / n, of(BAR) / n, of(SYMBOL) / len(b), of(HIGH) / len(b), breaks / n
    f[15:] = 1 - len(known) / max(1, lines) if breaks else 0.0, (sizes <= 2).sum() / n, np.log1p(n / (stop + 1))
    return f


@dataclass
class Additive:
    """A bin table a feature, and a table of two coarser bins a pair; a score is the sum of one entry of each."""

    intercept: float = 0.0
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    coarse: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int, np.ndarray]] = field(default_factory=list)

    def logits(self, x: np.ndarray) -> np.ndarray:
        z = np.full(len(x), self.intercept)
        if not self.edges:
            return z
        for f, t in enumerate(self.tables):
            z += t[np.searchsorted(self.edges[f], x[:, f], "right")]
        bins = {f: np.searchsorted(self.coarse[f], x[:, f], "right") for p in self.pairs for f in p[:2]}
        for f, g, t in self.pairs:
            z += t[bins[f], bins[g]]
        return z

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.logits(x)))


def stump(grad: np.ndarray, hess: np.ndarray, lam: float = 2.0, leaf: float = 5.0) -> np.ndarray:
    """Values a bin of a tree of two splits over ordered bins."""
    cuts = [0, len(grad)]
    for _ in range(2):
        best, where = 1e-9, None
        for a, z in zip(cuts[:-1], cuts[1:], strict=True):
            if z - a < 2:
                continue
            g, h = np.cumsum(grad[a:z]), np.cumsum(hess[a:z])
            gain = g[:-1] ** 2 / (h[:-1] + lam) + (g[-1] - g[:-1]) ** 2 / (h[-1] - h[:-1] + lam) - g[-1] ** 2 / (h[-1] + lam)
            gain[(h[:-1] < leaf * 0.1) | (h[-1] - h[:-1] < leaf * 0.1)] = 0
            k = int(gain.argmax())
            if gain[k] > best:
                best, where = gain[k], a + k + 1
        if where is None:
            break
        cuts = sorted([*cuts, where])
    out = np.zeros(len(grad))
    for a, z in zip(cuts[:-1], cuts[1:], strict=True):
        out[a:z] = grad[a:z].sum() / (hess[a:z].sum() + lam)
    return out


def quantile_edges(x: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(x, np.linspace(0, 1, bins + 1)[1:-1]))


def fit(x: np.ndarray, y: np.ndarray) -> Additive:
    """Cyclic boosting: each round visits every feature in turn with a small step, then the strongest pairs."""
    model = Additive()
    if not len(y):
        return model
    base = (y.sum() + 1) / (len(y) + 2)
    model.intercept = float(np.log(base / (1 - base)))
    if y.min() == y.max():
        return model
    n = x.shape[1]
    model.edges, model.coarse = [quantile_edges(x[:, f], BINS) for f in range(n)], [quantile_edges(x[:, f], PAIR_BINS) for f in range(n)]
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    bins = [np.searchsorted(model.edges[f], x[:, f], "right") for f in range(n)]
    z = np.full(len(y), model.intercept)
    for _ in range(ROUNDS):
        for f in range(n):
            p = 1 / (1 + np.exp(-z))
            step = RATE * stump(np.bincount(bins[f], y - p, len(model.tables[f])), np.bincount(bins[f], p * (1 - p), len(model.tables[f])))
            model.tables[f] += step
            z += step[bins[f]]
    coarse = [np.searchsorted(model.coarse[f], x[:, f], "right") for f in range(n)]
    p = 1 / (1 + np.exp(-z))
    gains = []
    for f in range(n):
        for g in range(f + 1, n):
            cell = coarse[f] * (len(model.coarse[g]) + 1) + coarse[g]
            gains.append((float((np.bincount(cell, y - p) ** 2 / (np.bincount(cell, p * (1 - p)) + 2)).sum()), f, g, cell))
    chosen = [(f, g, cell, np.zeros((len(model.coarse[f]) + 1) * (len(model.coarse[g]) + 1))) for _, f, g, cell in sorted(gains, key=lambda r: -r[0])[:PAIRS]]
    for _ in range(PAIR_ROUNDS):
        for _, _, cell, t in chosen:
            p = 1 / (1 + np.exp(-z))
            step = RATE * np.bincount(cell, y - p, len(t)) / (np.bincount(cell, p * (1 - p), len(t)) + 5)
            t += step
            z += step[cell]
    model.pairs = [(f, g, t.reshape(len(model.coarse[f]) + 1, -1)) for f, g, _, t in chosen]
    return model


def _features(rows: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(document_features(batch.column(1)).tolist(), pa.list_(pa.float64())), batch.column(2), batch.column(3)], names=["id", "x", "y", "h"])

    made = rows.select("id", "text", "y", F.xxhash64("text").alias("h")).mapInArrow(run, "id long, x array<double>, y int, h long")
    return made.groupBy("id", "y").agg(F.min_by("x", "h").alias("x"))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", sample: int = SAMPLE) -> Additive:
    """Fits on at most about `sample` labels, chosen by a hash of the id; features are made in tasks.

    An id and label count once, with the text of the smallest hash where rows repeat the id, so the
    sample stays bounded however often they do. Labels and documents without an id are left out.
    """
    marked = labels.select(F.col(id_col).cast("long").alias("_id"), F.col(label_col).cast("int").alias("y")).where("_id IS NOT NULL AND y IS NOT NULL").distinct()
    share = bounded_fraction(marked.count(), sample)
    pick = lambda c: hash_share(F.col(c), "quality sample") < share
    d = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).where(pick("id"))
    rows = d.join(marked.where(pick("_id")), F.col("id") == F.col("_id"))
    got = _features(rows).toPandas().sort_values(["id", "y"], kind="stable")
    x = np.stack(got["x"].to_list()) if len(got) else np.zeros((0, len(FEATURES)))
    return fit(x, got["y"].to_numpy().astype(float))


def score_quality(docs: DataFrame, model: Additive, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row a row of docs: id, score, predicted.

    Each whole text is scored from counts of its bytes, words and lines, whatever its length, long ones in
    windows. Null and empty texts have the
    features of a text without words; ids may be null or repeat, each row is scored on its own; an empty
    table gives an empty result; without labels the score is 0.5. Only the two named columns are read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = model.scores(document_features(batch.column(1)))
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(p), pa.array((p >= threshold).astype(np.int32))], names=["id", "score", "predicted"])

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(run, "id long, score double, predicted int")


def keep_good(docs: DataFrame, model: Additive, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs that score at least `threshold`, all columns as they are.

    Each row is judged by its whole text, a null one as an empty one, so rows that repeat an id stay or
    go on their own; an empty table stays empty.
    """

    @F.pandas_udf("double")
    def score(texts):
        import pandas as pd

        return pd.Series(model.scores(document_features(pa.array(texts, pa.string(), from_pandas=True))))

    return docs.where(score(F.col(text_col)) >= threshold)


def learnable(labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    return labels.where(crc_mod(F.col(id_col), 5) != 0)


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = train(docs, learnable(table(spark, sf_dir, "labels")))
    held_out = F.coalesce(crc_mod(F.col("id"), 5) == 0, F.lit(False))
    return score_quality(docs, model).select(F.col("id").alias("doc_id"), held_out.alias("held_out"), "score", "predicted")
