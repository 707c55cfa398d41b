"""Language identification by interpolated Kneser-Ney character models."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.llm.common import bounded_fraction, crc_mod, hash_share, table
from folio.llm.kernels import mix

ORDER = 4
DOCS_PER_LANGUAGE = 1500
CALIBRATION_SHARE = 0.15
REJECT_QUANTILE = 0.998
SPACE = 32
CHARS = 1 << 18
_fold: list[np.ndarray] = []


def fold_table() -> np.ndarray:
    """A symbol of 16 bits for each code point: letters in lower case, all else a space."""
    if not _fold:
        t = np.full(0x110000, SPACE, np.uint16)
        for cp in range(0x110000):
            if not 0xD800 <= cp < 0xE000 and (ch := chr(cp)).isalpha():
                low = ch.lower()
                x = ord(low) if len(low) == 1 else cp
                t[cp] = x if x < 0x10000 else 0xE000 + x % 0x1000
        _fold.append(t)
    return _fold[0]


def symbols(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(keys of ORDER symbols, their document, letters of each document); runs of spaces are one."""
    joined = "\n".join(texts) + "\n"
    cps = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    c = fold_table()[cps]
    ends = np.cumsum(np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts)))
    doc = np.repeat(np.arange(len(texts)), np.diff(ends, prepend=0))
    letter = c != SPACE
    letters = np.bincount(doc[letter], minlength=len(texts))
    keep = letter.copy()
    keep[1:] |= letter[:-1]  # one space after each run of letters
    c, doc = c[keep].astype(np.uint64), doc[keep]
    place = np.arange(len(c)) - np.searchsorted(doc, np.arange(len(texts)))[doc]
    key = c.copy()
    for k in range(1, ORDER):
        before = np.full(len(c), SPACE, np.uint64)
        before[k:] = c[:-k]
        before[place < k] = SPACE
        key |= before << np.uint64(16 * k)
    return key, doc, letters


def text_runs(texts: list[str | None]) -> Iterator[tuple[int, list[str]]]:
    run, start, size = [], 0, 0
    for i, t in enumerate(texts):
        run.append(t or "")
        size += len(run[-1]) + 1
        if size >= CHARS:
            yield start, run
            run, start, size = [], i + 1, 0
    if run:
        yield start, run


def windows(text: str) -> Iterator[tuple[np.ndarray, int]]:
    """(keys, letters) of a long text in windows of CHARS characters; the last symbols of one window are the context of the next."""
    tail, after_letter = np.full(ORDER - 1, SPACE, np.uint64), False
    for i in range(0, len(text) + 1, CHARS):
        part = text[i : i + CHARS]
        part += "\n" if i + CHARS > len(text) else ""
        c = fold_table()[np.frombuffer(part.encode("utf-32-le", "surrogatepass"), np.uint32)]
        letter = c != SPACE
        keep = letter.copy()
        keep[1:] |= letter[:-1]
        keep[0] |= after_letter
        after_letter = bool(letter[-1])
        s = np.concatenate([tail, c[keep].astype(np.uint64)])
        key = np.zeros(len(s) - ORDER + 1, np.uint64)
        for k in range(ORDER):
            key |= s[ORDER - 1 - k : len(s) - k] << np.uint64(16 * k)
        tail = s[len(s) - ORDER + 1 :]
        yield key, int(letter.sum())


def hashed(keys: np.ndarray, order: int) -> np.ndarray:
    return mix(keys + np.uint64(order * 0x9E3779B97F4A7C15 % 2**64))


def find(table_keys: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of q in a sorted hash array, and whether each is there."""
    if not len(table_keys):
        return np.zeros(len(q), np.int64), np.zeros(len(q), bool)
    at = np.minimum(np.searchsorted(table_keys, q), len(table_keys) - 1)
    return at, table_keys[at] == q


@dataclass
class Model:
    """For each order a sorted hash array of n-grams with log probabilities, one column a language, and
    a sorted hash array of contexts with log back-off weights."""

    languages: list[str]
    grams: list[tuple[np.ndarray, np.ndarray]]
    contexts: list[tuple[np.ndarray, np.ndarray]]
    unseen: np.ndarray
    temperature: float = 20.0
    limits: np.ndarray | None = None

    def log_probs(self, keys: np.ndarray) -> np.ndarray:
        out = np.zeros((len(keys), len(self.languages)), np.float32)
        todo = np.arange(len(keys))
        for order in range(ORDER, 0, -1):
            k = keys[todo] & np.uint64((1 << (16 * order)) - 1)
            at, there = find(self.grams[order - 1][0], hashed(k, order))
            out[todo[there]] += self.grams[order - 1][1][at[there]]
            todo, k = todo[~there], k[~there]
            if not len(todo):
                return out
            if order > 1:
                at, there = find(self.contexts[order - 1][0], hashed(k >> np.uint64(16), 16 + order))
                out[todo[there]] += self.contexts[order - 1][1][at[there]]
        out[todo] += self.unseen
        return out

    def entropies(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(nats a symbol for each language, letters) of each text."""
        h, letters = np.zeros((len(texts), len(self.languages))), np.zeros(len(texts), np.int64)
        long = {i for i, t in enumerate(texts) if t and len(t) > CHARS}
        for i in long:
            sums, count = np.zeros(len(self.languages)), 0
            for key, n in windows(texts[i]):
                sums, count = sums + self.log_probs(key).sum(axis=0, dtype=np.float64), count + len(key)
                letters[i] += n
            h[i] = -sums / max(count, 1)
        for start, run in text_runs([None if i in long else t for i, t in enumerate(texts)]):
            key, doc, n = symbols(run)
            letters[start : start + len(run)] += n
            if not len(key):
                continue
            lp = self.log_probs(key)
            first = np.flatnonzero(np.diff(doc, prepend=-1))
            sums = np.add.reduceat(lp, first, axis=0, dtype=np.float64)
            h[start + doc[first]] = -sums / np.diff(np.append(first, len(doc)))[:, None]
        return h, letters

    def decide(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
        """(language, score, cross-entropy, rejected) of each text."""
        if not self.languages:
            return ["und"] * len(texts), np.zeros(len(texts)), np.full(len(texts), np.nan), np.ones(len(texts), bool)
        h, letters = self.entropies(texts)
        best = h.argmin(axis=1)
        p = 1 / np.exp(-self.temperature * (h - h.min(axis=1, keepdims=True))).sum(axis=1)
        none = letters == 0
        low = h[np.arange(len(texts)), best]
        rejected = none | (low > self.limits[best]) if self.limits is not None else none
        return [("und" if z else self.languages[b]) for b, z in zip(best, none, strict=True)], np.where(none, 0.0, p), np.where(none, np.nan, low), rejected


def kneser_ney(counts: dict[str, tuple[np.ndarray, np.ndarray]]) -> Model:
    """Models of all languages from their counts of n-grams of the highest order."""
    languages = sorted(counts)
    per = {}
    for lang in languages:
        keys, n = counts[lang]
        orders = [None] * ORDER
        orders[ORDER - 1] = (keys, n.astype(np.float64))
        for order in range(ORDER - 1, 0, -1):  # continuation counts: distinct symbols seen before the n-gram
            k, c = np.unique(orders[order][0] & np.uint64((1 << (16 * order)) - 1), return_counts=True)
            orders[order - 1] = (k, c.astype(np.float64))
        per[lang] = orders
    union = [np.unique(np.concatenate([per[x][o][0] for x in languages])) if languages else np.zeros(0, np.uint64) for o in range(ORDER)]
    vocabulary = len(union[0]) + 1
    probs = [np.zeros((len(u), len(languages))) for u in union]
    grams, contexts = [], [(np.zeros(0, np.uint64), np.zeros((0, len(languages)), np.float32))]
    unseen = np.zeros(len(languages))
    for o in range(ORDER):
        ctx = union[o] >> np.uint64(16)
        names = np.unique(ctx)
        weights = np.ones((len(names), len(languages)))
        for j, lang in enumerate(languages):
            keys, n = per[lang][o]
            n1, n2 = (n == 1).sum(), (n == 2).sum()
            d = min(0.95, max(0.05, n1 / (n1 + 2 * n2))) if n1 + n2 else 0.5
            at, there = find(keys, union[o])
            c = np.where(there, n[at], 0.0)
            which = np.searchsorted(names, ctx)
            total, kinds = np.bincount(which, c, len(names)), np.bincount(which, c > 0, len(names))
            lam = np.where(total > 0, d * kinds / np.maximum(total, 1), 1.0)
            weights[:, j] = lam
            if o == 0:
                lower = np.full(len(union[0]), 1 / vocabulary)
                unseen[j] = np.log(lam[0] / vocabulary) if len(lam) else np.log(1 / vocabulary)
            else:
                lower = probs[o - 1][np.searchsorted(union[o - 1], union[o] & np.uint64((1 << (16 * o)) - 1)), j]
            probs[o][:, j] = np.maximum(c - d, 0) / np.maximum(total[which], 1) + lam[which] * lower
        h = hashed(union[o], o + 1)
        s = np.argsort(h)
        grams.append((h[s], np.log(probs[o][s]).astype(np.float32)))
        if o:
            h = hashed(names, 16 + o + 1)
            s = np.argsort(h)
            contexts.append((h[s], np.log(weights[s]).astype(np.float32)))
    return Model(languages, grams, contexts, unseen.astype(np.float32))


def train(docs: DataFrame, id_col: str, text_col: str, lang_col: str, docs_per_language: int = DOCS_PER_LANGUAGE) -> Model:
    """Fits on at most about `docs_per_language` labelled documents a language, chosen by a hash of the id; whole texts.

    N-grams are counted in tasks and summed by Spark; the counts of the bounded sample then come to the driver.
    """
    t = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).where("lang IS NOT NULL AND text IS NOT NULL")
    rows = {r["lang"]: r["count"] for r in t.groupBy("lang").count().collect()}
    if not rows:
        return kneser_ney({})
    share = F.create_map(*[F.lit(x) for lang, n in sorted(rows.items()) for x in (lang, bounded_fraction(n, docs_per_language))])
    sample = t.where(hash_share(F.col("id"), "language sample") < F.element_at(share, F.col("lang")))
    held = hash_share(F.col("id"), "language calibration") < CALIBRATION_SHARE

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, texts = np.array(batch.column(0).to_pylist(), object), batch.column(1).to_pylist()
            for start, run in text_runs(texts):
                key, doc, _ = symbols(run)
                mine = langs[start : start + len(run)]
                for lang in set(mine):
                    k, n = np.unique(key[(mine == lang)[doc]], return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(k), pa.string()), pa.array(k.view(np.int64)), pa.array(n)], names=["lang", "k", "n"])

    sums = sample.where(~held).select("lang", "text").mapInArrow(count, "lang string, k long, n long").groupBy("lang", "k").agg(F.sum("n").alias("n")).toPandas()
    counts = {}
    for lang, part in sums.groupby("lang"):
        k, n = part["k"].to_numpy().view(np.uint64), part["n"].to_numpy()
        s = np.argsort(k)
        counts[str(lang)] = (k[s], n[s])
    model = kneser_ney(counts)
    if not model.languages:
        return model

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h, letters = model.entropies(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(h.tolist(), pa.list_(pa.float64())), pa.array(letters)], names=["lang", "h", "letters"])

    cal = sample.where(held).select("lang", "text").mapInArrow(measure, "lang string, h array<double>, letters long").where("letters > 0").toPandas()
    cal = cal[cal["lang"].isin(model.languages)]
    if len(cal):
        h = np.stack(cal["h"].to_list())
        y = cal["lang"].map({x: j for j, x in enumerate(model.languages)}).to_numpy()
        gap = h - h.min(axis=1, keepdims=True)

        def loss(temp: float) -> float:
            z = np.exp(-temp * gap)
            return float(-np.log(np.maximum(z[np.arange(len(y)), y] / z.sum(axis=1), 1e-12)).mean())

        model.temperature = min((1, 2, 4, 8, 16, 32, 64, 128), key=loss)
        low = h.min(axis=1)
        model.limits = np.array([np.quantile(low[y == j], REJECT_QUANTILE) if (y == j).any() else np.inf for j in range(len(model.languages))])
    return model


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a row of docs: id, lang_pred, score, entropy, rejected.

    The whole text is scored under every language; the lowest cross-entropy a symbol wins. Text that is
    null or has no letter is `und` with score 0. rejected: the winner's cross-entropy lies above the
    0.998 quantile of that language's calibration rows, so the text fits no learned language well. Texts
    of any length are scored whole, long ones in windows. Equal entropies go to the first language by
    name. Ids may be null or repeat, each row is judged on its own; an empty table gives an empty result; without labelled rows all is `und`.
    Only the two named columns are read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lang, score, h, rejected = model.decide(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(lang, pa.string()), pa.array(score), pa.array(h, from_pandas=True), pa.array(rejected)], names=["id", "lang_pred", "score", "entropy", "rejected"])

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(run, "id long, lang_pred string, score double, entropy double, rejected boolean")


def op1_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held = crc_mod(F.col("doc_id"), 4) == 2
    model = train(docs.where(~held), "doc_id", "text", "lang")
    out = identify(docs, model)
    held_out = F.coalesce(crc_mod(F.col("id"), 4) == 2, F.lit(False))
    return out.select(F.col("id").alias("doc_id"), held_out.alias("held_out"), "lang_pred", "score", "entropy", "rejected")
