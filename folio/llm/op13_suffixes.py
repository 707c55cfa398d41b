"""Removal of repeated long strings by a logarithmic family of sampled suffix arrays."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.llm import kernels
from folio.llm.common import marked, materialize, table
from folio.llm.kernels import mix, powers, text_chunks

LENGTH = 400
#: Suffixes that may stand for a window: the first REACH places of it. What follows any of them inside the window has LENGTH - REACH + 1 bytes at least.
REACH = 224
GRAM = 16
BATCHES = 4
#: Neighbouring windows that are first told apart together.
CELL = 14
PLACE_BITS = 24
_codes = np.random.default_rng(1313).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
SUFFIXES = "prefix long, domain long, doc long, id long, place long"


class Sums:
    """Digests of the substrings of some bytes by running sums: equal bytes, equal digests, wherever they stand. Two kinds are independent of each other."""

    def __init__(self, b: np.ndarray, codes: np.ndarray):
        p, self.inv = powers(len(b) + 1)
        self.sums = np.zeros(len(b) + 1, np.uint64)
        np.cumsum(codes[b] * p[: len(b)], out=self.sums[1:])

    def raw(self, s: np.ndarray | slice, e: np.ndarray | slice) -> np.ndarray:
        return (self.sums[e] - self.sums[s]) * self.inv[s]


def window_minima(v: np.ndarray, w: int) -> np.ndarray:
    """The smallest of each w consecutive values, from minima that run forwards and backwards in blocks of w."""
    n = len(v) - w + 1
    padded = np.full(-(-len(v) // w) * w, np.iinfo(v.dtype).max, v.dtype)
    padded[: len(v)] = v
    grid = padded.reshape(-1, w)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[w - 1 : w - 1 + n])


def samples(b: np.ndarray, off: np.ndarray, length: int, reach: int) -> tuple[np.ndarray, ...]:
    """(row, place, first, last, prefix, domain) of the sampled suffixes of texts laid end to end.

    The window of `length` bytes at p is represented by the suffix at the least of its first `reach`
    places, in the order of a hash of the GRAM bytes there and then of places: a choice that looks at
    the window's bytes alone, so equal windows have equal representatives at equal distances. `first`
    and `last` are the windows that a suffix represents; `prefix` digests the length - reach + 1 bytes
    from it, which each of these windows holds, `domain` all bytes of these windows with the distance.
    """
    none = (np.zeros(0, np.int64),) * 6
    many = np.maximum(np.diff(off) - length + 1, 0)
    if not many.sum():
        return none
    one, two = Sums(b, kernels.BYTE_CODE), Sums(b, _codes)
    m = len(b) - GRAM + 1
    key = one.raw(slice(0, m), slice(GRAM, len(b) + 1))
    key *= np.uint64(0xD6E8FEB86659FD93)
    key &= ~np.uint64((1 << PLACE_BITS) - 1)
    key |= np.arange(m, dtype=np.uint64)
    at = (window_minima(key, reach) & np.uint64((1 << PLACE_BITS) - 1)).astype(np.int64)
    row = np.repeat(np.arange(len(many)), many)
    p = np.arange(len(row)) + np.repeat(off[:-1] - np.concatenate([[0], np.cumsum(many)[:-1]]), many)
    at = at[p]
    new = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1]) | (row[1:] != row[:-1])]))
    first, last, at, row = p[new], p[np.append(new[1:], len(p)) - 1], at[new], row[new]
    prefix = mix(one.raw(at, at + (length - reach + 1)))
    shape = ((at - first).astype(np.uint64) << np.uint64(32)) | (last - first).astype(np.uint64)
    domain = mix(two.raw(first, last + length) ^ (shape * np.uint64(0x9E3779B97F4A7C15)))
    return row, at - off[row], first - off[row], last - off[row], prefix, domain


def pieces(column: pa.Array, length: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, bytes before in its text, bytes, offsets): texts laid end to end, a long one in overlapping pieces that hold each window once."""
    for i, _, b, off in text_chunks(column):
        if len(off) == 2 and len(b) > kernels.WINDOW:
            for s in range(0, max(1, len(b) - length + 1), kernels.WINDOW):
                part = b[s : s + kernels.WINDOW + length - 1]
                yield i, s, part, np.array([0, len(part)])
        else:
            yield i, 0, b, off


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc (hash of id and text: equal rows are told from no other), id, text."""
    return docs.select(F.xxhash64(F.col(id_col).cast("long"), F.col(text_col)).alias("doc"), F.col(id_col).cast("long").alias("id"), F.coalesce(text_col, F.lit("")).alias("text"))


def sampled_suffixes(texts: DataFrame, length: int = LENGTH, reach: int = REACH) -> DataFrame:
    """The sampled suffixes of texts (doc, id, text), about two in `reach` bytes; place packs the suffix and the windows it represents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs, ids = batch.column(0), batch.column(1)
            for i, before, b, off in pieces(batch.column(2), length):
                row, at, first, last, prefix, domain = samples(b, off, length, reach)
                if len(row):
                    take = pa.array(i + row)
                    place = (at + before) << 16 | (at - first) << 8 | (at - last)
                    yield pa.RecordBatch.from_arrays([pa.array(prefix.view(np.int64)), pa.array(domain.view(np.int64)), docs.take(take), ids.take(take), pa.array(place)], names=["prefix", "domain", "doc", "id", "place"])

    if not GRAM <= length - reach + 1 or not 0 < reach <= 256:
        raise ValueError("a window must hold a gram at each of its first `reach` places, and these may be 256 at most")
    return texts.mapInArrow(run, SUFFIXES)


class SuffixFamily:
    """Sampled suffix arrays of batches in levels: a level of rank r holds 2**r batches, and equal levels are merged into one of the next rank.

    An array has a row for each distinct prefix of its suffixes, with their number, in the order of the
    prefixes' digests, in which equal prefixes stand together; where the suffixes are is kept with the batch. A
    batch is merged with the levels of ranks 0, 1, … up to the first that is free, in one pass that also
    tells what it shares with them, and scanned against the levels above; so a suffix moves as often as
    the logarithm of the number of batches. All steps are sorted merges of tables with one row a prefix,
    combined in the tasks first, so no prefix, however frequent, is more than a row of a task.
    """

    def __init__(self) -> None:
        self.levels: dict[int, DataFrame] = {}

    def add(self, suffixes: DataFrame) -> DataFrame:
        """Takes up a batch; returns the prefixes it has twice or shares with an earlier batch."""
        rows, rank = suffixes.select("prefix", F.lit(1).cast("long").alias("n"), F.lit(1).cast("long").alias("new")), 0
        while rank in self.levels:
            rows = rows.unionByName(self.levels.pop(rank).withColumn("new", F.lit(0).cast("long")))
            rank += 1
        merged = materialize(rows.groupBy("prefix").agg(F.sum("n").alias("n"), F.sum("new").alias("new")).sortWithinPartitions("prefix"))
        own = merged.where("new > 0")
        matches = own.where("n > 1").select("prefix")
        for level in self.levels.values():
            matches = matches.unionByName(own.where("n = 1").join(level.select("prefix").hint("merge"), "prefix", "left_semi").select("prefix"))
        self.levels[rank] = merged.select("prefix", "n")
        return matches


def first_window() -> Column:
    return (F.shiftright("place", 16) - F.shiftright("place", 8).bitwiseAND(255)).cast("long")


def last_window() -> Column:
    return (F.shiftright("place", 16) - F.col("place").bitwiseAND(255)).cast("long")


def _joined(texts: DataFrame, lists: DataFrame, how: str) -> DataFrame:
    """texts with the rows of lists (doc, id, …) of the same document."""
    l = lists.select(F.col("doc").alias("_d"), F.col("id").alias("_i"), *[c for c in lists.columns if c not in ("doc", "id")])
    return texts.join(l, (F.col("doc") == F.col("_d")) & F.col("id").eqNullSafe(F.col("_i")), how).drop("_d", "_i")


CELLS = "prefix long, inner long, outer long, suffix long, first long, last long, windows array<long>"


def window_cells(texts: DataFrame, evidence: DataFrame, length: int, cell: int = CELL) -> DataFrame:
    """The windows of the suffixes in `evidence` (suffix, prefix, doc, id, place), in cells of up to `cell` neighbours by their distance from the suffix.

    inner digests the bytes that all windows of a cell hold: equal windows have it in common. outer
    digests all bytes of the cell: equal ones repeat as a whole. windows are digests of each, from first to last.
    """

    def cells_of(b: np.ndarray, prefix: np.ndarray, place: np.ndarray, suffix: np.ndarray) -> pa.RecordBatch:
        at, back, fore = place >> 16, place >> 8 & 255, place & 255
        lo = int((at - back).min())
        sums = Sums(b[lo : int((at - fore).max()) + length], _codes)
        many = back // cell - fore // cell + 1
        of = np.repeat(np.arange(len(at)), many)
        c = np.arange(len(of)) - np.repeat(np.cumsum(many) - many, many) + (fore // cell)[of]
        near, far = np.maximum(fore[of], c * cell), np.minimum(back[of], c * cell + cell - 1)
        first, last = at[of] - far, at[of] - near
        shape = c.astype(np.uint64) << np.uint64(1)
        inner = mix(sums.raw(at[of] - c * cell - lo, at[of] - c * cell - cell + 1 + length - lo) ^ ((shape + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)))
        shape = (shape << np.uint64(16)) | (near.astype(np.uint64) << np.uint64(9)) | (far.astype(np.uint64) << np.uint64(1))
        outer = mix(sums.raw(first - lo, last + length - lo) ^ ((shape + np.uint64(2)) * np.uint64(0xC2B2AE3D27D4EB4F)))
        wide = last - first + 1
        p = np.arange(wide.sum()) + np.repeat(first - (np.cumsum(wide) - wide), wide)
        text = mix(sums.raw(p - lo, p - lo + length)).view(np.int64)
        lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(wide)]).astype(np.int32)), pa.array(text))
        return pa.RecordBatch.from_arrays([pa.array(x) for x in (prefix[of], inner.view(np.int64), outer.view(np.int64), suffix[of], first, last)] + [lists], names=[f.split(" ")[0] for f in CELLS.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                b, found = np.frombuffer(batch.column(0)[k].as_py().encode(), np.uint8), batch.column(1)[k].values
                prefix, place, suffix = (found.field(c).to_numpy(zero_copy_only=False) for c in range(3))
                order = np.argsort(place)
                for i in range(0, len(order), 4096):
                    some = order[i : i + 4096]
                    yield cells_of(b, prefix[some], place[some], suffix[some])

    lists = evidence.groupBy("doc", "id").agg(F.collect_list(F.struct("prefix", "place", "suffix")).alias("found"))
    some = marked(texts, F.col("doc"), lists.select("doc")).where("_marked").select("doc", "id", "text")
    return _joined(some, lists, "inner").select("text", "found").mapInArrow(run, CELLS)


def repeated_windows(texts: DataFrame, evidence: DataFrame, length: int) -> DataFrame:
    """(doc, id, first, last): windows of the single suffixes in `evidence` that another one of the same prefix has too.

    A suffix that is not single stands for others like it; its windows are known to repeat and only
    tell on others, so it goes without a number (-1). Cells whose bytes repeat as a whole are done. Of the others those
    with an inner part that repeats are looked at window by window; a bitmap picks them.
    """
    evidence = materialize(evidence.withColumn("suffix", F.when(F.col("single"), F.monotonically_increasing_id()).otherwise(-1)))
    cells = materialize(window_cells(texts, evidence, length))
    slim = cells.drop("windows")
    single = F.col("suffix") >= 0
    both = slim.groupBy("prefix", "outer").agg(F.count(F.lit(1)).alias("n"), F.max("suffix").alias("any")).where("n > 1 AND any >= 0").select("prefix", "outer", F.lit(True).alias("whole"))
    slim = materialize(slim.join(materialize(both), ["prefix", "outer"], "left").select("prefix", "inner", "suffix", "first", "last", F.coalesce("whole", F.lit(False)).alias("whole")))
    left = single & ~F.col("whole")
    open_ = slim.groupBy("prefix", "inner").agg(F.count(F.lit(1)).alias("n"), F.max(left).alias("any")).where("n > 1 AND any").select(F.xxhash64("prefix", "inner"))
    some = marked(cells, F.xxhash64("prefix", "inner"), open_).where("_marked")
    windows = materialize(some.select("prefix", "suffix", "first", F.posexplode("windows").alias("k", "text")).select("prefix", "text", "suffix", F.when(single, F.col("first") + F.col("k")).alias("p")))
    twice = windows.groupBy("prefix", "text").agg(F.count(F.lit(1)).alias("n"), F.max("suffix").alias("any")).where("n > 1 AND any >= 0").select("prefix", "text")
    one = windows.where(single).join(materialize(twice), ["prefix", "text"], "left_semi").select("suffix", F.col("p").alias("first"), F.col("p").alias("last"))
    found = slim.where("whole").where(single).select("suffix", "first", "last").unionByName(one)
    return found.join(evidence.where(single).select("suffix", "doc", "id"), "suffix").select("doc", "id", "first", "last")


def repeated(texts: DataFrame, length: int = LENGTH, reach: int = REACH, batches: int = BATCHES) -> DataFrame:
    """(doc, id, first, last): the windows of `length` bytes, from first to last, that also start elsewhere; a row may repeat.

    Batches of texts go into a SuffixFamily one after the other. Suffixes whose prefix it reports are
    compared by all the bytes of their windows: those with an equal domain repeat as a whole. Where a
    prefix has several domains, one suffix of each is looked at more closely.
    """
    suffixes = materialize(sampled_suffixes(texts, length, reach))
    family = SuffixFamily()
    matches = [materialize(family.add(suffixes.where(F.pmod(F.shiftrightunsigned("doc", 1), F.lit(batches)) == k))) for k in range(batches)]
    prefixes = matches[0]
    for m in matches[1:]:
        prefixes = prefixes.unionByName(m)
    some = marked(suffixes, F.col("prefix"), prefixes).where("_marked").select(*suffixes.columns)
    found = materialize(some.join(materialize(prefixes.distinct()), "prefix", "left_semi"))
    runs = materialize(found.groupBy("prefix", "domain").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("doc", "id", "place")).alias("one")))
    whole = found.join(runs.where("n > 1").select("prefix", "domain"), ["prefix", "domain"], "left_semi").select("doc", "id", first_window().alias("first"), last_window().alias("last"))
    mixed = runs.groupBy("prefix").agg(F.min("domain").alias("lo"), F.max("domain").alias("hi")).where("lo < hi").select("prefix")
    mixed = materialize(mixed)  # a table of its own, so that Spark can split what a frequent prefix meets
    evidence = runs.join(mixed, "prefix", "left_semi").select("prefix", (F.col("n") == 1).alias("single"), "one.doc", "one.id", "one.place")
    return whole.unionByName(repeated_windows(texts, evidence, length))


def runs_of(first: np.ndarray, last: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of bytes that the windows cover."""
    order = np.argsort(first)
    s, e = first[order], np.maximum.accumulate(last[order] + length)
    new = np.flatnonzero(np.concatenate([[True], s[1:] > e[:-1]]))
    return s[new], np.append(e[new[1:] - 1], e[-1])


CUT = "id long, n_bytes long, n_removed long, n_spans long, spans array<struct<start:long,end:long>>, kept binary, kept_sha256 string"


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, with_kept: bool = True) -> DataFrame:
    """One row a row of docs: id, n_bytes, n_removed, n_spans, spans (maximal removed runs of bytes), kept (the bytes left), kept_sha256.

    Removed is each byte of a string of `length` bytes of a text's UTF-8 form that also starts at
    another place, in the same text or any other; strings overlap, are judged on the input, and do not
    cross texts. What is left may end inside a character, so it is binary; `with_kept` false leaves it out.

    Suffixes are sampled (a sampled suffix array with minimizers, about one place in 112): of equal
    strings the same place is chosen, so none is lost. Equality is that of two independent 64-bit digests.
    Rows with equal ids and texts repeat each other; ids may be null or repeat. Null and
    empty texts have no bytes; texts of any length are read in overlapping pieces; an empty table gives
    an empty result. Only texts with a repeat are shuffled (as long as a bitmap of fixed size tells
    them), prefixes and windows in tables with one row each, so no frequent string is one task's.
    """
    texts = keyed(docs, id_col, text_col)
    found = materialize(repeated(texts, length).distinct())
    lists = found.groupBy("doc", "id").agg(F.collect_list(F.struct("first", "last")).alias("found"))
    told = marked(texts, F.col("doc"), found.select("doc"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                data, found = batch.column(1)[k].as_py().encode(), batch.column(2)[k].values
                s = e = np.zeros(0, np.int64)
                if found is not None and len(found):
                    s, e = runs_of(found.field(0).to_numpy(), found.field(1).to_numpy(), length)
                sha, kept, at = hashlib.sha256(), [], 0
                for a, z in [*zip(s.tolist(), e.tolist(), strict=True), (len(data), len(data))]:
                    sha.update(data[at:a])
                    kept.append(data[at:a])
                    at = z
                spans = [{"start": a, "end": z} for a, z in zip(s.tolist(), e.tolist(), strict=True)]
                yield pa.RecordBatch.from_pylist([{"id": batch.column(0)[k].as_py(), "n_bytes": len(data), "n_removed": int((e - s).sum()), "n_spans": len(s), "spans": spans, "kept": b"".join(kept) if with_kept else None, "kept_sha256": sha.hexdigest()}], schema)

    schema = pa.schema([("id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), ("kept", pa.binary()), ("kept_sha256", pa.string())])
    cut = _joined(told.where("_marked").select("doc", "id", "text"), lists, "left").select("id", "text", "found").mapInArrow(run, CUT)
    none = F.array().cast("array<struct<start:long,end:long>>")
    kept = F.col("text").cast("binary") if with_kept else F.lit(None).cast("binary")
    zero = F.lit(0).cast("long")
    rest = told.where("NOT _marked").select("id", F.octet_length("text").cast("long").alias("n_bytes"), zero.alias("n_removed"), zero.alias("n_spans"), none.alias("spans"), kept.alias("kept"), F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))
    return cut.unionByName(rest)


def op13_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = without_repeats(table(spark, sf_dir, "documents"), with_kept=False)
    return cut.select(F.col("id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept_sha256")


#: The same in DuckDB: all strings of 400 bytes, those that occur twice, and what they leave (two hexadecimal digits a byte).
SQL = """
WITH d AS (SELECT row_number() OVER () AS k, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents), p AS (SELECT k, h, unnest(range(0, greatest(0, len(h) // 2 - 399))) AS p FROM d), w AS (SELECT k, p, md5_number(substring(h, 2 * p + 1, 800)) AS w FROM p),
t AS (SELECT w FROM w GROUP BY 1 HAVING count(*) > 1), s AS (SELECT k, p, CASE WHEN p <= lag(p) OVER (PARTITION BY k ORDER BY p) + 400 THEN 0 ELSE 1 END AS x FROM w JOIN t USING (w)), g AS (SELECT k, p, sum(x) OVER (PARTITION BY k ORDER BY p ROWS UNBOUNDED PRECEDING) AS g FROM s),
i AS (SELECT k, min(p) AS a, max(p) + 400 AS z FROM g GROUP BY k, g), j AS (SELECT i.k, a, z, substring(h, 2 * coalesce(lag(z) OVER (PARTITION BY i.k ORDER BY a), 0) + 1, 2 * (a - coalesce(lag(z) OVER (PARTITION BY i.k ORDER BY a), 0))) AS part FROM i JOIN d ON d.k = i.k),
c AS (SELECT k, sum(z - a) AS n_removed, count(*) AS n_spans, string_agg(part, '' ORDER BY a) AS kept, max(z) AS z FROM j GROUP BY 1)
SELECT doc_id, CAST(len(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(kept, '') || substring(h, 2 * coalesce(z, 0) + 1))) AS kept_sha256 FROM d LEFT JOIN c ON c.k = d.k
"""
