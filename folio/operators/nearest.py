"""The k titles closest to each of a set of titles, by the share of matching characters."""

from __future__ import annotations

import difflib
import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from folio.functions.extract import sequence_ratio
from folio.functions.text import title_key
from folio.operators.titles import stored

GRAM = 3
#: Titles asked for and titles searched that meet in a task.
ASKED, SEARCHED = 256, 4096
#: Tasks a pair of blocks, so that few pairs share one, and tasks at most.
SPREAD, TASKS = 4, 4096
WORD = 64
#: Titles measured at once, and the length from which the sequence matcher leaves out frequent characters.
AT_ONCE, SHORT = 2048, 200


def first_of(df: DataFrame, keys: list[str], order: list, k: int) -> DataFrame:
    """The first k rows of each key, with their place; Spark keeps k a key in each task before it shuffles."""
    return df.withColumn("place", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("place") <= k)


def grams(key: str, n: int = GRAM):
    """Distinct runs of n characters of a column."""
    return F.array_distinct(F.expr(f"transform(sequence(1, greatest(1, length({key}) - {n - 1})), i -> substring({key}, i, {n}))"))


def _codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points in columns, zero below the end, and lengths."""
    size = np.array([len(t) for t in texts])
    flat = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
    out = np.zeros((int(size.max(initial=0)), len(texts)), np.uint32)
    column = np.repeat(np.arange(len(texts)), size)
    out[np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size), column] = flat
    return out, size


def common(title: str, codes: np.ndarray) -> np.ndarray:
    """Lengths of the longest common subsequence of a title and each column of codes, a bit for each place of the title.

    Matching blocks of two titles follow each other in both, so their characters are such a subsequence
    and no pair has more of them.
    """
    words = -(-len(title) // WORD)
    letters = sorted(set(title))
    index = np.zeros((len(letters) + 1, words), np.uint64)  # the last row: any other character
    for at, c in enumerate(title):
        index[letters.index(c), at // WORD] |= np.uint64(1 << at % WORD)
    known = np.array([ord(c) for c in letters], np.uint32)
    v = np.full((words, codes.shape[1]), np.uint64(2**64 - 1))
    for line in codes:
        at = np.searchsorted(known, line)
        at[known[np.minimum(at, len(known) - 1)] != line] = len(letters)
        carry = np.zeros(codes.shape[1], np.uint64)
        for w in range(words):
            u = v[w] & index[at, w]
            part = v[w] + u
            total = part + carry
            carry = ((part < u) | (total < part)).astype(np.uint64)
            v[w] = total | (v[w] - u)
    used = np.array([(1 << min(WORD, len(title) - w * WORD)) - 1 for w in range(words)], np.uint64)
    return np.bitwise_count(~v & used[:, None]).sum(axis=0).astype(np.int64)


def longest_blocks(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(end in a, end in b, size) of the longest run of characters that rows of a and b share; of equal ones the first in a, then in b.

    Rows are padded with different numbers, so padding is equal to nothing. A table of run lengths is
    made place by place of a, for all rows at once.
    """
    n, wide = b.shape
    run, size = np.zeros((n, wide + 1), np.uint8), np.zeros(n, np.uint8)
    end_a, end_b = np.zeros(n, np.int64), np.zeros(n, np.int64)
    for i in range(a.shape[1]):
        run[:, 1:] = (run[:, :-1] + np.uint8(1)) * (b == a[:, i : i + 1])
        most = run.max(axis=1)
        better = np.flatnonzero(most > size)
        size[better], end_a[better] = most[better], i + 1
        end_b[better] = run[better].argmax(axis=1)
    return end_a, end_b, size.astype(np.int64)


def _part(text: np.ndarray, lo: np.ndarray, hi: np.ndarray, pad: int) -> np.ndarray:
    at = lo[:, None] + np.arange(int((hi - lo).max()))
    return np.where(at < hi[:, None], text[np.arange(len(lo))[:, None], np.minimum(at, text.shape[1] - 1)], text.dtype.type(pad))


def matched(a: np.ndarray, size_a: np.ndarray, b: np.ndarray, size_b: np.ndarray) -> np.ndarray:
    """Matching characters of rows of numbers above 1, as the sequence matcher of the standard library counts them: the longest common run, then the same on either side of it."""
    total = np.zeros(len(a), np.int64)
    row, zero = np.arange(len(a)), np.zeros(len(a), np.int64)
    todo = [(row, zero, size_a, zero, size_b)]
    while todo:
        row, a_lo, a_hi, b_lo, b_hi = (np.concatenate(x) for x in zip(*todo, strict=True))
        some = (a_lo < a_hi) & (b_lo < b_hi)
        row, a_lo, a_hi, b_lo, b_hi = (x[some] for x in (row, a_lo, a_hi, b_lo, b_hi))
        todo = []
        if not len(row):
            break
        order = np.argsort(a_hi - a_lo, kind="stable")
        for k in np.array_split(order, -(-len(order) // 2048)):  # parts of similar length together
            r = row[k]
            e_a, e_b, n = longest_blocks(_part(a[r], a_lo[k], a_hi[k], 0), _part(b[r], b_lo[k], b_hi[k], 1))
            np.add.at(total, r, n)
            hit = n > 0
            r, n, e_a, e_b, k = r[hit], n[hit], a_lo[k][hit] + e_a[hit], b_lo[k][hit] + e_b[hit], k[hit]
            todo += [(r, a_lo[k], e_a - n, b_lo[k], e_b - n), (r, e_a, a_hi[k], e_b, b_hi[k])]
    return total


def ratios(title: str, others: list[str], codes: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The ratio of a title to each of the others (columns of codes); beyond SHORT characters, where common characters are no longer looked at, one by one."""
    out, plain = np.zeros(len(others)), np.flatnonzero(size < SHORT)
    if len(title) >= 250:
        plain = plain[:0]
    if len(plain):
        letters, own = np.unique(np.frombuffer(title.encode("utf-32-le"), np.uint32), return_inverse=True)  # 2 is any other character
        of = np.searchsorted(letters, codes[:, plain].T)
        of = np.where(letters[np.minimum(of, len(letters) - 1)] == codes[:, plain].T, of + 3, 2).astype(np.uint8)
        a = np.broadcast_to((own + 3).astype(np.uint8), (len(plain), len(title)))
        out[plain] = 2.0 * matched(a, np.full(len(plain), len(title)), of, size[plain]) / (size[plain] + len(title))
    rest = np.ones(len(others), bool)
    rest[plain] = False
    for j in np.flatnonzero(rest).tolist():
        out[j] = difflib.SequenceMatcher(None, title, others[j]).ratio()
    return out


def _closest(asked: pa.Table, searched: pa.Table, k: int) -> pa.Table:
    """The rows of (a, b, ratio) among the titles of two blocks that may belong to the k closest of a.

    Pairs are measured in the order of their bound, until the bound is below the k-th best found or the floor that
    the seeds of a have set.
    """
    b = searched.column("b").to_pylist()
    many = searched.column("n").to_numpy()
    codes, size = _codes(b)
    out: list[tuple] = []
    for a, floor in zip(asked.column("a").to_pylist(), asked.column("floor").to_pylist(), strict=True):
        bound = 2.0 * common(a, codes) / (size + len(a))
        best: list[float] = []  # the k best ratios so far, as often as rows have them
        least, found = floor, []
        order = np.argsort(-bound, kind="stable")
        for first in range(0, len(order), AT_ONCE):
            some = order[first : first + AT_ONCE]
            some = some[bound[some] >= least]
            if not len(some):
                break
            for j, ratio in zip(some.tolist(), ratios(a, [b[j] for j in some], codes[:, some], size[some]).tolist(), strict=True):
                if ratio < least:
                    continue
                found.append((a, b[j], ratio))
                for _ in range(min(k, int(many[j]))):
                    (heapq.heappushpop if len(best) == k else heapq.heappush)(best, ratio)
                if len(best) == k:
                    least = max(least, best[0])
        out += [x for x in found if x[2] >= least]
    a, b, r = zip(*out, strict=True) if out else ((), (), ())
    return pa.table({"a": pa.array(a, pa.string()), "b": pa.array(b, pa.string()), "ratio": pa.array(r, pa.float64())})


def _seeds(asked: DataFrame, searched: DataFrame, k: int, often: int) -> DataFrame:
    """(a, floor): a ratio that k rows at least reach, from titles that share rare runs of characters; it only says where looking may end.

    The inverted list holds the runs that at most `often` distinct titles have, so no list is long.
    """
    lists = searched.select("b", "n", F.explode(grams("b")).alias("g"))
    rare = lists.groupBy("g").agg(F.count(F.lit(1)).alias("df")).where(F.col("df") <= often)
    hits = asked.select("a", F.explode(grams("a")).alias("g")).join(lists.join(rare, "g"), "g").groupBy("a", "b").agg(F.sum(1 / F.col("df")).alias("weight"), F.first("n").alias("n"))
    met = first_of(hits, ["a"], [F.desc("weight"), "b"], 4 * k).select("a", "n", sequence_ratio("a", "b").alias("ratio"))
    # the ratio of the title with which k rows are reached, best first
    ranked = met.groupBy("a").agg(F.sort_array(F.collect_list(F.struct("ratio", "n")), asc=False).alias("r"))  # 4 * k at most
    done = F.expr(f"aggregate(r, named_struct('left', {k}L, 'floor', cast(0 as double)), (s, x) -> if(s.left <= 0, s, named_struct('left', s.left - x.n, 'floor', if(s.left - x.n <= 0, x.ratio, cast(0 as double)))))")
    return ranked.select("a", done["floor"].alias("floor"))


def nearest_titles(misses: DataFrame, candidates: DataFrame, miss_id: str, candidate_id: str, title: str = "title", k: int = 10, style: str = "eval", often: int = 64) -> DataFrame:
    """(miss_id, place, candidate_id, ratio): for each miss the k candidates with the most alike titles, ties to the smaller id.

    Titles are compared as keys by the share of matching characters (Ratcliff-Obershelp), exactly; rows without a
    title are left out. Both sides meet as distinct keys, so a title that many rows share is measured
    once. An inverted list of rare runs of characters first finds close titles, which set a floor for each
    miss; then the misses, a stated set, meet all keys in blocks of bounded size, where the bound of the
    longest common subsequence tells which pairs are worth measuring. Each pair of blocks returns what
    may belong to the k closest; of these the last ranking is made.
    """
    key = title_key(F.col(title), style)
    a = misses.select(F.col(miss_id).alias("a_id"), key.alias("a")).where("a <> ''")
    b = candidates.select(F.col(candidate_id).alias("b_id"), key.alias("b")).where("b <> ''")
    asked = a.select("a").distinct()
    searched = b.groupBy("b").agg(F.count(F.lit(1)).alias("n"))
    searched = stored(searched)
    asked = stored(asked.join(_seeds(asked, searched, k, often), "a", "left").select("a", F.coalesce("floor", F.lit(0.0)).alias("floor")))
    rows, columns = (max(1, math.ceil(d.count() / n)) for d, n in ((asked, ASKED), (searched, SEARCHED)))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    block = lambda c, n: F.pmod(F.xxhash64(c), F.lit(n)).cast("int")
    left = asked.withColumn("i", block("a", rows)).withColumn("j", every(columns))
    right = searched.withColumn("m", block("b", columns)).withColumn("l", every(rows))
    # blocks are few bytes and much work, so their number and not their size says how many tasks there are
    tasks = min(SPREAD * rows * columns, TASKS)
    left, right = left.repartition(tasks, "i", "j"), right.repartition(tasks, "l", "m")
    found = left.groupBy("i", "j").cogroup(right.groupBy("l", "m")).applyInArrow(lambda x, y: _closest(x, y, k), "a string, b string, ratio double")
    # of the ids of one title the k smallest can count
    ids = first_of(b, ["b"], ["b_id"], k).select("b", "b_id")
    near = first_of(found.join(ids, "b"), ["a"], [F.desc("ratio"), "b_id"], k)
    return a.join(near, "a").select(F.col("a_id").alias(miss_id), "place", F.col("b_id").alias(candidate_id), "ratio")
