"""Vectorised text kernels over Arrow string buffers, used inside Spark tasks.

Texts are cut into chunks of about a quarter of a mebibyte of UTF-8 bytes, so the temporary arrays of a task stay
small; one longer text is a chunk of its own. A null text is an empty text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK = 1 << 18
WINDOW = 1 << 20
SEPARATORS = (9, 10, 11, 12, 13, 32)
IS_SEP = np.zeros(256, bool)
IS_SEP[list(SEPARATORS)] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_rng = np.random.default_rng(20240229)
BYTE_CODE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BASE = 0x9E3779B97F4A7C15
BASE_INV = pow(BASE, -1, 2**64)
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse modulo 2**64; longer ones are not kept."""
    if len(_powers[0]) < n:
        made = []
        for base in (BASE, BASE_INV):
            p = np.full(n, base, np.uint64)
            p[0] = 1
            made.append(np.multiply.accumulate(p))
        if n > 2 * CHUNK:
            return made[0], made[1]
        _powers[:] = made
    return _powers[0], _powers[1]


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: each input bit changes half of the output bits."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


def text_chunks(column: pa.Array, limit: int = CHUNK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of texts."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    n = len(column)
    if n == 0:
        return
    _, at, data = column.buffers()
    at = np.frombuffer(at, np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(at, at[i] + limit, "right")) - 1)
        yield i, j, data[at[i] : at[j]], at[i : j + 1] - at[i]
        i = j


def word_spans(b: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words, and for each text the index of its first word (one more at the end)."""
    if len(b) == 0:
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(off), np.int64)
    body = ~IS_SEP[b]
    first = body.copy()
    first[1:] &= ~body[:-1]
    cut = off[(off > 0) & (off < len(b))]
    first[cut] = body[cut]
    last = body.copy()
    last[:-1] &= ~body[1:]
    last[cut - 1] = body[cut - 1]
    s, e = np.flatnonzero(first), np.flatnonzero(last) + 1
    return s, e, np.searchsorted(s, off)


def span_hashes(b: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
    """64-bit hashes of spans of bytes; equal bytes give equal hashes wherever they stand."""
    p, inv = powers(len(b) + 1)
    sums = np.zeros(len(b) + 1, np.uint64)
    np.cumsum(BYTE_CODE[b] * p[: len(b)], out=sums[1:])
    h = (sums[e] - sums[s]) * inv[s]
    return mix(h ^ ((e - s).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)))


def sequence_hashes(w: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the n consecutive values that begin at each place."""
    if len(w) < n:
        return np.zeros(0, np.uint64)
    h = np.zeros(len(w) - n + 1, np.uint64)
    for k in range(n):
        h = h * np.uint64(0xA0761D6478BD642F) + w[k : len(w) - n + 1 + k]
    return mix(h + np.uint64(n))


def windows(b: np.ndarray) -> Iterator[np.ndarray]:
    """One text in pieces of about WINDOW bytes that end between words."""
    i = 0
    while i < len(b):
        z = min(len(b), i + WINDOW)
        while z < len(b) and not IS_SEP[b[z]]:
            step = np.flatnonzero(IS_SEP[b[z : z + WINDOW]])
            z = z + int(step[0]) if len(step) else min(len(b), z + WINDOW)
        yield b[i:z]
        i = z


def word_hashes(b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, bytes) of the words of one text, made in windows."""
    hashes, sizes = [np.zeros(0, np.uint64)], [np.zeros(0, np.int32)]
    for part in windows(b):
        s, e, _ = word_spans(part, np.array([0, len(part)]))
        hashes.append(span_hashes(part, s, e))
        sizes.append((e - s).astype(np.int32))
    return np.concatenate(hashes), np.concatenate(sizes)


def shingle_sets(column: pa.Array, n: int = 5) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct hashes of n-word shingles) of each text, ASCII letters lower-cased.

    Fewer than n words make one shingle; no words make none. A text longer than WINDOW bytes is hashed in
    windows, so the temporaries of a text are those of a window and a few numbers a word.
    """
    for i, j, b, off in text_chunks(column):
        b = LOWER[b]
        if j == i + 1 and len(b) > WINDOW:
            w, _ = word_hashes(b)
            s = np.unique(sequence_hashes(w, n)) if len(w) >= n else sequence_hashes(w, len(w)) if len(w) else np.zeros(0, np.uint64)
            yield i, s
            continue
        s, e, at = word_spans(b, off)
        w = span_hashes(b, s, e)
        long = sequence_hashes(w, n)
        for k in range(j - i):
            a, z = at[k], at[k + 1]
            if z - a >= n:
                yield i + k, np.unique(long[a : z - n + 1])
            elif z > a:
                yield i + k, sequence_hashes(w[a:z], int(z - a))
            else:
                yield i + k, np.zeros(0, np.uint64)


def list_array(rows: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    off = np.zeros(len(rows) + 1, np.int32)
    np.cumsum([len(x) for x in rows], out=off[1:])
    return pa.ListArray.from_arrays(pa.array(off), pa.array(np.concatenate(rows) if rows else np.zeros(0), kind))
