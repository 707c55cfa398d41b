"""Shared passages of repeated words and lines."""

from __future__ import annotations

import numpy as np
import pytest

from folio.llm import op03_substrings


def words(rng, n):
    return " ".join("".join(rng.choice(list("abcdefghijklmnop"), int(rng.integers(2, 10)))) for _ in range(n))


def cuts(text):
    b = np.frombuffer(text.encode(), np.uint8)
    return np.flatnonzero(op03_substrings.boundaries(b, np.array([0, len(b)])))


UNITS = ["ha ", "a ", "so what ", "é è ", "ja nein ", "one two three ", "eight-by-eight "]


def test_passages_of_repeated_words_and_lines(spark):
    rng = np.random.default_rng(7)
    shared = [u * (700 // len(u)) for u in UNITS] + [(words(rng, k) + "\n") * (700 // (6 * k)) for k in (3, 4, 5, 6, 7, 8, 9, 10) * 4]
    texts = [words(rng, int(rng.integers(20, 60))) + " " + s + words(rng, 30) for s in shared for _ in range(2)]
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {}
    for r in op03_substrings.repeated_passages(d).collect():
        found[r["id"]] = max(found.get(r["id"], 0), r["end"] - r["start"])
    assert set(found) == set(range(len(texts)))
    assert all(found[i] >= 0.6 * len(shared[i // 2]) for i in found)


@pytest.mark.parametrize("unit", [*UNITS, "x", "xy", "0123456789abcdefghijk "])
def test_periodic_text_is_cut_into_equal_chunks(unit):
    rng = np.random.default_rng(5)
    seen = []
    for k in range(12):
        head = words(rng, 9 + k)
        b = (head + " " + unit * (3000 // len(unit)) + words(rng, 9)).encode()
        c = cuts(b.decode())
        n = len(head.encode())
        inner = [b[s:e] for s, e in zip(c, c[1:], strict=False) if s > n + 120 and e < n + 2000]
        assert len(inner) > 10 and len({len(x) for x in inner}) <= 2 and all(op03_substrings.GUARD <= len(x) <= 80 for x in inner)
        seen.append(set(inner))
    assert set.union(*seen) == set.intersection(*seen)


def test_texts_do_not_see_each_other():
    rng = np.random.default_rng(9)
    parts = [words(rng, int(k)).encode() for k in rng.integers(1, 60, 50)] + [b"", b"ha " * 30, b"x"]
    off = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
    whole = op03_substrings.boundaries(np.frombuffer(b"".join(parts), np.uint8), off)
    for p, o in zip(parts, off, strict=False):
        own = op03_substrings.boundaries(np.frombuffer(p, np.uint8), np.array([0, len(p)]))
        assert (whole[o : o + len(p)] == own).all()
