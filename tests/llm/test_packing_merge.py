"""Merging of open bins by counts of their fills."""

from __future__ import annotations

import collections

import numpy as np
import pytest

from folio.llm import op02_packing


def item_by_item(sizes, capacity):
    return len(op02_packing.best_fit(np.array(sizes), capacity)[2])


@pytest.mark.parametrize("seed", range(6))
def test_classes_pack_like_items(seed):
    rng = np.random.default_rng(seed)
    capacity = int(rng.integers(20, 200))
    sizes = rng.integers(1, capacity + 1, int(rng.integers(1, 3000))).tolist()
    if seed % 2:
        sizes = [max(1, capacity // 3)] * 700 + sizes
    counts = collections.Counter(sizes)
    slots = op02_packing.best_fit_classes(list(counts), list(counts.values()), capacity)
    bins = collections.defaultdict(list)
    taken = collections.Counter()
    for size, start, stop, per, first, offset in slots:
        for r in range(start, stop):
            bins[first + (r - start) // per].append((offset + (r - start) % per * size, size))
        taken[size] += stop - start
    assert taken == counts
    assert sorted(bins) == list(range(len(bins))) and len(bins) == item_by_item(sizes, capacity)
    for content in bins.values():
        at = 0
        for offset, size in sorted(content):
            assert offset == at
            at += size
        assert at <= capacity
    assert len(slots) <= 4 * capacity


def test_bins_that_cannot_be_filled(spark):
    word = "hello "
    n = len(op02_packing.token_ids(op02_packing.encoder(op02_packing.vocabulary()), word * 600))
    assert n < 1024 < 2 * n
    rows = [(k, word * 600) for k in range(600)] + [(600 + k, word * int(k)) for k in range(200)] + [(None, None), (None, ""), (3, word)]
    d = spark.createDataFrame(rows, "doc_id long, text string").repartition(9)
    got = op02_packing.pack_documents(d, fan_in=2).collect()
    assert len(got) == len(rows)
    by = collections.defaultdict(list)
    for r in got:
        by[r["sequence_id"]].append((r["offset"], r["length"]))
    for content in by.values():
        at = 0
        for offset, length in sorted(content):
            assert offset == at
            at += length
        assert at <= 1024
    sizes = [r["length"] for r in got]
    assert len(by) <= item_by_item(sizes, 1024) * 1.01 + 1
