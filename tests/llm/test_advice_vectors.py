"""Vectors: what a review found missing."""

from __future__ import annotations

import math

import numpy as np
import pytest

from folio.llm import op07_embeddings


@pytest.mark.parametrize("rows", [10**4, 10**6, 10**7, 3 * 10**7, 10**8])
def test_plan_reaches_its_recall_at_any_size(rows):
    k, tables, width = op07_embeddings.plan(rows, 0.95)
    d, _ = op07_embeddings.window(0.95)
    near = 1 - d * math.sqrt(2 / math.pi) / width
    assert 1 - (1 - near**k) ** tables >= 0.997


def test_cells_do_not_hang_on_the_rows_taken_at_once(spark, monkeypatch):
    x = np.random.default_rng(3).standard_normal((40, 8))
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)] + [(99, [1.0, 2.0])], "id long, v array<double>").coalesce(1)
    one = {r["id"]: (r["signs"], r["cells"]) for r in op07_embeddings.keys(rows, 5, 300, 1.5).collect()}
    monkeypatch.setattr(op07_embeddings, "PLACES", 5 * 300 * 7)
    assert {r["id"]: (r["signs"], r["cells"]) for r in op07_embeddings.keys(rows, 5, 300, 1.5).collect()} == one
    assert len(one) == 41 and all(len(c) == 300 for _, c in one.values())
