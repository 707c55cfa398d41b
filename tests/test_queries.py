"""Every query with SQL gives DuckDB's rows; the others run."""

from __future__ import annotations

import math
import os

import duckdb
import pytest

import __spark_entry__ as spark_entry
from folio.plans import registry

NAMES = sorted(registry.queries())


@pytest.fixture(scope="module")
def duck(sf):
    c = duckdb.connect()
    for f in os.listdir(sf):
        c.sql(f"CREATE VIEW {f[:-8]} AS SELECT * FROM read_parquet('{sf}/{f}')")
    return c


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 4)
    if hasattr(v, "as_tuple"):
        return round(float(v), 4)
    return v


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, sf, duck, name):
    df = spark_entry.queries()[name](spark, sf)
    cols = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in cols) for r in df.collect()), key=repr)
    if name not in registry.oracle_sql():
        return
    want = duck.sql(registry.oracle_sql()[name])
    at = [list(want.columns).index(c) for c in cols]
    assert got == sorted((tuple(plain(r[i]) for i in at) for r in want.fetchall()), key=repr)


def test_entry(spark):
    assert spark_entry.entry(spark).count() > 0


def test_plans_stay_in_the_jvm(spark, sf):
    for name in ("gate_bucket", "rule_adjust", "canonical_url", "digest_topn_week", "cosine_topk"):
        plan = spark_entry.queries()[name](spark, sf)._jdf.queryExecution().toString()
        assert "BatchEvalPython" not in plan and "CartesianProduct" not in plan
