"""Bucketed merges, counters of a write, sketches, the vector index, numbered deliveries, null keys."""

import glob
import os
import random
import uuid

import numpy as np
import pytest
from pyspark.sql import functions as F

from folio.operators import change, external, metrics, runs, search, vectors
from folio.sources.buckets import BucketedTable


def test_upsert_keeps_rows_without_a_key(spark):
    old = spark.createDataFrame([(1, "a"), (None, "keep me")], "k long, v string")
    new = spark.createDataFrame([(2, "b"), (None, "another"), (1, "z")], "k long, v string")
    got = {tuple(r) for r in change.upsert(old, new, ["k"], {"v": "take"}).collect()}
    assert got == {(1, "z", "updated"), (2, "b", "inserted"), (None, "keep me", "untouched"), (None, "another", "inserted")}
    two = spark.createDataFrame([(1, None, "x"), (1, 2, "y")], "a long, b long, v string")
    got = {tuple(r) for r in change.upsert(two, two.withColumn("v", F.lit("n")), ["a", "b"], {"v": "take"}).collect()}
    assert got == {(1, None, "x", "untouched"), (1, None, "n", "inserted"), (1, 2, "n", "updated")}


def files(path):
    return {os.path.basename(d): {os.path.basename(f) for f in glob.glob(f"{d}/*.parquet")} for d in glob.glob(f"{path}/_part=*")}


def test_merge_rewrites_touched_parts_only(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = [(k, f"v{k}", k * 1.0) for k in range(400)] + [(None, "no key", 0.5)]
    t = BucketedTable(spark, f"t_{uuid.uuid4().hex}", path, ["k"], parts=16, buckets=4)
    t.create(spark.createDataFrame(rows, "k long, v string, x double"))
    before = files(path)
    new = spark.createDataFrame([(7, "new", -1.0), (9000, "added", -2.0), (None, "no key either", 0.25)], "k long, v string, x double")
    touched = {f"_part={p}" for p in t.touched(new)}
    counts = t.merge(new, {"v": "take"})
    after = files(path)
    assert 0 < len(touched) < 4 and all(after[p] == before[p] for p in before if p not in touched)
    assert all(not (after[p] & before.get(p, set())) for p in touched)
    want = {(k, v, x) for k, v, x in rows if k != 7} | {(7, "new", 7.0), (9000, "added", -2.0), (None, "no key either", 0.25)}
    assert {tuple(r) for r in t.read().collect()} == want
    assert counts["inserted"] == 2 and counts["updated"] == 1
    assert t.merge(new.where("false")) == {"inserted": 0, "updated": 0, "untouched": 0} and files(path) == after
    t.drop()


def test_merge_does_not_shuffle_the_table(spark, tmp_path):
    t = BucketedTable(spark, f"t_{uuid.uuid4().hex}", str(tmp_path / "t"), ["k"], parts=4, buckets=4)
    t.create(spark.range(1000).selectExpr("id AS k", "id * 2 AS v"))
    new = spark.range(5).selectExpr("id AS k", "id AS v")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        d = t.merged(new, t.touched(new), {"v": "take"})
        plan = d._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count("Exchange") == 1 and "Bucketed: true" in plan  # the new rows alone
    t.drop()


def test_counts_come_from_the_write(spark, tmp_path):
    d = spark.range(100).selectExpr("id", "id % 7 AS r")
    counts = runs.written_with_counts(d, str(tmp_path / "o"), {"zero": F.count_if(F.col("r") == 0), "most": F.max("id")})
    assert counts == {"total": 100, "zero": 15, "most": 99} and spark.read.parquet(str(tmp_path / "o")).count() == 100
    assert runs.written_with_counts(d.where("false"), str(tmp_path / "e"), {})["total"] == 0


def test_merged_sketches_stay_within_their_bound(spark):
    r = random.Random(3)
    values = [(run, r.gauss(run, 5)) for run in range(8) for _ in range(4000)]
    d = spark.createDataFrame([*values, (3, None)], "run int, v double")
    sketches = runs.run_sketches(d, "run", "v", 200)
    names = {f"q{n}": n / 100 for n in (5, 50, 95, 99)}
    got = runs.merged_quantiles(sketches.withColumn("all", F.lit(1)), ["all"], names, 200).first()
    every = np.sort([v for _, v in values])
    assert got["runs"] == 8 and got["n"] == len(every)
    for name, q in names.items():
        assert abs(np.searchsorted(every, got[name], "right") / len(every) - q) < 0.0133 * 2  # bound of a sketch of 200
    few = runs.merged_quantiles(runs.run_sketches(d, "run", "v"), ["run"], {"p50": 0.5}).collect()
    for x in few:
        mine = sorted(v for run, v in values if run == x["run"])
        assert x["p50"] == mine[1999]  # exact while a run fits


def test_index_search_equals_a_full_scan(spark, tmp_path):
    r = np.random.default_rng(5)
    x = r.normal(size=(700, 12))
    x[300:340] = x[7]  # ties
    x[340:360] = x[7] + r.normal(size=(20, 12)) * 1e-9
    rows = [(k, v.tolist()) for k, v in enumerate(x)] + [(900, [0.0] * 12), (901, None), (902, [1.0, 2.0]), (903, [float("nan")] * 12), (904, (x[7] * 1e30).tolist()), (905, [])]
    d = spark.createDataFrame(rows, "id long, v array<double>").repartition(3)
    path = str(tmp_path / "index")
    vectors.build_index(d, "id", "v", path)
    queries = {1: x[7].tolist(), 2: r.normal(size=12).tolist(), 3: [0.0] * 12, 4: [3.0, 1.0]}
    for k in (1, 10, 25):
        got = vectors.search_index(spark, path, d, "id", "v", queries, k).collect()
        for q, v in queries.items():
            full = search.top_k(d.where("id NOT IN (901, 903)"), v, "id", "v", k).collect()
            mine = sorted((g["place"], g["key"]) for g in got if g["query"] == q)
            assert [key for _, key in mine] == [f["id"] for f in full], (k, q)


def test_top_k_orders_by_the_exact_cosine(spark):
    d = spark.createDataFrame([(1, [1.0, 0.0005]), (2, [1.0, 0.0004]), (3, [1.0, 0.0])], "id long, v array<double>")
    got = search.top_k(d, [1.0, 0.0], "id", "v", 3)
    assert [r["id"] for r in got.collect()] == [3, 2, 1] and {r["similarity"] for r in got.collect()} == {1.0}
    assert [r["id"] for r in search.top_k(d, [1.0, 0.0], "id", "v", 3, least=1 - 1e-9).collect()] == [3]


def test_numbers_run_over_the_whole_table(spark):
    d = spark.range(1000).selectExpr("(id * 7919) % 1009 AS k").repartition(5)
    got = sorted((r["number"], r["k"]) for r in external.numbered(d, "k").collect())
    assert [n for n, _ in got] == list(range(1000)) and [k for _, k in got] == sorted(k for _, k in got)
    told = external.deliver(d, "k", "long", ["k"], lambda rows, mark: None, size=64, marked=True).collect()
    assert {c: sum(r["chunk"] == c for r in told) for c in {r["chunk"] for r in told}} == {**{c: 64 for c in range(15)}, 15: 40}
    again = external.deliver(d, "k", "long", ["k"], lambda rows, mark: None, size=64, marked=True).collect()
    assert {(r["k"], r["mark"]) for r in told} == {(r["k"], r["mark"]) for r in again} and len({r["mark"] for r in told}) == 16


def test_running_rows_in_one_range_and_in_many(spark, monkeypatch):
    r = random.Random(4)
    d = spark.createDataFrame([(k, r.randint(0, 60), r.randint(0, 60)) for k in range(400)], "id int, a int, b int")
    one = metrics.spearman(d, "a", "b").first()
    monkeypatch.setattr(metrics, "RANGE_ROWS", 7)
    many = metrics.spearman(d, "a", "b").first()
    assert one["n"] == many["n"] == 400 and one["rho"] == pytest.approx(many["rho"], abs=1e-12)


@pytest.mark.parametrize("rows", [10_000, 9])
def test_isotonic_blocks_equal_a_plain_fit(spark, monkeypatch, rows):
    monkeypatch.setattr(metrics, "RANGE_ROWS", rows)
    monkeypatch.setattr(metrics, "FAN_IN", 3)
    r = random.Random(11)
    data = [(x := r.choice([r.random() * 100, float(r.randint(0, 20))]), x / 30 + r.gauss(0, 1)) for _ in range(500)]
    d = spark.createDataFrame([*data, (None, 1.0), (3.0, None)], "x double, y double")
    got = sorted(tuple(b) for b in metrics.isotonic_blocks(d, "x", "y").collect())
    xs = sorted({x for x, _ in data})
    ys, ws = (np.array(v, float) for v in zip(*[(np.mean([b for a, b in data if a == x]), sum(a == x for a, _ in data)) for x in xs], strict=True))
    want = metrics.pool(ys, ws)
    assert [y for lo, hi, y, _ in got for x in xs if lo <= x <= hi] == pytest.approx(want.tolist(), abs=1e-9)
    assert sum(w for *_, w in got) == 500 and all(a[2] < b[2] for a, b in zip(got, got[1:], strict=False))
    c = metrics.Calibrator.fit(d, "x", "y", scale=1, grid=None)
    assert c.monotone() and {x for x in c.xs if 0 < x < 100} <= set(xs)
