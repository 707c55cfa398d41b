"""Streams with state over several micro-batches, against plain walks."""

import random
from datetime import datetime, timedelta

import pytest

from folio.streaming import events as streams

BEGIN = datetime(2024, 1, 1)


def landed(spark, path, batches):
    """The given lists of (event_id, minutes, user_id) as micro-batches, one file each."""
    for rows in batches:
        spark.createDataFrame([(i, BEGIN + timedelta(minutes=m), u, "x", 1.0, "{}") for i, m, u in rows], streams.EVENTS).coalesce(1).write.mode("append").parquet(path)
    return streams.event_stream(spark, path, 1)


def made(seed, n=160, users=6, span=3000, parts=4):
    r = random.Random(seed)
    rows = sorted(((k, r.randint(0, span), r.randint(1, users)) for k in range(n)), key=lambda x: (x[1], x[0]))
    return [rows[k * n // parts : (k + 1) * n // parts] for k in range(parts)]


def test_limit_counts_accepted_events_only(spark, tmp_path):
    batches = made(1)
    s = streams.rate_limited(landed(spark, str(tmp_path / "e"), batches), "user_id", 2, 90 * 60)
    got = {r["event_id"]: r["accepted"] for r in streams.run_to_table(s, str(tmp_path / "o"), str(tmp_path / "c")).collect()}
    want, taken = {}, {}
    for i, m, u in (x for b in batches for x in b):
        near = [t for t in taken.setdefault(u, []) if t > m - 90]
        want[i] = len(near) < 2
        taken[u] = near + [m] * want[i]
    assert got == want and 0 < sum(want.values()) < len(want)


@pytest.mark.parametrize("refresh", [True, False])
def test_memory_expires_and_goes_on_in_a_second_run(spark, tmp_path, refresh):
    batches = made(2)
    want, seen = {}, {}
    for i, m, u in (x for b in batches for x in b):
        want[i] = u not in seen or m - seen[u] > 300
        if want[i] or refresh:
            seen[u] = m
    first = streams.remembered(landed(spark, str(tmp_path / "e1"), batches[:2]), hours=5, refresh=refresh, shards=3)
    first = streams.run_to_table(first, str(tmp_path / "o1"), str(tmp_path / "c1"))
    kept = streams.memory_of(first, refresh=refresh)
    second = streams.remembered(landed(spark, str(tmp_path / "e2"), batches[2:]), hours=5, refresh=refresh, initial=kept, shards=3)
    second = streams.run_to_table(second, str(tmp_path / "o2"), str(tmp_path / "c2"))
    assert {r["event_id"]: r["is_new"] for r in first.unionByName(second).collect()} == want
    assert any(want.values()) and not all(want.values())
    last = {r["user_id"]: r["at"] for r in streams.memory_of(second, refresh=refresh, before=kept).collect()}
    assert last == {u: int((BEGIN + timedelta(minutes=m) - datetime(1970, 1, 1)).total_seconds() * 1e6) for u, m in seen.items()}


def test_last_update_of_a_window_counts(spark, tmp_path):
    batches = [[(1, 10, 1), (2, 20, 1)], [(3, 30, 1), (4, 60 * 24 * 20, 1)], [(5, 40, 1)], [(6, 50, 1)]]
    s = streams.tumbling_weeks(landed(spark, str(tmp_path / "e"), batches))
    got = streams.run_updates(s, str(tmp_path / "o"), str(tmp_path / "c"), ["window", "event_type"]).collect()
    # the third batch is judged by the watermark before the second one, the fourth comes too late
    assert sorted((r["window"]["start"], r["n"]) for r in got) == [(datetime(2024, 1, 1), 4), (datetime(2024, 1, 15), 1)]
