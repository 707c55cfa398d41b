"""Streams over events in several micro-batches: limits, memories and windows with late rows, each with SQL of the same rules."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folio.plans.registry import query, table
from folio.session import scratch_path
from folio.streaming import events as streams

#: Weeks of events arrive one after the other; with delays, some rows come one or two batches later.
WEEK = "CASE WHEN ts < TIMESTAMP '2024-01-08' THEN 0 WHEN ts < TIMESTAMP '2024-01-15' THEN 1 WHEN ts < TIMESTAMP '2024-01-22' THEN 2 ELSE 3 END"
DELAYED = f"least(3, {WEEK} + CASE event_id % 10 WHEN 3 THEN 2 WHEN 4 THEN 1 ELSE 0 END)"
BATCHES = 4


def arrivals(spark, sf_dir, batch: str, where: str = "true", batches: int = BATCHES) -> DataFrame:
    """events as a stream whose micro-batches are the numbers of `batch`: each is written as one file, the next one after it."""
    landed = scratch_path(spark)
    e = table(spark, sf_dir, "events").where(where).withColumn("_b", F.expr(batch.replace("TIMESTAMP '", "timestamp_ntz'"))).persist()
    for b in range(batches):
        e.where(F.col("_b") == b).drop("_b").coalesce(1).write.mode("append").parquet(landed)
    e.unpersist()
    return streams.event_stream(spark, landed, 1)


_TIMED = "SELECT event_id, user_id, epoch_us(ts) AS t, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS r FROM events"
_KEPT = "list_filter(w.times, lambda x: x > e.t - 172800000000)"


@query("stream_rate_limit", f"""WITH RECURSIVE e AS ({_TIMED}), w AS (SELECT user_id, event_id, r, [t] AS times, TRUE AS accepted FROM e WHERE r = 1
UNION ALL SELECT e.user_id, e.event_id, e.r, CASE WHEN len({_KEPT}) < 3 THEN list_append({_KEPT}, e.t) ELSE {_KEPT} END, len({_KEPT}) < 3 FROM w JOIN e ON e.user_id = w.user_id AND e.r = w.r + 1) SELECT event_id, user_id, accepted FROM w""")
def stream_rate_limit(spark, sf_dir):
    """At most three accepted events of a user in two days; refused ones leave no mark."""
    s = streams.rate_limited(arrivals(spark, sf_dir, WEEK), "user_id", 3, 172_800)
    return streams.run_to_table(s, scratch_path(spark), scratch_path(spark))


@query("stream_seen_ids", "SELECT event_id, user_id, coalesce(ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) > INTERVAL 48 HOUR, TRUE) AS is_new FROM events")
def stream_seen_ids(spark, sf_dir):
    """Ids unseen for two days are new again; a second run begins with the memory that the first one left."""
    first = streams.remembered(arrivals(spark, sf_dir, WEEK, "ts < timestamp_ntz'2024-01-15'", 2))
    first = streams.run_to_table(first, scratch_path(spark), scratch_path(spark))
    kept = scratch_path(spark)
    streams.memory_of(first).write.parquet(kept)
    second = streams.remembered(arrivals(spark, sf_dir, f"{WEEK} - 2", "ts >= timestamp_ntz'2024-01-15'", 2), initial=spark.read.parquet(kept))
    second = streams.run_to_table(second, scratch_path(spark), scratch_path(spark))
    return first.unionByName(second).select("event_id", "user_id", "is_new")


@query("stream_ttl_cache", f"""WITH RECURSIVE e AS ({_TIMED}), w AS (SELECT user_id, event_id, r, t AS made, TRUE AS is_new FROM e WHERE r = 1
UNION ALL SELECT e.user_id, e.event_id, e.r, CASE WHEN e.t - w.made > 86400000000 THEN e.t ELSE w.made END, e.t - w.made > 86400000000 FROM w JOIN e ON e.user_id = w.user_id AND e.r = w.r + 1) SELECT event_id, user_id, NOT is_new AS hit FROM w""")
def stream_ttl_cache(spark, sf_dir):
    """A cache whose entries live a day from when they are made, whatever hits them."""
    s = streams.remembered(arrivals(spark, sf_dir, WEEK), hours=24, refresh=False)
    return streams.run_to_table(s, scratch_path(spark), scratch_path(spark)).select("event_id", "user_id", (~F.col("is_new")).alias("hit"))


def _late_sql(delay: str, final: str = "") -> str:
    """Rows with their batch and, as Spark has it, the watermark below which a row of the batch is late: the one that the batch before used to close windows."""
    return f"""a AS (SELECT *, {DELAYED} AS b FROM events), n AS (SELECT b, max(ts) AS m FROM a GROUP BY b), k AS (SELECT unnest(range(0, {BATCHES + 1})) AS b),
shut AS (SELECT k.b, max(n.m) - INTERVAL {delay} AS wm FROM k LEFT JOIN n ON n.b < k.b GROUP BY 1), late AS (SELECT b + 1 AS b, wm FROM shut), f AS (SELECT a.*, late.wm FROM a LEFT JOIN late ON late.b = a.b){final}"""


@query("stream_weekly", f"""WITH {_late_sql('1 DAY')}, w AS (SELECT *, wm IS NULL OR date_trunc('week', ts) + INTERVAL 7 DAY > wm AS counted FROM f)
SELECT CAST(CAST(date_trunc('week', ts) AS DATE) AS VARCHAR) AS week, event_type, count(*) AS n, round(sum(value), 4) AS total FROM w WHERE counted GROUP BY 1, 2 UNION ALL SELECT 'late', 'late', count(*), NULL FROM w WHERE NOT counted""")
def stream_weekly(spark, sf_dir):
    """Weeks in update mode, and how many rows came too late for theirs."""
    s = streams.tumbling_weeks(arrivals(spark, sf_dir, DELAYED))
    got = streams.run_updates(s, scratch_path(spark), scratch_path(spark), ["window", "event_type"])
    weeks = got.select(F.to_date("window.start").cast("string").alias("week"), "event_type", "n", F.round("total", 4).alias("total"))
    every, counted = table(spark, sf_dir, "events").agg(F.count(F.lit(1)).alias("all")), weeks.agg(F.sum("n").alias("counted"))
    late = every.crossJoin(F.broadcast(counted))  # one row each
    return weeks.unionByName(late.select(F.lit("late").alias("week"), F.lit("late").alias("event_type"), (F.col("all") - F.col("counted")).alias("n"), F.lit(None).cast("double").alias("total")))


@query("stream_sliding", f"""WITH {_late_sql('1 HOUR')}, s AS (SELECT f.*, time_bucket(INTERVAL 15 MINUTE, ts) - INTERVAL 15 MINUTE * i AS start FROM f, range(0, 4) AS r(i))
SELECT epoch_us(start) AS start, event_type, count(*) AS n FROM s WHERE (wm IS NULL OR start + INTERVAL 1 HOUR > wm) AND start + INTERVAL 1 HOUR <= (SELECT wm FROM shut WHERE b = {BATCHES}) GROUP BY 1, 2""")
def stream_sliding(spark, sf_dir):
    """Hours every quarter of an hour in append mode: a window comes out once, when the watermark has passed it."""
    s = streams.sliding(arrivals(spark, sf_dir, DELAYED))
    return streams.run_to_table(s, scratch_path(spark), scratch_path(spark)).select(F.unix_micros("window.start").alias("start"), "event_type", "n")


def _session_sql(k: int) -> str:
    """Sessions open after batch k - 1 and the rows of batch k that are not late: closed ones (c) and the rows of open ones (o)."""
    new = f"SELECT user_id, ts, event_id FROM f WHERE b = {k} AND (wm IS NULL OR ts + INTERVAL 30 MINUTE > wm)" if k < BATCHES else "SELECT user_id, ts, event_id FROM f WHERE FALSE"
    rows = new if k == 0 else f"{new} UNION ALL SELECT user_id, ts, event_id FROM o{k - 1}"
    return f""", g{k} AS (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) <= INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS x FROM ({rows})),
s{k} AS (SELECT *, sum(x) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS sid FROM g{k}), m{k} AS (SELECT user_id, sid, min(ts) AS start, count(*) AS n, coalesce(max(ts) + INTERVAL 30 MINUTE <= (SELECT wm FROM shut WHERE b = {k}), FALSE) AS done FROM s{k} GROUP BY 1, 2),
o{k} AS (SELECT s{k}.user_id, ts, event_id FROM s{k} JOIN m{k} USING (user_id, sid) WHERE NOT done)"""


@query("stream_sessions", f"WITH {_late_sql('1 HOUR')}{''.join(_session_sql(k) for k in range(BATCHES + 1))} " + " UNION ALL ".join(f"SELECT user_id, epoch_us(start) AS start, n FROM m{k} WHERE done" for k in range(BATCHES + 1)))
def stream_sessions(spark, sf_dir):
    """Sessions of half an hour in append mode; a row that comes late joins what is still open."""
    s = streams.sessions(arrivals(spark, sf_dir, DELAYED))
    return streams.run_to_table(s, scratch_path(spark), scratch_path(spark)).select("user_id", F.unix_micros("session_window.start").alias("start"), "n")
