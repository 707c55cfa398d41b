"""Queries over events standing in for scoring events, runs, votes and status changes."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from folio.functions import rules
from folio.operators import change, match, metrics, rank
from folio.plans.registry import query, table

EV = "ev AS (SELECT event_id, user_id AS pub_id, event_type AS mode, CAST(ts AS DATE) AS run_day, ts, value, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)"


def scored(spark, sf_dir) -> DataFrame:
    """events as scoring events: user is the publication, event type the mode, day the run, value the score."""
    e = table(spark, sf_dir, "events")
    return e.select("event_id", F.col("user_id").alias("pub_id"), F.col("event_type").alias("mode"), F.to_date("ts").alias("run_day"), "ts", "value", F.get_json_object("props", "$.k").cast("int").alias("k"))


@query("latest_event_per_pub", f"WITH {EV}, r AS (SELECT *, row_number() OVER (PARTITION BY pub_id ORDER BY ts DESC, event_id DESC) AS n FROM ev) SELECT pub_id, event_id, value FROM r WHERE n = 1")
def latest_event_per_pub(spark, sf_dir):
    d = scored(spark, sf_dir).withColumn("o", F.struct("ts", "event_id"))
    return match.latest(d, ["pub_id"], "o").select("pub_id", "event_id", "value")


@query("oldest_event_per_run", f"WITH {EV}, r AS (SELECT *, row_number() OVER (PARTITION BY run_day, pub_id ORDER BY ts, event_id) AS n FROM ev) SELECT CAST(run_day AS VARCHAR) AS run_day, pub_id, event_id FROM r WHERE n = 1")
def oldest_event_per_run(spark, sf_dir):
    d = scored(spark, sf_dir).withColumn("o", F.struct("ts", "event_id"))
    return match.latest(d, ["run_day", "pub_id"], "o", keep="oldest").select(F.col("run_day").cast("string").alias("run_day"), "pub_id", "event_id")


@query("window_filter_counts", f"WITH {EV} SELECT count(*) FILTER (WHERE ts BETWEEN TIMESTAMP '2024-01-08' AND TIMESTAMP '2024-01-15') AS inside, count(*) FILTER (WHERE ts < TIMESTAMP '2024-01-08') AS before, count(*) FILTER (WHERE ts > TIMESTAMP '2024-01-15') AS after, count(*) FILTER (WHERE ts IS NULL) AS missing FROM ev")
def window_filter_counts(spark, sf_dir):
    lo, hi = F.lit("2024-01-08").cast("timestamp_ntz"), F.lit("2024-01-15").cast("timestamp_ntz")
    t = F.col("ts")
    return scored(spark, sf_dir).agg(F.count_if(t.between(lo, hi)).alias("inside"), F.count_if(t < lo).alias("before"), F.count_if(t > hi).alias("after"), F.count_if(t.isNull()).alias("missing"))


@query("week_range", "SELECT event_id, value FROM events WHERE ts >= TIMESTAMP '2024-01-08' AND ts < TIMESTAMP '2024-01-15'")
def week_range(spark, sf_dir):
    return table(spark, sf_dir, "events").where("ts >= timestamp_ntz'2024-01-08' AND ts < timestamp_ntz'2024-01-15'").select("event_id", "value")


@query("run_history_topk", f"WITH {EV} SELECT CAST(run_day AS VARCHAR) AS run_day, count(*) AS n, count(DISTINCT pub_id) AS pubs FROM ev GROUP BY 1 ORDER BY 1 DESC LIMIT 10")
def run_history_topk(spark, sf_dir):
    d = scored(spark, sf_dir).groupBy("run_day").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("pub_id").alias("pubs")).orderBy(F.desc("run_day")).limit(10)
    return d.withColumn("run_day", F.col("run_day").cast("string"))


@query("run_mode_averages", f"WITH {EV} SELECT mode, count(*) AS n, round(avg(value), 6) AS mean FROM ev GROUP BY 1")
def run_mode_averages(spark, sf_dir):
    return scored(spark, sf_dir).groupBy("mode").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("value"), 6).alias("mean"))


@query("history_bars", f"WITH {EV}, r AS (SELECT run_day, count(*) AS n FROM ev GROUP BY 1) SELECT CAST(run_day AS VARCHAR) AS run_day, n, repeat('#', CAST(floor(n * 50 / (SELECT max(n) FROM r)) AS INTEGER)) AS bar FROM r")
def history_bars(spark, sf_dir):
    r = scored(spark, sf_dir).groupBy("run_day").agg(F.count(F.lit(1)).alias("n"))
    d = r.crossJoin(F.broadcast(r.agg(F.max("n").alias("m"))))  # one row
    return d.select(F.col("run_day").cast("string").alias("run_day"), "n", F.repeat(F.lit("#"), F.floor(F.col("n") * 50 / F.col("m")).cast("int")).alias("bar"))


@query("coalesce_upsert", f"""WITH {EV}, r AS (SELECT *, row_number() OVER (PARTITION BY pub_id ORDER BY ts DESC, event_id DESC) AS n FROM ev WHERE run_day < DATE '2024-01-10'), o AS (SELECT pub_id, mode, k, value FROM r WHERE n = 1),
r2 AS (SELECT *, row_number() OVER (PARTITION BY pub_id ORDER BY ts DESC, event_id DESC) AS n FROM ev WHERE run_day >= DATE '2024-01-10' AND pub_id % 3 <> 0), w AS (SELECT pub_id, mode, CASE WHEN k % 2 = 0 THEN k END AS k, value FROM r2 WHERE n = 1)
SELECT coalesce(o.pub_id, w.pub_id) AS pub_id, CASE WHEN o.pub_id IS NULL THEN w.mode ELSE o.mode END AS mode, coalesce(w.k, o.k) AS k, CASE WHEN w.pub_id IS NULL THEN o.value ELSE w.value END AS value, CASE WHEN o.pub_id IS NULL THEN 'inserted' WHEN w.pub_id IS NULL THEN 'untouched' ELSE 'updated' END AS merge_kind FROM o FULL JOIN w ON o.pub_id = w.pub_id""")
def coalesce_upsert(spark, sf_dir):
    d = scored(spark, sf_dir).withColumn("o", F.struct("ts", "event_id"))
    cols = ["pub_id", "mode", "k", "value"]
    old = match.latest(d.where("run_day < date'2024-01-10'"), ["pub_id"], "o").select(*cols)
    new = match.latest(d.where("run_day >= date'2024-01-10' AND pub_id % 3 <> 0"), ["pub_id"], "o").select(*cols).withColumn("k", F.when(F.col("k") % 2 == 0, F.col("k")))
    return change.upsert(old, new, ["pub_id"], {"mode": "keep", "k": "fill", "value": "take"})


@query("insert_or_ignore", f"WITH {EV}, o AS (SELECT DISTINCT pub_id FROM ev WHERE run_day < DATE '2024-01-03'), n AS (SELECT DISTINCT pub_id FROM ev) SELECT pub_id FROM o UNION ALL SELECT pub_id FROM n WHERE pub_id NOT IN (SELECT pub_id FROM o)")
def insert_or_ignore(spark, sf_dir):
    d = scored(spark, sf_dir)
    return change.insert_or_ignore(d.where("run_day < date'2024-01-03'").select("pub_id").distinct(), d.select("pub_id").distinct(), ["pub_id"])


@query("vote_upsert", f"WITH {EV}, v AS (SELECT event_id, pub_id, CASE WHEN k % 3 <> 0 THEN k END AS ip, value, ts FROM ev), r AS (SELECT *, row_number() OVER (PARTITION BY pub_id, ip ORDER BY ts DESC, event_id DESC) AS n FROM v WHERE ip IS NOT NULL) SELECT pub_id, ip, event_id FROM r WHERE n = 1 UNION ALL SELECT pub_id, ip, event_id FROM v WHERE ip IS NULL")
def vote_upsert(spark, sf_dir):
    d = scored(spark, sf_dir).withColumn("ip", F.when(F.col("k") % 3 != 0, F.col("k"))).withColumn("o", F.struct("ts", "event_id"))
    return change.votes(d.select("pub_id", "ip", "event_id", "o"), ["pub_id"], "ip", "o").select("pub_id", "ip", "event_id")


@query("status_transition", f"WITH {EV} SELECT event_id, CASE WHEN mode IN ('click', 'view') AND value < 50 THEN 'cutoff' ELSE mode END AS status FROM ev")
def status_transition(spark, sf_dir):
    return change.transition(scored(spark, sf_dir).withColumn("status", F.col("mode")), "status", "cutoff", ("click", "view"), F.col("value") < 50).select("event_id", "status")


@query("unique_guard", f"WITH {EV} SELECT pub_id, CAST(run_day AS VARCHAR) AS run_day, count(*) AS n FROM ev GROUP BY 1, 2 HAVING count(*) > 1")
def unique_guard(spark, sf_dir):
    return change.duplicates(scored(spark, sf_dir).withColumn("run_day", F.col("run_day").cast("string")), ["pub_id", "run_day"])


@query("consistency_counts", f"WITH {EV}, a AS (SELECT DISTINCT pub_id FROM ev WHERE mode = 'click'), b AS (SELECT DISTINCT pub_id FROM ev WHERE value > 90) SELECT (SELECT count(*) FROM a WHERE pub_id NOT IN (SELECT pub_id FROM b)) AS left_only, (SELECT count(*) FROM b WHERE pub_id NOT IN (SELECT pub_id FROM a)) AS right_only, (SELECT count(*) FROM a WHERE pub_id IN (SELECT pub_id FROM b)) AS both")
def consistency_counts(spark, sf_dir):
    d = scored(spark, sf_dir)
    return change.consistency(d.where("mode = 'click'"), d.where("value > 90"), "pub_id")


def _pairs(spark, sf_dir) -> DataFrame:
    v = F.col("value").cast("int") % 101
    d = scored(spark, sf_dir).withColumn("s", v)
    return d.groupBy("pub_id").agg(F.max(F.when(F.col("mode") == "click", F.col("s"))).alias("a"), F.max(F.when(F.col("mode") == "view", F.col("s"))).alias("b"))


_PAIRS = f"{EV}, p AS (SELECT pub_id, max(CASE WHEN mode = 'click' THEN CAST(trunc(value) AS INTEGER) % 101 END) AS a, max(CASE WHEN mode = 'view' THEN CAST(trunc(value) AS INTEGER) % 101 END) AS b FROM ev GROUP BY 1)"


@query("agreement_level", f"WITH {_PAIRS} SELECT pub_id, a, b, CASE WHEN abs(a - b) <= 15 THEN 'high' WHEN abs(a - b) <= 30 THEN 'moderate' WHEN a IS NOT NULL AND b IS NOT NULL THEN 'low' END AS agreement FROM p")
def agreement_level(spark, sf_dir):
    return _pairs(spark, sf_dir).withColumn("agreement", rules.agreement(F.col("a"), F.col("b")))


@query("fallback_score", f"WITH {EV}, r AS (SELECT pub_id, event_id, CAST(trunc(value) AS INTEGER) % 101 AS s, CASE k % 3 WHEN 0 THEN 'low' WHEN 1 THEN 'medium' ELSE 'high' END AS c, k % 3 AS o FROM ev) SELECT pub_id, CAST(round_even(avg(s), 0) AS INTEGER) AS final_score, arg_min(c, o) AS confidence, count(*) AS n_reviews FROM r GROUP BY 1")
def fallback_score(spark, sf_dir):
    k = F.col("k") % 3
    r = scored(spark, sf_dir).select("pub_id", F.col("event_id").alias("reviewer"), (F.col("value").cast("int") % 101).alias("score"), F.when(k == 0, "low").when(k == 1, "medium").otherwise("high").alias("confidence"), F.col("mode").alias("summary"))
    return rules.fallback_evaluation(r).select("pub_id", "final_score", "confidence", "n_reviews")


@query("signal_merge", f"WITH {_PAIRS} SELECT pub_id, coalesce(a % 2 = 0, FALSE) OR coalesce(b % 3 = 0, FALSE) AS breath, CASE WHEN a IS NULL AND b IS NULL THEN 'none' WHEN a IS NULL THEN 'colon' WHEN b IS NULL THEN 'other' ELSE 'colon' END AS cancer_type FROM p")
def signal_merge(spark, sf_dir):
    d = _pairs(spark, sf_dir)
    a = F.when(F.col("a").isNotNull(), F.create_map(F.lit("breath_voc"), (F.col("a") % 2 == 0).cast("string"), F.lit("cancer_type"), F.lit("other")))
    b = F.when(F.col("b").isNotNull(), F.create_map(F.lit("breath_voc"), (F.col("b") % 3 == 0).cast("string"), F.lit("cancer_type"), F.lit("Colon")))
    m = rules.merge_signals(a, b)
    return d.select("pub_id", (m["breath_based"] == "true").alias("breath"), m["cancer_type"].alias("cancer_type"))


@query("json_signals", "SELECT CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, count(*) AS n, round(avg(value), 6) AS mean FROM events GROUP BY 1")
def json_signals(spark, sf_dir):
    return scored(spark, sf_dir).groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("value"), 6).alias("mean"))


@query("neighbour_lane", f"WITH {EV}, s AS (SELECT pub_id AS pmid, CAST(round(avg(value), 4) AS DOUBLE) AS score FROM ev GROUP BY 1 ORDER BY score DESC, pmid LIMIT 10), e AS (SELECT DISTINCT pub_id AS pmid, k AS neighbour FROM ev), r AS (SELECT e.*, row_number() OVER (PARTITION BY e.pmid ORDER BY neighbour) AS n FROM e JOIN s ON e.pmid = s.pmid) SELECT DISTINCT neighbour FROM r WHERE n <= 10")
def neighbour_lane(spark, sf_dir):
    d = scored(spark, sf_dir)
    seeds = d.groupBy(F.col("pub_id").alias("pmid")).agg(F.round(F.avg("value"), 4).alias("score"))
    edges = d.select(F.col("pub_id").alias("pmid"), F.col("k").alias("neighbour"), F.col("k").alias("place")).distinct()
    return match.neighbour_lane(seeds, edges)


@query("byte_budget", f"""WITH RECURSIVE {EV}, i AS (SELECT run_day, event_id, value, row_number() OVER (PARTITION BY run_day ORDER BY value DESC, event_id) AS r, CAST(k AS BIGINT) * 100 + 37 AS size FROM ev), t AS (SELECT * FROM i),
w AS (SELECT run_day, r, CASE WHEN size <= 9000 THEN size ELSE 0 END AS used, size <= 9000 AS attached FROM t WHERE r = 1 UNION ALL SELECT t.run_day, t.r, CASE WHEN w.used + t.size <= 9000 THEN w.used + t.size ELSE w.used END, w.used + t.size <= 9000 FROM w JOIN t ON t.run_day = w.run_day AND t.r = w.r + 1)
SELECT CAST(run_day AS VARCHAR) AS run_day, CAST(r AS BIGINT) AS r, attached FROM w""")
def byte_budget(spark, sf_dir):
    d = scored(spark, sf_dir).withColumn("r", F.row_number().over(Window.partitionBy("run_day").orderBy(F.desc("value"), "event_id"))).withColumn("size", F.col("k") * 100 + 37)
    return rank.byte_budget(d, "run_day", "r", "size", 9000).select(F.col("run_day").cast("string").alias("run_day"), F.col("r").cast("long").alias("r"), "attached")


@query("rate_limit_frame", "SELECT event_id, count(*) OVER (PARTITION BY user_id ORDER BY epoch(ts) RANGE BETWEEN 3599 PRECEDING AND CURRENT ROW) AS in_hour FROM events")
def rate_limit_frame(spark, sf_dir):
    w = Window.partitionBy("user_id").orderBy(F.col("s")).rangeBetween(-3599, 0)
    e = table(spark, sf_dir, "events").withColumn("s", F.unix_micros(F.col("ts").cast("timestamp")) / 1e6)
    return e.select("event_id", F.count(F.lit(1)).over(w).alias("in_hour"))


@query("weekly_windows", "SELECT CAST(date_trunc('week', ts) AS DATE)::VARCHAR AS week, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2")
def weekly_windows(spark, sf_dir):
    d = table(spark, sf_dir, "events").groupBy(F.window("ts", "7 days", startTime="4 days").alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("total"))
    return d.select(F.to_date("w.start").cast("string").alias("week"), "event_type", "n", "total")


@query("sessions", "WITH g AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS b, event_id FROM events), s AS (SELECT user_id, sum(b) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS sid FROM g) SELECT user_id, CAST(count(*) AS BIGINT) AS n FROM s GROUP BY user_id, sid")
def sessions(spark, sf_dir):
    return table(spark, sf_dir, "events").groupBy("user_id", F.session_window("ts", "30 minutes")).agg(F.count(F.lit(1)).alias("n")).select("user_id", "n")


@query("dense_daily_ranks", f"WITH {EV}, d AS (SELECT run_day, mode, count(*) AS n FROM ev GROUP BY 1, 2) SELECT CAST(run_day AS VARCHAR) AS run_day, mode, n, dense_rank() OVER (PARTITION BY run_day ORDER BY n DESC) AS place FROM d")
def dense_daily_ranks(spark, sf_dir):
    d = scored(spark, sf_dir).groupBy("run_day", "mode").agg(F.count(F.lit(1)).alias("n"))
    return d.select(F.col("run_day").cast("string").alias("run_day"), "mode", "n", F.dense_rank().over(Window.partitionBy("run_day").orderBy(F.desc("n"))).cast("long").alias("place"))


@query("event_spearman_by_mode", f"WITH {EV}, v AS (SELECT mode, value AS s, k AS r FROM ev), q AS (SELECT mode, rank() OVER (PARTITION BY mode ORDER BY s) + (count(*) OVER (PARTITION BY mode, s) - 1) / 2.0 AS a, rank() OVER (PARTITION BY mode ORDER BY r) + (count(*) OVER (PARTITION BY mode, r) - 1) / 2.0 AS b FROM v) SELECT mode, round(corr(a, b), 6) AS rho, count(*) AS n FROM q GROUP BY 1")
def event_spearman_by_mode(spark, sf_dir):
    return metrics.spearman(scored(spark, sf_dir), "value", "k", "mode").select("mode", F.round("rho", 6).alias("rho"), "n")


AS_OF = datetime(2024, 1, 31)


@query("ttl_cache", f"WITH {EV}, c AS (SELECT pub_id, max(ts) AS t FROM ev GROUP BY 1) SELECT count(*) FILTER (WHERE t >= TIMESTAMP '2024-01-31' - INTERVAL 1 DAY) AS fresh, count(*) FILTER (WHERE t < TIMESTAMP '2024-01-31' - INTERVAL 1 DAY) AS stale FROM c")
def ttl_cache(spark, sf_dir):
    c = scored(spark, sf_dir).groupBy("pub_id").agg(F.max("ts").cast("timestamp").alias("cached_at"))
    hit, miss = match.split_cached(c.select("pub_id"), c, "pub_id", AS_OF, 1)
    n = lambda d, name: d.agg(F.count(F.lit(1)).alias(name))
    return n(hit, "fresh").crossJoin(F.broadcast(n(miss, "stale")))  # one row each
