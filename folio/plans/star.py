"""Relational breadth over the star schema."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from folio.plans.registry import query, table

Q1 = "SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 2) AS sum_qty, round(sum(l_extendedprice), 2) AS sum_price, round(sum(l_extendedprice * (1 - l_discount)), 2) AS sum_disc, round(avg(l_discount), 6) AS avg_disc, count(*) AS n FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02' GROUP BY 1, 2"


@query("pricing_summary", Q1)
def pricing_summary(spark, sf_dir):
    l = table(spark, sf_dir, "lineitem").where("l_shipdate <= timestamp_ntz'1998-09-02'")
    return l.groupBy("l_returnflag", "l_linestatus").agg(F.round(F.sum("l_quantity"), 2).alias("sum_qty"), F.round(F.sum("l_extendedprice"), 2).alias("sum_price"), F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("sum_disc"), F.round(F.avg("l_discount"), 6).alias("avg_disc"), F.count(F.lit(1)).alias("n"))


@query("nation_revenue", "SELECT n_name, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1")
def nation_revenue(spark, sf_dir):
    t = lambda n: table(spark, sf_dir, n)
    d = t("lineitem").join(t("orders"), F.col("l_orderkey") == F.col("o_orderkey")).join(t("customer"), F.col("o_custkey") == F.col("c_custkey")).join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return d.groupBy("n_name").agg(F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"))


@query("customers_without_orders", "SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)")
def customers_without_orders(spark, sf_dir):
    return table(spark, sf_dir, "customer").join(table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey")), "c_custkey", "left_anti").select("c_custkey")


@query("late_orders_semi", "SELECT o_orderkey FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R' AND l_quantity > 45)")
def late_orders_semi(spark, sf_dir):
    l = table(spark, sf_dir, "lineitem").where("l_returnflag = 'R' AND l_quantity > 45").select(F.col("l_orderkey").alias("o_orderkey"))
    return table(spark, sf_dir, "orders").join(l, "o_orderkey", "left_semi").select("o_orderkey")


@query("segment_rollup", "SELECT c_mktsegment, o_orderstatus, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ROLLUP (c_mktsegment, o_orderstatus)")
def segment_rollup(spark, sf_dir):
    d = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    return d.rollup("c_mktsegment", "o_orderstatus").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("status_cube", "SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY CUBE (o_orderstatus, o_orderpriority)")
def status_cube(spark, sf_dir):
    return table(spark, sf_dir, "orders").cube("o_orderstatus", "o_orderpriority").agg(F.count(F.lit(1)).alias("n"))


@query("top_orders_per_customer", "SELECT o_custkey, o_orderkey, r FROM (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS r FROM orders) WHERE r <= 3")
def top_orders_per_customer(spark, sf_dir):
    r = F.row_number().over(Window.partitionBy("o_custkey").orderBy(F.desc("o_totalprice"), "o_orderkey"))
    return table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", r.cast("long").alias("r")).where("r <= 3")


@query("running_spend", "SELECT o_orderkey, round(sum(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS UNBOUNDED PRECEDING), 2) AS spent, lag(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS previous FROM orders")
def running_spend(spark, sf_dir):
    w = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    return table(spark, sf_dir, "orders").select("o_orderkey", F.round(F.sum("o_totalprice").over(w.rowsBetween(Window.unboundedPreceding, 0)), 2).alias("spent"), F.lag("o_orderkey").over(w).alias("previous"))


@query("key_sets", "SELECT 'union' AS kind, count(*) AS n FROM (SELECT c_nationkey FROM customer UNION SELECT s_nationkey FROM supplier) UNION ALL SELECT 'intersect', count(*) FROM (SELECT c_nationkey FROM customer INTERSECT SELECT s_nationkey FROM supplier) UNION ALL SELECT 'except', count(*) FROM (SELECT c_nationkey FROM customer EXCEPT SELECT s_nationkey FROM supplier)")
def key_sets(spark, sf_dir):
    c, s = table(spark, sf_dir, "customer").select("c_nationkey"), table(spark, sf_dir, "supplier").select("s_nationkey")
    n = lambda d, k: d.agg(F.count(F.lit(1)).alias("n")).select(F.lit(k).alias("kind"), "n")
    return n(c.union(s).distinct(), "union").unionByName(n(c.intersect(s), "intersect")).unionByName(n(c.subtract(s), "except"))


@query("priority_pivot", "SELECT o_orderpriority, count(*) FILTER (WHERE o_orderstatus = 'F') AS f, count(*) FILTER (WHERE o_orderstatus = 'O') AS o FROM orders GROUP BY 1")
def priority_pivot(spark, sf_dir):
    d = table(spark, sf_dir, "orders").groupBy("o_orderpriority").pivot("o_orderstatus", ["F", "O"]).count()
    return d.select("o_orderpriority", F.coalesce("F", F.lit(0)).alias("f"), F.coalesce("O", F.lit(0)).alias("o"))


@query("part_size_quantiles", "SELECT p_brand, CAST(min(p_size) AS INTEGER) AS least, CAST(max(p_size) AS INTEGER) AS most, round(avg(p_retailprice), 3) AS mean, count(DISTINCT p_type) AS types FROM part GROUP BY 1")
def part_size_quantiles(spark, sf_dir):
    return table(spark, sf_dir, "part").groupBy("p_brand").agg(F.min("p_size").alias("least"), F.max("p_size").alias("most"), F.round(F.avg("p_retailprice"), 3).alias("mean"), F.count_distinct("p_type").alias("types"))


@query("full_nations", "SELECT coalesce(n_name, '-') AS nation, count(c_custkey) AS customers, count(DISTINCT s_suppkey) AS suppliers FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey LEFT JOIN supplier ON s_nationkey = n_nationkey GROUP BY 1")
def full_nations(spark, sf_dir):
    t = lambda n: table(spark, sf_dir, n)
    c = t("customer").groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("c"))
    s = t("supplier").groupBy("s_nationkey").agg(F.count(F.lit(1)).alias("s"))
    d = t("nation").join(c, F.col("n_nationkey") == F.col("c_nationkey"), "left").join(s, F.col("n_nationkey") == F.col("s_nationkey"), "left")
    # both sides are reduced before the join; the product of counts is what the row join would give
    return d.select(F.col("n_name").alias("nation"), (F.coalesce("c", F.lit(0)) * F.greatest(F.lit(1), F.coalesce("s", F.lit(0)))).alias("customers"), F.coalesce("s", F.lit(0)).alias("suppliers"))
