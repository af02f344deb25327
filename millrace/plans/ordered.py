"""Ordered analytics."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import aggregate as agg
from millrace.operators import ordered as od
from millrace.plans.sales import _round
from millrace.registry import query
from millrace.tables import FACT_SALES_SQL, events, fact_sales, table


def _user_events(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "value")


@query("rolling_7_rows", "WIN-01", """
SELECT event_id, user_id,
  CASE WHEN count(value) OVER w = 7 THEN round(avg(value) OVER w, 4) END AS value_rolling_7
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""")
def rolling_7_rows(spark, sf_dir):
    out = od.rolling_aggregation(
        _user_events(spark, sf_dir), "ts", ["value"], 7, "mean", ["user_id"], ["event_id"]
    )
    return _round(out.select("event_id", "user_id", "value_rolling_7"))


@query("rolling_std_unkeyed", "WIN-01", """
SELECT event_id, CASE WHEN count(value) OVER w = 30 THEN round(stddev(value) OVER w, 4) END AS value_rolling_30
FROM events WINDOW w AS (ORDER BY ts, event_id ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)""")
def rolling_std_unkeyed(spark, sf_dir):
    out = od.rolling_aggregation(_user_events(spark, sf_dir), "ts", ["value"], 30, "std", (), ["event_id"])
    return _round(out.select("event_id", "value_rolling_30"))


@query("growth_rate", "WIN-02", f"""
WITH {FACT_SALES_SQL},
d AS (SELECT transaction_date, region, sum(total_amount) AS revenue FROM fact_sales GROUP BY 1, 2)
SELECT CAST(transaction_date AS VARCHAR) AS transaction_date, region,
  round((revenue / lag(revenue) OVER w - 1) * 100, 4) AS growth_pct
FROM d WINDOW w AS (PARTITION BY region ORDER BY transaction_date)""")
def growth_rate(spark, sf_dir):
    daily = agg.sales_by_region(fact_sales(spark, sf_dir))
    out = od.growth_rate(daily, ["transaction_date"], "total_revenue", "growth_pct", ["region"])
    return _round(out.select(F.col("transaction_date").cast("string"), "region", "growth_pct"))


@query("cumulative_value", "WIN-03", """
SELECT event_id, round(sum(value) OVER (ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING), 3) AS running_value
FROM events""")
def cumulative_value(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("event_id", "ts", "value")
    out = od.cumulative(rows, ["ts", "event_id"], "value", "running_value")
    return _round(out.select("event_id", "running_value"), 3)


@query("average_rank", "WIN-04", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  rank() OVER (ORDER BY l_quantity DESC) + (count(*) OVER (PARTITION BY l_quantity) - 1) / 2 AS value_rank
FROM lineitem""")
def average_rank(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity"
    )
    return od.average_rank(rows, "l_quantity", "value_rank").drop("l_quantity")


@query("recent_n_stats", "WIN-05 SRT-03", """
SELECT user_id, count(*) AS n, round(avg(value), 4) AS avg_value, max(value) AS max_value
FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
WHERE rn <= 10 GROUP BY 1""")
def recent_n_stats(spark, sf_dir):
    recent = od.first_rows(
        _user_events(spark, sf_dir), [F.desc("ts"), F.desc("event_id")], 10, ["user_id"]
    )
    out = recent.groupBy("user_id").agg(
        F.count("*").alias("n"), F.avg("value").alias("avg_value"), F.max("value").alias("max_value")
    )
    return _round(out)


@query("first_last_delta", "WIN-06 AGG-26", """
SELECT user_id, round(arg_max(value, event_id) - arg_min(value, event_id), 4) AS value_delta,
  round(avg(value), 4) AS avg_value, max(value) AS max_value, min(value) AS min_value
FROM events GROUP BY 1""")
def first_last_delta(spark, sf_dir):
    from millrace.operators.monitoring import sample_summary

    rows = events(spark, sf_dir)
    return _round(sample_summary(rows, "event_id", ["value"], ["user_id"]))


@query("chunks_of_rows", "SET-04", """
SELECT (row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1) // 25 AS chunk, user_id, event_id
FROM events""")
def chunks_of_rows(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("event_id", "user_id", "ts")
    return od.chunk_rows(rows, ["ts", "event_id"], 25, partition_by=["user_id"]).drop("ts")


@query("top_k_values", "SRT-01 SRT-02 SRT-03", """
SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10""")
def top_k_values(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return rows.orderBy(F.desc("o_totalprice"), "o_orderkey").limit(10)


@query("ffill_values", "PRJ-05", """
WITH e AS (SELECT event_id, user_id, ts, CASE WHEN event_id % 3 = 0 THEN NULL ELSE value END AS value FROM events)
SELECT event_id, user_id, last_value(value IGNORE NULLS) OVER
  (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS value FROM e""")
def ffill_values(spark, sf_dir):
    rows = _user_events(spark, sf_dir).withColumn("value", F.when(F.col("event_id") % 3 != 0, F.col("value")))
    return od.forward_fill(rows, ["ts", "event_id"], ["value"], ["user_id"]).drop("ts")
