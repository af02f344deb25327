"""Sales summaries, resampling and profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import aggregate as agg
from millrace.operators import custom, metrics, profile, timeseries
from millrace.registry import query
from millrace.tables import FACT_SALES_SQL, events, fact_sales, table


def _round(df, digits=4, skip=()):
    """Round double columns: sums of doubles depend on their order."""
    return df.select(
        *[
            F.round(c, digits).alias(c) if t == "double" and c not in skip else F.col(c)
            for c, t in df.dtypes
        ]
    )


def _text_date(df, *columns):
    return df.withColumns({c: F.col(c).cast("string") for c in columns})


# The average is taken from the rounded revenue and rounded by arithmetic that is
# the same in every engine, so that exact halves do not differ.
@query("daily_sales_by_region", "AGG-02 JN-01", f"""
WITH {FACT_SALES_SQL},
d AS (SELECT CAST(transaction_date AS VARCHAR) AS transaction_date, region, count(*) AS transaction_count,
  round(sum(total_amount), 2) AS total_revenue FROM fact_sales GROUP BY 1, 2)
SELECT *, floor(total_revenue / transaction_count * 10000 + 0.5) / 10000 AS avg_transaction_value FROM d""")
def daily_sales_by_region(spark, sf_dir):
    out = agg.sales_by_region_from_lines(
        *[table(spark, sf_dir, t) for t in ("lineitem", "orders", "customer", "nation", "region")]
    )
    out = _text_date(out, "transaction_date").withColumn("total_revenue", F.round("total_revenue", 2))
    average = F.floor(F.col("total_revenue") / F.col("transaction_count") * 10000 + 0.5) / 10000
    return out.withColumn("avg_transaction_value", average)


@query("daily_product_performance", "AGG-03", f"""
WITH {FACT_SALES_SQL}
SELECT CAST(transaction_date AS VARCHAR) AS transaction_date, product_id,
       sum(quantity) AS units_sold, round(sum(total_amount), 4) AS revenue,
       count(DISTINCT customer_id) AS unique_customers
FROM fact_sales GROUP BY 1, 2""")
def daily_product_performance(spark, sf_dir):
    return _round(_text_date(agg.product_performance(fact_sales(spark, sf_dir)), "transaction_date"))


@query("general_aggregate", "AGG-01 UDF-03", f"""
WITH {FACT_SALES_SQL}
SELECT region, status, round(sum(total_amount), 2) AS total_amount_sum,
       round(avg(total_amount), 4) AS total_amount_mean,
       round(stddev(total_amount), 4) AS total_amount_std,
       count(quantity) AS quantity_count, max(quantity) AS quantity_max,
       count(DISTINCT product_id) AS product_id_nunique
FROM fact_sales WHERE region IS NOT NULL AND status IS NOT NULL GROUP BY 1, 2""")
def general_aggregate(spark, sf_dir):
    out = agg.aggregate(
        fact_sales(spark, sf_dir),
        ["region", "status"],
        {
            "total_amount": ["sum", "mean", "std"],
            "quantity": ["count", "max"],
            "product_id": ["nunique"],
        },
    )
    return _round(out.withColumn("total_amount_sum", F.round("total_amount_sum", 2)))


@query("pivot_sales", "AGG-07", f"""
WITH {FACT_SALES_SQL}
SELECT region,
       round(coalesce(sum(total_amount) FILTER (WHERE status = 'F'), 0), 2) AS F,
       round(coalesce(sum(total_amount) FILTER (WHERE status = 'O'), 0), 2) AS O,
       round(coalesce(sum(total_amount) FILTER (WHERE status = 'P'), 0), 2) AS P
FROM fact_sales GROUP BY 1""")
def pivot_sales(spark, sf_dir):
    out = agg.pivot_aggregation(
        fact_sales(spark, sf_dir), "region", "status", "total_amount", pivot_values=["F", "O", "P"]
    )
    return _round(out, 2)


@query("customer_ltv", "AGG-27", f"""
WITH {FACT_SALES_SQL}
SELECT customer_id, round(sum(total_amount), 2) AS lifetime_value, count(*) AS purchases,
       CAST(min(transaction_date) AS VARCHAR) AS first_purchase,
       CAST(max(transaction_date) AS VARCHAR) AS last_purchase
FROM fact_sales GROUP BY 1""")
def customer_ltv(spark, sf_dir):
    out = agg.customer_lifetime_value(fact_sales(spark, sf_dir))
    return _round(_text_date(out, "first_purchase", "last_purchase"), 2)


@query("batch_summary", "AGG-15", f"""
WITH {FACT_SALES_SQL}
SELECT count(*) AS batch_size, round(avg(total_amount), 4) AS avg_amount,
       round(sum(total_amount), 2) AS total_revenue FROM fact_sales""")
def batch_summary(spark, sf_dir):
    out = agg.batch_summary(fact_sales(spark, sf_dir))
    return _round(out.withColumn("total_revenue", F.round("total_revenue", 2)))


@query("outcome_by_batch", "AGG-19 SET-04", """
WITH chunks AS (
  SELECT *, (row_number() OVER (ORDER BY event_id) - 1) // 100 + 1 AS batch_number FROM events)
SELECT batch_number, count(*) AS total, count(*) FILTER (WHERE event_type <> 'error') AS successful,
       count(*) FILTER (WHERE event_type = 'error') AS failed,
       round(sum(value) FILTER (WHERE event_type <> 'error'), 4) AS amount_total,
       round(avg(value) FILTER (WHERE event_type <> 'error'), 4) AS amount_avg
FROM chunks GROUP BY 1""")
def outcome_by_batch(spark, sf_dir):
    from millrace.operators.ordered import chunk_rows

    rows = events(spark, sf_dir).select("event_id", "event_type", "value")
    chunks = chunk_rows(rows, ["event_id"], 100).withColumn("batch_number", F.col("chunk") + 1)
    ok = F.col("event_type") != "error"
    return _round(agg.outcome_summary(chunks, ok, "value", ["batch_number"]))


# One oracle per bin width: bin start, label, and the series of starts.
def _resample_sql(source, ts, unit, step, label, exprs, cols):
    return f"""
WITH b AS (SELECT date_trunc('{unit}', {ts}) AS s, {exprs} FROM {source} GROUP BY 1),
g AS (SELECT unnest(generate_series(min(s)::TIMESTAMP, max(s)::TIMESTAMP, INTERVAL {step})) AS s FROM b),
r AS (SELECT {label} AS d, {cols} FROM g LEFT JOIN b ON g.s = b.s::TIMESTAMP)
SELECT strftime(d, '%Y-%m-%d %H:%M:%S') AS ts, * EXCLUDE (d), year(d) AS year, month(d) AS month,
       quarter(d) AS quarter, isodow(d) - 1 AS day_of_week, weekofyear(d) AS week_of_year FROM r"""


def _ts_text(df):
    out = df.withColumn("ts", F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    ints = {c: F.col(c).cast("long") for c in ("year", "month", "quarter", "day_of_week", "week_of_year")}
    return _round(out.withColumns(ints))


def _resample(name, source, ts, value, freq, unit, step, label, fn):
    sql_fn = {"sum": "sum", "mean": "avg", "max": "max", "count": "count", "min": "min"}[fn]
    filled = f"coalesce({value}, 0)" if fn in ("sum", "count") else value
    digits = "" if fn == "count" else ", 4"
    shown = filled if fn == "count" else f"round({filled}{digits})"
    sql = _resample_sql(source, ts, unit, step, label, f"{sql_fn}({value}) AS {value}", f"{shown} AS {value}")

    def run(spark, sf_dir):
        df = table(spark, sf_dir, source).withColumnRenamed(ts, "ts")
        return _ts_text(timeseries.time_series_aggregation(df, "ts", [value], freq, fn))

    run.__module__ = __name__
    query(name, "AGG-05 SCL-16", sql)(run)


_resample("resample_hourly", "events", "ts", "value", "H", "hour", "'1 hour'", "g.s", "mean")
_resample("resample_daily", "orders", "o_orderdate", "o_totalprice", "D", "day", "'1 day'", "g.s", "sum")
_resample("resample_weekly", "orders", "o_orderdate", "o_totalprice", "W", "week", "'7 days'",
          "g.s + INTERVAL '6 days'", "count")
_resample("resample_monthly", "orders", "o_orderdate", "o_totalprice", "M", "month", "'1 month'",
          "g.s + INTERVAL '1 month' - INTERVAL '1 day'", "max")
_resample("resample_quarterly", "orders", "o_orderdate", "o_totalprice", "Q", "quarter", "'3 months'",
          "g.s + INTERVAL '3 months' - INTERVAL '1 day'", "min")
_resample("resample_yearly", "orders", "o_orderdate", "o_totalprice", "Y", "year", "'1 year'",
          "g.s + INTERVAL '1 year' - INTERVAL '1 day'", "mean")


@query("resample_all_widths", "AGG-06", """
WITH d AS (
  SELECT 'daily' AS width, date_trunc('day', ts) AS b, value FROM events
  UNION ALL
  SELECT 'weekly', date_trunc('week', ts) + INTERVAL '6 days', value FROM events
  UNION ALL
  SELECT 'monthly', date_trunc('month', ts) + INTERVAL '1 month' - INTERVAL '1 day', value FROM events)
SELECT width, strftime(b, '%Y-%m-%d %H:%M:%S') AS ts, round(sum(value), 4) AS value_sum,
       round(avg(value), 6) AS value_mean, count(value) AS value_count, max(value) AS value_max
FROM d GROUP BY 1, 2""")
def resample_all_widths(spark, sf_dir):
    tables = timeseries.aggregate_by_time_window(
        events(spark, sf_dir), "ts", ["daily", "weekly", "monthly"], ["value"], ["sum", "mean", "count", "max"]
    )
    out = None
    for width, df in tables.items():
        part = df.select(
            F.lit(width).alias("width"),
            F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts"),
            F.round("value_sum", 4).alias("value_sum"),
            F.round("value_mean", 6).alias("value_mean"),
            "value_count",
            "value_max",
        )
        out = part if out is None else out.unionByName(part)
    return out


_PROFILE_FIELDS = """count({c}) AS count, round(avg({c}), 4) AS mean, round(stddev({c}), 4) AS std,
  min({c})::DOUBLE AS min, round(quantile_cont({c}, 0.25), 4) AS q25,
  round(quantile_cont({c}, 0.5), 4) AS median, round(quantile_cont({c}, 0.75), 4) AS q75,
  max({c})::DOUBLE AS max, count(*) - count({c}) AS null_count,
  round((count(*) - count({c})) * 100.0 / count(*), 4)::DOUBLE AS null_percentage,
  count(DISTINCT {c}) AS unique_count, round(skewness({c}), 4) AS skewness,
  round(kurtosis({c}), 4) AS kurtosis"""


def _profile_sql(source, columns, keys=""):
    parts = [
        f"SELECT {keys}'{c}' AS column_name, {_PROFILE_FIELDS.format(c=f'({c}::DOUBLE)')} FROM {source}"
        + (f" GROUP BY {keys.rstrip(', ')}" if keys else "")
        for c in columns
    ]
    return "\nUNION ALL\n".join(parts)


_NUMERIC = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
# Nulls are put in by key, the same way on both sides.
_HOLES_SQL = """(SELECT l_returnflag, l_linestatus, l_quantity, l_discount, l_tax,
  CASE WHEN l_linenumber = 7 THEN NULL ELSE l_extendedprice END AS l_extendedprice FROM lineitem)"""


def _lineitem_with_holes(spark, sf_dir):
    df = table(spark, sf_dir, "lineitem")
    return df.withColumn(
        "l_extendedprice", F.when(F.col("l_linenumber") != 7, F.col("l_extendedprice"))
    ).select("l_returnflag", "l_linestatus", *_NUMERIC)


@query("profile_numeric", "AGG-08 AGG-09", _profile_sql(_HOLES_SQL, _NUMERIC))
def profile_numeric(spark, sf_dir):
    return _round(profile.summary_statistics(_lineitem_with_holes(spark, sf_dir), _NUMERIC))


@query("profile_by_group", "AGG-09 TXT-12", _profile_sql("documents", ["n_chars"], "lang, "))
def profile_by_group(spark, sf_dir):
    return _round(profile.summary_statistics(table(spark, sf_dir, "documents"), ["n_chars"], ["lang"]))


@query("missing_table", "AGG-10", f"""
SELECT * FROM (
SELECT 'l_extendedprice' AS column_name, count(*) - count(l_extendedprice) AS missing_count,
  round((count(*) - count(l_extendedprice)) * 100.0 / count(*), 4)::DOUBLE AS missing_percentage
FROM {_HOLES_SQL}
UNION ALL SELECT 'l_quantity', count(*) - count(l_quantity),
  round((count(*) - count(l_quantity)) * 100.0 / count(*), 4)::DOUBLE FROM lineitem)
WHERE missing_count > 0""")
def missing_table(spark, sf_dir):
    return _round(profile.missing_table(_lineitem_with_holes(spark, sf_dir)))


@query("value_distribution", "AGG-11 TXT-12", """
SELECT lang, count(*) AS count, round(count(*) * 100.0 / sum(count(*)) OVER (), 6)::DOUBLE AS percentage,
       round(max(count(*)) OVER () / count(*), 6) AS imbalance_ratio,
       round(count(*) / max(count(*)) OVER (), 6) AS balance
FROM documents GROUP BY 1""")
def value_distribution(spark, sf_dir):
    return _round(profile.value_distribution(table(spark, sf_dir, "documents"), "lang"), 6)


@query("histogram", "AGG-12", """
WITH s AS (SELECT min(l_extendedprice) AS lo, (max(l_extendedprice) - min(l_extendedprice)) / 30 AS w FROM lineitem),
b AS (SELECT least(floor((l_extendedprice - lo) / w), 29)::BIGINT AS bin, count(*) AS n FROM lineitem, s GROUP BY 1)
SELECT g.bin, round(lo + g.bin * w, 4) AS bin_start, round(lo + (g.bin + 1) * w, 4) AS bin_end,
       coalesce(n, 0) AS count
FROM (SELECT unnest(range(30)) AS bin) g CROSS JOIN s LEFT JOIN b ON g.bin = b.bin""")
def histogram(spark, sf_dir):
    return _round(profile.histogram(table(spark, sf_dir, "lineitem"), "l_extendedprice", 30))


@query("corr_matrix", "AGG-13", "\nUNION ALL\n".join(
    f"SELECT '{a}' AS column_a, '{b}' AS column_b, "
    + ("1.0::DOUBLE" if a == b else f"round(corr({a}, {b}), 6)")
    + " AS correlation FROM " + ("(SELECT 1)" if a == b else "lineitem")
    for a in _NUMERIC for b in _NUMERIC))
def corr_matrix(spark, sf_dir):
    return _round(profile.correlation_matrix(table(spark, sf_dir, "lineitem"), _NUMERIC), 6)


@query("corr_with_target", "AGG-13 SRT-01", "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, round(corr({c}, l_linenumber), 6) AS correlation FROM lineitem"
    for c in _NUMERIC))
def corr_with_target(spark, sf_dir):
    out = profile.target_correlations(table(spark, sf_dir, "lineitem"), _NUMERIC, "l_linenumber", True)
    return _round(out, 6)


@query("outlier_summary", "AGG-14", "\nUNION ALL\n".join(f"""
SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} < lo OR {c} > hi) AS outlier_count,
  round(count(*) FILTER (WHERE {c} < lo OR {c} > hi) * 100.0 / count(*), 4)::DOUBLE AS outlier_percentage,
  round(any_value(lo), 4) AS lower, round(any_value(hi), 4) AS upper
FROM {t}, (SELECT q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM (
  SELECT quantile_cont({c}::DOUBLE, 0.25) AS q1, quantile_cont({c}::DOUBLE, 0.75) AS q3 FROM {t}))"""
    for t, c in (("documents", "n_chars"),)))
def outlier_summary(spark, sf_dir):
    return _round(profile.outlier_summary(table(spark, sf_dir, "documents"), ["n_chars"]))


@query("aggregate_named", "AGG-01 UDF-03", """
SELECT l_returnflag, l_linestatus, median(l_quantity) AS med, round(quantile_cont(l_quantity, 0.9), 6) AS q90,
  round(skewness(l_extendedprice), 6) AS skew, round(kurtosis(l_extendedprice), 6) AS kurt,
  round(ln(product(1 + l_discount / 1000)), 6) AS prod, count(*) AS size,
  first(l_extendedprice ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey) AS first,
  last(l_extendedprice ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey) AS last,
  max(l_quantity) - min(l_quantity) AS spread
FROM lineitem GROUP BY 1, 2""")
def aggregate_named(spark, sf_dir):
    def spread(value):
        return F.max(value) - F.min(value)

    line = table(spark, sf_dir, "lineitem").withColumn("factor", 1 + F.col("l_discount") / 1000)
    out = agg.aggregate(
        line,
        ["l_returnflag", "l_linestatus"],
        {
            "l_quantity": {"med": "median", "q90": agg.quantile(0.9), "spread": spread, "size": "size"},
            "l_extendedprice": {"skew": "skew", "kurt": "kurt", "first": "first", "last": "last"},
            "factor": {"prod": "prod"},
        },
        order_by=F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"),
    )
    return _round(out.withColumn("prod", F.ln("prod")), 6)


@query("metric_list", "AGG-02 WIN-03 WIN-04 PRJ-16", """
WITH m AS (SELECT strftime(o_orderdate, '%Y-%m') AS month, round(sum(o_totalprice), 2) AS total, count(*)::DOUBLE AS n,
  count(*) FILTER (WHERE o_orderstatus = 'F')::DOUBLE AS done FROM orders GROUP BY 1)
SELECT month, total, n, done, round(total / nullif(done, 0), 4) AS per_done, round(done / n * 100, 4) AS done_share, n - done AS open,
  round((total / lag(total) OVER (ORDER BY month) - 1) * 100, 4) AS growth, round(sum(total) OVER (ORDER BY month), 1) AS so_far,
  rank() OVER (ORDER BY n DESC) + (count(*) OVER (PARTITION BY n) - 1) / 2 AS place, round(total / n, 4) AS each
FROM m""")
def metric_list(spark, sf_dir):
    done = F.count_if(F.col("o_orderstatus") == "F").cast("double")
    months = table(spark, sf_dir, "orders").groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("month")).agg(
        F.round(F.sum("o_totalprice"), 2).alias("total"), F.count("*").cast("double").alias("n"), done.alias("done")
    )
    out = metrics.calculate_metrics(months, [
        {"name": "per_done", "type": "ratio", "numerator": "total", "denominator": "done"},
        {"name": "done_share", "type": "percentage", "value": "done", "total": "n"},
        {"name": "open", "type": "difference", "column1": "n", "column2": "done"},
        {"name": "growth", "type": "growth_rate", "value": "total"},
        {"name": "so_far", "type": "cumulative", "value": "total"},
        {"name": "place", "type": "rank", "value": "n"},
        {"name": "each", "type": "custom", "formula": "total / n"},
    ], ["month"])
    return _round(out.withColumn("so_far", F.round("so_far", 1)))


@query("python_aggregates", "UDF-03", """
WITH c AS (SELECT l_returnflag, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2),
m AS (SELECT l_returnflag, l_linenumber FROM c QUALIFY row_number() OVER (PARTITION BY l_returnflag ORDER BY n DESC, l_linenumber) = 1)
SELECT l_returnflag, round(exp(avg(ln(l_quantity))), 6) AS geometric_mean, any_value(m.l_linenumber)::BIGINT AS usual_line
FROM lineitem JOIN m USING (l_returnflag) GROUP BY 1""")
def python_aggregates(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_linenumber", F.col("l_quantity").cast("double").alias("l_quantity"))
    return _round(custom.aggregate(rows, ["l_returnflag"], {
        "geometric_mean": custom.geometric_mean("l_quantity"), "usual_line": custom.mode("l_linenumber", "long"),
    }), 6)
