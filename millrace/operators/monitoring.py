"""Metrics over records of past runs: stages, alerts, dashboards, samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.ordered import join_on
from millrace.operators.quantiles import exact_quantiles


def stage_metrics(
    metrics: DataFrame, keys: Sequence[str], records: str = "records", duration: str = "duration"
) -> DataFrame:
    """Records, duration statistics and throughput per stage."""
    total = F.sum(duration)
    throughput = F.when(total > 0, F.sum(records) / total).otherwise(F.lit(0.0))
    return metrics.groupBy(*keys).agg(
        F.sum(records).alias("records_processed"),
        F.count(duration).alias("duration_count"),
        total.alias("duration_total"),
        F.avg(duration).alias("duration_avg"),
        F.min(duration).alias("duration_min"),
        F.max(duration).alias("duration_max"),
        throughput.alias("throughput"),
    )


def error_counts(metrics: DataFrame, keys: Sequence[str], error_type: str) -> DataFrame:
    """Errors per stage and type."""
    return metrics.filter(F.col(error_type).isNotNull()).groupBy(*keys, error_type).agg(
        F.count("*").alias("error_count")
    )


def windowed_rate(
    df: DataFrame, ts: str, hit: Column, width: str = "5 minutes", slide: str | None = None, keys: Sequence[str] = ()
) -> DataFrame:
    """Hits, rows, share of hits and hits per second per window."""
    bins = F.window(ts, width, slide) if slide else F.window(ts, width)
    out = df.groupBy(*keys, bins.alias("w")).agg(F.count_if(hit).alias("hits"), F.count("*").alias("total"))
    seconds = F.unix_timestamp("w.end") - F.unix_timestamp("w.start")
    return out.select(
        *keys,
        F.col("w.start").alias("window_start"),
        F.col("w.end").alias("window_end"),
        "hits",
        "total",
        (F.col("hits") / F.col("total")).alias("hit_share"),
        (F.col("hits") / seconds).alias("rate_per_second"),
    )


def held_alerts(
    windows: DataFrame, breach: Column, hold: int, order: str = "window_start", keys: Sequence[str] = (),
    slide: str | None = None,
) -> DataFrame:
    """Windows in which ``breach`` has held for ``hold`` successive windows.

    Takes windows that are already aggregated, ``slide`` apart (their own width by
    default); a missing window breaks the run. Self-joining on shifted window starts is not
    needed: a run is complete when the window ``hold - 1`` rows earlier is as many steps away.
    """
    if hold < 1:
        raise ValueError("hold counts windows, from 1")
    start = F.unix_timestamp("window_start")
    after = F.col("window_start") + F.expr(f"INTERVAL {slide}") if slide else F.col("window_end")
    rows = windows.filter(breach).withColumn("_t", F.unix_timestamp(order)).withColumn("_w", F.unix_timestamp(after) - start)
    # Runs are found per day-long block of time; a window also goes to every later block its run can reach.
    span = 86_400
    home = F.floor(F.col("_t") / span)
    lead = F.col("_w") * (hold - 1)
    blocks = F.explode(F.sequence(home, F.floor((F.col("_t") + lead) / span)))
    placed = rows.withColumn("_home", home).withColumn("_block", blocks)
    w = Window.partitionBy(*keys, "_block").orderBy("_t")
    run = F.col("_t") - F.lag("_t", hold - 1).over(w) if hold > 1 else F.lit(0)
    return (
        placed.withColumn("_run", run)
        .filter((F.col("_block") == F.col("_home")) & (F.col("_run") == F.col("_w") * (hold - 1)))
        .select(*windows.columns)
    )


def duration_percentiles(
    metrics: DataFrame, duration: str, probabilities: Sequence[float], keys: Sequence[str] = ()
) -> DataFrame:
    """Exact duration percentiles per key, named ``p50``, ``p95`` ..."""
    q = exact_quantiles(metrics, [duration], probabilities, keys)
    return q.select(*keys, *[F.col(f"q{i}").alias(f"p{round(p * 100)}") for i, p in enumerate(probabilities)])


def threshold_alerts(
    metrics: DataFrame,
    as_of: Column,
    keys: Sequence[str] = ("pipeline",),
    ts: str = "ts",
    duration: str = "duration",
    records: str = "records",
    lag: str = "lag",
    failed: str = "failed",
) -> DataFrame:
    """One row per key with the state of every threshold rule."""
    # Alert thresholds.
    max_error_rate, max_p95, min_throughput, max_lag, max_age = 0.05, 300.0, 100.0, 10_000, 3_600
    base = metrics.groupBy(*keys).agg(
        (F.count_if(F.col(failed)) / F.count("*")).alias("error_rate"),
        F.try_divide(F.sum(records), F.sum(duration)).alias("throughput"),
        F.max(lag).alias("max_lag"),
        (F.unix_timestamp(as_of) - F.unix_timestamp(F.max(ts))).alias("age_seconds"),
    )
    p95 = duration_percentiles(metrics, duration, [0.95], keys)
    return (
        join_on(base, p95, keys)
        .withColumns(
            {
                "high_error_rate": F.col("error_rate") > max_error_rate,
                "slow": F.col("p95") > max_p95,
                "low_throughput": F.col("throughput") < min_throughput,
                "high_lag": F.col("max_lag") > max_lag,
                "stale": F.col("age_seconds") > max_age,
            }
        )
    )


def top_increases(df: DataFrame, ts: str, as_of: Column, hit: Column, keys: Sequence[str], k: int = 10) -> DataFrame:
    """The ``k`` keys with most hits in the hour before ``as_of``."""
    recent = df.filter(hit & (F.col(ts) > as_of - F.expr("INTERVAL 1 HOUR")) & (F.col(ts) <= as_of))
    return recent.groupBy(*keys).agg(F.count("*").alias("increase")).orderBy(F.desc("increase"), *keys).limit(k)


def sample_summary(samples: DataFrame, ts: str, columns: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Average, maximum, minimum and last-minus-first of sampled gauges."""
    aggs = []
    for c in columns:
        aggs += [
            F.avg(c).alias(f"avg_{c}"),
            F.max(c).alias(f"max_{c}"),
            F.min(c).alias(f"min_{c}"),
            (F.max_by(c, ts) - F.min_by(c, ts)).alias(f"{c}_delta"),
        ]
    return samples.groupBy(*keys).agg(*aggs)


def run_statistics(runs: DataFrame, model: str = "model_name", seconds: str = "inference_time",
                   found: str = "num_detections") -> DataFrame:
    """Speed per model: average and spread of run time, runs per second, hits per run."""
    return runs.groupBy(model).agg(
        F.avg(seconds).alias("avg_inference_time"),
        F.stddev_pop(seconds).alias("std_inference_time"),
        F.try_divide(F.lit(1.0), F.avg(seconds)).alias("fps"),
        F.sum(found).alias("total_detections"),
        F.try_divide(F.sum(found), F.count("*")).alias("detections_per_image"),
    )
