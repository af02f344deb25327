"""Message processing, streaming jobs, monitoring and fraud queries."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from millrace.operators import fraud
from millrace.operators import monitoring as mon
from millrace.operators.aggregate import success_counters
from millrace.plans.sales import _round
from millrace.registry import query
from millrace.session import new_path
from millrace.sources import tables
from millrace.streaming import detectors, jobs, messages, progress
from millrace.tables import FACT_SALES_SQL, events, fact_sales, table

# --- messages ---------------------------------------------------------------------

# Messages out of events: some lack a field, some are not positive, some are broken.
_MESSAGES_SQL = """
m AS (SELECT event_id, user_id, event_type, ts, event_id % 50 = 0 AS broken,
  CASE WHEN event_id % 11 = 0 THEN NULL ELSE 'P' || user_id END AS product_id,
  CASE WHEN event_id % 13 = 0 THEN -1.0 ELSE (event_id % 9 + 1)::DOUBLE END AS quantity, value AS price FROM events),
s AS (SELECT *, CASE WHEN broken THEN 'error' WHEN product_id IS NULL OR quantity <= 0 OR price <= 0 THEN 'invalid' ELSE 'processed' END AS message_status FROM m)"""


def _as_messages(df):
    k = F.col("event_id")
    record = F.struct(
        k.cast("string").alias("transaction_id"),
        F.when(k % 11 != 0, F.concat(F.lit("P"), "user_id")).alias("product_id"),
        F.concat(F.lit("  "), F.upper("event_type")).alias("product_name"),
        F.when(k % 13 == 0, F.lit(-1.0)).otherwise((k % 9 + 1).cast("double")).alias("quantity"),
        F.col("value").alias("price"), F.col("event_type").alias("region"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp"),
    )
    text = F.when(k % 50 == 0, F.lit("{broken")).otherwise(F.to_json(record))
    return df.select("event_id", text.alias("value"))


def _processed(df):
    return messages.process_messages(messages.parse_messages(_as_messages(df)), F.lit(datetime.datetime(2024, 2, 1)))


@query("message_processing", "PRJ-07 PRJ-08 PRJ-09 PRJ-10", f"""WITH {_MESSAGES_SQL}
SELECT event_id, message_status, CASE WHEN broken THEN 'not a record' WHEN product_id IS NULL THEN 'missing product_id'
    WHEN quantity <= 0 THEN 'not positive' END AS reason,
  CASE WHEN message_status = 'processed' THEN round(quantity * price, 4) END AS total_amount,
  CASE WHEN message_status = 'processed' THEN upper(substr(event_type, 1, 2)) END AS region_code,
  CASE WHEN message_status = 'processed' THEN event_type END AS name,
  CASE WHEN message_status = 'processed' THEN hour(ts)::DOUBLE END AS hour,
  CASE WHEN message_status = 'processed' THEN '2024-02-01' END AS processing_date
FROM s""")
def message_processing(spark, sf_dir):
    out = _processed(table(spark, sf_dir, "events"))
    return _round(out.select(
        "event_id", "message_status", "reason", "total_amount", "region_code",
        F.when(F.col("message_status") == "processed", F.col("product_name")).alias("name"),
        F.col("hour").cast("double").alias("hour"), F.col("processing_date").cast("string").alias("processing_date"),
    ))


@query("success_counters", "AGG-16", f"""WITH {_MESSAGES_SQL}
SELECT count(*) FILTER (WHERE message_status = 'processed') AS processed, count(*) FILTER (WHERE message_status <> 'processed') AS errors,
  round(count(*) FILTER (WHERE message_status = 'processed') / count(*), 6) AS success_rate FROM s""")
def success_counters_query(spark, sf_dir):
    return _round(success_counters(_processed(table(spark, sf_dir, "events")), "message_status"), 6)


@query("captured_errors", "UDF-01", "SELECT event_id, event_type <> 'error' AS ok FROM events")
def captured_errors(spark, sf_dir):
    def parse(text):
        if text == "error":
            raise ValueError("bad message")
        return len(text)

    run = messages.with_error_capture(parse, "int")
    out = table(spark, sf_dir, "events").select("event_id", run("event_type").alias("r"))
    return out.select("event_id", F.col("r.error").isNull().alias("ok"))


# --- streams -----------------------------------------------------------------------


def _event_stream(spark, sf_dir):
    schema = table(spark, sf_dir, "events").schema
    return tables.read_topic_files(spark, sf_dir, schema, "parquet", pathGlobFilter="events.parquet")


def _run(spark, df, label):
    path = new_path(spark, label)
    jobs.run_to_files(df, f"{path}/out", f"{path}/checkpoint")
    return spark.read.parquet(f"{path}/out")


# A window is written once the watermark (newest event minus 10 minutes) has passed its end.
@query("stream_window_60s", "ST-01 ST-04", """
SELECT strftime(date_trunc('minute', ts), '%Y-%m-%d %H:%M:%S') AS window_start, count(*) AS n, round(sum(value), 4) AS total,
  round(avg(value), 4) AS average
FROM events GROUP BY date_trunc('minute', ts)
HAVING date_trunc('minute', ts) + INTERVAL '60 seconds' <= (SELECT max(ts) FROM events) - INTERVAL '10 minutes'""")
def stream_window_60s(spark, sf_dir):
    out = _run(spark, jobs.windowed_amounts(_event_stream(spark, sf_dir), "ts", "value"), "windows")
    start = F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("window_start")
    return _round(out.select(start, "n", "total", "average"))


@query("stream_sliding", "ST-07", """
WITH w AS (SELECT event_type, time_bucket(INTERVAL '30 minutes', ts) - o * INTERVAL '30 minutes' AS s FROM events, (SELECT unnest([0, 1]) AS o))
SELECT event_type, strftime(s, '%Y-%m-%d %H:%M:%S') AS window_start, count(*) AS n FROM w GROUP BY event_type, s
HAVING s + INTERVAL '60 minutes' <= (SELECT max(ts) FROM events) - INTERVAL '10 minutes'""")
def stream_sliding(spark, sf_dir):
    stream = jobs.windowed_amounts(_event_stream(spark, sf_dir), "ts", "value", "60 minutes", "30 minutes", keys=["event_type"])
    out = _run(spark, stream, "sliding")
    return out.select("event_type", F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("window_start"), "n")


@query("stream_dedup", "ST-05", "SELECT event_id, user_id, value FROM events")
def stream_dedup(spark, sf_dir):
    twice = _event_stream(spark, sf_dir).withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2))))
    out = _run(spark, jobs.distinct_messages(twice, ["event_id"], "ts"), "dedup")
    return out.select("event_id", "user_id", "value")


@query("stream_dead_letters", "ST-01 SNK-16 UDF-02", f"""WITH {_MESSAGES_SQL}
SELECT CASE WHEN message_status = 'processed' THEN 'processed' ELSE 'dead' END AS route, message_status, count(*) AS n FROM s GROUP BY 1, 2""")
def stream_dead_letters(spark, sf_dir):
    path = new_path(spark, "routes")
    route = F.when(F.col("message_status") == "processed", "processed").otherwise("dead")
    jobs.run_batches(_processed(_event_stream(spark, sf_dir)), jobs.route_batches(f"{path}/out", route), f"{path}/checkpoint")
    out = spark.read.parquet(f"{path}/out")
    return out.groupBy("route", "message_status").agg(F.count("*").alias("n"))


@query("stream_batch_summary", "ST-02 ST-03 AGG-15", """
SELECT count(*) AS batch_size, round(avg(value), 4) AS avg_amount, round(sum(value), 3) AS total_revenue FROM events""")
def stream_batch_summary(spark, sf_dir):
    path = new_path(spark, "summaries")
    jobs.run_batches(_event_stream(spark, sf_dir), jobs.summarise_batches(f"{path}/out", "value"), f"{path}/checkpoint")
    out = spark.read.parquet(f"{path}/out").select("batch_size", "avg_amount", F.round("total_revenue", 3).alias("total_revenue"))
    return _round(out)


# Errors arrive after all other events: those older than the newest event seen by
# then, less ten minutes, are late.
@query("stream_late_rows", "ST-08", """
SELECT event_type, event_type = 'error' AND ts < (SELECT max(ts) FROM events WHERE event_type <> 'error') - INTERVAL '600 seconds' AS late,
  count(*) AS n FROM events GROUP BY 1, 2""")
def stream_late_rows(spark, sf_dir):
    path = new_path(spark, "late")
    rows = table(spark, sf_dir, "events")
    errors = F.col("event_type") == "error"
    for part in (rows.filter(~errors), rows.filter(errors)):
        part.write.mode("append").parquet(f"{path}/in")
        stream = tables.read_topic_files(spark, f"{path}/in", rows.schema, "parquet")
        jobs.run_batches(stream, jobs.split_late_batches(spark, f"{path}/out", "ts", 600), f"{path}/checkpoint")
    out = spark.read.parquet(f"{path}/out/rows").withColumn("late", F.col("late").cast("boolean"))
    return out.groupBy("event_type", "late").agg(F.count("*").alias("n"))


@query("stream_health", "ST-06 AGG-23", "SELECT count(*) AS records, true AS healthy FROM events")
def stream_health(spark, sf_dir):
    path = new_path(spark, "health")
    done = jobs.run_to_files(_event_stream(spark, sf_dir).select("event_id"), f"{path}/out", f"{path}/checkpoint")
    return jobs.health(jobs.progress_rows(spark, done)).select("records", "healthy")


@query("stream_lag", "ST-06 AGG-23", """
WITH p AS (SELECT event_type AS query, count(*) AS records, round(count(*) / sum(value), 6) AS throughput, max(day(ts)) AS last_batch
  FROM events GROUP BY 1),
l AS (SELECT event_type AS query, count(*) AS lag FROM events WHERE ts > TIMESTAMP '2024-01-28' AND event_type <> 'signup' GROUP BY 1)
SELECT query, records, throughput, last_batch, lag, coalesce(lag <= 130, true) AS healthy FROM p LEFT JOIN l USING (query)""")
def stream_lag(spark, sf_dir):
    rows = events(spark, sf_dir)
    progress = rows.groupBy(F.col("event_type").alias("query"), F.dayofmonth("ts").cast("long").alias("batch_id")).agg(
        F.count("*").alias("records"), F.sum("value").alias("duration")
    )
    # What came in last is still to be read; nothing is known about one of the queries.
    waiting = rows.filter((F.col("ts") > F.lit(datetime.datetime(2024, 1, 28))) & (F.col("event_type") != "signup"))
    lag = waiting.groupBy(F.col("event_type").alias("query")).agg(F.count("*").alias("lag"))
    return _round(jobs.health(progress, lag, max_lag=130), 6)


@query("stream_rapid", "FR-02 ST-07", """
WITH w AS (SELECT user_id, time_bucket(INTERVAL '2 hours', ts) - o * INTERVAL '2 hours' AS s FROM events, (SELECT unnest([0, 1, 2]) AS o))
SELECT user_id, strftime(s, '%Y-%m-%d %H:%M:%S') AS window_start, count(*) AS n FROM w GROUP BY user_id, s
HAVING count(*) >= 3 AND s + INTERVAL '6 hours' <= (SELECT max(ts) FROM events) - INTERVAL '10 minutes'""")
def stream_rapid(spark, sf_dir):
    stream = jobs.rapid_windows(_event_stream(spark, sf_dir), "user_id", "ts", 3, "6 hours", "2 hours")
    out = _run(spark, stream, "rapid")
    return out.select("user_id", F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("window_start"), "n")


# --- monitoring ---------------------------------------------------------------------

_METRICS_SQL = """metrics AS (SELECT user_id % 5 AS pipeline, event_type AS stage, event_id % 7 AS records, value AS duration, ts,
  (event_id % 12000)::BIGINT AS lag, event_type = 'error' AS failed FROM events)"""


def _metrics(spark, sf_dir):
    k = F.col("event_id")
    return events(spark, sf_dir).select(
        (F.col("user_id") % 5).alias("pipeline"), F.col("event_type").alias("stage"), (k % 7).alias("records"),
        F.col("value").alias("duration"), "ts", (k % 12000).alias("lag"), (F.col("event_type") == "error").alias("failed"),
    )


@query("stage_metrics", "AGG-23", f"""WITH {_METRICS_SQL}
SELECT pipeline, stage, CAST(sum(records) AS BIGINT) AS records_processed, count(duration) AS duration_count,
  round(sum(duration), 4) AS duration_total, round(avg(duration), 4) AS duration_avg, min(duration) AS duration_min,
  max(duration) AS duration_max, round(sum(records) / sum(duration), 6) AS throughput FROM metrics GROUP BY 1, 2""")
def stage_metrics(spark, sf_dir):
    out = mon.stage_metrics(_metrics(spark, sf_dir), ["pipeline", "stage"])
    return _round(out.withColumn("throughput", F.round("throughput", 6)), 4, skip=("throughput",))


@query("error_counts", "AGG-23", f"""WITH {_METRICS_SQL}
SELECT pipeline, stage, count(*) AS error_count FROM metrics WHERE stage = 'error' GROUP BY 1, 2""")
def error_counts(spark, sf_dir):
    rows = _metrics(spark, sf_dir).withColumn("stage", F.when(F.col("failed"), F.col("stage")))
    return mon.error_counts(rows, ["pipeline"], "stage")


@query("alert_error_rate", "AGG-24 ST-07", """
WITH b AS (SELECT time_bucket(INTERVAL '1 hour', ts) AS s, count(*) FILTER (WHERE event_type = 'error') AS hits, count(*) AS total
  FROM events GROUP BY 1),
bad AS (SELECT *, hits / total AS share FROM b WHERE hits / total > 0.15),
r AS (SELECT *, lag(s, 1) OVER (ORDER BY s) AS p FROM bad)
SELECT strftime(s, '%Y-%m-%d %H:%M:%S') AS window_start, hits, total, round(share, 6) AS hit_share FROM r WHERE p = s - INTERVAL '1 hour'""")
def alert_error_rate(spark, sf_dir):
    windows = mon.windowed_rate(events(spark, sf_dir), "ts", F.col("event_type") == "error", "1 hour")
    held = mon.held_alerts(windows, F.col("hit_share") > 0.15, 2)
    start = F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("window_start")
    return _round(held.select(start, "hits", "total", "hit_share"), 6)


def _runs_sql(windows, hold, step):
    """Windows of a breaching run at least ``hold`` long, by numbering runs of successive windows."""
    return f"""
WITH w AS ({windows}), bad AS (SELECT * FROM w WHERE breach),
r AS (SELECT *, epoch(s)::BIGINT // {step} - row_number() OVER (ORDER BY s) AS run FROM bad),
c AS (SELECT *, row_number() OVER (PARTITION BY run ORDER BY s) AS held FROM r)
SELECT strftime(s, '%Y-%m-%d %H:%M:%S') AS window_start, hits, total FROM c WHERE held >= {hold}"""


@query("alert_long_hold", "AGG-24", _runs_sql("""
  SELECT time_bucket(INTERVAL '1 hour', ts) AS s, count(*) FILTER (WHERE event_type = 'error') AS hits, count(*) AS total,
    count(*) > 7 AS breach FROM events GROUP BY 1""", 30, 3600))
def alert_long_hold(spark, sf_dir):
    windows = mon.windowed_rate(events(spark, sf_dir), "ts", F.col("event_type") == "error", "1 hour")
    held = mon.held_alerts(windows, F.col("total") > 7, 30)
    return held.select(F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("window_start"), "hits", "total")


@query("alert_sliding", "AGG-24", _runs_sql("""
  SELECT s, count(*) FILTER (WHERE event_type = 'error') AS hits, count(*) AS total,
    count(*) FILTER (WHERE event_type = 'error') / count(*) > 0.12 AS breach
  FROM (SELECT *, time_bucket(INTERVAL '1 hour', ts) - INTERVAL '1 hour' * unnest([0, 1, 2]) AS s FROM events) GROUP BY 1""", 4, 3600))
def alert_sliding(spark, sf_dir):
    windows = mon.windowed_rate(events(spark, sf_dir), "ts", F.col("event_type") == "error", "3 hours", "1 hour")
    held = mon.held_alerts(windows, F.col("hit_share") > 0.12, 4, slide="1 hour")
    return held.select(F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("window_start"), "hits", "total")


@query("duration_percentiles", "AGG-25", f"""WITH {_METRICS_SQL}
SELECT stage, round(quantile_cont(duration, 0.5), 4) AS p50, round(quantile_cont(duration, 0.95), 4) AS p95 FROM metrics GROUP BY 1""")
def duration_percentiles(spark, sf_dir):
    return _round(mon.duration_percentiles(_metrics(spark, sf_dir), "duration", [0.5, 0.95], ["stage"]))


@query("threshold_alerts", "AGG-24", f"""WITH {_METRICS_SQL},
a AS (SELECT pipeline, count(*) FILTER (WHERE failed) / count(*) AS error_rate, sum(records) / sum(duration) AS throughput, max(lag) AS max_lag,
  epoch(TIMESTAMP '2024-02-01 00:00:00')::BIGINT - epoch(max(ts))::BIGINT AS age_seconds, quantile_cont(duration, 0.95) AS p95 FROM metrics GROUP BY 1)
SELECT pipeline, round(error_rate, 6) AS error_rate, round(throughput, 6) AS throughput, max_lag, round(p95, 4) AS p95,
  error_rate > 0.05 AS high_error_rate, p95 > 300 AS slow, throughput < 100 AS low_throughput, max_lag > 10000 AS high_lag, age_seconds > 3600 AS stale FROM a""")
def threshold_alerts(spark, sf_dir):
    out = mon.threshold_alerts(_metrics(spark, sf_dir), F.lit(datetime.datetime(2024, 2, 1)))
    return _round(out.drop("age_seconds").withColumn("p95", F.round("p95", 4)), 6)


@query("top_error_increase", "AGG-25 SRT-03", """
SELECT user_id, count(*) AS increase FROM events
WHERE event_type <> 'view' AND ts > TIMESTAMP '2024-01-20 11:00:00' AND ts <= TIMESTAMP '2024-01-20 12:00:00'
GROUP BY 1 ORDER BY increase DESC, user_id LIMIT 10""")
def top_error_increase(spark, sf_dir):
    at = F.lit(datetime.datetime(2024, 1, 20, 12))
    return mon.top_increases(events(spark, sf_dir), "ts", at, F.col("event_type") != "view", ["user_id"])


@query("run_statistics", "AGG-18", """
SELECT event_type AS model_name, round(avg(value), 6) AS avg_inference_time, round(stddev_pop(value), 6) AS std_inference_time,
  round(1 / avg(value), 6) AS fps, CAST(sum(event_id % 7) AS BIGINT) AS total_detections,
  round(sum(event_id % 7) / count(*), 6) AS detections_per_image FROM events GROUP BY 1""")
def run_statistics(spark, sf_dir):
    runs = events(spark, sf_dir).select(
        F.col("event_type").alias("model_name"), F.col("value").alias("inference_time"), (F.col("event_id") % 7).alias("num_detections")
    )
    return _round(mon.run_statistics(runs), 6)


@query("stream_lasting_health", "ST-06", """
SELECT 'late marks' AS query, 1::BIGINT AS starts, 0::BIGINT AS failures, 'ended' AS last_event, count(*)::BIGINT AS records, true AS healthy FROM events""")
def stream_lasting_health(spark, sf_dir):
    path = new_path(spark, "progress")
    log = progress.ProgressLog(spark, f"{path}/log").start()
    try:
        rows = jobs.event_time(_event_stream(spark, sf_dir), "ts", "10 minutes")
        jobs.run_to_files(rows, f"{path}/out", f"{path}/checkpoint", name="late marks")
        log.wait_for_ends(1)
    finally:
        log.stop()
    return progress.lasting_health(spark, f"{path}/log").select("query", "starts", "failures", "last_event", "records", "healthy")


# --- fraud ---------------------------------------------------------------------------


@query("fraud_high_value", "FR-01", f"""WITH {FACT_SALES_SQL}
SELECT l_orderkey, l_linenumber, product_id, l_suppkey, total_amount, l_linenumber / 7 > 0.8 AS is_suspicious FROM fact_sales
WHERE total_amount BETWEEN 10000 AND 50000""")
def fraud_high_value(spark, sf_dir):
    hits = fraud.high_value(fact_sales(spark, sf_dir), "total_amount")
    return hits.select(
        "l_orderkey", "l_linenumber", "product_id", "l_suppkey", "total_amount",
        fraud.suspicious(F.col("l_linenumber") / 7).alias("is_suspicious"),
    )


@query("fraud_rapid", "FR-02", """
WITH e AS (SELECT user_id, floor(epoch(ts))::BIGINT AS epoch FROM events),
c AS (SELECT user_id, epoch, count(*) OVER (PARTITION BY user_id ORDER BY epoch RANGE BETWEEN 21600 PRECEDING AND CURRENT ROW) AS n_recent FROM e)
SELECT DISTINCT user_id, epoch, n_recent FROM c WHERE n_recent >= 3""")
def fraud_rapid(spark, sf_dir):
    return fraud.rapid_succession(events(spark, sf_dir), "user_id", "ts", 3, 21_600)


_ALERTS_SQL = """
WITH e AS (SELECT user_id, floor(epoch(ts))::BIGINT AS epoch FROM events),
c AS (SELECT user_id, epoch, count(*) OVER (PARTITION BY user_id ORDER BY epoch RANGE BETWEEN 21600 PRECEDING AND CURRENT ROW) AS n_recent,
  count(*) OVER (PARTITION BY user_id, epoch) AS n FROM e)
SELECT DISTINCT user_id, epoch, n_recent FROM c WHERE n_recent >= 3 AND n_recent - n < 3"""


@query("fraud_rapid_alerts", "FR-02", _ALERTS_SQL)
def fraud_rapid_alerts(spark, sf_dir):
    return fraud.rapid_alerts(events(spark, sf_dir), "user_id", "ts", 3, 21_600)


# A second is settled once the watermark (newest event minus 10 minutes) has passed its end.
@query("fraud_rapid_stream", "FR-02", _ALERTS_SQL + " AND epoch + 1 <= (SELECT epoch(max(ts)) FROM events) - 600")
def fraud_rapid_stream(spark, sf_dir):
    with detectors.keyed_state(spark):
        alerts = detectors.rapid_succession_stream(_event_stream(spark, sf_dir), "user_id", "ts", 3, 21_600, transaction="event_id")
        return _run(spark, alerts, "alerts")


@query("fraud_multi_method", "FR-04", """
WITH e AS (SELECT user_id, floor(epoch(ts))::BIGINT AS epoch, event_type FROM events)
SELECT a.user_id, a.epoch, count(DISTINCT b.event_type)::INT AS n_methods FROM (SELECT DISTINCT user_id, epoch FROM e) a
JOIN e b ON a.user_id = b.user_id AND b.epoch BETWEEN a.epoch - 43200 AND a.epoch GROUP BY 1, 2 HAVING count(DISTINCT b.event_type) >= 3""")
def fraud_multi_method(spark, sf_dir):
    return fraud.many_methods(events(spark, sf_dir), "user_id", "ts", "event_type", 3, 43_200)


_PLACES_SQL = """h AS (SELECT o_custkey, s_nationkey, l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey)"""


@query("fraud_location", "FR-03", f"""WITH {_PLACES_SQL},
c AS (SELECT o_custkey, s_nationkey, count(*) AS n FROM h GROUP BY 1, 2),
u AS (SELECT o_custkey, s_nationkey FROM c QUALIFY n >= 0.1 * sum(n) OVER (PARTITION BY o_custkey))
SELECT h.* FROM h ANTI JOIN u ON h.o_custkey = u.o_custkey AND h.s_nationkey = u.s_nationkey""")
def fraud_location(spark, sf_dir):
    rows = (
        table(spark, sf_dir, "lineitem")
        .join(table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(table(spark, sf_dir, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .select("o_custkey", "s_nationkey", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    )
    usual = fraud.usual_places(rows, "o_custkey", "s_nationkey")
    return fraud.unusual_location(rows, usual, "o_custkey", "s_nationkey").drop("fraud_type")
