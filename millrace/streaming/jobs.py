"""Streaming queries over messages and events.

Every job keeps its offsets and state in a checkpoint, writes per-batch output
under the batch id, and so gives the same result when a batch is run again.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.operators.aggregate import batch_summary


def event_time(df: DataFrame, ts: str, delay: str) -> DataFrame:
    """Event time as an instant, with the lateness the stream waits for."""
    return df.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)


def windowed_amounts(
    df: DataFrame, ts: str, amount: str, width: str = "60 seconds", slide: str | None = None, delay: str = "10 minutes",
    keys: Sequence[str] = (),
) -> DataFrame:
    """Count, sum and average per tumbling or sliding window."""
    bins = F.window(ts, width, slide) if slide else F.window(ts, width)
    out = event_time(df, ts, delay).groupBy(*keys, bins.alias("w")).agg(
        F.count("*").alias("n"), F.sum(amount).alias("total"), F.avg(amount).alias("average")
    )
    return out.select(*keys, F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "n", "total", "average")


def distinct_messages(df: DataFrame, keys: Sequence[str], ts: str, delay: str = "10 minutes") -> DataFrame:
    """Each message once, however often it was sent within the delay."""
    return event_time(df, ts, delay).dropDuplicatesWithinWatermark(list(keys))


def rapid_windows(
    df: DataFrame, customer: str, ts: str, count: int = 10, width: str = "5 minutes", slide: str = "30 seconds", delay: str = "10 minutes"
) -> DataFrame:
    """Windows in which a customer made at least ``count`` transactions."""
    out = event_time(df, ts, delay).groupBy(customer, F.window(ts, width, slide).alias("w")).agg(F.count("*").alias("n"))
    return out.filter(F.col("n") >= count).select(customer, F.col("w.start").alias("window_start"), "n")


# --- sinks ---------------------------------------------------------------------------


def run_to_files(df: DataFrame, path: str, checkpoint: str, fmt: str = "parquet", name: str | None = None) -> StreamingQuery:
    """Process everything available now into files, exactly once."""
    writer = df.writeStream.queryName(name) if name else df.writeStream
    query = (
        writer.format(fmt).option("path", path).option("checkpointLocation", checkpoint)
        .outputMode("append").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return query


def run_batches(df: DataFrame, function: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Call ``function(batch, batch_id)`` per micro-batch; offsets commit after it."""
    query = df.writeStream.foreachBatch(function).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def _batch_path(path: str, batch_id: int) -> str:
    return f"{path}/batch_id={batch_id}"


def route_batches(path: str, route: Column) -> Callable[[DataFrame, int], None]:
    """Write each batch once, split by route (for example processed or dead)."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("route", route).write.mode("overwrite").partitionBy("route").parquet(_batch_path(path, batch_id))

    return write


def summarise_batches(path: str, amount: str = "total_amount") -> Callable[[DataFrame, int], None]:
    """One summary row per batch."""

    def write(batch: DataFrame, batch_id: int) -> None:
        summary = batch_summary(batch, amount).withColumn("summarised_at", F.current_timestamp())
        summary.write.mode("overwrite").parquet(_batch_path(path, batch_id))

    return write


def split_late_batches(spark: SparkSession, path: str, ts: str, delay_seconds: int) -> Callable[[DataFrame, int], None]:
    """Write rows older than the newest earlier event minus the delay as late.

    The newest event so far is kept beside the output of each batch, so a batch reads one
    mark however long the stream runs, and a repeated batch sees the same one.
    """
    marks = f"{path}/_marks_by_batch"

    def write(batch: DataFrame, batch_id: int) -> None:
        mark = None
        if batch_id > 0:
            mark = spark.read.parquet(_batch_path(marks, batch_id - 1)).agg(F.max("newest")).first()[0]
        late = F.lit(False) if mark is None else F.col(ts).cast("timestamp") < F.lit(mark) - F.expr(f"INTERVAL {delay_seconds} SECONDS")
        batch.withColumn("late", F.coalesce(late, F.lit(False))).write.mode("overwrite").partitionBy("late").parquet(
            f"{path}/rows/batch_id={batch_id}"
        )
        newest = batch.agg(F.greatest(F.max(F.col(ts).cast("timestamp")), F.lit(mark).cast("timestamp")).alias("newest"))
        newest.write.mode("overwrite").parquet(_batch_path(marks, batch_id))

    return write


# --- health ----------------------------------------------------------------------------


def progress_rows(spark: SparkSession, query: StreamingQuery) -> DataFrame:
    """Recent progress of a query as metric rows (bounded by Spark's own limit)."""
    rows = [
        (p.name or str(p.id), int(p.batchId), int(p.numInputRows), float(p.inputRowsPerSecond or 0.0),
         float(p.processedRowsPerSecond or 0.0), float(p.durationMs.get("triggerExecution", 0)) / 1000.0)
        for p in query.recentProgress
    ]
    return spark.createDataFrame(
        rows, "query string, batch_id long, records long, input_rate double, processed_rate double, duration double"
    )


def health(progress: DataFrame, lag: DataFrame | None = None, max_lag: int = 1_000) -> DataFrame:
    """Throughput per query and whether its lag is acceptable."""
    out = progress.groupBy("query").agg(
        F.sum("records").alias("records"), F.try_divide(F.sum("records"), F.sum("duration")).alias("throughput"),
        F.max("batch_id").alias("last_batch"),
    )
    if lag is None:
        return out.withColumns({"lag": F.lit(0).cast("long"), "healthy": F.lit(True)})
    return out.join(lag, "query", "left").withColumn("healthy", F.coalesce(F.col("lag") <= max_lag, F.lit(True)))
