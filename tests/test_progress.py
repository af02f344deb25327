"""Logged progress of two queries, a restart and a failure."""

import time

import pytest
from pyspark.sql import functions as F

from millrace.streaming import jobs, progress


def stream(spark, path, name, out):
    df = spark.readStream.schema("id long").option("maxFilesPerTrigger", 1).parquet(path)
    return df.writeStream.queryName(name).format("parquet").option("path", f"{out}/{name}").option(
        "checkpointLocation", f"{out}/{name}-marks").trigger(availableNow=True)


def test_two_queries_restart_and_failure(spark, tmp_path):
    src, out, log_path = f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/log"
    assert progress.logged_progress(spark, log_path).count() == 0
    for i in range(5):
        spark.range(10 * i, 10 * i + 10).coalesce(1).write.mode("append").parquet(src)
    log = progress.ProgressLog(spark, log_path, rows_per_file=3).start()
    try:
        for name in ("one", "two"):
            stream(spark, src, name, out).start().awaitTermination()
        spark.range(90, 100).coalesce(1).write.mode("append").parquet(src)
        stream(spark, src, "one", out).start().awaitTermination()  # from its checkpoint

        def fail(batch, batch_id):
            raise ValueError("no such sink")

        df = spark.readStream.schema("id long").parquet(src)
        query = df.writeStream.queryName("bad").foreachBatch(fail).option("checkpointLocation", f"{out}/bad").start()
        with pytest.raises(Exception, match="no such sink"):
            query.awaitTermination()
        assert log.wait_for_ends(4)
    finally:
        log.stop()
    rows = progress.logged_progress(spark, log_path)
    records = {r["query"]: (r.records, r.batches) for r in rows.where("event = 'progress' AND records > 0").groupBy("query").agg(
        F.sum("records").alias("records"), F.count("*").alias("batches")).collect()}
    assert records == {"one": (60, 6), "two": (50, 5)}
    state = {r["query"]: r for r in progress.lasting_health(spark, log_path).collect()}
    assert (state["one"].starts, state["one"].failures, state["one"].healthy, state["one"].records) == (2, 0, True, 60)
    assert (state["bad"].failures, state["bad"].healthy, state["bad"].last_event) == (1, False, "failed")
    assert "no such sink" in rows.where("event = 'failed'").first().error
    lag = spark.createDataFrame([("two", 5_000)], "query string, lag long")
    assert {r["query"]: r.healthy for r in progress.lasting_health(spark, log_path, lag).collect()} == {"one": True, "two": False, "bad": False}


def test_old_files_go(spark, tmp_path):
    log = progress.ProgressLog(spark, f"{tmp_path}/log", rows_per_file=1, keep_files=3)
    for i in range(6):
        log._add(event="progress", query="q", batch_id=i, records=1)
        time.sleep(0.002)
    assert sorted(r.batch_id for r in progress.logged_progress(spark, f"{tmp_path}/log").collect()) == [3, 4, 5]
