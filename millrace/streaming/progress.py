"""Progress of streaming queries kept in a table, beyond the last reports that Spark remembers."""

from __future__ import annotations

import json
import threading
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from millrace.streaming.jobs import health

ROWS = (
    "event string, query string, run_id string, at timestamp, batch_id long, records long, input_rate double, "
    "processed_rate double, duration double, error string"
)


class ProgressLog(StreamingQueryListener):
    """Appends a row per start, report and end of every query to a folder of JSON files.

    A file is closed after ``rows_per_file`` rows and written whole under a new name, so a reader never
    sees half a row and a restart only adds files. ``flush`` writes what is held; so does every end of a
    query, and ``stop``. Oldest files go once there are more than ``keep_files``.
    """

    def __init__(self, spark: SparkSession, path: str, rows_per_file: int = 100, keep_files: int = 1_000):
        super().__init__()
        self.spark = spark
        self.path = path.rstrip("/")
        self.rows_per_file = rows_per_file
        self.keep_files = keep_files
        self.held: list[dict] = []
        self.names: dict[str, str] = {}
        self.written = 0
        self.lock = threading.RLock()
        self.ended = threading.Condition(self.lock)
        self.ends = 0

    def start(self) -> ProgressLog:
        self.spark.streams.addListener(self)
        return self

    def stop(self) -> None:
        self.spark.streams.removeListener(self)
        self.flush()

    def wait_for_ends(self, n: int, seconds: float = 60.0) -> bool:
        """Wait until ``n`` ends of queries have been seen: Spark reports them a moment after the query is over."""
        with self.ended:
            return self.ended.wait_for(lambda: self.ends >= n, seconds)

    def _add(self, flush: bool = False, **row) -> None:
        with self.lock:
            self.held.append(row)
            if flush or len(self.held) >= self.rows_per_file:
                self._write()

    def onQueryStarted(self, event) -> None:
        name = event.name or str(event.id)
        self.names[str(event.runId)] = name
        self._add(event="started", query=name, run_id=str(event.runId), at=event.timestamp)

    def onQueryProgress(self, event) -> None:
        p = event.progress
        self._add(
            event="progress", query=p.name or str(p.id), run_id=str(p.runId), at=p.timestamp, batch_id=int(p.batchId), records=int(p.numInputRows),
            input_rate=_number(p.inputRowsPerSecond), processed_rate=_number(p.processedRowsPerSecond),
            duration=float((p.durationMs or {}).get("triggerExecution", 0)) / 1000.0,
        )

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        run = str(event.runId)
        self._add(
            True, event="failed" if event.exception else "ended", query=self.names.pop(run, str(event.id)), run_id=run,
            at=_now(), error=event.exception,
        )
        with self.ended:
            self.ends += 1
            self.ended.notify_all()

    def flush(self) -> None:
        with self.lock:
            self._write()

    def _write(self) -> None:
        if not self.held:
            return
        lines = "".join(json.dumps(row) + "\n" for row in self.held).encode()
        self.held = []
        self.written += 1
        jvm = self.spark._jvm
        folder = jvm.org.apache.hadoop.fs.Path(self.path)
        fs = folder.getFileSystem(self.spark._jsc.hadoopConfiguration())
        fs.mkdirs(folder)
        name = f"{_now()}-{self.written:06d}-{uuid.uuid4().hex[:8]}.json".replace(":", "")
        hidden, final = (jvm.org.apache.hadoop.fs.Path(folder, n) for n in (f"_{name}", name))
        out = fs.create(hidden)
        out.write(bytearray(lines))
        out.close()
        fs.rename(hidden, final)
        files = sorted(f.getPath().getName() for f in fs.listStatus(folder) if f.getPath().getName().endswith(".json") and not f.getPath().getName().startswith("_"))
        for old in files[: max(0, len(files) - self.keep_files)]:
            fs.delete(jvm.org.apache.hadoop.fs.Path(folder, old), False)


def _number(value) -> float | None:
    value = float(value or 0.0)
    return value if value == value and abs(value) != float("inf") else None


def _now() -> str:
    from datetime import datetime, timezone

    return datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%S.%f")[:-3] + "Z"


def logged_progress(spark: SparkSession, path: str) -> DataFrame:
    """The rows that ``ProgressLog`` wrote, whichever process wrote them; none before the first."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return spark.createDataFrame([], ROWS)
    return spark.read.schema(ROWS).json(path)


def lasting_health(spark: SparkSession, path: str, lag: DataFrame | None = None, max_lag: int = 1_000) -> DataFrame:
    """``jobs.health`` over all logged reports, with failures and whether the last run ended by one."""
    rows = logged_progress(spark, path)
    reports = rows.where("event = 'progress'").select("query", "batch_id", "records", "input_rate", "processed_rate", "duration")
    ends = rows.groupBy("query").agg(
        F.count_if(F.col("event") == "started").alias("starts"), F.count_if(F.col("event") == "failed").alias("failures"),
        F.max_by("event", F.struct("at", F.when(F.col("event") == "started", 0).when(F.col("event") == "progress", 1).otherwise(2))).alias("last_event"),
    )
    out = ends.join(health(reports, lag, max_lag), "query", "left")
    return out.withColumn("healthy", F.coalesce(F.col("healthy"), F.lit(True)) & (F.col("last_event") != "failed"))
