"""Session settings and the shared work folder."""

from __future__ import annotations

import atexit
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings every operator relies on. Cluster sizing (executors, memory, shuffle
# partitions) is left to the deployment; AQE coalesces and splits from there.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(app: str = "millrace", master: str | None = None, **conf: str) -> SparkSession:
    """Build a session with the settings above; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def work_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and written intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``. Without that setting only a
    single-process session, whose tasks share its disk, gets a temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(root)
        return root.rstrip("/")
    if spark.sparkContext.getCheckpointDir() is None:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="millrace-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def new_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared work folder; what is written there goes when the process ends."""
    path = f"{work_root(spark)}/{label}-{uuid.uuid4().hex}"
    _PINNED.add(path)
    return path


# Intermediate tables of this process that are still there.
_PINNED: set[str] = set()


def pin(df: DataFrame) -> DataFrame:
    """Cut the lineage: write the rows to the shared work folder and read them back.

    Survives the loss of executors. Unlike a checkpointed plan, the table read
    back has known sizes, prunes columns, and drags no constraints of earlier
    rounds into the plans of an iterative job. The tables go when the process
    ends, or earlier by ``unpin``.
    """
    path = new_path(df.sparkSession, "pinned")
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._pinned_path = path
    return out


def _delete(spark: SparkSession, path: str) -> None:
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jvm_path, True)
    _PINNED.discard(path)


def unpin(*frames: DataFrame) -> None:
    """Delete pinned tables that no later result reads."""
    for df in frames:
        path = getattr(df, "_pinned_path", None)
        if path in _PINNED:
            _delete(df.sparkSession, path)


@contextmanager
def scratch() -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Delete on leaving whatever was pinned inside; results must be written or read by then.

    For sessions that live long: without it, intermediate tables stay until the process ends.
    Gives a function that pins a result for after the scope.
    """
    before = set(_PINNED)

    def keep(df: DataFrame) -> DataFrame:
        out = pin(df)
        before.add(out._pinned_path)
        return out

    try:
        yield keep
    finally:
        spark = SparkSession.getActiveSession()
        for path in _PINNED - before if spark is not None else ():
            _delete(spark, path)


@atexit.register
def _unpin_all() -> None:
    try:
        spark = SparkSession.getActiveSession()
        for path in list(_PINNED) if spark is not None else []:
            _delete(spark, path)
    except Exception:  # the session is already gone; the folder's owner cleans up
        pass
