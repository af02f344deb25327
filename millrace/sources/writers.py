"""Writers by format, partitioned and incremental writes, upserts, retention.

Paths may use any Hadoop file system (local, s3a, abfss, gs).
"""

from __future__ import annotations

import datetime
from collections.abc import Callable, Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.ordered import join_on
from millrace.session import pin, unpin
from millrace.sources.readers import exists
from millrace.sources.tables import Database


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", **options) -> None:
    df.write.mode(mode).options(**{"header": True, "encoding": "utf-8", **options}).csv(path)


def write_json(df: DataFrame, path: str, mode: str = "overwrite", **options) -> None:
    """One object per line, ISO dates."""
    df.write.mode(mode).options(**options).json(path)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", **options) -> None:
    df.write.mode(mode).options(**{"compression": "snappy", **options}).parquet(path)


WRITERS: dict[str, Callable[..., None]] = {"csv": write_csv, "json": write_json, "parquet": write_parquet}


def write(df: DataFrame, path: str, fmt: str | None = None, mode: str = "overwrite", **options) -> None:
    """Write by format name or path suffix."""
    name = (fmt or path.rstrip("/").rsplit("/", 1)[-1].rpartition(".")[2]).lower()
    if name not in WRITERS:
        raise ValueError(f"Unsupported format: {name}")
    WRITERS[name](df, path, mode, **options)


def write_partitioned(
    df: DataFrame, path: str, columns: Sequence[str], fmt: str = "parquet", mode: str = "overwrite", **options
) -> None:
    """Directories ``col=value``.

    Rows are rebalanced on the partition columns, which keeps files few but lets
    Spark split a value that holds most of the rows over several writers.
    """
    if fmt not in WRITERS:
        raise ValueError(f"Unsupported format: {fmt}")
    writer = df.hint("rebalance", *[F.col(c) for c in columns]).write.mode(mode).partitionBy(*columns)
    if fmt == "csv":
        options = {"header": True, **options}
    writer.options(**options).format(fmt).save(path)


def write_incremental(df: DataFrame, path: str, mode: str = "append", fmt: str = "parquet", **options) -> None:
    """Append to or replace earlier output, in any format."""
    if mode not in ("append", "overwrite"):
        raise ValueError(f"unknown mode: {mode}")
    write(df, path, fmt, mode, **options)


def write_database(df: DataFrame, table: str, database: Database, schema: str | None = None, mode: str = "append", batch: int = 1_000) -> None:
    """Append rows in batches of inserts, one connection per partition."""
    name = f"{schema}.{table}" if schema else table
    options = {"url": database.url, "driver": database.driver, "dbtable": name, "batchsize": str(batch), **database.options}
    df.write.format("jdbc").options(**options).mode(mode).save()


def write_copy_files(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Tab-separated files without header and with empty NULLs, for a bulk COPY."""
    df.write.mode(mode).options(sep="\t", nullValue="", header=False).csv(path)


def stamp(df: DataFrame, batch_id: str) -> DataFrame:
    """Add the id of the batch the rows were written by."""
    return df.withColumn("batch_id", F.lit(batch_id))


# --- upserts and retention -------------------------------------------------------------


def upsert(spark: SparkSession, path: str, updates: DataFrame, keys: Sequence[str], partition_by: Sequence[str]) -> None:
    """Insert rows or replace those with the same key, in a partitioned table.

    Only partitions that receive rows, or lose rows whose key moves elsewhere, are
    rewritten; to find the latter, keys alone are read. NULL is a key and a partition like
    any other. The merged rows are written aside before the partitions they come from are
    replaced. Updates that repeat a key are refused.
    """
    updates = pin(updates)
    repeated = updates.groupBy(*keys).count().where("count > 1").select(*keys).first()
    if repeated is not None:
        unpin(updates)
        raise ValueError(f"updates hold a key more than once: {tuple(repeated)}")
    if not exists(spark, path):
        write_partitioned(updates, path, partition_by)
        unpin(updates)
        return
    place = list(partition_by)
    current = spark.read.parquet(path)
    # Directory names come back as guessed types; use the types of the updates.
    types = {f.name: f.dataType for f in updates.schema.fields}
    current = current.select(*[F.col(c).cast(t) for c, t in types.items()], F.input_file_name().alias("_file"))
    new_keys = updates.select(*keys)
    moved = join_on(current.select(*dict.fromkeys([*keys, *place])), new_keys, keys, "left_semi").select(*place)
    touched = moved.unionByName(updates.select(*place)).distinct()
    old = join_on(current, touched, place, "left_semi")
    merged = pin(join_on(old, new_keys, keys, "left_anti").drop("_file").unionByName(updates))
    # Dynamic overwrite leaves a partition alone that gets no rows; its directory has to go.
    emptied = join_on(old, merged.select(*place).distinct(), place, "left_anti")
    folders = [r[0] for r in emptied.select(F.regexp_replace("_file", "/[^/]*$", "")).distinct().collect()]
    write_partitioned(merged, path, partition_by, partitionOverwriteMode="dynamic")
    for folder in folders:
        jvm_path = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(folder))
        jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jvm_path, True)
    unpin(updates, merged)


def _as_type_of(value: str, example: object) -> object:
    """A directory's value in the type of ``example``."""
    if isinstance(example, datetime.datetime):
        return datetime.datetime.fromisoformat(value)
    if isinstance(example, datetime.date):
        return datetime.date.fromisoformat(value)
    return type(example)(value)


def drop_old_partitions(spark: SparkSession, path: str, column: str, before: object) -> list[str]:
    """Remove partition directories with a value below ``before``; returns the values as text.

    Values are compared in the type of ``before``; the partition of NULL stays.
    """
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = jvm_path.getFileSystem(spark._jsc.hadoopConfiguration())
    dropped = []
    for status in fs.listStatus(jvm_path):
        name = status.getPath().getName()
        key, _, value = name.partition("=")
        value = unquote(value)
        if key != column or value == "__HIVE_DEFAULT_PARTITION__":
            continue
        if _as_type_of(value, before) < before:
            fs.delete(status.getPath(), True)
            dropped.append(value)
    return sorted(dropped, key=lambda v: _as_type_of(v, before))


def refresh_table(df: DataFrame, name: str, path: str | None = None) -> None:
    """Replace a named result table."""
    writer = df.write.mode("overwrite").format("parquet")
    (writer.option("path", path) if path else writer).saveAsTable(name)


# --- messages ---------------------------------------------------------------------------


def topic_records(df: DataFrame, key: str | Column | None = None) -> DataFrame:
    """(key, value) records with the row as JSON."""
    k = F.lit(None).cast("string") if key is None else (F.col(key) if isinstance(key, str) else key).cast("string")
    return df.select(k.alias("key"), F.to_json(F.struct(*df.columns)).alias("value"))


def write_topic(df: DataFrame, servers: str, topic: str, key: str | Column | None = None) -> None:
    """Send rows to a topic; needs the Kafka connector jar."""
    records = topic_records(df, key)
    records.write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).save()


def send_counts(df: DataFrame, valid: Column) -> DataFrame:
    """How many rows a send would deliver and how many it would refuse."""
    ok = F.coalesce(valid, F.lit(False))
    return df.agg(F.count_if(ok).alias("sent"), F.count_if(~ok).alias("failed"))
