"""Table reads: scans, queries, increments, partitions, topics."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Database:
    """Connection of a JDBC source; the driver jar is the user's."""

    url: str
    driver: str
    options: dict[str, str] = field(default_factory=dict)


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def scan_table(
    spark: SparkSession, name: str, schema: str | None = None, columns: Sequence[str] | None = None,
    limit: int | None = None, database: Database | None = None, split_on: str | None = None,
    lower: object = None, upper: object = None, partitions: int = 8,
) -> DataFrame:
    """Scan a catalog or JDBC table. ``split_on`` with bounds reads in parallel."""
    full = f"{schema}.{name}" if schema else name
    if database is None:
        df = spark.table(".".join(quoted(p) for p in full.split(".")))
    else:
        options = {"url": database.url, "driver": database.driver, "dbtable": full, **database.options}
        if split_on:
            options |= {
                "partitionColumn": split_on, "lowerBound": str(lower), "upperBound": str(upper),
                "numPartitions": str(partitions),
            }
        df = spark.read.format("jdbc").options(**options).load()
    if columns:
        df = df.select(*columns)
    return df.limit(limit) if limit is not None else df


def run_query(spark: SparkSession, sql: str, params: dict | None = None, **tables: DataFrame) -> DataFrame:
    """SQL with named parameters (``:name``) over tables given as ``{name}``."""
    return spark.sql(sql, args=params, **tables)


def read_incremental(df: DataFrame, timestamp: str, last: object) -> DataFrame:
    """Rows newer than the last mark."""
    return df.filter(F.col(timestamp) > F.lit(last))


def high_water_mark(df: DataFrame, timestamp: str):
    """The mark for the next incremental read."""
    return df.agg(F.max(timestamp)).first()[0]


def read_partition(df: DataFrame, column: str, value: object, limit: int | None = None) -> DataFrame:
    """One partition value; only its directory is read."""
    out = df.filter(F.col(column) == F.lit(value))
    return out.limit(limit) if limit is not None else out


def find_documents(
    df: DataFrame, where: str | Column | None = None, projection: Sequence[str] | None = None, limit: int | None = None
) -> DataFrame:
    """Filter, projection and limit over a collection of documents."""
    out = df.filter(where) if where is not None else df
    if projection:
        out = out.select(*projection)
    return out.limit(limit) if limit is not None else out


def table_info(df: DataFrame) -> DataFrame:
    """Column, type, nullability and the row count of the table."""
    spark = df.sparkSession
    fields = [(i + 1, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema.fields)]
    info = spark.createDataFrame(fields, "position int, column_name string, data_type string, nullable boolean")
    return info.withColumn("row_count", df.agg(F.count("*")).scalar())


def kafka_options(servers: str, topics: Sequence[str], start: str = "earliest", max_per_batch: int | None = None, **extra: str) -> dict[str, str]:
    """Options of the Kafka source."""
    options = {
        "kafka.bootstrap.servers": servers, "subscribe": ",".join(topics), "startingOffsets": start,
        "failOnDataLoss": "true", **extra,
    }
    if max_per_batch is not None:
        options["maxOffsetsPerTrigger"] = str(max_per_batch)
    return options


def read_topic(spark: SparkSession, options: dict[str, str], stream: bool = True) -> DataFrame:
    """Topic records with their envelope; needs the Kafka connector jar."""
    reader = spark.readStream if stream else spark.read
    df = reader.format("kafka").options(**options).load()
    return df.select(
        "topic", "partition", "offset", "timestamp",
        F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"),
    )


def read_topic_files(spark: SparkSession, path: str, schema, fmt: str = "json", stream: bool = True, max_files: int | None = None, **options) -> DataFrame:
    """Landed topic records in files, read the same way as a topic."""
    reader = (spark.readStream if stream else spark.read).schema(schema).options(**options)
    if stream and max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.format(fmt).load(path)
