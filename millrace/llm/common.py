"""Helpers shared by the corpus operators."""

from __future__ import annotations

import math
import string

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Name of the row number that tells repeated rows apart.
ROW = "__row"


def columns(df: DataFrame, **names: str) -> DataFrame:
    """Only the named columns, under the given names; whatever else the table holds cannot clash."""
    return df.select(*[F.col(f"`{have}`").alias(name) for name, have in names.items()])


def lower_ascii(col: Column) -> Column:
    """Lower-case A-Z and nothing else; plain ASCII text takes the faster built-in."""
    return F.when(F.octet_length(col) == F.char_length(col), F.lower(col)).otherwise(
        F.translate(col, string.ascii_uppercase, string.ascii_lowercase)
    )


def with_row(df: DataFrame) -> DataFrame:
    """Add a row number; pin the result before using it twice, as it depends on the scan."""
    return df.withColumn(ROW, F.monotonically_increasing_id())


def tasks_for(df: DataFrame, rows: int, rows_per_task: int) -> int:
    """Shuffle partitions for ``rows``: the session's number, more when tasks would grow too large."""
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(rows / rows_per_task))


def gapless(df: DataFrame, group: str, order: list[str], name: str, rows_per_bucket: int = 100_000) -> DataFrame:
    """Number the rows of each group from 0 without holding a group in one task.

    ``df`` must be pinned and ``order`` settle every tie. Rows are dealt into hashed
    buckets within their group; a bucket starts where the earlier ones end.
    """
    largest = df.groupBy(group).count().agg(F.max("count")).first()[0] or 0
    buckets = max(8, math.ceil(largest / rows_per_bucket))
    dealt = df.withColumn("__bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)).cast("int"))
    before = Window.partitionBy(group).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        dealt.groupBy(group, "__bucket").agg(F.count("*").alias("__n"))
        .select(group, "__bucket", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    )
    inside = F.row_number().over(Window.partitionBy(group, "__bucket").orderBy(*order)) - 1
    return (
        dealt.withColumn("__inside", inside)
        .join(starts, [group, "__bucket"])
        .withColumn(name, (F.col("__start") + F.col("__inside")).cast("long"))
        .drop("__bucket", "__inside", "__start")
    )
