"""Ordered analytics that stay parallel with no key, or with one huge key.

A plain window sorts each key in one task. Here rows are range-partitioned on
(keys, order) instead, so a key with a third of all rows spans many slices; the
slices' small totals are carried forward and added to a window inside each slice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.session import pin

SLICE, TIE, PLACE, ORDINAL, BLOCK, HOME = "_slice", "_tie", "_place", "_ordinal", "_block", "_home"

# Rows per block when a frame reaches back over earlier rows.
BLOCK_ROWS = 100_000

# First rows per key that may meet in one task: so many from each map task.
GROUP_LIMIT_ROWS = 100

Order = str | Column


def _column(item: Order) -> Column:
    return F.col(item) if isinstance(item, str) else item


def _slices(df: DataFrame, keys: Sequence[str], order_by: Sequence[Order], place: str | None = None) -> DataFrame:
    """Range-partition on keys and order, and stamp each row with its slice; with ``place`` also with a
    number that grows by one from row to row of the slice."""
    order = [_column(o) for o in order_by]
    ranged = df.withColumn(TIE, F.monotonically_increasing_id()).repartitionByRange(
        *[F.col(k) for k in keys], *order, F.col(TIE)
    )
    if place:
        ranged = ranged.sortWithinPartitions(*[F.col(k) for k in keys], *order, F.col(TIE)).withColumn(place, F.monotonically_increasing_id())
    # The slice numbers must not change under the two reads below.
    return pin(ranged.withColumn(SLICE, F.spark_partition_id()))


def join_on(left: DataFrame, right: DataFrame, names: Sequence[str], how: str = "left") -> DataFrame:
    """Join on equally named keys where NULL equals NULL; keeps the left keys."""
    renamed = right.select(
        *[F.col(n).alias(f"_r_{n}") for n in names], *[F.col(c) for c in right.columns if c not in names]
    )
    cond = F.lit(True)
    for name in names:
        cond = cond & F.col(name).eqNullSafe(F.col(f"_r_{name}"))
    return left.join(renamed, cond, how).drop(*[f"_r_{n}" for n in names])


_COMBINE = {"sum": F.sum, "count": F.sum, "max": F.max, "min": F.min}


def running(
    df: DataFrame,
    order_by: Sequence[Order],
    outputs: dict[str, tuple[str, str]],
    partition_by: Sequence[str] = (),
) -> DataFrame:
    """Running sum, count, max, min or last non-null value per key.

    ``outputs`` maps a new column to (column, function). Frames run from the
    first row of the key to the current row. ``count`` counts rows when the
    column is ``*``.
    """
    keys = list(partition_by)
    order = [*[_column(o) for o in order_by], F.col(TIE)]
    rows = _slices(df, keys, order_by)
    slice_keys = [*keys, SLICE]
    local = Window.partitionBy(*slice_keys).orderBy(*order).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    before = Window.partitionBy(*keys).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    # Within a slice the row number orders "last" without rebuilding the sort keys.
    totals, carried, local_cols = [], [], {}
    for name, (column, fn) in outputs.items():
        value = F.lit(1) if column == "*" else F.col(column)
        if fn in ("sum", "max", "min"):
            agg = {"sum": F.sum, "max": F.max, "min": F.min}[fn]
            totals.append(agg(value).alias(name))
            local_cols[name] = agg(value).over(local)
        elif fn == "count":
            totals.append(F.count(value).alias(name))
            local_cols[name] = F.count(value).over(local)
        elif fn == "last":
            totals.append(F.max_by(value, F.when(value.isNotNull(), F.col("_pos"))).alias(name))
            local_cols[name] = F.last(value, ignorenulls=True).over(local)
        else:
            raise ValueError(f"unknown running function: {fn}")
        combined = F.last(name, ignorenulls=True) if fn == "last" else _COMBINE[fn](name)
        carried.append(combined.over(before).alias(f"_before_{name}"))
    source = rows
    if any(fn == "last" for _, fn in outputs.values()):
        source = rows.withColumn("_pos", F.row_number().over(Window.partitionBy(*slice_keys).orderBy(*order)))
    offsets = source.groupBy(*slice_keys).agg(*totals).select(*slice_keys, *carried)
    joined = join_on(rows, offsets, slice_keys)
    for name, (_, fn) in outputs.items():
        prev, here = F.col(f"_before_{name}"), local_cols[name]
        if fn in ("sum", "count"):
            merged = F.when(prev.isNull(), here).when(here.isNull(), prev).otherwise(prev + here)
        elif fn == "max":
            merged = F.greatest(prev, here)
        elif fn == "min":
            merged = F.least(prev, here)
        else:
            merged = F.coalesce(here, prev)
        joined = joined.withColumn(name, merged)
    return joined.drop(SLICE, TIE, *[f"_before_{n}" for n in outputs])


def with_ordinal(
    df: DataFrame, order_by: Sequence[Order], partition_by: Sequence[str] = (), name: str = ORDINAL
) -> DataFrame:
    """1-based row number per key.

    A slice is sorted before it is written, so places in it give the numbers: rows are neither shuffled
    by slice nor sorted once more.
    """
    keys = list(partition_by)
    rows = _slices(df, keys, order_by, place=PLACE)
    slice_keys = [*keys, SLICE]
    before = Window.partitionBy(*keys).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    parts = rows.groupBy(*slice_keys).agg(F.min(PLACE).alias("_first"), F.count("*").alias("_rows"))
    offsets = parts.select(*slice_keys, (F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first") + 1).alias("_shift"))
    return join_on(rows, offsets, slice_keys).withColumn(name, F.col(PLACE) + F.col("_shift")).drop(SLICE, TIE, PLACE, "_shift")


def _blocks(numbered: DataFrame, depth: int) -> DataFrame:
    """Cut numbered rows into blocks, each led by ``depth`` rows of the one before."""
    size = max(depth, BLOCK_ROWS)
    position = F.col(ORDINAL) - 1
    home = F.floor(position / size)
    needed_next = position % size >= size - depth
    return numbered.withColumn(HOME, home).withColumn(
        BLOCK, F.explode(F.when(needed_next, F.array(home, home + 1)).otherwise(F.array(home)))
    )


def _home_rows(df: DataFrame) -> DataFrame:
    return df.filter(F.col(BLOCK) == F.col(HOME)).drop(BLOCK, HOME, ORDINAL)


_ROLLING = {"mean": F.avg, "sum": F.sum, "std": F.stddev, "max": F.max, "min": F.min}


def rolling_aggregation(
    df: DataFrame,
    date_column: str,
    value_columns: Sequence[str],
    window: int = 7,
    agg_func: str = "mean",
    partition_by: Sequence[str] = (),
    tie_by: Sequence[str] = (),
) -> DataFrame:
    """Rolling statistic over the last ``window`` rows, as ``<col>_rolling_<window>``.

    NULL until the frame holds ``window`` non-null values.
    """
    if agg_func not in _ROLLING:
        raise ValueError(f"unknown rolling function: {agg_func}")
    keys = list(partition_by)
    numbered = with_ordinal(df, [date_column, *tie_by], keys)
    frame = Window.partitionBy(*keys, BLOCK).orderBy(ORDINAL).rowsBetween(-(window - 1), 0)
    out = _blocks(numbered, window - 1)
    for column in value_columns:
        full = F.count(column).over(frame) == window
        out = out.withColumn(
            f"{column}_rolling_{window}", F.when(full, _ROLLING[agg_func](column).over(frame))
        )
    return _home_rows(out)


def growth_rate(
    df: DataFrame, order_by: Sequence[Order], value: str, name: str, partition_by: Sequence[str] = ()
) -> DataFrame:
    """Change in percent against the previous row; gaps take the last known value."""
    keys = list(partition_by)
    filled = running(df, order_by, {"_filled": (value, "last"), ORDINAL: ("*", "count")}, keys)
    frame = Window.partitionBy(*keys, BLOCK).orderBy(ORDINAL)
    out = _blocks(filled, 1)
    change = F.try_divide("_filled", F.lag("_filled").over(frame)) - 1
    return _home_rows(out.withColumn(name, change * 100)).drop("_filled")


def cumulative(
    df: DataFrame, order_by: Sequence[Order], value: str, name: str, partition_by: Sequence[str] = ()
) -> DataFrame:
    """Cumulative sum; rows with a NULL value stay NULL."""
    out = running(df, order_by, {name: (value, "sum")}, partition_by)
    return out.withColumn(name, F.when(F.col(value).isNotNull(), F.col(name)))


def average_rank(
    df: DataFrame, value: str, name: str, ascending: bool = False, partition_by: Sequence[str] = ()
) -> DataFrame:
    """Rank with ties sharing their mean rank; NULL values get no rank.

    Values are counted first, so a value shared by many rows costs one row.
    """
    keys = list(partition_by)
    counts = df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("_n"))
    order = F.col(value).asc() if ascending else F.col(value).desc()
    ranks = running(counts, [order], {"_upto": ("_n", "sum")}, keys).select(
        *keys, value, (F.col("_upto") - (F.col("_n") - 1) / 2).alias(name)
    )
    return join_on(df, ranks, [*keys, value])


def forward_fill(
    df: DataFrame, order_by: Sequence[Order], columns: Sequence[str], partition_by: Sequence[str] = ()
) -> DataFrame:
    """Replace NULLs by the last earlier value of the key."""
    out = running(df, order_by, {f"_ff_{c}": (c, "last") for c in columns}, partition_by)
    for column in columns:
        out = out.withColumn(column, F.col(f"_ff_{column}")).drop(f"_ff_{column}")
    return out.select(*df.columns)


def first_rows(
    df: DataFrame, order_by: Sequence[Column], n: int, partition_by: Sequence[str]
) -> DataFrame:
    """The first ``n`` rows per key in the given order.

    Up to ``GROUP_LIMIT_ROWS``, or the lower limit the session sets, Spark itself limits each
    group before the shuffle, so no key sends more than ``n`` rows per map task. Above,
    rows are numbered over slices.
    """
    limit = int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", str(GROUP_LIMIT_ROWS)))
    if n > min(limit, GROUP_LIMIT_ROWS):
        return with_ordinal(df, order_by, partition_by).filter(F.col(ORDINAL) <= n).drop(ORDINAL)
    w = Window.partitionBy(*partition_by).orderBy(*order_by)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")


def first_last_delta(df: DataFrame, value: str, order: str, name: str, keys: Sequence[str]) -> DataFrame:
    """Last value minus first value per key."""
    return df.groupBy(*keys).agg((F.max_by(value, order) - F.min_by(value, order)).alias(name))


def chunk_rows(
    df: DataFrame, order_by: Sequence[Order], size: int, name: str = "chunk", partition_by: Sequence[str] = ()
) -> DataFrame:
    """Number consecutive chunks of ``size`` rows, from 0."""
    numbered = with_ordinal(df, order_by, partition_by)
    return numbered.withColumn(name, F.floor((F.col(ORDINAL) - 1) / size)).drop(ORDINAL)
