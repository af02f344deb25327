"""Resampling on calendar bins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.aggregate import AggSpec, resolve

# Names a caller may use for each bin width.
WINDOW_NAMES = {
    "hourly": "H", "daily": "D", "weekly": "W", "monthly": "M", "quarterly": "Q", "yearly": "Y",
}

# Date-truncation unit and the step between bins.
_UNIT = {"H": "hour", "D": "day", "W": "week", "M": "month", "Q": "quarter", "Y": "year"}
_STEP = {"H": "1 hour", "D": "1 day", "W": "7 days", "M": "1 month", "Q": "3 months", "Y": "1 year"}


def _start(ts: Column, freq: str) -> Column:
    return F.date_trunc(_UNIT[freq], ts)


def _label(start: Column, freq: str) -> Column:
    """Hours and days are labelled by their start, longer bins by their last day."""
    if freq in ("H", "D"):
        return start
    if freq == "W":
        return start + F.expr("INTERVAL 6 DAYS")
    return start + F.expr(f"INTERVAL {_STEP[freq].upper()}") - F.expr("INTERVAL 1 DAY")


def bin_label(ts: Column, freq: str) -> Column:
    """Label of the bin that holds ``ts``."""
    return _label(_start(ts, freq), freq)


def date_parts(df: DataFrame, column: str) -> DataFrame:
    """Add year, month, quarter, day_of_week (Monday 0) and ISO week."""
    c = F.col(column)
    return df.withColumns(
        {
            "year": F.year(c),
            "month": F.month(c),
            "quarter": F.quarter(c),
            "day_of_week": F.weekday(c),
            "week_of_year": F.weekofyear(c),
        }
    )


def _fill_gaps(binned: DataFrame, start: str, freq: str, zero: Sequence[str]) -> DataFrame:
    """Add the bins between the first and the last one; sums and counts become 0."""
    step = F.expr(f"INTERVAL {_STEP[freq].upper()}")
    bounds = binned.agg(F.min(start).alias("_lo"), F.max(start).alias("_hi")).filter(F.col("_lo").isNotNull())
    # First the years, then the bins of each: a stray date makes rows, never one huge list.
    year = F.expr("INTERVAL 1 YEAR")
    years = bounds.select(
        "_lo", "_hi", F.explode(F.sequence(F.date_trunc("year", "_lo"), F.date_trunc("year", "_hi"), year)).alias("_year")
    ).repartition("_year")
    # The grid of a year counts from the first bin at or before it, so that weeks run on across years.
    first = _start(F.greatest("_year", "_lo"), freq)
    grid = years.select(
        "_lo", "_hi", "_year", F.explode(F.sequence(first, F.least(F.col("_year") + year, F.col("_hi")), step)).alias(start)
    )
    grid = grid.filter((F.col(start) >= F.col("_lo")) & (F.col(start) <= F.col("_hi"))).select(start).distinct()
    return grid.join(binned, start, "left").fillna(0, subset=list(zero))


def time_series_aggregation(
    df: DataFrame,
    date_column: str,
    value_columns: Sequence[str],
    freq: str = "D",
    agg_func: AggSpec = "sum",
) -> DataFrame:
    """Resample to calendar bins, keep empty bins, add date parts."""
    freq = WINDOW_NAMES.get(freq, freq)
    if freq not in _UNIT:
        raise ValueError(f"unknown frequency: {freq}")
    agg = resolve(agg_func)
    ts = F.col(date_column).cast("timestamp")
    binned = (
        df.filter(ts.isNotNull())
        .groupBy(_start(ts, freq).alias("_start"))
        .agg(*[agg(F.col(c)).alias(c) for c in value_columns])
    )
    zero = value_columns if agg_func in ("sum", "count") else []
    filled = _fill_gaps(binned, "_start", freq, zero)
    out = filled.select(_label(F.col("_start"), freq).alias(date_column), *value_columns)
    return date_parts(out, date_column)


def aggregate_by_time_window(
    df: DataFrame,
    timestamp_column: str,
    windows: Sequence[str],
    value_columns: Sequence[str],
    agg_funcs: Sequence[str],
) -> dict[str, DataFrame]:
    """Several bin widths from one hourly pass; columns are ``<col>_<fn>``.

    Every width is rolled up from hourly partial results, so the detail rows are
    scanned and shuffled once however many widths are asked for.
    """
    known = {"sum", "mean", "count", "min", "max"}
    if not agg_funcs or set(agg_funcs) - known:
        raise ValueError(f"aggregates must be some of {sorted(known)}")
    ts = F.col(timestamp_column).cast("timestamp")
    parts = [
        fn(c).alias(f"_{name}_{c}")
        for c in value_columns
        for name, fn in (("sum", F.sum), ("count", F.count), ("min", F.min), ("max", F.max))
    ]
    hourly = df.filter(ts.isNotNull()).groupBy(_start(ts, "H").alias("_hour")).agg(*parts)
    results = {}
    for window in windows:
        freq = WINDOW_NAMES.get(window, window)
        if freq not in _UNIT:
            raise ValueError(f"unknown window: {window}")
        cols, zero = [], []
        for c in value_columns:
            total, n = F.sum(f"_sum_{c}"), F.sum(f"_count_{c}")
            rolled = {
                "sum": total,
                "mean": F.try_divide(total, n),
                "count": n,
                "min": F.min(f"_min_{c}"),
                "max": F.max(f"_max_{c}"),
            }
            for fn in agg_funcs:
                cols.append(rolled[fn].alias(f"{c}_{fn}"))
                if fn in ("sum", "count"):
                    zero.append(f"{c}_{fn}")
        binned = hourly.groupBy(_start(F.col("_hour"), freq).alias("_start")).agg(*cols)
        filled = _fill_gaps(binned, "_start", freq, zero)
        values = [c for c in filled.columns if c != "_start"]
        labelled = filled.select(_label(F.col("_start"), freq).alias(timestamp_column), *values)
        results[window] = date_parts(labelled, timestamp_column)
    return results
