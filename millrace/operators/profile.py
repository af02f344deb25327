"""Column profiles: summaries, missing values, distributions, outliers."""

from __future__ import annotations

import itertools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.aggregate import kurtosis, skewness
from millrace.operators.ordered import join_on
from millrace.operators.quantiles import approximate_quantiles, distinct_counts, exact_quantiles


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def known(column: str) -> Column:
    """Value with NaN read as NULL."""
    value = F.col(column)
    return F.when(~F.isnan(value.cast("double")), value)


def _long(df: DataFrame, keys: Sequence[str], columns: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """Turn ``<field>__<column>`` aggregates of one wide row into rows per column."""
    rows = [
        F.struct(F.lit(c).alias("column_name"), *[F.col(f"{f}__{c}").alias(f) for f in fields])
        for c in columns
    ]
    return df.select(*keys, F.explode(F.array(*rows)).alias("_r")).select(*keys, "_r.*")


def summary_statistics(
    df: DataFrame, columns: Sequence[str] | None = None, by: Sequence[str] = (), error: float | None = None
) -> DataFrame:
    """Profile per numeric column, overall or per group.

    Moments come from one aggregate over all columns, quartiles by selection, distinct counts by
    hashing. With ``error`` quartiles are those of a sketch, off by at most that share of the
    rows in rank, and distinct counts are estimates within about 2 %. Skewness and kurtosis are
    bias-corrected.
    """
    columns = [c for c in (columns or numeric_columns(df)) if c in df.columns and c not in by]
    aggs = []
    for c in columns:
        v = known(c).cast("double")
        n = F.count(v)
        aggs += [
            n.alias(f"count__{c}"),
            F.avg(v).alias(f"mean__{c}"),
            F.stddev(v).alias(f"std__{c}"),
            F.min(v).alias(f"min__{c}"),
            F.max(v).alias(f"max__{c}"),
            (F.count("*") - n).alias(f"null_count__{c}"),
            (F.try_divide(F.count("*") - n, F.count("*")) * 100).alias(f"null_percentage__{c}"),
            skewness(v).alias(f"skewness__{c}"),
            kurtosis(v).alias(f"kurtosis__{c}"),
        ]
    fields = ["count", "mean", "std", "min", "max", "null_count", "null_percentage", "skewness", "kurtosis"]
    moments = _long(df.groupBy(*by).agg(*aggs), by, columns, fields)
    names = [*by, "column_name"]
    if error is None:
        quartiles = exact_quantiles(df, columns, [0.25, 0.5, 0.75], by)
        distinct = distinct_counts(df, columns, by)
    else:
        quartiles = approximate_quantiles(df, columns, [0.25, 0.5, 0.75], by, error).drop("count")
        estimates = [F.approx_count_distinct(known(c).cast("double"), 0.02).alias(f"unique_count__{c}") for c in columns]
        distinct = _long(df.groupBy(*by).agg(*estimates), by, columns, ["unique_count"])
    return join_on(join_on(moments, quartiles, names), distinct, names).select(
        *names,
        *["count", "mean", "std", "min"],
        F.col("q0").alias("q25"),
        F.col("q1").alias("median"),
        F.col("q2").alias("q75"),
        *["max", "null_count", "null_percentage"],
        F.coalesce("unique_count", F.lit(0)).alias("unique_count"),
        *["skewness", "kurtosis"],
    )


def missing_table(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Missing count and percent of the columns that miss values, most first."""
    columns = list(columns or df.columns)
    numeric = set(numeric_columns(df))
    aggs = []
    for c in columns:
        gone = (known(c) if c in numeric else F.col(c)).isNull()
        aggs += [
            F.count_if(gone).alias(f"missing_count__{c}"),
            (F.try_divide(F.count_if(gone), F.count("*")) * 100).alias(f"missing_percentage__{c}"),
        ]
    table = _long(df.agg(*aggs), [], columns, ["missing_count", "missing_percentage"])
    return table.filter("missing_count > 0").orderBy(F.desc("missing_count"), "column_name")


def value_distribution(df: DataFrame, column: str) -> DataFrame:
    """Count, share and how many times rarer than the largest value each one is."""
    counts = df.groupBy(column).agg(F.count("*").alias("count"))
    overall = counts.agg(F.struct(F.sum("count").alias("n"), F.max("count").alias("top")).alias("s"))
    whole = overall.scalar()
    return counts.select(
        column,
        "count",
        (F.col("count") / whole["n"] * 100).alias("percentage"),
        (whole["top"] / F.col("count")).alias("imbalance_ratio"),
        (F.col("count") / whole["top"]).alias("balance"),
    )


def histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """Equal-width bins over the value range; the last bin is closed."""
    v = F.col(column).cast("double")
    edges = df.agg(F.struct(F.min(v).alias("lo"), F.max(v).alias("hi")).alias("s")).scalar()
    width = (edges["hi"] - edges["lo"]) / bins
    index = F.least(F.coalesce(F.floor(F.try_divide(v - edges["lo"], width)), F.lit(0)), F.lit(bins - 1))
    counted = df.filter(v.isNotNull()).groupBy(index.alias("bin")).agg(F.count("*").alias("n"))
    spark = df.sparkSession
    grid = spark.range(bins).select(F.col("id").alias("bin"))
    return grid.join(counted, "bin", "left").select(
        "bin",
        (edges["lo"] + F.col("bin") * width).alias("bin_start"),
        (edges["lo"] + (F.col("bin") + 1) * width).alias("bin_end"),
        F.coalesce("n", F.lit(0)).alias("count"),
    )


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of every pair, from one aggregate."""
    pairs = list(itertools.combinations(columns, 2))
    aggs = [F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"c{i}") for i, (a, b) in enumerate(pairs)]
    rows = [
        F.struct(F.lit(x).alias("column_a"), F.lit(y).alias("column_b"), F.col(f"c{i}").alias("correlation"))
        for i, (a, b) in enumerate(pairs)
        for x, y in ((a, b), (b, a))
    ]
    rows += [
        F.struct(F.lit(c).alias("column_a"), F.lit(c).alias("column_b"), F.lit(1.0).alias("correlation"))
        for c in columns
    ]
    return df.agg(*aggs).select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def target_correlations(df: DataFrame, columns: Sequence[str], target: str, absolute: bool = False) -> DataFrame:
    """Correlation of each column with the target, strongest first."""
    aggs = [F.corr(F.col(c).cast("double"), F.col(target).cast("double")).alias(f"correlation__{c}") for c in columns]
    table = _long(df.agg(*aggs), [], columns, ["correlation"])
    key = F.abs("correlation") if absolute else F.col("correlation")
    return table.orderBy(key.desc(), "column_name")


def iqr_fences(df: DataFrame, columns: Sequence[str], factor: float = 1.5) -> DataFrame:
    """Lower and upper outlier fence per column."""
    q = exact_quantiles(df, columns, [0.25, 0.75])
    spread = (F.col("q1") - F.col("q0")) * factor
    return q.select("column_name", (F.col("q0") - spread).alias("lower"), (F.col("q1") + spread).alias("upper"))


def fence_values(fences: DataFrame) -> dict[str, tuple[float, float]]:
    """Read the fences (one row per column) so they become filter literals."""
    return {r.column_name: (r.lower, r.upper) for r in fences.collect()}


def outlier_summary(df: DataFrame, columns: Sequence[str], factor: float = 1.5) -> DataFrame:
    """Rows outside the fences per column, as count and percent of all rows."""
    fences = fence_values(iqr_fences(df, columns, factor))
    aggs = []
    for c in columns:
        lo, hi = fences.get(c, (None, None))
        out = F.count_if((F.col(c) < lo) | (F.col(c) > hi)) if lo is not None else F.lit(0).cast("long")
        aggs += [
            out.alias(f"outlier_count__{c}"),
            (F.try_divide(out, F.count("*")) * 100).alias(f"outlier_percentage__{c}"),
            F.lit(lo).cast("double").alias(f"lower__{c}"),
            F.lit(hi).cast("double").alias(f"upper__{c}"),
        ]
    fields = ["outlier_count", "outlier_percentage", "lower", "upper"]
    return _long(df.agg(*aggs), [], columns, fields)
