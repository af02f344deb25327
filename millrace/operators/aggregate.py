"""Grouped aggregation, pivots and the sales summaries."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

AggSpec = str | Callable[[Column], Column]


def skewness(value: Column) -> Column:
    """Bias-corrected skewness; NULL for fewer than three values."""
    n = F.count(value).cast("double")
    return F.when(n > 2, F.try_divide(F.skewness(value) * F.sqrt(n * (n - 1)), n - 2))


def kurtosis(value: Column) -> Column:
    """Bias-corrected excess kurtosis; NULL for fewer than four values."""
    n = F.count(value).cast("double")
    return F.when(n > 3, F.try_divide(n - 1, (n - 2) * (n - 3)) * ((n + 1) * F.kurtosis(value) + 6))


def quantile(share: float = 0.5) -> Callable[[Column], Column]:
    """Exact quantile with linear interpolation."""

    def at(value: Column) -> Column:
        return F.percentile(value, F.lit(share))

    at.__name__ = f"q{round(share * 100)}"
    return at


# Aggregate names a caller may use, with sample statistics as the default.
NAMED: dict[str, Callable[[Column], Column]] = {
    "sum": F.sum,
    "mean": F.avg,
    "avg": F.avg,
    "count": F.count,
    "min": F.min,
    "max": F.max,
    "std": F.stddev,
    "var": F.variance,
    "nunique": F.countDistinct,
    "approx_nunique": F.approx_count_distinct,
    "skew": skewness,
    "kurt": kurtosis,
    "median": F.median,
    "quantile": quantile(),
    "prod": F.product,
    "size": lambda value: F.count(F.lit(1)),
}
# Names that need an order of rows.
ORDERED: dict[str, Callable[[Column, Column], Column]] = {"first": F.min_by, "last": F.max_by}


def resolve(fn: AggSpec, order: Column | None = None) -> Callable[[Column], Column]:
    """Turn an aggregate name or a Column function into a Column function.

    ``first`` and ``last`` take the first or last value that is not NULL, in the given order.
    """
    if callable(fn):
        return fn
    if fn in ORDERED:
        if order is None:
            raise ValueError(f"{fn} needs an order column")
        return lambda value: ORDERED[fn](value, F.when(value.isNotNull(), order))
    if fn not in NAMED:
        raise ValueError(f"unknown aggregate: {fn}")
    return NAMED[fn]


def aggregate(
    df: DataFrame,
    group_by: str | Sequence[str],
    aggregations: dict[str, AggSpec | Sequence[AggSpec] | dict[str, AggSpec]],
    keep_null_keys: bool = False,
    order_by: str | Column | None = None,
) -> DataFrame:
    """General group-by.

    A single function keeps the column name, a list gives ``<col>_<fn>``, and a
    dict maps output names to functions. Rows with a NULL key are dropped unless
    ``keep_null_keys``. ``order_by`` gives the row order for ``first`` and ``last``.
    """
    order = F.col(order_by) if isinstance(order_by, str) else order_by
    keys = [group_by] if isinstance(group_by, str) else list(group_by)
    multi = any(isinstance(s, (list, tuple)) for s in aggregations.values())
    out = []
    for column, spec in aggregations.items():
        value = F.col(column)
        if isinstance(spec, dict):
            out += [resolve(fn, order)(value).alias(name) for name, fn in spec.items()]
        elif isinstance(spec, (list, tuple)):
            out += [resolve(fn, order)(value).alias(f"{column}_{_fn_name(fn)}") for fn in spec]
        else:
            name = f"{column}_{_fn_name(spec)}" if multi else column
            out.append(resolve(spec, order)(value).alias(name))
    if not keep_null_keys:
        df = df.dropna(subset=keys)
    return df.groupBy(*keys).agg(*out)


def _fn_name(fn: AggSpec) -> str:
    return fn if isinstance(fn, str) else fn.__name__


def pivot_aggregation(
    df: DataFrame,
    index: str | Sequence[str],
    columns: str,
    values: str,
    agg_func: AggSpec = "sum",
    fill_value: float | int | str | None = 0,
    pivot_values: Sequence | None = None,
) -> DataFrame:
    """Pivot table. Pass ``pivot_values`` to save the pass that finds them.

    Without them Spark reads the distinct values itself and refuses more than
    ``spark.sql.pivotMaxValues``.
    """
    keys = [index] if isinstance(index, str) else list(index)
    grouped = df.dropna(subset=[*keys, columns]).groupBy(*keys)
    pivoted = grouped.pivot(columns, list(pivot_values)) if pivot_values else grouped.pivot(columns)
    out = pivoted.agg(resolve(agg_func)(F.col(values)))
    if fill_value is None:
        return out
    return out.fillna(fill_value, subset=[c for c in out.columns if c not in keys])


def sales_by_region(sales: DataFrame) -> DataFrame:
    """Transactions, revenue and average value per day and region."""
    return sales.groupBy("transaction_date", "region").agg(
        F.count("*").alias("transaction_count"),
        F.sum("total_amount").alias("total_revenue"),
        F.avg("total_amount").alias("avg_transaction_value"),
    )


def sales_by_region_from_lines(
    line: DataFrame, orders: DataFrame, customer: DataFrame, nation: DataFrame, region: DataFrame
) -> DataFrame:
    """The same summary straight from the normalised tables.

    Day and region depend only on the order, so lines are summed per order
    before the join: the group-by and the join share one exchange on the order
    key, and the sums shrink the shuffle.
    """
    per_order = line.groupBy("l_orderkey").agg(
        F.count("*").alias("n"), F.sum("l_extendedprice").alias("amount")
    )
    return (
        per_order.join(orders, per_order.l_orderkey == orders.o_orderkey)
        .join(customer, orders.o_custkey == customer.c_custkey)
        .join(nation, customer.c_nationkey == nation.n_nationkey)
        .join(region, nation.n_regionkey == region.r_regionkey)
        .groupBy(F.to_date("o_orderdate").alias("transaction_date"), F.col("r_name").alias("region"))
        .agg(F.sum("n").alias("transaction_count"), F.sum("amount").alias("total_revenue"))
        .withColumn("avg_transaction_value", F.col("total_revenue") / F.col("transaction_count"))
    )


def product_performance(sales: DataFrame, approximate: bool = False) -> DataFrame:
    """Units, revenue and distinct customers per day and product."""
    distinct = F.approx_count_distinct if approximate else F.countDistinct
    return sales.groupBy("transaction_date", "product_id").agg(
        F.sum("quantity").alias("units_sold"),
        F.sum("total_amount").alias("revenue"),
        distinct("customer_id").alias("unique_customers"),
    )


def daily_summary(sales: DataFrame, as_of: Column, created_at: Column) -> DataFrame:
    """Totals per region for the day before ``as_of``."""
    return (
        sales.filter(F.col("transaction_date") == F.date_sub(as_of, 1))
        .groupBy(F.col("transaction_date").alias("date"), "region")
        .agg(
            F.count("*").alias("transaction_count"),
            F.sum("quantity").alias("total_quantity"),
            F.sum("total_amount").alias("total_revenue"),
            F.avg("total_amount").alias("avg_transaction_value"),
        )
        .withColumn("created_at", created_at)
    )


def customer_lifetime_value(sales: DataFrame) -> DataFrame:
    """Revenue, purchases and first and last day per customer."""
    return sales.groupBy("customer_id").agg(
        F.sum("total_amount").alias("lifetime_value"),
        F.count("*").alias("purchases"),
        F.min("transaction_date").alias("first_purchase"),
        F.max("transaction_date").alias("last_purchase"),
    )


def batch_summary(df: DataFrame, amount: str = "total_amount") -> DataFrame:
    """Size, average amount and revenue of one batch."""
    return df.agg(
        F.count("*").alias("batch_size"),
        F.coalesce(F.avg(amount), F.lit(0.0)).alias("avg_amount"),
        F.coalesce(F.sum(amount), F.lit(0.0)).alias("total_revenue"),
    )


def success_counters(df: DataFrame, status: str = "status") -> DataFrame:
    """Processed rows, other rows, and the success rate (0 for no rows)."""
    ok = F.count_if(F.col(status) == "processed")
    rate = F.coalesce(F.try_divide(ok, F.count("*")), F.lit(0.0))
    return df.agg(ok.alias("processed"), (F.count("*") - ok).alias("errors"), rate.alias("success_rate"))


def outcome_summary(df: DataFrame, ok: Column, amount: str, keys: Sequence[str] = ()) -> DataFrame:
    """Succeeded and failed counts, total and average amount, per key or overall."""
    return df.groupBy(*keys).agg(
        F.count("*").alias("total"),
        F.count_if(ok).alias("successful"),
        F.count_if(~ok).alias("failed"),
        F.sum(F.when(ok, F.col(amount))).alias("amount_total"),
        F.avg(F.when(ok, F.col(amount))).alias("amount_avg"),
    )
