"""A list of named metrics, computed column by column."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators import ordered


def calculate_metrics(df: DataFrame, metrics: Sequence[dict], order_by: Sequence[str | Column] = ()) -> DataFrame:
    """Add each metric as a column, in the order given; later ones may use earlier ones.

    Every metric has ``name`` and ``type``: ratio (numerator, denominator), percentage (value,
    total), difference (column1, column2), growth_rate and cumulative (value, along
    ``order_by``), rank (value, ascending) or custom (formula: an SQL expression or a Column).
    Division by zero gives NULL.
    """
    for m in metrics:
        name, kind = m["name"], m["type"]
        if kind in ("growth_rate", "cumulative") and not order_by:
            raise ValueError(f"{name}: {kind} needs an order")
        if kind == "ratio":
            df = df.withColumn(name, F.try_divide(m["numerator"], m["denominator"]))
        elif kind == "percentage":
            df = df.withColumn(name, F.try_divide(m["value"], m["total"]) * 100)
        elif kind == "difference":
            df = df.withColumn(name, F.col(m["column1"]) - F.col(m["column2"]))
        elif kind == "growth_rate":
            df = ordered.growth_rate(df, order_by, m["value"], name)
        elif kind == "cumulative":
            df = ordered.cumulative(df, order_by, m["value"], name)
        elif kind == "rank":
            df = ordered.average_rank(df, m["value"], name, m.get("ascending", False))
        elif kind == "custom":
            df = df.withColumn(name, F.expr(m["formula"]) if isinstance(m["formula"], str) else m["formula"])
        else:
            raise ValueError(f"unknown metric type: {kind}")
    return df
