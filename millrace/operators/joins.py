"""Join helpers over keys; Spark picks the strategy from sizes it knows."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Join:
    """One step of a join chain: table, ON condition and type."""

    table: DataFrame
    on: str | Column | list[str]
    how: str = "inner"


def join_chain(
    main: DataFrame, joins: Sequence[Join], columns: Sequence[str | Column] | None = None, where: str | Column | None = None
) -> DataFrame:
    """Main table joined with each table in turn, filtered and projected.

    Conditions may use any predicate, but need an equality for a shuffled join.
    """
    out = main
    for j in joins:
        on = F.expr(j.on) if isinstance(j.on, str) else j.on
        out = out.join(j.table, on, j.how)
    if where is not None:
        out = out.filter(where)
    return out.select(*columns) if columns else out


def orphans(facts: DataFrame, dimension: DataFrame, fact_key: str, dimension_key: str) -> DataFrame:
    """Fact rows whose key the dimension lacks (a NULL key counts)."""
    keys = dimension.select(F.col(dimension_key).alias("_dim_key"))
    return facts.join(keys, F.col(fact_key) == F.col("_dim_key"), "left_anti")


def values_without_reference(df: DataFrame, column: str, reference: DataFrame) -> DataFrame:
    """Distinct values of a column that the reference set lacks, NULL included."""
    ref = reference.select(F.col(reference.columns[0]).alias("_ref"))
    values = df.select(column).distinct()
    return values.join(ref, F.col(column).eqNullSafe(F.col("_ref")), "left_anti")


def lookup_name(df: DataFrame, names: DataFrame, key: str, name: str, prefix: str = "class_") -> DataFrame:
    """Add the name of a key, or ``<prefix><key>`` for unknown ones."""
    joined = df.join(names.select(key, name), key, "left")
    return joined.withColumn(name, F.coalesce(name, F.concat(F.lit(prefix), F.col(key).cast("string"))))
