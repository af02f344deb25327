"""Quantiles by selection: a mergeable sketch brackets each one, a second pass gathers what is inside.

No value is sorted or shuffled but the few inside a bracket.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.ordered import join_on
from millrace.session import pin

# Ranks of the sketch are right within 1/ACCURACY of the rows; brackets reach three times as far.
ACCURACY = 10_000
# Values of a bracket that are gathered; a bracket that holds more is narrowed by another sketch.
GATHER = 500_000
# Steps of the sketch inside a bracket.
GRID = 256

_INFINITE = (float("-inf"), float("inf"))


def _value(column: str) -> Column:
    """The value as a double, NaN as NULL, both zeros as one."""
    v = F.col(column).cast("double")
    return F.when(~F.isnan(v), v + 0.0)


def approximate_quantiles(
    df: DataFrame, columns: Sequence[str], probabilities: Sequence[float], by: Sequence[str] = (), error: float = 1e-4
) -> DataFrame:
    """Quantiles from one mergeable sketch per (by, column_name), one scan, no sort.

    Each is a value of the column whose rank is off by at most ``error`` of the rows. NULL and NaN are
    left out; a column without values gives no row. Columns as in ``exact_quantiles``, and ``count``.
    """
    accuracy = F.lit(max(1, round(1 / error)))
    aggs = []
    for c in columns:
        v = _value(c)
        sketch = F.percentile_approx(v, [float(p) for p in probabilities], accuracy)
        aggs.append(F.struct(F.lit(c).alias("column_name"), F.count(v).alias("count"), sketch.alias("q")).alias(c))
    rows = df.groupBy(*by).agg(*aggs).select(*by, F.inline(F.array(*[F.col(f"`{c}`") for c in columns])))
    return rows.where("count > 0").select(
        *by, "column_name", "count", *[F.col("q")[i].alias(f"q{i}") for i in range(len(probabilities))]
    )


def distinct_counts(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Exact number of distinct values per (by, column_name), by hashing; NULL and NaN are none."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), _value(c).alias("value")) for c in columns])
    values = df.select(*by, F.inline(pairs)).where("value IS NOT NULL")
    return values.distinct().groupBy(*by, "column_name").agg(F.count("*").alias("unique_count"))


def exact_quantiles(
    df: DataFrame, columns: Sequence[str], probabilities: Sequence[float], by: Sequence[str] = (),
    accuracy: int = ACCURACY, gather: int = GATHER,
) -> DataFrame:
    """Exact linear-interpolated quantiles: one row per (by, column_name), named ``q0``, ``q1`` ...

    One scan sketches every column and gives each quantile a bracket of two values around
    its rank. A second counts what is below the bracket and gathers what is inside, about 8/``accuracy``
    of the rows; where that is more than ``gather`` values, a scan in between narrows the bracket. The
    result is exact whatever the sketch's error: a rank outside its bracket is seen
    by the counts, and the bracket widened. NULL and NaN are left out, a column without values
    gives no row; NULL is a group like any other.
    """
    columns, by = list(columns), list(by)
    values = df.select(*by, *[_value(c).alias(f"_v{j}") for j, c in enumerate(columns)])
    for reach in (3 / accuracy, 24 / accuracy, 192 / accuracy):
        found = _selected(values, len(columns), [float(p) for p in probabilities], by, accuracy, gather, reach)
        if not found.where("_bad").take(1):
            break
    else:
        raise RuntimeError("ranks of the sketch are off by far more than it promises")
    named = F.element_at(F.array(*[F.lit(c) for c in columns]), F.col("_column") + 1)
    return found.select(*by, named.alias("column_name"), *[f"q{i}" for i in range(len(probabilities))])


# Brackets: one row per group, for column j the count _n{j} and an array _b{j} of (lo, hi), one per probability.


def _selected(
    values: DataFrame, n_columns: int, probabilities: list[float], by: list[str], accuracy: int, gather: int, reach: float
) -> DataFrame:
    ends = [x for p in probabilities for x in (max(p - reach, 0.0), min(p + reach, 1.0))]
    counts = [F.count(f"_v{j}").alias(f"_n{j}") for j in range(n_columns)]
    sketches = [F.percentile_approx(f"_v{j}", ends, F.lit(accuracy)).alias(f"_q{j}") for j in range(n_columns)]
    sketched = values.groupBy(*by).agg(*counts, *sketches)

    def first_bracket(j: int) -> Column:
        whole, q = F.col(f"_n{j}") <= gather, F.col(f"_q{j}")
        return F.array(*[
            F.struct(
                F.when(whole | F.lit(p - reach <= 0), F.lit(_INFINITE[0])).otherwise(q[2 * i]).alias("lo"),
                F.when(whole | F.lit(p + reach >= 1), F.lit(_INFINITE[1])).otherwise(q[2 * i + 1]).alias("hi"),
            )
            for i, p in enumerate(probabilities)
        ]).alias(f"_b{j}")

    brackets = pin(sketched.select(*by, *[f"_n{j}" for j in range(n_columns)], *map(first_bracket, range(n_columns))))
    largest = brackets.agg(F.greatest(*[F.max(f"_n{j}") for j in range(n_columns)], F.lit(0))).first()[0] or 0
    inside = largest * 2 * (reach + 1 / accuracy)
    while largest > gather and inside > gather:
        brackets = pin(_narrowed(values, brackets, n_columns, probabilities, by, accuracy))
        inside *= (2 * _margin(accuracy) + 2) / GRID
    return pin(_gathered(values, brackets, n_columns, probabilities, by))


def _against(
    values: DataFrame, brackets: DataFrame, n_columns: int, n: int, by: list[str], inner: Callable[[Column], list[Column]]
) -> DataFrame:
    """Per group, column j and probability i: counts below, at and above the ends of the bracket, and ``inner`` aggregates of what is inside."""
    if by:
        held = join_on(values, brackets, by, "inner")

        def end(j: int, i: int, side: str) -> Column:
            return F.col(f"_b{j}")[i][side]

    else:
        row, held = brackets.first(), values

        def end(j: int, i: int, side: str) -> Column:
            bracket = row[f"_b{j}"][i]
            return F.lit(bracket[side] if bracket else None).cast("double")

    aggs = []
    for j in range(n_columns):
        v = F.col(f"_v{j}")
        for i in range(n):
            lo, hi = end(j, i, "lo"), end(j, i, "hi")
            aggs.append(F.struct(
                F.lit(j).alias("_column"), F.lit(i).alias("_i"), F.count_if(v < lo).alias("below"), F.count_if(v == lo).alias("at_lo"),
                F.count_if((v == hi) & (hi > lo)).alias("at_hi"), *inner(F.when((v > lo) & (v < hi), v)),
            ).alias(f"_s{j}_{i}"))
    names = [f"_s{j}_{i}" for j in range(n_columns) for i in range(n)]
    parts = held.groupBy(*by).agg(*aggs).select(*by, F.inline(F.array(*names)))
    known = brackets.select(*by, F.inline(F.array(*[
        F.struct(F.lit(j).alias("_column"), F.lit(i).alias("_i"), F.col(f"_n{j}").alias("_n"), F.col(f"_b{j}")[i]["lo"].alias("lo"), F.col(f"_b{j}")[i]["hi"].alias("hi"))
        for j in range(n_columns) for i in range(n)
    ])))
    return join_on(known.where("_n > 0"), parts, [*by, "_column", "_i"], "inner")


def _target(probabilities: list[float]) -> Column:
    return (F.col("_n") - 1) * F.element_at(F.array(*[F.lit(p) for p in probabilities]), F.col("_i") + 1)


def _margin(accuracy: int) -> int:
    return 1 + math.ceil(GRID / accuracy)


def _narrowed(values, brackets, n_columns: int, probabilities: list[float], by: list[str], accuracy: int) -> DataFrame:
    """Brackets between two steps of a sketch of what the present ones hold."""
    steps = [k / GRID for k in range(GRID + 1)]
    held = _against(values, brackets, n_columns, len(probabilities), by, lambda v: [
        F.count(v).alias("inside"), F.percentile_approx(v, steps, F.lit(accuracy)).alias("grid"),
    ])
    start = F.col("below") + F.col("at_lo")
    low, high = F.floor(_target(probabilities)) - start, F.ceil(_target(probabilities)) - start
    # As much further on either side as the sketch may err; grid positions beyond the ends are the ends.
    first = F.floor(low / F.col("inside") * GRID).cast("int") - _margin(accuracy)
    last = F.ceil((high + 1) / F.col("inside") * GRID).cast("int") + _margin(accuracy)
    narrow = F.struct(
        F.when((F.col("inside") == 0) | (first < 0) | (low < 0), F.col("lo")).otherwise(F.get("grid", F.least(first, F.lit(GRID)))).alias("lo"),
        F.when((F.col("inside") == 0) | (last > GRID) | (high >= F.col("inside")), F.col("hi")).otherwise(F.get("grid", F.greatest(last, F.lit(0)))).alias("hi"),
    )
    found = held.select(*by, "_column", "_i", narrow.alias("b"))
    arrays = [
        F.array(*[F.max(F.when((F.col("_column") == j) & (F.col("_i") == i), F.col("b"))) for i in range(len(probabilities))]).alias(f"_b{j}")
        for j in range(n_columns)
    ]
    rows = found.groupBy(*by).agg(*arrays)
    return join_on(brackets.select(*by, *[f"_n{j}" for j in range(n_columns)]), rows, by, "inner") if by else rows.select(
        *[F.lit(brackets.first()[f"_n{j}"]).alias(f"_n{j}") for j in range(n_columns)], *[f"_b{j}" for j in range(n_columns)]
    )


def _gathered(values, brackets, n_columns: int, probabilities: list[float], by: list[str]) -> DataFrame:
    """Quantiles per group and column from what the brackets hold."""
    held = _against(values, brackets, n_columns, len(probabilities), by, lambda v: [F.sort_array(F.collect_list(v)).alias("inside")])
    start, size = F.col("below") + F.col("at_lo"), F.size("inside")
    target = _target(probabilities)

    def at(rank: Column) -> Column:
        return F.when(rank < F.col("below"), None).when(rank < start, F.col("lo")).when(
            rank < start + size, F.get("inside", (rank - start).cast("int"))
        ).when(rank < start + size + F.col("at_hi"), F.col("hi"))

    low, high = at(F.floor(target)), at(F.ceil(target))
    one = held.select(*by, "_column", "_i", low.alias("_low"), high.alias("_high"), (target - F.floor(target)).alias("_share"))
    # Equal ends need no weights, which infinite ones could not bear.
    value = F.when(F.col("_low") == F.col("_high"), F.col("_low")).otherwise(F.col("_low") + (F.col("_high") - F.col("_low")) * F.col("_share"))
    return one.groupBy(*by, "_column").agg(
        F.bool_or(F.col("_low").isNull() | F.col("_high").isNull()).alias("_bad"),
        *[F.max(F.when(F.col("_i") == i, value)).alias(f"q{i}") for i in range(len(probabilities))],
    )
