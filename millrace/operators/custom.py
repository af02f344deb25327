"""Functions of the caller: whole groups as Arrow tables, and aggregates in two phases."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.ordered import join_on
from millrace.session import pin

# Bytes of a group that a task may hold.
GROUP_BYTES = 256 << 20
# Groups whose states a task holds before it hands them on, and states of one group that meet at a time.
HELD_GROUPS = 50_000
SALTS = 32


def row_bytes(schema: T.StructType) -> Column:
    """About the size of a row in memory."""
    sizes = []
    for f in schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            sizes.append(F.coalesce(F.octet_length(c), F.lit(0)) + 16)
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            sizes.append(F.coalesce(F.length(F.to_json(F.struct(c))), F.lit(0)) + 16)
        else:
            sizes.append(F.lit(16))
    return sum(sizes, F.lit(0)).cast("long")


def apply_per_group(
    df: DataFrame, by: Sequence[str], function: Callable[[pa.Table], pa.Table], schema: str, max_bytes: int = GROUP_BYTES
) -> DataFrame:
    """Call ``function`` with every group's rows as one Arrow table; it returns a table of ``schema``.

    A group whose function fails gives one row with the failure in ``error`` and NULL elsewhere; other
    groups are not touched by it. A group of more than about ``max_bytes`` is not handed to one
    task: it gives one such row that says so. NULL keys are a group like any other; an empty table has
    no groups. Returns the keys, the columns of ``schema``, and ``error``.
    """
    by = list(by)
    declared = T.StructType.fromDDL(schema)
    clash = set(declared.names) & {*by, "error"}
    if clash:
        raise ValueError(f"names taken by keys or error: {', '.join(sorted(clash))}")
    keys = T.StructType([df.schema[c] for c in by])
    out_schema = T.StructType([*keys.fields, *declared.fields, T.StructField("error", T.StringType())])
    empty = df.sparkSession.createDataFrame([], out_schema)
    arrow = empty.toArrow().schema
    sizes = df.groupBy(*by).agg(F.sum(row_bytes(df.schema)).alias("_bytes"))
    large = pin(sizes.where(F.col("_bytes") > max_bytes))

    def run(key: tuple, table: pa.Table) -> pa.Table:
        try:
            made = function(table)
            columns = [made.column(f.name).cast(arrow.field(f.name).type) for f in declared.fields]
            n, error = made.num_rows, None
        except Exception as e:
            n, error = 1, f"{type(e).__name__}: {e}"
            columns = [pa.nulls(1, arrow.field(f.name).type) for f in declared.fields]
        head = [pa.array([k.as_py()] * n, arrow.field(c).type) for k, c in zip(key, by)]
        return pa.Table.from_arrays([*head, *columns, pa.array([error] * n, pa.string())], schema=arrow)

    fitting = join_on(df, large, by, "left_anti") if large.take(1) else df
    done = fitting.groupBy(*by).applyInArrow(run, out_schema)
    refused = large.select(
        *by, *[F.lit(None).cast(f.dataType).alias(f.name) for f in declared.fields],
        F.concat(F.lit("group of about "), F.col("_bytes"), F.lit(f" bytes is over the limit of {max_bytes}")).alias("error"),
    )
    return done.unionByName(refused)


def check_groups(
    df: DataFrame, by: Sequence[str], check: Callable[[pa.Table], bool | str], max_bytes: int = GROUP_BYTES
) -> DataFrame:
    """One row per group: whether the caller's check passed, and its message.

    The check returns True, False, or a message that tells what is wrong. Where it fails itself, or
    the group is too large, ``passed`` is False and the message says why.
    """
    def run(table: pa.Table) -> pa.Table:
        said = check(table)
        message = said if isinstance(said, str) else None
        return pa.table({"passed": [said is True or (not isinstance(said, str) and bool(said))], "message": pa.array([message], pa.string())})

    out = apply_per_group(df, by, run, "passed boolean, message string", max_bytes)
    return out.select(*by, F.coalesce("passed", F.lit(False)).alias("passed"), F.coalesce("message", "error").alias("message"))


@dataclass(frozen=True)
class TwoPhase:
    """An aggregate of the caller.

    ``partial`` turns some rows of a group into a state, ``merge`` joins two states in any order, ``finish``
    turns the last one into the value of type ``returns``. States travel pickled.
    """

    partial: Callable[[pa.Table], Any]
    merge: Callable[[Any, Any], Any]
    finish: Callable[[Any], Any]
    returns: str = "double"


def aggregate(df: DataFrame, by: Sequence[str], aggregates: dict[str, TwoPhase]) -> DataFrame:
    """The caller's aggregates per group, in two phases.

    Tasks make states of the rows they read, merge those of a group, and hand on one state per group (or one per
    HELD_GROUPS groups met in between); states of a busy group are merged under SALTS salts first. So
    rows are not shuffled and no task holds a group. NULL keys are a group; an empty table gives no
    rows, and neither does it without keys.
    """
    by = list(by)
    names = list(aggregates)
    keys = T.StructType([df.schema[c] for c in by])
    held = T.StructType([*keys.fields, T.StructField("_salt", T.IntegerType()), T.StructField("_state", T.BinaryType())])
    arrow = df.sparkSession.createDataFrame([], held).toArrow().schema
    kinds = [T.StructType.fromDDL(f"v {a.returns}").fields[0].dataType for a in aggregates.values()]
    final = T.StructType([*keys.fields, *[T.StructField(n, k) for n, k in zip(names, kinds)]])
    final_arrow = df.sparkSession.createDataFrame([], final).toArrow().schema

    def merged(a: list, b: list) -> list:
        return [g.merge(x, y) for g, x, y in zip(aggregates.values(), a, b)]

    def out(states: dict[tuple, list], salt: int) -> pa.RecordBatch:
        columns = [pa.array([k[i] for k in states], arrow.field(c).type) for i, c in enumerate(by)]
        return pa.RecordBatch.from_arrays(
            [*columns, pa.array([salt] * len(states), pa.int32()), pa.array([pickle.dumps(s) for s in states.values()], pa.binary())], schema=arrow
        )

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        salt = TaskContext.get().partitionId() % SALTS
        states: dict[tuple, list] = {}
        for batch in batches:
            table = pa.Table.from_batches([batch])
            rows: dict[tuple, list[int]] = {}
            lists = [table.column(c).to_pylist() for c in by]
            for at, key in enumerate(zip(*lists) if by else [()] * table.num_rows):
                rows.setdefault(key, []).append(at)
            for key, places in rows.items():
                part = table if len(rows) == 1 else table.take(pa.array(places))
                new = [g.partial(part) for g in aggregates.values()]
                states[key] = merged(states[key], new) if key in states else new
            if len(states) >= HELD_GROUPS:
                yield out(states, salt)
                states = {}
        if states:
            yield out(states, salt)

    def join(table: pa.Table) -> list:
        states = (pickle.loads(s.as_py()) for s in table.column("_state"))
        state = next(states)
        for more in states:
            state = merged(state, more)
        return state

    def second(key: tuple, table: pa.Table) -> pa.Table:
        *group, salt = [k.as_py() for k in key]
        return pa.Table.from_batches([out({tuple(group): join(table)}, salt)])

    def last(key: tuple, table: pa.Table) -> pa.Table:
        values = [g.finish(s) for g, s in zip(aggregates.values(), join(table))]
        columns = [pa.array([v], f.type) for v, f in zip([*[k.as_py() for k in key], *values], final_arrow)]
        return pa.Table.from_arrays(columns, schema=final_arrow)

    states = df.mapInArrow(first, held)
    salted = states.groupBy(*by, "_salt").applyInArrow(second, held)
    if by:
        return salted.groupBy(*by).applyInArrow(last, final)
    # Without keys at most SALTS states are left.
    return salted.groupBy(F.lit(1).alias("_all")).applyInArrow(lambda key, table: last((), table), final)


def geometric_mean(column: str) -> TwoPhase:
    """Of the positive values; NULL without any."""
    def partial(table: pa.Table) -> tuple[float, int]:
        import numpy as np

        v = table.column(column).drop_null().to_numpy().astype(float)
        v = v[v > 0]
        return float(np.log(v).sum()), len(v)

    def finish(state: tuple[float, int]) -> float | None:
        import math

        return math.exp(state[0] / state[1]) if state[1] else None

    return TwoPhase(partial, lambda a, b: (a[0] + b[0], a[1] + b[1]), finish)


def mode(column: str, returns: str) -> TwoPhase:
    """The most frequent value, the smallest of those as frequent; the state counts distinct values."""
    from collections import Counter

    return TwoPhase(
        lambda table: Counter(table.column(column).drop_null().to_pylist()), lambda a, b: a + b,
        lambda state: min(state, key=lambda v: (-state[v], v)) if state else None, returns,
    )
