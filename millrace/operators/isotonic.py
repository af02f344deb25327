"""Isotonic regression over many tasks: pools inside slices of the scores, then over what is left of them."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.ordered import forward_fill
from millrace.session import pin, unpin

# Blocks of one slice, and fitted blocks up to which a model goes to every task.
SLICE_BLOCKS = 500_000
LOCAL_BLOCKS = 200_000

BLOCKS = "lo double, hi double, total double, weight double"


class _Pool:
    """Blocks of rising mean; a new one that falls below the last is pooled with it."""

    def __init__(self) -> None:
        self.blocks: list[list[float]] = []

    def add(self, lo: float, hi: float, total: float, weight: float) -> None:
        blocks = self.blocks
        while blocks and blocks[-1][2] * weight >= total * blocks[-1][3]:
            last = blocks.pop()
            lo, total, weight = last[0], last[2] + total, last[3] + weight
        blocks.append([lo, hi, total, weight])


def _pooled(blocks: DataFrame, cuts: Sequence[float]) -> DataFrame:
    """The blocks pooled within the slices between the cuts; equal means in a row are one block."""
    slice_of = F.size(F.filter(F.array(*[F.lit(float(c)) for c in cuts]), lambda c: c <= F.col("lo"))) if cuts else F.lit(0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pool, now = _Pool(), None

        def out() -> pa.RecordBatch:
            parts = [pa.array(c, pa.float64()) for c in zip(*pool.blocks)]
            return pa.RecordBatch.from_arrays([pa.array([now] * len(pool.blocks), pa.int32()), *parts], ["slice", "lo", "hi", "total", "weight"])

        for batch in batches:
            for part, *block in zip(*[c.to_pylist() for c in batch.columns]):
                if part != now:
                    if pool.blocks:
                        yield out()
                    pool, now = _Pool(), part
                pool.add(*block)
        if pool.blocks:
            yield out()

    placed = blocks.select(slice_of.cast("int").alias("slice"), "lo", "hi", "total", "weight")
    tasks = min(len(cuts) + 1, max(int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions")), (len(cuts) + 1) // 4))
    return placed.repartition(tasks, "slice").sortWithinPartitions("slice", "lo").mapInArrow(run, f"slice int, {BLOCKS}")


def fit_isotonic(
    df: DataFrame, score: str, label: str, weight: str | None = None, slice_blocks: int = SLICE_BLOCKS
) -> DataFrame:
    """The rising step function of the score nearest to the label by weighted squares.

    Rows are counted per score first. Neighbouring scores whose means do not rise are pooled inside slices of
    the scores; pooling what pooling left gives the same as pooling all at once, so slices are then
    cut anew through the middle of the old ones, and joined where few blocks are left, until every
    border rises. Only the borders of the slices come to the driver. NULL and NaN scores and
    NULL labels do not count. Returns lo and hi score of every block, calibrated (its mean), weight.
    """
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    s, y = F.col(score).cast("double"), F.col(label).cast("double")
    rows = df.where(s.isNotNull() & ~F.isnan(s) & y.isNotNull())
    counted = pin(rows.groupBy((s + 0.0).alias("lo")).agg(F.sum(y * w).alias("total"), F.sum(w).alias("weight")).where("weight > 0").select(
        "lo", F.col("lo").alias("hi"), "total", "weight"
    ))
    n = counted.count()
    slices = max(1, -(-n // slice_blocks))
    shares = [k / slices for k in range(1, slices)]
    cuts = sorted(set(counted.agg(F.percentile_approx("lo", shares, F.lit(10_000))).first()[0])) if shares else []
    held = counted
    while True:
        pooled = pin(_pooled(held, cuts))
        unpin(held)
        held = pooled.drop("slice")
        held._pinned_path = pooled._pinned_path
        borders = pooled.groupBy("slice").agg(
            F.count("*").alias("n"), F.percentile_approx("lo", 0.5).alias("middle"),
            F.min_by(F.col("total") / F.col("weight"), "lo").alias("first"), F.max_by(F.col("total") / F.col("weight"), "lo").alias("last"),
        ).orderBy("slice").collect()
        if all(a.last < b.first for a, b in zip(borders, borders[1:])):
            break
        cuts, filled = [], borders[0].n / 2
        for a, b in zip(borders, borders[1:]):
            # The middle of three blocks or more is no old border.
            if a.n > 2 and filled + (a.n + b.n) / 2 > slice_blocks:
                cuts.append(a.middle)
                filled = a.n / 2
            filled += b.n / 2
    return held.select("lo", "hi", (F.col("total") / F.col("weight")).alias("calibrated"), "weight")


def calibrate(df: DataFrame, blocks: DataFrame, score: str, output: str = "calibrated", local_blocks: int = LOCAL_BLOCKS) -> DataFrame:
    """Add the fitted value: a block's own inside it, a straight line between two blocks, the outer ones beyond.

    NULL and NaN scores give NULL, and everything does if nothing was fitted. A model within
    ``local_blocks`` goes to every task; a larger one is merged with the rows by score.
    """
    blocks = pin(blocks)
    n = blocks.count()
    if n <= local_blocks:
        edges = blocks.orderBy("lo").toPandas()
        x = edges[["lo", "hi"]].to_numpy().ravel()
        y = np.repeat(edges["calibrated"].to_numpy(), 2)

        @F.pandas_udf("double")
        def value(scores):
            import pandas as pd

            known = scores.astype(float)
            return pd.Series(np.where(known.isna() | (not len(x)), np.nan, np.interp(known, x, y) if len(x) else np.nan))

        known = F.col(score).cast("double")
        return df.withColumn(output, F.when(known.isNotNull() & ~F.isnan(known), value(known))).withColumn(
            output, F.when(~F.isnan(output), F.col(output))
        )
    key = F.monotonically_increasing_id()
    rows = pin(df.withColumn("__row", key))
    places = rows.select("__row", F.col(score).cast("double").alias("x"), F.lit(1).alias("is_row"), F.lit(None).cast("double").alias("at"), F.lit(None).cast("double").alias("v"))
    ends = blocks.select(F.inline(F.array(*[F.struct(F.col(c).alias("x"), F.col("calibrated").alias("v")) for c in ("lo", "hi")]))).groupBy("x").agg(F.max("v").alias("v"))
    marks = ends.select(F.lit(None).cast("long").alias("__row"), "x", F.lit(0).alias("is_row"), F.col("x").alias("at"), "v")
    both = places.where("x IS NOT NULL AND NOT isnan(x)").unionByName(marks)
    back = forward_fill(both.withColumns({"a": F.col("at"), "va": F.col("v")}), ["x", "is_row", "__row"], ["a", "va"])
    # The other way round: the next end at or behind the row.
    ahead = forward_fill(
        back.withColumns({"b": F.col("at"), "vb": F.col("v")}), [F.col("x").desc(), F.col("is_row").asc(), F.col("__row").desc()], ["b", "vb"]
    ).where("is_row = 1")
    share = (F.col("x") - F.col("a")) / (F.col("b") - F.col("a"))
    between = F.when(F.col("a").isNull(), F.col("vb")).when(F.col("b").isNull() | (F.col("a") == F.col("b")), F.col("va")).otherwise(
        F.col("va") + (F.col("vb") - F.col("va")) * share
    )
    return rows.join(ahead.select("__row", between.alias(output)), "__row", "left").drop("__row")
