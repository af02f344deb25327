"""Nearest rows by locality-sensitive hashing: several tables of random projections with bounded buckets."""

from __future__ import annotations

import random
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.session import pin, unpin

TABLES = 8
# Rows of a bucket; a larger one is cut by further projections.
BUCKET = 512
# Projections after which what is left of a bucket is dealt by key. Cells then have a
# thousand-millionth of the first width per feature, so only rows nearly equal are left.
DEPTH = 90


def _cell(x: Column, table: Column, tables: int, features: int, depth: int, seed: int) -> Column:
    """Cell of a point along the depth-th random direction of its table; cells halve once per number of features."""
    rng = random.Random(f"{seed}-{depth}")
    ways = F.array(*[F.array(*[F.lit(rng.gauss(0, 1)) for _ in range(features)]) for _ in range(tables)])
    offsets = F.array(*[F.lit(rng.random()) for _ in range(tables)])
    along = F.aggregate(F.zip_with(x, ways[table], lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v)
    return F.floor(along * F.lit(2.0 ** (depth // features)) + offsets[table])


def _bucket_pairs(keys: np.ndarray, x: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k nearest others of every row of a bucket: row, other, distance."""
    n = len(keys)
    if n < 2:
        return keys[:0], keys[:0], np.zeros(0)
    away = np.sqrt(((x[:, None, :] - x[None, :, :]) ** 2).sum(axis=2))
    np.fill_diagonal(away, np.inf)
    take = min(k, n - 1)
    near = np.argpartition(away, take - 1, axis=1)[:, :take]
    row = np.repeat(np.arange(n), take)
    return keys[row], keys[near.ravel()], away[row, near.ravel()]


def nearest_neighbours(
    df: DataFrame, key: str, features: Sequence[str], k: int = 5, by: Sequence[str] = (), tables: int = TABLES,
    bucket: int = BUCKET, rounds: int = 2, seed: int = 42,
) -> DataFrame:
    """About the ``k`` nearest other rows of every row, by Euclidean distance, within the groups of ``by``.

    Every table cuts the space into cells along random directions. Buckets of more than ``bucket``
    rows are cut again along further directions, in narrower cells, until none is left; crowds of
    equal rows, which no direction parts, are dealt by key. So no task compares more than a
    bucket with itself, however rows crowd. The nearest of all tables are kept; in each of ``rounds``
    they are compared with their own nearest, which finds most neighbours that every table parted
    from the row (it matters from some five features on). NULL and NaN features count as 0; scale
    features before. ``key`` names each row and is not NULL. A row alone in its group has no
    neighbour and is not returned. Returns by, key, rank from 1, neighbour, distance; ties by neighbour.
    """
    by, features = list(by), list(features)
    kind = df.schema[key].dataType
    values = F.array(*[F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(None)), F.lit(0.0)) for c in features])
    points = pin(df.select(*by, F.col(key).alias("_key"), values.alias("_x"), F.xxhash64(*by, values).alias("_p")))
    # Crowds of equal rows have each other; some of them stand for the crowd among the rest.
    some = F.array(*[F.min(F.when(F.pmod(F.xxhash64("_key"), F.lit(k + 1)) == j, F.col("_key"))) for j in range(k + 1)])
    crowds = pin(points.groupBy("_p").agg(F.count("*").alias("_n"), some.alias("_some")).where(F.col("_n") > bucket))
    known = points.join(crowds, "_p", "left")
    dealt = F.xxhash64("_p", F.pmod(F.xxhash64("_key"), F.ceil(F.col("_n") / bucket)))
    settled = [known.where("_n IS NOT NULL").select("_key", "_x", dealt.alias("_b"))]
    tabled = F.explode(F.array(*[F.lit(t) for t in range(tables)])).alias("_t")
    rest = known.where(F.col("_n").isNull() | F.array_contains("_some", F.col("_key"))).select(*by, "_key", "_x", tabled)
    rest = rest.select("_key", "_x", "_t", F.xxhash64(*by, "_t").alias("_b"))
    held: list[DataFrame] = [points, crowds]
    for depth in range(DEPTH + 1):
        large = pin(rest.groupBy("_b").agg(F.count("*").alias("_n")).where(F.col("_n") > bucket))
        marked = pin(rest.join(large, "_b", "left"))
        held += [large, marked]
        settled.append(marked.where("_n IS NULL").select("_key", "_x", "_b"))
        if not large.take(1):
            break
        cut = F.pmod(F.xxhash64("_key"), F.ceil(F.col("_n") / bucket)) if depth == DEPTH else _cell(
            F.col("_x"), F.col("_t"), tables, len(features), depth, seed
        )
        rest = marked.where("_n IS NOT NULL").select("_key", "_x", "_t", F.xxhash64("_b", cut).alias("_b"))
    else:
        settled.append(rest.select("_key", "_x", "_b"))
    placed = settled[0]
    for more in settled[1:]:
        placed = placed.unionByName(more)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in _with_end(batches):
            if batch is not None:
                new = pa.Table.from_batches([batch])
                held = new if held is None else pa.concat_tables([held, new]).combine_chunks()
            if held is None or not len(held):
                continue
            b = held.column("_b").to_numpy()
            cuts = np.flatnonzero(np.r_[True, b[1:] != b[:-1]])
            ends = np.r_[cuts[1:], len(b)]
            if batch is not None:
                cuts, ends = cuts[:-1], ends[:-1]  # the last bucket may go on
            out = []
            x = np.array(held.column("_x").combine_chunks().flatten()).reshape(len(b), -1)
            for a, z in zip(cuts.tolist(), ends.tolist()):
                out.append(_bucket_pairs(np.arange(a, z), x[a:z], k))
            if out:
                row, other, away = (np.concatenate(p) for p in zip(*out))
                names = held.column("_key").combine_chunks()
                yield pa.RecordBatch.from_arrays(
                    [names.take(pa.array(row)), names.take(pa.array(other)), pa.array(away)], ["_key", "neighbour", "distance"]
                )
                held = held.slice(int(ends[-1]))

    name = kind.simpleString()
    pairs = (
        placed.select("_b", "_key", "_x").repartition("_b").sortWithinPartitions("_b")
        .mapInArrow(run, f"_key {name}, neighbour {name}, distance double")
    )
    near = pin(_nearest(pairs, k))
    held.append(near)
    at = points.select("_key", "_x")
    for _ in range(rounds):
        ahead = near.select(F.col("_key").alias("_mid"), F.col("neighbour").alias("_other"))
        second = near.select("_key", F.col("neighbour").alias("_mid")).join(ahead, "_mid").where("_key <> _other").select("_key", "_other").distinct()
        there = at.select(F.col("_key").alias("_other"), F.col("_x").alias("_y"))
        away = F.sqrt(F.aggregate(F.zip_with("_x", "_y", lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, v: s + v))
        found = second.join(at, "_key").join(there, "_other").select("_key", F.col("_other").alias("neighbour"), away.alias("distance"))
        # Distances of before are recomputed with the rest, so that one row's are all summed in one way.
        near = pin(_nearest(found.unionByName(_measured(near, at, there, away)), k))
        held.append(near)
    out = near.withColumn("rank", F.row_number().over(Window.partitionBy("_key").orderBy("distance", "neighbour"))).select(
        "_key", "rank", "neighbour", "distance"
    )
    named = out.join(points.select(*by, "_key"), "_key").select(*by, F.col("_key").alias(key), "rank", "neighbour", "distance") if by else (
        out.withColumnRenamed("_key", key)
    )
    named = pin(named)
    unpin(*held)
    return named


def _measured(near: DataFrame, at: DataFrame, there: DataFrame, away: Column) -> DataFrame:
    pairs = near.select("_key", F.col("neighbour").alias("_other"))
    return pairs.join(at, "_key").join(there, "_other").select("_key", F.col("_other").alias("neighbour"), away.alias("distance"))


def _nearest(pairs: DataFrame, k: int) -> DataFrame:
    """The k nearest of each row, each other row once."""
    best = F.slice(F.array_sort(F.collect_set(F.struct("distance", "neighbour"))), 1, k)
    return pairs.groupBy("_key").agg(best.alias("_near")).select("_key", F.inline("_near"))


def _with_end(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch | None]:
    yield from batches
    yield None
