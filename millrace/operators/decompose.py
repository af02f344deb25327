"""Truncated singular value decomposition by a random range finder and tree-wise QR."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.session import pin, unpin

# A basis of at most so many bytes goes to every task; a larger one is joined by feature.
BASIS_BYTES = 64 << 20
# Products of nonzero values formed at a time, and triangles that one task of the QR tree stacks.
SLICE = 50_000
FAN = 32

PART = "task long, at long, v array<double>"


def _values(df: DataFrame, features: str, *keep: str | Column) -> DataFrame:
    """Places and values of the nonzero features of a vector column, NULL for a NULL vector."""
    raw = F.unwrap_udt(F.col(f"`{features}`"))
    dense = F.when(F.size(raw["values"]) == 0, F.array().cast("array<int>")).otherwise(F.sequence(F.lit(0), F.size(raw["values"]) - 1))
    return df.select(*keep, F.when(raw["type"] == 0, raw["indices"]).otherwise(dense).alias("_i"), raw["values"].alias("_x"))


def _width(df: DataFrame, features: str) -> int:
    raw = F.unwrap_udt(F.col(f"`{features}`"))
    return df.agg(F.max(F.when(raw["type"] == 0, raw["size"]).otherwise(F.size(raw["values"])))).first()[0] or 0


def _triangle(above: np.ndarray, rows: np.ndarray) -> np.ndarray:
    return np.linalg.qr(np.vstack([above, rows]), mode="r")


def _csr(places: pd.Series, values: pd.Series) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, int]]:
    """Slices of rows as row number, place and value of their nonzeros, and the number of rows."""
    at, n = 0, len(values)
    sizes = np.array([len(x) for x in values], dtype=np.int64)
    while at < n:
        end = at + max(1, int(np.searchsorted(np.cumsum(sizes[at:]), SLICE, side="right")))
        x = np.concatenate([np.asarray(v, float) for v in values[at:end]]) if sizes[at:end].sum() else np.zeros(0)
        i = np.concatenate([np.asarray(p, np.int64) for p in places[at:end]]) if len(x) else np.zeros(0, np.int64)
        yield np.repeat(np.arange(end - at), sizes[at:end]), i, x, end - at
        at = end


def _summed(groups: np.ndarray, products: np.ndarray, into: np.ndarray) -> None:
    """Add the products of each group to its row."""
    if len(groups):
        order = np.argsort(groups, kind="stable")
        ranked = groups[order]
        starts = np.flatnonzero(np.r_[True, ranked[1:] != ranked[:-1]])
        into[ranked[starts]] += np.add.reduceat(products[order], starts, axis=0)


def _product(rows: np.ndarray, i: np.ndarray, x: np.ndarray, n: int, basis: np.ndarray) -> np.ndarray:
    out = np.zeros((n, basis.shape[1]))
    if len(x) == n * len(basis):
        return x.reshape(n, -1) @ basis  # all features of every row are there
    _summed(rows, x[:, None] * basis[i], out)
    return out


def tree_qr(parts: DataFrame, width: int) -> np.ndarray:
    """The triangle of a tall matrix from triangles of its parts (PART), stacked FAN at a time."""
    tasks = parts.select("task").distinct().count()
    held = parts
    while tasks > 1:
        tasks = math.ceil(tasks / FAN)

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            top, me = np.zeros((0, width)), TaskContext.get().partitionId()
            for batch in batches:
                if len(batch):
                    top = _triangle(top, np.stack([np.asarray(v, float) for v in batch["v"]]))
            if len(top):
                yield pd.DataFrame({"task": me, "at": range(len(top)), "v": list(top)})

        held = pin(held.repartition(tasks, F.pmod(F.xxhash64("task"), F.lit(tasks))).mapInPandas(run, PART))
    top = np.array([r.v for r in held.orderBy("at").collect()]).reshape(-1, width)  # at most width rows
    return _triangle(np.zeros((0, width)), top) if len(top) else top


def _inverse(triangle: np.ndarray) -> np.ndarray:
    """What makes the columns that the triangle belongs to orthonormal; dependent ones vanish."""
    u, s, w = np.linalg.svd(triangle, full_matrices=False)
    inverse = np.where(s > s.max(initial=0) * 1e-12, 1 / np.maximum(s, 1e-300), 0.0)
    return w.T * inverse


def _local_pass(rows: DataFrame, basis: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Triangle of A·basis, and A'·A·basis, in one scan; both matrices are no larger than the basis."""
    width = basis.shape[1]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        top, back = np.zeros((0, width)), np.zeros(basis.shape)
        for batch in batches:
            for r, i, x, n in _csr(batch["_i"], batch["_x"]):
                y = _product(r, i, x, n, basis)
                top = _triangle(top, y)
                if len(x) == n * len(basis):
                    back += x.reshape(n, -1).T @ y
                else:
                    _summed(i, x[:, None] * y[r], back)
        me = TaskContext.get().partitionId()
        some = np.flatnonzero(back.any(axis=1))
        if len(top):
            yield pd.DataFrame({"task": me, "at": range(len(top)), "v": list(top)})
        for a in range(0, len(some), 1000):
            yield pd.DataFrame({"task": -1, "at": some[a:a + 1000], "v": list(back[some[a:a + 1000]])})

    out = pin(rows.mapInPandas(run, PART))
    triangle = tree_qr(out.where("task >= 0"), width)
    added = out.where("task < 0").groupBy("at").agg(F.array(*[F.sum(F.col("v")[j]) for j in range(width)]).alias("v"))
    back = np.zeros(basis.shape)
    for r in added.toLocalIterator():
        back[r.at] = r.v
    unpin(out)
    return triangle, back


def _local_basis(rows: DataFrame, d: int, width: int, power: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    basis = np.random.default_rng(seed).normal(size=(d, width))
    for last in [False] * power + [True]:
        triangle, back = _local_pass(rows, basis)
        reduced = back @ _inverse(triangle)  # B', with B what is left of A in the found range
        if last:
            v, s, _ = np.linalg.svd(reduced, full_matrices=False)
            return v, s
        basis = np.linalg.qr(reduced)[0]
    raise AssertionError


# The same with a basis too large for a task: a table of one row per feature, joined to the nonzero values.


def _mapped(basis: DataFrame, matrix: np.ndarray) -> DataFrame:
    """Every row of the basis times a small matrix."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                yield pd.DataFrame({"feature": batch["feature"], "v": list(np.stack(batch["v"].to_numpy()) @ matrix)})

    return basis.mapInPandas(run, "feature long, v array<double>")


def _triangles(table: DataFrame, width: int) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        top = np.zeros((0, width))
        for batch in batches:
            for a in range(0, len(batch), 1000):
                top = _triangle(top, np.stack(batch["v"].iloc[a:a + 1000].to_numpy()))
        if len(top):
            yield pd.DataFrame({"task": TaskContext.get().partitionId(), "at": range(len(top)), "v": list(top)})

    return pin(table.select("v").mapInPandas(run, PART))


def _joined(rows: DataFrame, row_key: str, basis: DataFrame, width: int) -> DataFrame:
    """A·basis by row: nonzero values meet the basis by feature and are summed by row."""
    cells = rows.select(row_key, F.explode(F.arrays_zip("_i", "_x")).alias("c")).select(
        row_key, F.col("c._i").cast("long").alias("feature"), F.col("c._x").alias("x")
    )
    return cells.join(basis, "feature").groupBy(row_key).agg(F.array(*[F.sum(F.col("x") * F.col("v")[j]) for j in range(width)]).alias("v"))


def _table_basis(rows: DataFrame, d: int, width: int, power: int, seed: int) -> tuple[DataFrame, np.ndarray]:
    def draw(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            drawn = [np.random.default_rng([seed, f]).normal(size=width) for f in batch["feature"].tolist()]
            yield pd.DataFrame({"feature": batch["feature"], "v": drawn})

    numbered = pin(rows.withColumn("_row", F.monotonically_increasing_id()))
    basis = pin(rows.sparkSession.range(d).withColumnRenamed("id", "feature").mapInPandas(draw, "feature long, v array<double>"))
    for last in [False] * power + [True]:
        y = pin(_joined(numbered, "_row", basis, width))
        triangle = tree_qr(_triangles(y, width), width)
        cells = numbered.join(y, "_row").select("v", F.explode(F.arrays_zip("_i", "_x")).alias("c"))
        back = cells.groupBy(F.col("c._i").cast("long").alias("feature")).agg(
            F.array(*[F.sum(F.col("c._x") * F.col("v")[j]) for j in range(width)]).alias("v")
        )
        reduced = pin(_mapped(back, _inverse(triangle)))
        unpin(y, basis)
        small = tree_qr(_triangles(reduced, width), width)
        if last:
            _, s, w = np.linalg.svd(small, full_matrices=False)
            kept = np.where(s > s.max(initial=0) * 1e-12, 1 / np.maximum(s, 1e-300), 0.0)
            return _mapped(reduced, w.T * kept), s
        basis = pin(_mapped(reduced, _inverse(small)))
    raise AssertionError


def singular_directions(
    df: DataFrame, features: str, dimensions: int = 100, oversample: int = 10, power: int = 3, seed: int = 42,
    basis_bytes: int = BASIS_BYTES,
) -> tuple[DataFrame, list[float]]:
    """Leading right singular vectors of a vector column (no centring), and the singular values.

    A random basis of ``dimensions + oversample`` directions is refined ``power`` times: each scan
    multiplies every row with it, takes the QR of the product as a tree of small triangles, and
    adds up what goes back to the features. No matrix of features by features is formed. A basis
    within ``basis_bytes`` goes to every task; a larger one stays a table and meets the rows by
    feature. NULL vectors do not count. Each vector's largest entry is positive. Returns a table
    of feature and v (one entry per dimension, at most as many as features), and the values.
    """
    d = _width(df, features)
    spark = df.sparkSession
    if not d:
        return spark.createDataFrame([], "feature long, v array<double>"), []
    rows = _values(df, features).where("_x IS NOT NULL")
    kept = min(dimensions, d)
    width = min(kept + oversample, d)
    if d * width * 8 <= basis_bytes:
        v, s = _local_basis(rows, d, width, power, seed)
        v = v[:, :kept] * np.sign(v[np.abs(v[:, :kept]).argmax(axis=0), np.arange(kept)])
        table = spark.createDataFrame(pd.DataFrame({"feature": np.arange(d), "v": [r.tolist() for r in v]}), "feature long, v array<double>")
        return table, s[:kept].tolist()
    found, s = _table_basis(rows, d, width, power, seed)
    found = pin(found)
    signs = found.agg(*[F.signum(F.max_by(F.col("v")[j], F.abs(F.col("v")[j]))).alias(f"s{j}") for j in range(kept)]).first()
    turned = F.array(*[F.col("v")[j] * F.lit(float(signs[j])) for j in range(kept)])
    return found.select("feature", turned.alias("v")), s[:kept].tolist()


def project(df: DataFrame, features: str, basis: DataFrame, dimensions: int, key: str, basis_bytes: int = BASIS_BYTES) -> DataFrame:
    """``key`` and ``reduced``: every vector times the basis; NULL for a NULL vector."""
    d = _width(df, features)
    if d * dimensions * 8 <= basis_bytes:
        matrix = np.zeros((d, dimensions))
        for r in basis.toLocalIterator():  # within basis_bytes
            matrix[r.feature] = r.v

        @F.pandas_udf("array<double>")
        def times(vectors: pd.DataFrame) -> pd.Series:
            out: list = [None] * len(vectors)
            known = np.flatnonzero(vectors["_x"].notna().to_numpy())
            part, at = vectors.iloc[known], 0
            for r, i, x, n in _csr(part["_i"].to_numpy(), part["_x"].to_numpy()):
                for y in _product(r, i, x, n, matrix):
                    out[known[at]] = y
                    at += 1
            return pd.Series(out, dtype=object)

        return _values(df, features, F.col(f"`{key}`")).select(f"`{key}`", times(F.struct("_i", "_x")).alias("reduced"))
    rows = pin(_values(df, features, F.col(f"`{key}`")).withColumn("_row", F.monotonically_increasing_id()))
    found = _joined(rows, "_row", basis, dimensions)
    none = F.array(*[F.lit(0.0)] * dimensions)
    value = F.when(F.col("_x").isNotNull(), F.coalesce("v", none))
    return rows.join(found, "_row", "left").select(f"`{key}`", value.alias("reduced"))
