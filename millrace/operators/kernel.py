"""Random Fourier features: a linear machine on them is a kernel machine with the RBF kernel."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.decompose import _csr, _product, _values, _width

# Directions that are drawn at a time, so that wide vectors need no matrix of all of them.
STRIPE = 64


def scale_gamma(df: DataFrame, features: str) -> float:
    """1 / (features x variance of all entries), the usual width of the kernel; 1 where that is no number."""
    d = _width(df, features)
    sums = F.struct(F.aggregate("_x", F.lit(0.0), lambda s, x: s + x).alias("s"), F.aggregate("_x", F.lit(0.0), lambda s, x: s + x * x).alias("q"))
    row = _values(df, features).where("_x IS NOT NULL").select(sums.alias("a")).agg(
        F.sum("a.s").alias("s"), F.sum("a.q").alias("q"), F.count("*").alias("n")
    ).first()
    entries = row.n * d
    if not entries:
        return 1.0
    variance = row.q / entries - (row.s / entries) ** 2
    return 1.0 / (d * variance) if variance > 0 else 1.0


def rbf_features(
    df: DataFrame, features: str, output: str = "rbf", gamma: float = 1.0, dimensions: int = 512, seed: int = 42
) -> DataFrame:
    """Add a vector whose inner products approximate ``exp(-gamma |x - y|^2)``.

    Entry j is sqrt(2 / dimensions) cos(w_j x + b_j), w_j normal with variance 2 gamma and b_j uniform. An
    inner product is off by more than e with a probability below 2 exp(-dimensions e^2 / 8). Directions
    follow from the seed alone, so every task and every table has the same ones. A NULL vector gives NULL.
    """
    d = _width(df, features)

    @F.pandas_udf("array<double>")
    def mapped(vectors: pd.DataFrame) -> pd.Series:
        out: list = [None] * len(vectors)
        known = np.flatnonzero(vectors["_x"].notna().to_numpy())
        places, values = vectors["_i"].to_numpy()[known], vectors["_x"].to_numpy()[known]
        columns = []
        for first in range(0, dimensions, STRIPE):
            rng = np.random.default_rng([seed, first])
            size = min(STRIPE, dimensions - first)
            w = rng.normal(scale=np.sqrt(2 * gamma), size=(d, size))
            b = rng.uniform(0, 2 * np.pi, size=size)
            parts = [_product(r, i, x, n, w) for r, i, x, n in _csr(places, values)]
            columns.append(np.cos(np.concatenate(parts) + b) if parts else np.zeros((0, size)))
        for at, row in zip(known, np.hstack(columns) * np.sqrt(2 / dimensions)):
            out[at] = row
        return pd.Series(out, dtype=object)

    raw = _values(df.select("*"), features, "*")
    found = raw.withColumn("_z", mapped(F.struct("_i", "_x")))
    return found.withColumn(output, F.when(F.col("_z").isNotNull(), array_to_vector("_z"))).drop("_i", "_x", "_z")
