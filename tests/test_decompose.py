"""Truncated SVD against NumPy's."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from millrace.operators import decompose, learn

SF = "/root/testdata/sf0.01"


def gathered(basis, d, k):
    out = np.zeros((d, k))
    for r in basis.collect():
        out[r.feature] = r.v
    return out


def same_span(v, want):
    """Singular values of v'·want are 1 where the spans agree."""
    return np.linalg.svd(v.T @ want, compute_uv=False)


@pytest.mark.parametrize("basis_bytes", [decompose.BASIS_BYTES, 0])
def test_sparse_rows_equal_numpy(spark, basis_bytes):
    rng = np.random.default_rng(1)
    n, d, k = 300, 40, 5
    a = (rng.normal(size=(n, 8)) * [9, 7, 5, 4, 3, 0.2, 0.1, 0.1]) @ (rng.normal(size=(8, d)) * (rng.random(d) < 0.7))
    a[7] = 0
    rows = [(None, None)] + [
        (i, Vectors.sparse(d, {j: x for j, x in enumerate(r) if x}) if i % 3 else Vectors.dense(r)) for i, r in enumerate(a)
    ]
    df = spark.createDataFrame(rows, ["id", "f"]).repartition(5)
    basis, values = decompose.singular_directions(df, "f", k, basis_bytes=basis_bytes)
    u, s, w = np.linalg.svd(a, full_matrices=False)
    v = gathered(basis, d, k)
    assert values == pytest.approx(s[:k].tolist(), rel=1e-6)
    assert np.abs(v.T @ v - np.eye(k)).max() < 1e-9
    assert same_span(v, w[:k].T).min() > 1 - 1e-6
    assert (v[np.abs(v).argmax(axis=0), np.arange(k)] > 0).all()
    got = {r.id: r.reduced for r in decompose.project(df, "f", basis, k, "id", basis_bytes).collect()}
    assert got.pop(None) is None
    assert np.abs(np.array([got[i] for i in range(n)]) - a @ v).max() < 1e-9


def test_embeddings_equal_numpy(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").orderBy("vec_id").collect()
    a = np.array([r.embedding for r in rows], dtype=float)
    df = spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", array_to_vector(F.col("embedding").cast("array<double>")).alias("f"))
    u, s, w = np.linalg.svd(a, full_matrices=False)

    def reduced(k):
        out = learn.truncated_svd(df, "f", "vec_id", k).select("vec_id", vector_to_array("reduced").alias("r"))
        return np.array([r.r for r in out.orderBy("vec_id").collect()])

    whole = reduced(100)  # as many directions as features: exact
    assert whole.shape == (len(a), a.shape[1]) and np.abs(np.abs(whole) - np.abs(u * s)).max() < 1e-6
    # Ten of a nearly flat spectrum: the last ones are approximate.
    assert np.sqrt((reduced(10) ** 2).sum(axis=0)) == pytest.approx(s[:10].tolist(), rel=5e-2)


def test_edges(spark):
    df = spark.createDataFrame([(1, Vectors.dense([1.0, 0.0])), (2, Vectors.dense([2.0, 0.0]))], ["id", "f"])
    basis, values = decompose.singular_directions(df, "f", 5)  # rank one, more dimensions than features
    assert values[0] == pytest.approx(5 ** 0.5) and values[1] == pytest.approx(0, abs=1e-9)
    assert decompose.singular_directions(df.where("false"), "f", 5)[1] == []
    assert learn.truncated_svd(df.where("false"), "f", "id").count() == 0


def test_tree_of_triangles(spark, monkeypatch):
    monkeypatch.setattr(decompose, "FAN", 2)
    rng = np.random.default_rng(2)
    a = rng.normal(size=(90, 4))
    parts = spark.createDataFrame([(i // 10, i % 10, r.tolist()) for i, r in enumerate(a)], decompose.PART)
    r = decompose.tree_qr(parts, 4)
    assert r.T @ r == pytest.approx(a.T @ a)
