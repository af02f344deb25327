"""Isotonic fit against plain pooling, random Fourier features against the kernel itself."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from millrace.operators import isotonic, kernel, learn


def plain_fit(x, y, w):
    order = np.argsort(x, kind="stable")
    blocks = []
    for s in np.unique(x):
        m = x == s
        blocks.append([s, s, (y[m] * w[m]).sum(), w[m].sum()])
        while len(blocks) > 1 and blocks[-2][2] * blocks[-1][3] >= blocks[-1][2] * blocks[-2][3]:
            b = blocks.pop()
            blocks[-1] = [blocks[-1][0], b[1], blocks[-1][2] + b[2], blocks[-1][3] + b[3]]
    assert len(order) == len(x)
    return [(a, b, t / n, n) for a, b, t, n in blocks]


SHAPES = {
    "rising": lambda rng, x: x + rng.normal(size=len(x)) * 0.05, "falling": lambda rng, x: -x, "noise": lambda rng, x: rng.normal(size=len(x)),
    "wave": lambda rng, x: np.sin(8 * x) + 3 * x, "exact": lambda rng, x: x * 1.0,
}


@pytest.mark.parametrize("shape,slice_blocks", [("rising", 40), ("falling", 25), ("noise", 25), ("wave", 40), ("exact", 60), ("wave", 500_000)])
def test_equal_to_plain_pooling(spark, shape, slice_blocks):
    rng = np.random.default_rng(3)
    x = np.round(rng.random(1200), 3)
    y, w = SHAPES[shape](rng, x), rng.integers(1, 4, size=len(x)).astype(float)
    df = spark.createDataFrame([tuple(map(float, r)) for r in zip(x, y, w)], "x double, y double, w double").repartition(5)
    blocks = isotonic.fit_isotonic(df, "x", "y", "w", slice_blocks)
    got = sorted((r.lo, r.hi, r.calibrated, r.weight) for r in blocks.collect())
    want = plain_fit(x, y, w)
    assert [g[:2] for g in got] == [b[:2] for b in want]
    assert np.allclose([g[2:] for g in got], [b[2:] for b in want])


@pytest.mark.parametrize("local", [1000, 0])
def test_new_scores_and_edges(spark, local):
    df = spark.createDataFrame([(0.1, 0.0), (0.2, 1.0), (0.3, 0.0), (0.5, 1.0), (None, 1.0), (float("nan"), 0.0), (0.4, None)], "s double, y double")
    blocks = isotonic.fit_isotonic(df, "s", "y")
    assert sorted(tuple(r) for r in blocks.collect()) == [(0.1, 0.1, 0.0, 1.0), (0.2, 0.3, 0.5, 2.0), (0.5, 0.5, 1.0, 1.0)]
    new = spark.createDataFrame([(0, -1.0), (1, 0.1), (2, 0.15), (3, 0.25), (4, 0.4), (5, 0.5), (6, 9.0), (7, None), (8, float("nan")), (9, 0.25)], "id int, s double")
    got = {r.id: r.p for r in isotonic.calibrate(new, blocks, "s", "p", local).collect()}
    assert {i: p if p is None else round(p, 9) for i, p in got.items()} == {0: 0.0, 1: 0.0, 2: 0.25, 3: 0.5, 4: 0.75, 5: 1.0, 6: 1.0, 7: None, 8: None, 9: 0.5}
    nothing = isotonic.fit_isotonic(df.where("false"), "s", "y")
    assert nothing.count() == 0
    assert {r.p for r in isotonic.calibrate(new, nothing, "s", "p", local).collect()} == {None}


def test_kernel_error_stays_in_its_bound(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(60, 5))
    x[rng.random(x.shape) < 0.4] = 0
    rows = [(i, Vectors.sparse(5, {j: v for j, v in enumerate(r) if v}) if i % 2 else Vectors.dense(r)) for i, r in enumerate(x)] + [(99, None)]
    df = spark.createDataFrame(rows, ["id", "f"])
    assert kernel.scale_gamma(df, "f") == pytest.approx(1 / (5 * x.var()))
    out = {r.id: r.z for r in kernel.rbf_features(df, "f", "rbf", 0.3, 2048).select("id", F.col("rbf").alias("z")).collect()}
    assert out.pop(99) is None
    z = np.array([out[i].toArray() for i in range(60)])
    want = np.exp(-0.3 * ((x[:, None] - x[None]) ** 2).sum(axis=2))
    # 3,600 products, each off by more than 0.2 with a probability below 2 exp(-2048 * 0.04 / 8) = 7e-5.
    assert np.abs(z @ z.T - want).max() < 0.2
    again = {r.id: r.z for r in kernel.rbf_features(df.where("id < 5"), "f", "rbf", 0.3, 2048).select("id", F.col("rbf").alias("z")).collect()}
    assert all(np.allclose(again[i].toArray(), z[i]) for i in range(5))


def test_two_rings_need_the_kernel(spark):
    rng = np.random.default_rng(5)
    angle, label = rng.random(400) * 2 * np.pi, np.arange(400) % 2
    radius = np.where(label == 1, 3.0, 1.0) + rng.normal(size=400) * 0.1
    points = np.stack([radius * np.cos(angle), radius * np.sin(angle)], axis=1)
    df = spark.createDataFrame([(float(y), Vectors.dense(p)) for y, p in zip(label, points)], ["label", "features"])
    ready = kernel.rbf_features(df, "features", "rbf", 0.5, 128)

    def accuracy(model, rows):
        return model.transform(rows).where("prediction = label").count() / 400

    linear, curved = (learn.classifier("svc", features=f).fit(ready) for f in ("features", "rbf"))
    assert accuracy(curved, ready) > 0.98 and accuracy(linear, ready) < 0.7
