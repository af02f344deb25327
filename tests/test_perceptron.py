"""The streamed perceptron against MLlib's own, block for block."""

import random

import numpy as np
import pytest
from pyspark.ml import classification as mc
from pyspark.ml.linalg import Vectors

from millrace.operators import learn, perceptron


@pytest.fixture(scope="module")
def train(spark):
    rng = random.Random(5)
    rows = []
    for i in range(700):
        kind = rng.randint(0, 2)
        places = sorted(rng.sample(range(40), 6))
        values = [rng.gauss(1.0 if p % 3 == kind else 0.0, 1.0) for p in places]
        vector = Vectors.sparse(40, places, values)
        rows.append((float(kind), vector if i % 5 else Vectors.dense(vector.toArray())))
    return spark.createDataFrame(rows, ["label", "features"]).coalesce(3)


@pytest.fixture(autouse=True)
def streamed(monkeypatch):
    monkeypatch.setattr(perceptron, "HELD_BYTES", 0)


def test_few_rows_are_left_to_mllib(train, monkeypatch):
    monkeypatch.setattr(perceptron, "HELD_BYTES", 700 * 40 * 8)
    params = dict(layers=[40, 4, 3], maxIter=10, seed=42)
    own, theirs = learn.classifier("mlp", width=40, **params).fit(train), mc.MultilayerPerceptronClassifier(**params).fit(train)
    assert own.hasSummary and own.weights.toArray() == pytest.approx(theirs.weights.toArray())
    monkeypatch.setattr(perceptron, "HELD_BYTES", 700 * 40 * 8 - 1)
    assert not learn.classifier("mlp", width=40, **params).fit(train).hasSummary


@pytest.mark.parametrize("layers, rounds, direct", [([40, 6, 3], 25, 1), ([40, 3], 40, 16), ([40, 5, 4, 3], 25, 16)])
def test_same_model_as_mllib(spark, train, monkeypatch, layers, rounds, direct):
    monkeypatch.setattr(perceptron, "DIRECT", direct)
    held = perceptron.pin(train)
    params = dict(layers=layers, maxIter=rounds, seed=42, blockSize=64)
    own, theirs = perceptron.Perceptron(**params).fit(held), mc.MultilayerPerceptronClassifier(**params).fit(held)
    assert own.weights.toArray() == pytest.approx(theirs.weights.toArray(), rel=1e-5, abs=1e-6)
    assert type(own) is type(theirs) and own.getMaxIter() == rounds and not own.hasSummary
    a, b = (np.array([r.probability.toArray() for r in m.transform(held).collect()]) for m in (own, theirs))
    assert a == pytest.approx(b, abs=1e-6)


def test_a_task_holds_one_block_of_dense_rows(spark, train):
    """Nothing is kept by Spark: MLlib keeps every row with 8 bytes a feature."""
    storage = spark.sparkContext._jsc.sc()
    peak = []
    objective = perceptron._objective

    def watched(*args):
        peak.append(len(storage.getRDDStorageInfo()))
        return objective(*args)

    before = len(storage.getRDDStorageInfo())
    perceptron._objective = watched
    try:
        learn.classifier("mlp", width=40, layers=[40, 4, 3]).fit(train)
    finally:
        perceptron._objective = objective
    assert len(peak) > 5 and max(peak) == before


@pytest.mark.parametrize("row", [(3.0, Vectors.dense([1.0, 2.0])), (0.5, Vectors.dense([1.0, 2.0])), (None, Vectors.dense([1.0, 2.0])),
                                 (0.0, None), (0.0, Vectors.dense([1.0, float("nan")]))])
def test_odd_rows_are_refused(spark, train, row):
    df = spark.createDataFrame([(1.0, Vectors.dense([0.0, 1.0])), row], train.schema).coalesce(1)
    with pytest.raises(Exception, match="labels are|missing|not finite"):
        perceptron.Perceptron(layers=[2, 3], maxIter=3).fit(df)
