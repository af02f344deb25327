"""Successive halving: nested shares, survivors by hand-made scores, winner on all rows."""

import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from millrace.functions.scalar import stable_bucket
from millrace.operators import learn


@pytest.fixture(scope="module")
def train(spark):
    rows = [(i, float(i % 2), Vectors.dense([i % 2 + (i * 7 % 10) / 9.0, (i * 13 % 11) / 10.0])) for i in range(600)]
    return spark.createDataFrame(rows, ["id", "label", "features"]).repartition(3).cache()


def test_rungs_by_hand(spark, train):
    candidates = [("lr", {"regParam": r}) for r in (100.0, 0.1)] + [("svc", {"regParam": 0.1})]
    model, rows = learn.successive_halving(train, candidates, "id", shares=(0.2, 1.0), keep=0.4, metric="accuracy")
    place = {r.id: r.p for r in train.select("id", stable_bucket([F.lit("halving-42"), "id"], 1_000_000).alias("p")).collect()}
    held = [i for i, p in place.items() if p % 5 == 0]
    sizes = {share: [i for i, p in place.items() if p % 5 and p // 5 < share * 200_000] for share in (0.2, 1.0)}
    assert set(sizes[0.2]) < set(sizes[1.0]) and len(sizes[1.0]) + len(held) == 600
    assert [r[3] for r in rows] == [len(sizes[0.2])] * 3 + [len(sizes[1.0])] * 2
    for rung, name, setting, n, score, _ in rows:
        ids = sizes[0.2 if rung == 0 else 1.0]
        fitted = learn.classifier(name, **setting).fit(train.where(train.id.isin(ids)))
        right = fitted.transform(train.where(train.id.isin(held))).where("prediction = label").count()
        assert score == pytest.approx(right / len(held))
    first = sorted(range(3), key=lambda i: (-rows[i][4], i))[:2]
    assert [(r[1], r[2]) for r in rows[3:]] == [candidates[i] for i in sorted(first)]
    assert sum(r[5] for r in rows[3:]) == 1
    winner = next(r for r in rows[3:] if r[5])
    again = learn.classifier(winner[1], **winner[2]).fit(train)
    assert model.coefficients.toArray() == pytest.approx(again.coefficients.toArray())


def test_settings_and_shares(train):
    assert len(learn.grid_settings(["nb", "lr", "svc", "rf", "gbt"])) == 4 + 3 + 3 + 9 + 6
    with pytest.raises(ValueError, match="grow"):
        learn.successive_halving(train, [("lr", {})], "id", shares=(0.5, 0.2))
