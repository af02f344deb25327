"""Nearest rows by hashing against comparison of all rows, and oversampling between them."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.operators import features, neighbours
from millrace.plans import load_all
from millrace.plans.learning import _SURFACE, _surface
from millrace.session import pin

SF = "/root/testdata/sf0.01"


def recall(got, ids, x, groups):
    hit = total = 0
    for i in range(len(ids)):
        away = np.sqrt(((x - x[i]) ** 2).sum(axis=1))
        away[i] = np.inf
        away[groups != groups[i]] = np.inf
        want = min(5, int(np.isfinite(away).sum()))
        limit = np.sort(away)[want - 1] if want else 0
        mine = sorted(r.distance for r in got.get(ids[i], []))
        assert len(mine) == want and all(r.neighbour != ids[i] for r in got.get(ids[i], []))
        hit += sum(d <= limit + 1e-9 for d in mine)  # ties count
        total += want
    return hit / total


def test_recall_on_documents(spark):
    rows = features.zscore(_surface(spark, SF), _SURFACE, suffix="_z").orderBy("doc_id").collect()
    got = {}
    for r in load_all()["nearest_rows"].run(spark, SF).collect():
        got.setdefault(r.doc_id, []).append(r)
    x = np.array([[r[f"{c}_z"] or 0.0 for c in _SURFACE] for r in rows])
    assert recall(got, [r.doc_id for r in rows], x, np.array([r.quality for r in rows])) >= 0.95


@pytest.fixture(scope="module")
def points(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(3000, 4))
    x[:900] = x[0]  # a crowd of equal rows
    x[900:1300] = x[900] + rng.normal(size=(400, 4)) * 1e-3  # and a dense one
    frame = spark.createDataFrame([(f"k{i}", i % 3, *map(float, r)) for i, r in enumerate(x)], "k string, g int, a double, b double, c double, d double")
    return x, frame


def test_recall_with_crowds_and_bounded_buckets(points):
    x, frame = points
    got = {}
    for r in neighbours.nearest_neighbours(frame, "k", list("abcd"), 5, by=["g"], bucket=150).collect():
        assert 1 <= r["rank"] <= 5
        got.setdefault(r.k, []).append(r)
    assert recall(got, [f"k{i}" for i in range(len(x))], x, np.arange(len(x)) % 3) >= 0.95


def test_edges(spark):
    schema = "id long, g string, a double, b double"
    rows = [(1, "x", 1.0, None), (2, "x", float("nan"), 0.0), (3, "y", 5.0, 5.0), (4, None, 0.0, 0.0), (5, None, 0.0, 1.0)]
    frame = spark.createDataFrame(rows, schema)
    got = {(r.id, r.neighbour, round(r.distance, 6)) for r in neighbours.nearest_neighbours(frame, "id", ["a", "b"], by=["g"]).collect()}
    assert got == {(1, 2, 1.0), (2, 1, 1.0), (4, 5, 1.0), (5, 4, 1.0)}
    assert neighbours.nearest_neighbours(frame.where("false"), "id", ["a", "b"]).count() == 0
    assert neighbours.nearest_neighbours(frame.where("id = 1"), "id", ["a"]).count() == 0


def test_new_rows_lie_between_near_rows(spark):
    rng = np.random.default_rng(3)
    centres = {0: (0.0, 0.0), 1: (50.0, 50.0), 2: (0.0, 90.0)}
    rows = [(i, 0, *map(float, rng.normal(size=2))) for i in range(300)]
    rows += [(1000 + i, 1, *map(float, rng.normal(size=2) + (centres[1] if i % 2 else centres[2]))) for i in range(40)]
    frame = spark.createDataFrame(rows, "id long, y int, a double, b double")
    out = features.oversample_near(frame, "y", ["a", "b"], "id").collect()
    counts = {y: sum(r.y == y for r in out) for y in (0, 1)}
    assert counts == {0: 300, 1: 300} and sum(not r.synthetic for r in out) == 340
    for r in out:
        if r.synthetic:  # never on the way from one cluster of the class to the other
            assert r.id is None and min(np.hypot(r.a - x, r.b - y) for x, y in (centres[1], centres[2])) < 6


def test_single_rows_are_refused_or_copied_by_name(spark):
    frame = spark.createDataFrame([(i, "many", float(i)) for i in range(6)] + [(9, "one", 4.0)], "id long, y string, a double")
    with pytest.raises(ValueError, match="'one'"):
        features.oversample_near(frame, "y", ["a"], "id")
    out = features.oversample_near(frame, "y", ["a"], "id", alone="copy").where("y = 'one'").collect()
    assert len(out) == 6 and {r.a for r in out} == {4.0} and sum(r.synthetic for r in out) == 5
    assert features.oversample_near(frame.where("false"), "y", ["a"], "id").count() == 0


def test_plan_has_no_loop_join(spark, monkeypatch):
    plans = []

    def seen(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return pin(df)

    monkeypatch.setattr(neighbours, "pin", seen)
    frame = spark.range(2000).select("id", (F.col("id") * 7 % 31).cast("double").alias("a"))
    neighbours.nearest_neighbours(frame, "id", ["a"], bucket=50)
    assert plans and not any("NestedLoop" in p or "Cartesian" in p for p in plans)
