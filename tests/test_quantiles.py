"""Quantiles by selection against NumPy, the sketch against its stated error."""

import numpy as np
import pandas as pd
import pytest

from millrace.operators import quantiles
from millrace.operators.profile import summary_statistics

SHARES = [0.0, 0.001, 0.25, 0.5, 0.95, 1.0]


@pytest.fixture(scope="module")
def frame(spark):
    rng = np.random.default_rng(5)
    n = 20_000
    v = rng.lognormal(size=n)
    v[rng.random(n) < 0.35] = 1.0  # a third of all rows hold one value
    w = np.round(rng.normal(size=n), 1)
    w[rng.random(n) < 0.2] = np.nan
    g = rng.choice(["a", "b", "c", None], size=n, p=[0.7, 0.2, 0.05, 0.05])
    pdf = pd.DataFrame({"g": g, "v": v, "w": w, "z": -0.0, "i": np.where(rng.random(n) < 0.01, -1e300, v)})
    df = spark.createDataFrame(pdf, "g string, v double, w double, z double, i double").repartition(7)
    return df.cache(), pdf


def check(rows, pdf, by):
    seen = set()
    for r in rows:
        part = pdf if not by else pdf[pdf.g.isna()] if r.g is None else pdf[pdf.g == r.g]
        want = np.quantile(part[r.column_name].dropna(), SHARES)
        assert [r[f"q{i}"] for i in range(len(SHARES))] == pytest.approx(list(want), rel=1e-12)
        seen.add((r.g if by else None, r.column_name))
    return len(seen)


# Sketch and brackets as in production, then sketches so rough that brackets are narrowed or miss.
@pytest.mark.parametrize("accuracy,gather,by,columns", [
    (10_000, 500_000, (), "vwzi"), (10_000, 500_000, ("g",), "vw"), (10_000, 50, (), "v"), (100, 300, ("g",), "vw"),
])
def test_equal_to_numpy(frame, by, accuracy, gather, columns):
    df, pdf = frame
    rows = quantiles.exact_quantiles(df, list(columns), SHARES, by, accuracy, gather).collect()
    assert check(rows, pdf, by) == len(columns) * (4 if by else 1)


def test_missed_brackets_are_widened(frame, monkeypatch):
    df, pdf = frame
    tried = []
    plain = quantiles._selected

    def first_wrong(values, n, probabilities, by, accuracy, gather, reach):
        tried.append(reach)
        moved = [min(p + 0.2, 1.0) for p in probabilities] if len(tried) == 1 else probabilities
        if len(tried) > 1:
            return plain(values, n, probabilities, by, accuracy, gather, reach)
        target = quantiles._target
        monkeypatch.setattr(quantiles, "_target", lambda _: target(probabilities))
        out = plain(values, n, moved, by, accuracy, gather, reach)
        monkeypatch.setattr(quantiles, "_target", target)
        return out

    monkeypatch.setattr(quantiles, "_selected", first_wrong)
    rows = quantiles.exact_quantiles(df, ["v"], SHARES, (), 10_000, 500).collect()
    assert check(rows, pdf, ()) == 1 and len(tried) == 2


def test_sketch_keeps_its_error(frame):
    df, pdf = frame
    rows = quantiles.approximate_quantiles(df, ["v", "w"], SHARES, ["g"], error=0.01).collect()
    assert len(rows) == 8
    for r in rows:
        part = np.sort((pdf[pdf.g.isna()] if r.g is None else pdf[pdf.g == r.g])[r.column_name].dropna())
        assert r["count"] == len(part)
        for i, p in enumerate(SHARES):
            low, high = np.searchsorted(part, r[f"q{i}"], "left"), np.searchsorted(part, r[f"q{i}"], "right")
            assert low - 0.01 * len(part) - 1 <= p * len(part) <= high + 0.01 * len(part) + 1


def test_edges(spark):
    schema = "g string, v double"
    empty = spark.createDataFrame([], schema)
    assert quantiles.exact_quantiles(empty, ["v"], [0.5]).count() == 0
    assert quantiles.exact_quantiles(empty, ["v"], [0.5], ["g"]).count() == 0
    rows = [("a", None), ("a", float("nan")), ("b", 3.0), (None, 1.0), (None, 2.0)]
    df = spark.createDataFrame(rows, schema)
    assert {(r.g, r.q0) for r in quantiles.exact_quantiles(df, ["v"], [0.5], ["g"]).collect()} == {("b", 3.0), (None, 1.5)}
    assert {(r.g, r.unique_count) for r in quantiles.distinct_counts(df, ["v"], ["g"]).collect()} == {("b", 1), (None, 2)}
    assert quantiles.exact_quantiles(df.where("g = 'a'"), ["v"], [0.5]).count() == 0


def test_approximate_profile(frame):
    df, pdf = frame
    got = {r.column_name: r for r in summary_statistics(df, ["v", "w"], error=0.005).collect()}
    for c in ("v", "w"):
        part = pdf[c].dropna()
        assert abs((part < got[c].median).mean() - 0.5) < 0.3 and got[c]["count"] == len(part)
        assert got[c].unique_count == pytest.approx(part.nunique(), rel=0.1)


def test_no_range_shuffle(frame, monkeypatch):
    df, _ = frame
    plans, pin = [], quantiles.pin

    def seen(out):
        plans.append(out._jdf.queryExecution().executedPlan().toString())
        return pin(out)

    monkeypatch.setattr(quantiles, "pin", seen)
    quantiles.exact_quantiles(df, ["v", "w"], SHARES)
    assert len(plans) == 2 and not any("rangepartitioning" in p or "NestedLoop" in p or "Window" in p for p in plans)
