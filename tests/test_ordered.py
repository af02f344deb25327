"""Ordered analytics against pandas, with and without keys, over many blocks."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from millrace.operators import ordered as od


@pytest.fixture
def frame(spark):
    # Small tables would otherwise end up in a single slice.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield _frame(spark)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def _frame(spark):
    rng = np.random.default_rng(7)
    n = 400
    # One key holds most rows.
    pdf = pd.DataFrame({
        "id": np.arange(n), "k": np.where(np.arange(n) % 10 < 8, "hot", "cold"), "t": rng.permutation(n) // 3,
        "v": np.where(rng.random(n) < 0.15, np.nan, rng.integers(0, 20, n)),
    })
    df = spark.createDataFrame(pdf).withColumn("v", F.when(~F.isnan("v"), F.col("v")))
    return df, pdf.sort_values(["t", "id"])


def by_id(df, column):
    return df.select("id", column).toPandas().set_index("id")[column].astype(float).sort_index()


def check(got, want):
    pd.testing.assert_series_equal(got, want.astype(float).sort_index(), check_names=False)


@pytest.mark.parametrize("keys", [[], ["k"]])
@pytest.mark.parametrize("fn", ["mean", "sum", "std", "max", "min"])
def test_rolling(frame, keys, fn, monkeypatch):
    monkeypatch.setattr(od, "BLOCK_ROWS", 25)
    df, pdf = frame
    got = by_id(od.rolling_aggregation(df, "t", ["v"], 4, fn, keys, ["id"]), "v_rolling_4")
    series = pdf.set_index("id")
    if keys:
        want = series.groupby("k")["v"].transform(lambda s: getattr(s.rolling(4), fn)())
    else:
        want = getattr(series["v"].rolling(4), fn)()
    check(got, want)


def test_unknown_rolling_function_raises(frame):
    with pytest.raises(ValueError):
        od.rolling_aggregation(frame[0], "t", ["v"], 3, "mode")


@pytest.mark.parametrize("keys", [[], ["k"]])
def test_growth_cumulative_rank_fill(frame, keys, monkeypatch):
    monkeypatch.setattr(od, "BLOCK_ROWS", 30)
    df, pdf = frame
    s = pdf.set_index("id")
    grouped = (lambda f: s.groupby("k")["v"].transform(f)) if keys else (lambda f: f(s["v"]))
    check(by_id(od.cumulative(df, ["t", "id"], "v", "c", keys), "c"), grouped(lambda x: x.cumsum()))
    check(by_id(od.average_rank(df, "v", "r", partition_by=keys), "r"), grouped(lambda x: x.rank(ascending=False)))
    check(by_id(od.average_rank(df, "v", "r", True, keys), "r"), grouped(lambda x: x.rank()))
    check(by_id(od.forward_fill(df, ["t", "id"], ["v"], keys), "v"), grouped(lambda x: x.ffill()))
    growth = by_id(od.growth_rate(df, ["t", "id"], "v", "g", keys), "g")
    want = grouped(lambda x: x.ffill() / x.ffill().shift() - 1) * 100
    check(growth, want.replace([np.inf, -np.inf], np.nan))


def test_unkeyed_work_uses_many_tasks(frame):
    df, _ = frame
    parts = od._slices(df, [], ["t", "id"]).select(od.SLICE).distinct().count()
    assert parts > 1


def test_empty_and_single_row(spark):
    empty = spark.createDataFrame([], "id int, v double")
    assert od.cumulative(empty, ["id"], "v", "c").count() == 0
    one = spark.createDataFrame([(1, 5.0)], "id int, v double")
    assert od.growth_rate(one, ["id"], "v", "g").first().g is None
    assert od.with_ordinal(one, ["id"]).first()[od.ORDINAL] == 1


def test_first_rows_and_chunks(frame, monkeypatch):
    df, pdf = frame
    recent = od.first_rows(df, [F.desc("t"), F.desc("id")], 5, ["k"]).toPandas()
    want = pdf.groupby("k").tail(5)
    assert set(recent.id) == set(want.id)
    monkeypatch.setattr(od, "GROUP_LIMIT_ROWS", 2)  # number over slices instead
    recent = od.first_rows(df, [F.desc("t"), F.desc("id")], 5, ["k"]).toPandas()
    assert set(recent.id) == set(want.id)
    sizes = [r[1] for r in od.chunk_rows(df, ["id"], 150).groupBy("chunk").count().orderBy("chunk").collect()]
    assert sizes == [150, 150, 100]


def test_numbers_need_no_shuffle_by_slice(spark):
    from collections import defaultdict

    rows = [(None if i % 11 == 0 else i % 3, None if i % 17 == 0 else float(i * 7919 % 101), i) for i in range(900)]
    df = spark.createDataFrame(rows, "k int, v double, i int").repartition(5)
    out = od.with_ordinal(df, [F.col("v").desc(), "i"], ["k"])
    found = defaultdict(dict)
    for r in out.collect():
        found[r.k][r[od.ORDINAL]] = r.i
    for k in (None, 0, 1, 2):
        of = sorted((r for r in rows if r[0] == k), key=lambda r: (r[1] is None, -(r[1] or 0.0), r[2]))
        assert found[k] == {n: r[2] for n, r in enumerate(of, 1)}
    alone = od.with_ordinal(df.repartition(4), ["i"])
    assert {r.i: r[od.ORDINAL] for r in alone.collect()} == {i: i + 1 for i in range(900)}
    plan = alone._jdf.queryExecution().optimizedPlan().toString()
    # The only window is over the few totals of the slices.
    assert plan.count("Window ") == 1 and "Aggregate" in plan[plan.index("Window "):]
