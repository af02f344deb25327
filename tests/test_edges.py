"""Inputs the tables never hold: NULL keys and partitions, long lists, long holds, empty rules."""

import datetime

import pytest
from pyspark.sql import functions as F

from millrace.functions import scalar
from millrace.operators import aggregate, clean, monitoring, quality, timeseries
from millrace.sources import writers
from tests.conftest import rows


def test_flatten_keeps_every_item(spark):
    df = spark.createDataFrame(
        [(1, [1, 2, 3, 4], [(["a"],), (["b", "c"],)]), (2, [], None), (3, None, [])],
        "id int, a array<int>, b array<struct<c: array<string>>>",
    )
    flat = clean.flatten(df)
    assert flat.columns == ["id", "a_0", "a_1", "a_2", "a_3", "b_0_c_0", "b_0_c_1", "b_1_c_0", "b_1_c_1"]
    assert rows(flat, "id")[0] == (1, 1, 2, 3, 4, "a", None, "b", "c")
    with pytest.raises(Exception, match="more than 2 items"):
        clean.flatten(df, max_items=2).select("a_1").collect()
    long = clean.flatten_long(df, ["id"])
    assert sorted(rows(long)) == [
        (1, "a_0", "1"), (1, "a_1", "2"), (1, "a_2", "3"), (1, "a_3", "4"),
        (1, "b_0_c_0", "a"), (1, "b_1_c_0", "b"), (1, "b_1_c_1", "c"),
    ]


def test_deep_merge_keeps_both_sides(spark):
    kind = "k int, r struct<x: int, y: int>"
    base = spark.createDataFrame([(1, (1, 2)), (2, None), (None, (5, 6))], kind)
    change = spark.createDataFrame([(1, (None, 9)), (2, None), (3, (7, 8)), (None, (0, None))], kind)
    merged = clean.deep_merge(base, change, ["k"])
    assert [(r.k, r.r and tuple(r.r)) for r in merged.orderBy("k").collect()] == [(None, (0, 6)), (1, (1, 9)), (2, None), (3, (7, 8))]


def test_lists_and_flags(spark):
    df = spark.createDataFrame([(["a", "b"], 5, None), (None, None, None)], "a array<string>, n int, z double")
    lists = df.select(scalar.ensure_list("a", "array<string>"), scalar.ensure_list("n", "int"))
    assert rows(lists) == [(["a", "b"], [5]), ([], [])]
    assert clean.iqr_clip(df, ["n", "z"], flag=True).columns == ["a", "n", "z", "z_outlier", "n_outlier"]


def test_upsert_with_null_partitions_and_moved_keys(spark, tmp_path):
    path, kind = str(tmp_path / "t"), "id int, part string, v int"
    writers.upsert(spark, path, spark.createDataFrame([(1, "a", 1), (2, None, 2), (3, None, 3), (4, "b", 4), (None, "c", 5)], kind), ["id"], ["part"])
    writers.upsert(spark, path, spark.createDataFrame([(3, None, 30), (4, "a", 40), (None, "c", 50)], kind), ["id"], ["part"])
    got = spark.read.schema(kind).parquet(path).select("id", "part", "v")
    assert sorted(rows(got), key=str) == sorted([(1, "a", 1), (2, None, 2), (3, None, 30), (4, "a", 40), (None, "c", 50)], key=str)
    with pytest.raises(ValueError, match="more than once"):
        writers.upsert(spark, path, spark.createDataFrame([(1, "a", 1), (1, "b", 2)], kind), ["id"], ["part"])


def test_retention_compares_values(spark, tmp_path):
    path = str(tmp_path / "t")
    writers.write_partitioned(spark.createDataFrame([(n, n) for n in (2, 9, 10, 11)] + [(0, None)], "v int, p int"), path, ["p"])
    assert writers.drop_old_partitions(spark, path, "p", 10) == ["2", "9"]
    assert spark.read.parquet(path).count() == 3
    days = str(tmp_path / "d")
    dates = [(datetime.date(2024, 1, d),) for d in (1, 2, 3)]
    writers.write_partitioned(spark.createDataFrame(dates, "d date").withColumn("v", F.lit(1)), days, ["d"])
    assert writers.drop_old_partitions(spark, days, "d", datetime.date(2024, 1, 3)) == ["2024-01-01", "2024-01-02"]


def _windows(spark, starts, width, bad):
    at = datetime.datetime(2024, 1, 1)
    step = datetime.timedelta(minutes=1)
    data = [(at + s * step, at + (s + width) * step, b) for s, b in zip(starts, bad)]
    return spark.createDataFrame(data, "window_start timestamp, window_end timestamp, bad boolean")


def test_alerts_hold_for_days_and_slide(spark):
    hours = _windows(spark, range(0, 6000, 60), 60, [True] * 100)
    assert monitoring.held_alerts(hours, F.col("bad"), 50).count() == 51
    assert monitoring.held_alerts(hours, F.col("bad"), 1).count() == 100
    sliding = _windows(spark, range(0, 1000, 10), 30, [i != 40 for i in range(100)])
    assert monitoring.held_alerts(sliding, F.col("bad"), 3, slide="10 minutes").count() == 95


def test_aggregate_names(spark):
    df = spark.createDataFrame([("a", 1.0, 3), ("a", None, 1), ("a", 4.0, 2), ("a", 9.0, 4), ("b", None, 1)], "k string, v double, t int")
    spec = {"v": {n: n for n in ("median", "prod", "size", "count", "first", "last", "skew")}}
    got = {r.k: r.asDict() for r in aggregate.aggregate(df, "k", spec, order_by="t").collect()}
    assert (got["a"]["median"], got["a"]["prod"], got["a"]["size"], got["a"]["count"]) == (4.0, 36.0, 4, 3)
    assert (got["a"]["first"], got["a"]["last"]) == (4.0, 9.0)
    assert round(got["a"]["skew"], 6) == 0.722109
    assert got["b"]["first"] is None and got["b"]["size"] == 1
    with pytest.raises(ValueError, match="order"):
        aggregate.aggregate(df, "k", {"v": "first"})


def test_gaps_of_a_stray_date(spark):
    df = spark.createDataFrame([(datetime.datetime(2023, 12, 27), 1), (datetime.datetime(2024, 1, 11), 2), (datetime.datetime(1700, 1, 1), 3)], "t timestamp, v int")
    weeks = timeseries.time_series_aggregation(df.where("v < 3"), "t", ["v"], "W")
    assert [(str(r.t)[:10], r.v) for r in weeks.orderBy("t").collect()] == [("2023-12-31", 1), ("2024-01-07", 0), ("2024-01-14", 2)]
    assert timeseries.time_series_aggregation(df, "t", ["v"], "D").count() == (datetime.date(2024, 1, 11) - datetime.date(1700, 1, 1)).days + 1
    with pytest.raises(ValueError, match="unknown window"):
        timeseries.aggregate_by_time_window(df, "t", ["fortnightly"], ["v"], ["sum"])


def test_rules_on_odd_input(spark):
    df = spark.createDataFrame([(None, 0), (None, 1), (1, 2)], "k int, q int")
    rules = [
        quality.NullRule("absent", ["zz"]),
        quality.PredicateRule("inverse", 1 / F.col("q") > 2),
        quality.PredicateRule("sound", F.col("q") > 1),
        quality.CustomRule("dict", lambda d: {"passed": False, "violations": 2, "total": 4}),
        quality.CustomRule("late", lambda d: d.where(1 / F.col("q") > 2)),
        quality.DuplicateRule("rows", ["k"]),
        quality.DuplicateRule("keys", ["k"], count="keys"),
        quality.GroupRule("groups", ["k"], F.sum("q") > 1),
        quality.ReferenceRule("list", "q", [0, 1]),
    ]
    got = {r.rule_name: (r.passed, r.violations) for r in quality.check_rules(df, rules).collect()}
    assert got == {
        "absent": (True, 0), "inverse": (False, 0), "sound": (False, 1), "dict": (False, 2), "late": (False, 0),
        "rows": (False, 2), "keys": (False, 1), "groups": (False, 1), "list": (False, 1),
    }
    assert rows(quality.duplicate_rows(df, ["k"])) == [(None, 0), (None, 1)]
    assert rows(quality.missing_references(df, rules[-1])) == [(2,)]


def test_scratch_leaves_nothing(spark):
    from pathlib import Path

    from millrace.operators import ordered
    from millrace.session import new_path, scratch, work_root

    folder = Path(work_root(spark).removeprefix("file:"))
    before = {p.name for p in folder.iterdir()} if folder.exists() else set()
    with scratch():
        df = spark.range(50).withColumn("v", F.col("id") % 5)
        assert ordered.cumulative(df, ["id"], "v", "s").agg(F.max("s")).first()[0] == 100
        df.write.parquet(new_path(spark, "extra"))
    assert not [p.name for p in folder.iterdir() if p.name not in before and p.name.startswith(("pinned", "extra"))]


def test_random_settings_and_vectors(spark):
    from millrace.operators import features, learn

    grid = {"a": [1, 2, 3], "b": [0, 1]}
    drawn = learn.random_settings(grid, 4, seed=3)
    assert drawn == learn.random_settings(grid, 4, seed=3) and len({tuple(d.items()) for d in drawn}) == 4
    assert len(learn.random_settings(grid, 99)) == 6
    df = spark.createDataFrame([(1, "y"), (2, None), (3, "x")], "id int, c string")
    assert [(r.id, r.v["size"], r.v["index"]) for r in features.one_hot_vector(df, "c", "v").orderBy("id").collect()] == [(1, 2, 1), (2, 2, None), (3, 2, 0)]
