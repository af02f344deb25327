"""Cleaning, quality rules, aggregation and resampling on small frames."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from millrace.operators import aggregate as agg
from millrace.operators import clean, features, profile, quality as dq, timeseries
from millrace.functions import health, scalar, text
from tests.conftest import rows


@pytest.fixture
def people(spark):
    data = [(1, "Ann ", 20.0, "a@x.org", 100.0), (2, None, None, "invalid-email", -50.0), (3, "BOB", 40.0, None, None),
            (3, "BOB", 40.0, None, None), (5, "Eve", 60.0, "e@x.org", 500.0)]
    return spark.createDataFrame(data, "id int, name string, age double, email string, amount double")


def test_clean_data_drops_copies_and_fills(people):
    out = clean.clean_data(people, ["age", "amount"], ["name"])
    assert out.count() == 4 and out.filter("age IS NULL OR amount IS NULL").count() == 0
    assert {r.name for r in out.collect()} == {"ann", None, "bob", "eve"}
    assert clean.impute(people, ["age"], "median").filter("id = 2").first().age == 40.0
    with pytest.raises(ValueError):
        clean.impute(people, ["age"], "mode")


def test_nan_counts_as_missing(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,), (3.0,)], "v double")
    assert profile.missing_table(df).first().missing_count == 2
    assert [r.v for r in clean.impute(df, ["v"]).collect()] == [1.0, 2.0, 2.0, 3.0]
    got = profile.summary_statistics(df).first()
    assert (got["count"], got["mean"], got["median"], got.skewness) == (2, 2.0, 2.0, None)


def test_profile_of_an_empty_column(spark):
    df = spark.createDataFrame([(None,), (None,)], "v double")
    got = profile.summary_statistics(df, ["v"]).first()
    assert (got["count"], got.null_percentage, got.unique_count, got["median"]) == (0, 100.0, 0, None)


def test_outliers_are_flagged_and_clipped(spark):
    df = spark.createDataFrame([(i, v) for i, v in enumerate([300.0, 120.0, 125.0, 130.0, 128.0, 122.0])], "id int, bp double")
    assert [r.id for r in clean.iqr_clip(df, ["bp"], flag=True).filter("bp_outlier").collect()] == [0]
    assert clean.iqr_clip(df, ["bp"]).agg(F.max("bp")).first()[0] < 300
    assert clean.iqr_filter(df, ["bp"]).count() == 5


def test_rules(people):
    rules = dq.rules_from_config([
        {"name": "nulls", "type": "null_check", "columns": ["name", "amount"], "threshold": 10},
        {"name": "copies", "type": "duplicate_check", "columns": ["id"]},
        {"name": "amount", "type": "range_check", "column": "amount", "min_value": 0, "max_value": 1000},
        {"name": "mail", "type": "pattern_check", "column": "email", "pattern": r"[^@]+@[^@]+\.org"},
        {"name": "ids", "type": "referential_check", "column": "id", "reference_values": [1, 2, 3]},
        {"name": "adult", "type": "custom_check", "function": lambda df: F.col("age") < 18},
        {"name": "boom", "type": "custom_check", "function": lambda df: F.col("no_such_column") > 1},
        {"name": "fine", "type": "custom_check", "function": lambda df: True},
        {"name": "gone", "type": "range_check", "column": "nope"},
        {"name": "odd", "type": "no_such_type"},
    ])
    got = {r.rule_name: r for r in dq.check_rules(people, rules).collect()}
    assert {n: (r.passed, r.violations) for n, r in got.items()} == {
        "nulls": (False, 3), "copies": (False, 2), "amount": (False, 1), "mail": (False, 3), "ids": (False, 1),
        "adult": (True, 0), "boom": (False, 0), "fine": (True, 0), "gone": (False, 0),
    }
    with pytest.raises(ValueError, match="amount"):
        dq.require_passed(dq.check_rules(people, rules))
    report = dq.text_report(dq.check_rules(people, rules))
    assert report.startswith("9 rules, 2 passed, 7 failed") and "copies" in report


def test_row_rules_share_one_scan(people):
    rules = [dq.NullRule("n"), dq.RangeRule("r", "amount", 0), dq.PatternRule("p", "email", ".*")]
    plan = dq.check_rules(people, rules)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 1


def test_rules_on_an_empty_table(spark):
    empty = spark.createDataFrame([], "id int, v double")
    rules = [dq.NullRule("n"), dq.DuplicateRule("d"), dq.RangeRule("r", "v", 0, 1), dq.ReferenceRule("f", "id", [1])]
    assert [r.passed for r in dq.check_rules(empty, rules).collect()] == [True] * 4
    with pytest.raises(ValueError):
        clean.require_rows(empty)


def test_schema_rule(people):
    problems = dq.schema_problems(people, {"id": "bigint", "name": "int", "phone": "string"})
    assert problems["missing_columns"] == ["phone"] and len(problems["type_mismatches"]) == 1
    assert "age" in problems["extra_columns"]


def test_aggregate_drops_null_keys_and_names_columns(spark):
    df = spark.createDataFrame([("A", 1.0, 2), ("A", 3.0, 4), (None, 9.0, 9)], "k string, v double, q int")
    assert rows(agg.aggregate(df, "k", {"v": ["sum", "mean"], "q": "max"})) == [("A", 4.0, 2.0, 4)]
    assert agg.aggregate(df, "k", {"v": "sum"}, keep_null_keys=True).count() == 2
    assert agg.aggregate(df, "k", {"v": "sum"}).columns == ["k", "v"]
    with pytest.raises(ValueError):
        agg.aggregate(df, "k", {"v": "no_such"})


def test_resample_keeps_empty_bins_and_labels(spark):
    days = [dt.datetime(2024, 1, 1, 5), dt.datetime(2024, 1, 3, 7), dt.datetime(2024, 3, 31)]
    df = spark.createDataFrame([(d, 1.0) for d in days], "t timestamp, v double")
    daily = timeseries.time_series_aggregation(df, "t", ["v"], "D", "sum").orderBy("t").collect()
    assert len(daily) == 91 and [r.v for r in daily[:3]] == [1.0, 0.0, 1.0] and daily[0].day_of_week == 0
    monthly = timeseries.time_series_aggregation(df, "t", ["v"], "M", "mean").orderBy("t").collect()
    assert [(r.t.day, r.v) for r in monthly] == [(31, 1.0), (29, None), (31, 1.0)]
    weekly = timeseries.time_series_aggregation(df, "t", ["v"], "W", "count").orderBy("t").collect()
    assert weekly[0].t == dt.datetime(2024, 1, 7) and weekly[0].v == 2
    with pytest.raises(ValueError):
        timeseries.time_series_aggregation(df, "t", ["v"], "decade")


def test_pivot_fills_and_histogram_handles_constants(spark):
    df = spark.createDataFrame([("a", "x", 1.0), ("b", "y", 2.0)], "i string, c string, v double")
    assert rows(agg.pivot_aggregation(df, "i", "c", "v"), "i") == [("a", 1.0, 0.0), ("b", 0.0, 2.0)]
    assert profile.histogram(df.withColumn("v", F.lit(3.0)), "v", 4).agg(F.sum("count")).first()[0] == 2


def test_flatten_refuses_long_lists(spark):
    df = spark.createDataFrame([([1, 2, 3],)], "a array<int>")
    assert rows(clean.flatten(df, max_items=3)) == [(1, 2, 3)]
    with pytest.raises(Exception, match="more than 2 items"):
        clean.flatten(df, max_items=2).collect()


def test_split_is_stratified_and_disjoint(spark):
    df = spark.range(1000).withColumn("label", (F.col("id") % 10 == 0).cast("int"))
    out = features.stratified_split(df, "label", "id", {"train": 0.7, "valid": 0.15, "test": 0.15})
    got = {(r.split, r.label): r.n for r in out.groupBy("split", "label").agg(F.count("*").alias("n")).collect()}
    assert got == {("train", 0): 630, ("valid", 0): 135, ("test", 0): 135, ("train", 1): 70, ("valid", 1): 15, ("test", 1): 15}
    assert out.select("id").distinct().count() == 1000


def test_scaling_and_encoding(spark):
    df = spark.createDataFrame([(1, 1.0, "b"), (2, 3.0, "a"), (3, 5.0, None)], "id int, v double, c string")
    z = features.zscore(df, ["v"]).agg(F.avg("v"), F.stddev_pop("v")).first()
    assert z[0] == pytest.approx(0) and z[1] == pytest.approx(1)
    assert [r.v for r in features.minmax(df, ["v"]).orderBy("id").collect()] == [0.0, 0.5, 1.0]
    assert rows(features.label_encode(df, ["c"]).select("id", "c_code"), "id") == [(1, 1), (2, 0), (3, 2)]
    assert rows(features.one_hot(df, "c", ["a", "b"]).select("id", "c_a", "c_b"), "id") == [(1, 0, 1), (2, 1, 0), (3, 0, 0)]


def test_oversampling_balances_between_neighbours(spark):
    df = spark.range(60).select("id", (F.col("id") >= 50).cast("int").alias("y"), (F.col("id") * 1.0).alias("a"), (F.col("id") % 7 * 1.0).alias("b"))
    out = features.oversample(df, "y", ["a", "b"], "id")
    assert {r.y: r["count"] for r in out.groupBy("y").count().collect()} == {0: 50, 1: 50}
    new = out.filter("synthetic").agg(F.min("a"), F.max("a")).first()
    assert 50 <= new[0] and new[1] <= 59


def test_text_cases(spark):
    df = spark.createDataFrame([("Check out this link: http://spam.com!!! Call 1234567890 NOW!",), ("URGENT!!! Free money NOW!!!",), ("",), ("Ünïcode 😀 ÄÖ",)], "t string")
    cleaned = [r[0] for r in df.select(text.clean_text("t")).collect()]
    assert cleaned[0] == "check out this link call now" and cleaned[2] == ""
    f = df.select(*[c.alias(n) for n, c in text.surface_features("t").items()]).collect()
    assert f[1].num_exclamation == 6 and f[2].length == 0 and f[3].num_capitals == 3
    w = df.select(*[c.alias(n) for n, c in text.word_features("t").items()]).collect()
    assert w[2].avg_word_length == 0.0 and w[2].num_unique_words == 0
    assert [r[0] for r in df.select(text.valid_email_text("t")).collect()] == [True, True, False, True]


def test_scalar_edge_cases(spark):
    df = spark.createDataFrame([("a.tar.gz", 0.0), (".bashrc", 2.0), ("x" * 300 + ".txt", None)], "s string, d double")
    got = df.select(
        scalar.file_extension("s"), F.length(scalar.sanitize_name("s")), scalar.safe_divide(F.lit(1.0), "d"),
        scalar.ratio(F.lit(1.0), "d"), scalar.human_bytes(F.lit(1536)),
    ).collect()
    assert [r[0] for r in got] == ["gz", "", "txt"]
    assert got[2][1] == 255 and [r[2] for r in got] == [0.0, 0.5, None] and [r[3] for r in got] == [None, 0.5, None]
    assert got[0][4] == "1.50 KB"
    with pytest.raises(ValueError):
        scalar.content_hash("s", "crc")


def test_health_edges(spark):
    df = spark.createDataFrame([(0.0,), (18.5,), (100.0,), (101.0,), (None,)], "b double")
    got = [r[0] for r in df.select(health.cut("b", health.BMI_BINS, health.BMI_LABELS)).collect()]
    assert got == [None, "underweight", "obese_2", None, None]
    levels = spark.createDataFrame([(0.29,), (0.3,), (0.7,), (None,)], "p double").select(health.risk_level("p"))
    assert [r[0] for r in levels.collect()] == ["Low", "Medium", "High", None]
