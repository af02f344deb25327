"""Per-group functions that fail alone, and two-phase aggregates against plain Python."""

import math
from collections import Counter

import pyarrow as pa
import pyarrow.compute as pc
import pytest

from millrace.operators import custom

SCHEMA = "g string, h int, v double, t string"
ROWS = [("a", 1, 1.0, "x"), ("a", 1, 4.0, "y"), ("b", 1, None, "y"), ("b", 2, 8.0, None), (None, 1, 2.0, "z"), (None, 1, 2.0, "z"), ("c", 3, -1.0, "q")]


@pytest.fixture(scope="module")
def df(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(4)


def test_failing_group_fails_alone(df):
    def total(table: pa.Table) -> pa.Table:
        if "q" in table.column("t").to_pylist():
            raise ValueError("no q here")
        return pa.table({"n": [table.num_rows], "total": [pc.sum(table.column("v")).as_py()]})

    got = {r.g: tuple(r)[1:] for r in custom.apply_per_group(df, ["g"], total, "n long, total double").collect()}
    assert got == {"a": (2, 5.0, None), "b": (2, 8.0, None), None: (2, 4.0, None), "c": (None, None, "ValueError: no q here")}


def test_wrong_results_are_failures_of_their_group(df):
    def odd(table: pa.Table) -> pa.Table:
        return pa.table({"n": ["many"]}) if table.num_rows == 2 else pa.table({"other": [1]})

    errors = [r.error for r in custom.apply_per_group(df, ["g"], odd, "n long").collect()]
    assert len(errors) == 4 and all(errors)


def test_large_groups_are_refused_by_name(spark):
    rows = [("big", "x" * 1000)] * 50 + [("small", "y")]
    out = custom.apply_per_group(spark.createDataFrame(rows, "g string, t string"), ["g"], lambda t: pa.table({"n": [t.num_rows]}), "n long", 10_000)
    got = {r.g: (r.n, r.error) for r in out.collect()}
    assert got["small"] == (1, None) and got["big"][0] is None and "over the limit of 10000" in got["big"][1]


def test_many_rows_none_and_empty(df):
    out = custom.apply_per_group(df, ["g", "h"], lambda t: t.select(["v"]).rename_columns(["w"]), "w double")
    assert sorted(map(repr, map(tuple, out.collect()))) == sorted(repr((g, h, v, None)) for g, h, v, _ in ROWS)
    assert custom.apply_per_group(df, ["g"], lambda t: t.slice(0, 0).select(["v"]).rename_columns(["w"]), "w double").count() == 0
    assert custom.apply_per_group(df.where("false"), ["g"], lambda t: t, "n long").count() == 0
    with pytest.raises(ValueError, match="taken"):
        custom.apply_per_group(df, ["g"], lambda t: t, "g string")


def test_checks(df):
    def check(table):
        if table.num_rows == 1:
            return 1 / 0
        values = table.column("v").to_pylist()
        return "missing value" if None in values else len(set(values)) > 1

    got = {r.g: (r.passed, r.message) for r in custom.check_groups(df, ["g"], check).collect()}
    assert got == {"a": (True, None), "b": (False, "missing value"), None: (False, None), "c": (False, "ZeroDivisionError: division by zero")}


@pytest.mark.parametrize("held", [50_000, 1])
def test_two_phase_aggregates(spark, monkeypatch, held):
    monkeypatch.setattr(custom, "HELD_GROUPS", held)
    rows = [(None if i % 7 == 0 else f"g{i % 3}", float(i % 11), i % 5) for i in range(2000)]
    df = spark.createDataFrame(rows, "g string, v double, k int").repartition(6)
    aggs = {"gm": custom.geometric_mean("v"), "m": custom.mode("k", "int")}
    got = {r.g: (r.gm, r.m) for r in custom.aggregate(df, ["g"], aggs).collect()}
    for g in {r[0] for r in rows}:
        v = [math.log(r[1]) for r in rows if r[0] == g and r[1] > 0]
        counts = Counter(r[2] for r in rows if r[0] == g)
        assert got[g] == (pytest.approx(math.exp(sum(v) / len(v))), min(counts, key=lambda k: (-counts[k], k)))
    whole = custom.aggregate(df, [], {"m": custom.mode("k", "int")}).collect()
    assert [r.m for r in whole] == [0]
    assert custom.aggregate(df.where("false"), ["g"], aggs).count() == 0
    none = custom.aggregate(df.where("v = 0"), ["g"], {"gm": custom.geometric_mean("v")}).collect()
    assert {r.gm for r in none} == {None}


def test_rows_are_not_shuffled(spark):
    df = spark.range(100).selectExpr("id % 3 AS g", "cast(id AS double) AS v")
    plan = custom.aggregate(df, ["g"], {"gm": custom.geometric_mean("v")})._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 2 and plan.index("MapInArrow") > plan.rindex("Exchange hashpartitioning")
