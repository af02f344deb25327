"""Rule-based data-quality checks.

Row-level rules of a run share one aggregate pass; duplicate and reference rules
add one shuffle each. Every result is a row of the same shape (``RESULT``).
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions import scalar
from millrace.operators.joins import values_without_reference
from millrace.operators.ordered import join_on
from millrace.operators.profile import known, numeric_columns

log = logging.getLogger(__name__)

RESULT = (
    "rule_name string, rule_type string, passed boolean, violations long, "
    "total long, pct double, message string"
)
_FIELDS = [f.split()[0] for f in RESULT.split(", ")]


@dataclass(frozen=True)
class NullRule:
    """Missing values per column may not exceed ``threshold`` percent."""

    name: str
    columns: Sequence[str] | None = None
    threshold: float = 0.0


@dataclass(frozen=True)
class DuplicateRule:
    """Copies of the same key; ``count`` is ``rows`` (all copies) or ``keys``."""

    name: str
    columns: Sequence[str] | None = None
    max_duplicates: int = 0
    count: str = "rows"


@dataclass(frozen=True)
class RangeRule:
    """Values below or above the limits; NULL does not violate."""

    name: str
    column: str
    min_value: float | None = None
    max_value: float | None = None


@dataclass(frozen=True)
class PatternRule:
    """Values, as text, must match a pattern from their start."""

    name: str
    column: str
    pattern: str


@dataclass(frozen=True)
class ReferenceRule:
    """Distinct values must be in a reference set."""

    name: str
    column: str
    reference: DataFrame | Sequence = ()


@dataclass(frozen=True)
class PredicateRule:
    """Rows that satisfy ``violates`` break the rule."""

    name: str
    violates: Column
    max_violations: int = 0
    rule_type: str = "business_rule"


@dataclass(frozen=True)
class CustomRule:
    """Caller's function of the table. It may return a Column of violations, a DataFrame of
    violating rows, a bool, or a dict with ``passed`` and any of ``violations``, ``total``
    and ``message``. An error, then or while rows are read, fails this rule alone."""

    name: str
    function: Callable[[DataFrame], Column | bool | dict | DataFrame]


@dataclass(frozen=True)
class GroupRule:
    """Caller's check of every group: an aggregate Column that must be true.

    Aggregates are formed before the shuffle, so no group has to fit into a task. A group for
    which the check is NULL violates the rule.
    """

    name: str
    columns: Sequence[str]
    holds: Column
    max_violations: int = 0


@dataclass(frozen=True)
class SchemaRule:
    """Columns and types the table must have."""

    name: str
    expected: dict[str, str] = field(default_factory=dict)


Rule = NullRule | DuplicateRule | RangeRule | PatternRule | ReferenceRule | PredicateRule | CustomRule | GroupRule | SchemaRule


def rules_from_config(config: Sequence[dict]) -> list[Rule]:
    """Build rules from plain mappings; unknown types are warned about and skipped."""
    build = {
        "null_check": lambda n, r: NullRule(n, r.get("columns"), r.get("threshold", 0)),
        "duplicate_check": lambda n, r: DuplicateRule(n, r.get("columns"), r.get("max_duplicates", 0)),
        "range_check": lambda n, r: RangeRule(n, r["column"], r.get("min_value"), r.get("max_value")),
        "pattern_check": lambda n, r: PatternRule(n, r["column"], r["pattern"]),
        "referential_check": lambda n, r: ReferenceRule(n, r["column"], r.get("reference_values", ())),
        "custom_check": lambda n, r: CustomRule(n, r["function"]),
    }
    rules = []
    for item in config:
        kind = item.get("type")
        if kind in build:
            rules.append(build[kind](item.get("name", "unnamed_rule"), item))
        else:
            log.warning("Unknown rule type: %s", kind)
    return rules


def _struct(name, kind, passed, violations, total, pct, message) -> Column:
    values = (
        F.lit(name), F.lit(kind), passed, violations.cast("long"), total.cast("long"),
        F.coalesce(pct.cast("double"), F.lit(0.0)), message,
    )
    return F.struct(*[v.alias(f) for v, f in zip(values, _FIELDS)])


def _pct(part: Column, whole: Column) -> Column:
    return F.try_divide(part, whole) * 100


class _Fused:
    """Collects aggregates of all row rules and the struct each result becomes."""

    def __init__(self, df: DataFrame):
        self.df = df
        self.numeric = set(numeric_columns(df))
        self.aggs: list[Column] = [F.count("*").alias("_total")]
        self.results: list[Column] = []
        self.callers: list[tuple[int, str, str]] = []  # expressions of the caller's: aggregate, rule name, type

    def count(self, violates: Column) -> Column:
        name = f"_v{len(self.aggs)}"
        self.aggs.append(F.count_if(F.coalesce(violates, F.lit(False))).alias(name))
        return F.col(name)

    def _missing(self, c: str) -> Column:
        return (known(c) if c in self.numeric else F.col(c)).isNull()

    def add_null(self, r: NullRule) -> None:
        total = F.col("_total")
        wanted = r.columns or self.df.columns
        counts = {c: self.count(self._missing(c)) for c in wanted if c in self.df.columns}
        failed = F.filter(
            F.array(*[F.when(_pct(n, total) > r.threshold, F.lit(c)) for c, n in counts.items()]).cast("array<string>"),
            lambda c: c.isNotNull(),
        )
        violations = sum(counts.values(), F.lit(0))
        worst = [_pct(n, total) for n in counts.values()] or [F.lit(0.0)]
        message = F.when(F.size(failed) == 0, F.lit("no column lacks too many values")).otherwise(
            F.concat(F.lit("too many values missing in: "), F.array_join(failed, ", "))
        )
        pct = F.greatest(*worst) if len(worst) > 1 else worst[0]
        self.results.append(_struct(r.name, "null_check", F.size(failed) == 0, violations, total, pct, message))

    def add_count(
        self, name: str, kind: str, violates: Column, what: str, allowed: int = 0, of_caller: bool = False
    ) -> None:
        if of_caller:
            self.callers.append((len(self.aggs), name, kind))
        n, total = self.count(violates), F.col("_total")
        message = F.concat(n.cast("string"), F.lit(f" {what}"))
        self.results.append(_struct(name, kind, n <= allowed, n, total, _pct(n, total), message))

    def frame(self) -> DataFrame:
        """All results from one pass.

        A caller's expression can fail on some row, which only shows when rows are read. With
        such rules the pass runs now; if it fails, their expressions are tried one by one
        and those that fail give failed results.
        """
        counted, broken = self.df.agg(*self.aggs), {}
        if self.callers:
            try:
                row = counted.first()
            except Exception:
                for at, _, _ in self.callers:
                    try:
                        self.df.agg(self.aggs[at]).first()
                    except Exception as err:
                        broken[at] = str(err).split("\n")[0]
                        self.aggs[at] = F.lit(None).cast("long").alias(f"_v{at}")
                counted = self.df.agg(*self.aggs)
                row = counted.first()
            counted = self.df.sparkSession.createDataFrame([row], counted.schema)
        results = counted.select(F.explode(F.array(*self.results)).alias("r")).select("r.*")
        if not broken:
            return results
        names = {name: broken[at] for at, name, _ in self.callers if at in broken}
        failed = [(name, kind, False, 0, 0, 0.0, _failed_with(broken[at])) for at, name, kind in self.callers if at in broken]
        kept = results.filter(~F.col("rule_name").isin(list(names)))
        return kept.union(_constant(self.df.sparkSession, failed))


def _failed_with(err: object) -> str:
    return f"the check could not be run: {err}"


def _constant(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame(rows, RESULT)


def _duplicates(df: DataFrame, rules: Sequence[DuplicateRule]) -> DataFrame:
    """Results of all rules on the same key, from one group-by."""
    groups = df.groupBy(*(rules[0].columns or df.columns)).agg(F.count("*").alias("_n"))
    again = F.col("_n") > 1
    totals = groups.agg(
        F.coalesce(F.sum(F.when(again, F.col("_n"))), F.lit(0)).alias("rows"),
        F.count_if(again).alias("keys"), F.coalesce(F.sum("_n"), F.lit(0)).alias("total"),
    )
    results = []
    for r in rules:
        n = F.col(r.count)
        what = "rows share their key" if r.count == "rows" else "keys occur more than once"
        message = F.concat(n.cast("string"), F.lit(f" {what}"))
        pct = _pct(n, F.col("total"))
        results.append(_struct(r.name, "duplicate_check", n <= r.max_duplicates, n, F.col("total"), pct, message))
    return totals.select(F.explode(F.array(*results)).alias("r")).select("r.*")


def _groups(df: DataFrame, r: GroupRule) -> DataFrame:
    checked = df.groupBy(*r.columns).agg(F.coalesce(r.holds, F.lit(False)).alias("_holds"))
    n, total = F.count_if(~F.col("_holds")), F.count("*")
    message = F.concat(n.cast("string"), F.lit(" groups break the rule"))
    return checked.agg(
        _struct(r.name, "group_check", n <= r.max_violations, n, total, _pct(n, total), message).alias("r")
    ).select("r.*")


def _reference_frame(df: DataFrame, r: ReferenceRule) -> DataFrame:
    """The reference values as a one-column table."""
    if isinstance(r.reference, DataFrame):
        return r.reference
    field = T.StructField("v", df.schema[r.column].dataType)
    return df.sparkSession.createDataFrame([(v,) for v in r.reference], T.StructType([field]))


def _reference(df: DataFrame, r: ReferenceRule) -> DataFrame:
    ref = _reference_frame(df, r)
    known_values = ref.select(F.col(ref.columns[0]).alias("_ref"), F.lit(True).alias("_known")).distinct()
    values = df.select(F.col(r.column).alias("_v")).distinct()
    matched = values.join(known_values, F.col("_v").eqNullSafe(F.col("_ref")), "left")
    n, total = F.count_if(F.col("_known").isNull()), F.count("*")
    message = F.concat(n.cast("string"), F.lit(" distinct values are not in the reference set"))
    return matched.agg(
        _struct(r.name, "referential_check", n == 0, n, total, _pct(n, total), message).alias("r")
    ).select("r.*")


def missing_references(df: DataFrame, r: ReferenceRule, n: int = 10) -> DataFrame:
    """First ``n`` distinct values that the reference set lacks."""
    return values_without_reference(df, r.column, _reference_frame(df, r)).orderBy(r.column).limit(n)


# Types that count as compatible.
TYPE_GROUPS = {
    "numeric": ["tinyint", "smallint", "int", "bigint", "float", "double", "decimal"],
    "string": ["string", "varchar", "char"],
    "datetime": ["date", "timestamp", "timestamp_ntz"],
}


def schema_problems(df: DataFrame, expected: dict[str, str]) -> dict[str, list[str]]:
    """Missing columns, extra columns and type mismatches; no data is read."""
    actual = dict(df.dtypes)

    def group(name: str) -> str:
        base = name.split("(")[0]
        return next((g for g, names in TYPE_GROUPS.items() if base in names), name)

    return {
        "missing_columns": sorted(set(expected) - set(actual)),
        "extra_columns": sorted(set(actual) - set(expected)),
        "type_mismatches": sorted(
            f"{c}: expected {t}, got {actual[c]}"
            for c, t in expected.items()
            if c in actual and group(actual[c]) != group(t)
        ),
    }


def check_rules(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Result row per rule, in one lazy DataFrame."""
    spark = df.sparkSession
    fused, frames, fixed = _Fused(df), [], []
    same_key: dict[tuple, list[DuplicateRule]] = {}
    for r in rules:
        column = getattr(r, "column", None)
        if column is not None and column not in df.columns:
            kind = {RangeRule: "range_check", PatternRule: "pattern_check"}.get(type(r), "referential_check")
            fixed.append((r.name, kind, False, 0, 0, 0.0, f"there is no column {column}"))
        elif isinstance(r, NullRule):
            fused.add_null(r)
        elif isinstance(r, RangeRule):
            c, bad = F.col(r.column), F.lit(False)
            if r.min_value is not None:
                bad = bad | (c < r.min_value)
            if r.max_value is not None:
                bad = bad | (c > r.max_value)
            fused.add_count(r.name, "range_check", bad, f"values outside [{r.min_value}, {r.max_value}]")
        elif isinstance(r, PatternRule):
            fused.add_count(r.name, "pattern_check", ~scalar.matches_prefix(r.column, r.pattern),
                            "values do not match the pattern")
        elif isinstance(r, PredicateRule):
            fused.add_count(r.name, r.rule_type, r.violates, "rows break the rule", r.max_violations, of_caller=True)
        elif isinstance(r, DuplicateRule):
            same_key.setdefault(tuple(r.columns or df.columns), []).append(r)
        elif isinstance(r, GroupRule):
            frames.append(_groups(df, r))
        elif isinstance(r, ReferenceRule):
            frames.append(_reference(df, r))
        elif isinstance(r, SchemaRule):
            problems = schema_problems(df, r.expected)
            n = len(problems["missing_columns"]) + len(problems["type_mismatches"])
            word = "is as expected" if n == 0 else "differs"
            fixed.append((r.name, "schema_check", n == 0, n, len(r.expected), 0.0, f"the schema {word}"))
        else:
            _custom(df, r, fused, frames, fixed)
    frames += [_duplicates(df, group) for group in same_key.values()]
    if fused.results:
        frames.insert(0, fused.frame())
    if fixed:
        frames.append(_constant(spark, fixed))
    if not frames:
        return _constant(spark, [])
    out = frames[0]
    for frame in frames[1:]:
        out = out.union(frame)
    return out


def _custom(df: DataFrame, r: CustomRule, fused: _Fused, frames: list, fixed: list) -> None:
    def result(passed: bool, violations: int, total: int, message: str) -> None:
        pct = violations / total * 100 if total else 0.0
        fixed.append((r.name, "custom_check", passed, violations, total, pct, message))

    try:
        outcome = r.function(df)
        if isinstance(outcome, Column):
            df.select(outcome)  # what cannot be resolved fails here, not in the shared pass
        elif isinstance(outcome, DataFrame):
            outcome = outcome.count()
    except Exception as err:
        result(False, 0, 0, _failed_with(str(err).split("\n")[0]))
        return
    if isinstance(outcome, bool):
        result(outcome, int(not outcome), 0, "the check holds" if outcome else "the check does not hold")
    elif isinstance(outcome, int):
        result(outcome == 0, outcome, outcome, f"{outcome} rows break the rule")
    elif isinstance(outcome, Column):
        fused.add_count(r.name, "custom_check", outcome, "rows break the rule", of_caller=True)
    elif isinstance(outcome, dict):
        passed = bool(outcome.get("passed", False))
        message = outcome.get("message", "the check holds" if passed else "the check does not hold")
        result(passed, int(outcome.get("violations", not passed)), int(outcome.get("total", 0)), str(message))
    else:
        result(False, 0, 0, f"a check cannot return {type(outcome).__name__}")


# --- samples and details of one rule ----------------------------------------


def duplicate_rows(df: DataFrame, columns: Sequence[str], n: int = 10) -> DataFrame:
    """First ``n`` rows that share their key, NULL included, with another row; ties by the other columns."""
    repeated = df.groupBy(*columns).agg(F.count("*").alias("_n")).filter("_n > 1").drop("_n")
    others = [c for c, kind in df.dtypes if c not in columns and not kind.startswith(("map", "variant"))]
    return join_on(df, repeated, list(columns), "left_semi").orderBy(*columns, *others).limit(n)


def range_details(df: DataFrame, r: RangeRule) -> DataFrame:
    """Actual minimum and maximum beside the limits."""
    c = F.col(r.column).cast("double")
    return df.agg(F.min(c).alias("actual_min"), F.max(c).alias("actual_max")).withColumns(
        {"min_value": F.lit(r.min_value).cast("double"), "max_value": F.lit(r.max_value).cast("double")}
    )


def pattern_samples(df: DataFrame, r: PatternRule, key: str, n: int = 5) -> DataFrame:
    """First ``n`` values that do not match, by key."""
    return df.filter(~scalar.matches_prefix(r.column, r.pattern)).orderBy(key).select(key, r.column).limit(n)


# --- whole-table checks ------------------------------------------------------


def freshness(df: DataFrame, date: str, as_of: Column, max_lag_days: int = 2) -> DataFrame:
    """Days between the newest date and ``as_of``."""
    out = df.agg(F.max(date).alias("latest_date"))
    lag = F.datediff(as_of, "latest_date")
    return out.withColumns({"days_lag": lag, "passed": F.coalesce(lag <= max_lag_days, F.lit(False))})


def volume(df: DataFrame, date: str, as_of: Column, days: int = 30, sigmas: float = 3.0) -> DataFrame:
    """Is the row count of ``as_of`` within ``sigmas`` of the daily mean?"""
    daily = (
        df.filter((F.col(date) >= F.date_sub(as_of, days)) & (F.col(date) <= as_of))
        .groupBy(date)
        .agg(F.count("*").alias("n"))
    )
    out = daily.agg(
        F.count("*").alias("record_count"),
        F.avg("n").alias("avg_daily_count"),
        F.stddev("n").alias("stddev_daily_count"),
        F.coalesce(F.sum(F.when(F.col(date) == as_of, F.col("n"))), F.lit(0)).alias("today_count"),
    )
    off = F.abs(F.col("today_count") - F.col("avg_daily_count"))
    return out.withColumn("passed", F.coalesce(off <= sigmas * F.col("stddev_daily_count"), F.lit(False)))


_COMPARE: dict[str, Callable[[Column, Column], Column]] = {
    "equals": lambda a, e: a == e,
    "not_equals": lambda a, e: a != e,
    "greater_than": lambda a, e: a > e,
    "greater_than_or_equals": lambda a, e: a >= e,
    "less_than": lambda a, e: a < e,
    "less_than_or_equals": lambda a, e: a <= e,
}


@dataclass(frozen=True)
class SqlCheck:
    """One-value query over ``{data}`` and the value it is compared with."""

    name: str
    sql: str
    expected: float
    comparison: str = "equals"
    args: dict | None = None


def sql_checks(df: DataFrame, checks: Sequence[SqlCheck], date_filter: str | Column | None = None) -> DataFrame:
    """Run each check and compare; all queries become subqueries of one job."""
    spark = df.sparkSession
    data = df.filter(date_filter) if date_filter is not None else df
    rows = []
    for c in checks:
        if c.comparison not in _COMPARE:
            raise ValueError(f"unknown comparison: {c.comparison}")
        actual = spark.sql(c.sql, args=c.args, data=data).scalar().cast("double")
        passed = F.coalesce(_COMPARE[c.comparison](actual, F.lit(float(c.expected))), F.lit(False))
        rows.append(
            F.struct(
                F.lit(c.name).alias("name"), actual.alias("actual"), F.lit(float(c.expected)).alias("expected"),
                F.lit(c.comparison).alias("comparison"), passed.alias("passed"),
            )
        )
    return spark.range(1).select(F.explode(F.array(*rows)).alias("r")).select("r.*")


# --- rule presets -------------------------------------------------------------


def sales_rules(as_of: Column) -> list[Rule]:
    """Business rules of a sales table."""
    q, p, t = F.col("quantity"), F.col("price"), F.col("total_amount")
    return [
        PredicateRule("positive_amounts", (q <= 0) | (p <= 0) | (t <= 0)),
        PredicateRule("amount_calculation", F.abs(t - q * p) > 0.01),
        PredicateRule("date_consistency", F.col("transaction_date") > as_of),
    ]


def file_rules(critical: Sequence[str], min_rows: int = 10) -> list[Rule]:
    """Checks of an incoming file: critical fields, positive numbers, enough rows."""
    return [
        NullRule("critical_nulls", critical),
        PredicateRule("positive_quantity", F.col("quantity") <= 0),
        PredicateRule("positive_price", F.col("price") <= 0),
        CustomRule("enough_rows", lambda df: df.limit(min_rows).count() >= min_rows),
    ]


def box_rules() -> list[Rule]:
    """Plausibility of bounding boxes."""
    # Smallest area and the accepted aspect ratios.
    min_area, min_ratio, max_ratio = 100, 0.1, 10
    w, h = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")
    ratio = w / (h + 1e-6)
    return [
        PredicateRule("negative_coordinates", (F.col("x1") < 0) | (F.col("y1") < 0)),
        PredicateRule("empty_area", w * h <= 0),
        PredicateRule("small_area", w * h < min_area),
        PredicateRule("extreme_aspect", (ratio < min_ratio) | (ratio > max_ratio)),
    ]


def source_rules(required: Sequence[str], min_records: int, date_column: str, date_format: str) -> list[Rule]:
    """Gate for a source: columns there, enough records, dates parse."""
    parsed = F.try_to_timestamp(F.col(date_column).cast("string"), F.lit(date_format))
    return [
        CustomRule("required_columns", lambda df: not set(required) - set(df.columns)),
        CustomRule("min_records", lambda df: df.limit(min_records).count() >= min_records),
        CustomRule("date_format", lambda df: parsed.isNull()),
    ]


# --- results -------------------------------------------------------------------


def require_passed(results: DataFrame) -> DataFrame:
    """Fail with the names of the failed checks (results are one row per rule)."""
    failed = [r[0] for r in results.filter(~F.col("passed")).select(results.columns[0]).collect()]
    if failed:
        raise ValueError(f"Quality checks failed: {failed}")
    return results


def text_report(results: DataFrame, max_message: int = 100) -> str:
    """One line per rule under a pass count; failed rules show their share."""
    lines = []
    for r in results.orderBy("passed", "rule_name").toLocalIterator():
        text = r.message if len(r.message) <= max_message else r.message[:max_message] + " [truncated]"
        share = "" if r.passed else f" ({r.violations} of {r.total}, {r.pct:.2f}%)"
        lines.append(f"{'pass' if r.passed else 'FAIL'}  {r.rule_name} [{r.rule_type}] {text}{share}")
    failed = sum(line.startswith("FAIL") for line in lines)
    return "\n".join([f"{len(lines)} rules, {len(lines) - failed} passed, {failed} failed", *lines])
