"""Data-quality checks."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from millrace.operators import custom, joins
from millrace.operators import quality as dq
from millrace.plans.sales import _round
from millrace.registry import query
from millrace.tables import BOXES_SQL, FACT_SALES_SQL, boxes, fact_sales, table

# The checks take their "today" as a parameter; the data ends in these days.
AS_OF = datetime.date(2001, 8, 1)


def _today():
    return F.lit(AS_OF)

# Missing values are put in by key, the same way on both sides.
_DIRTY_SQL = f"""{FACT_SALES_SQL}, dirty AS (
  SELECT * REPLACE (CASE WHEN l_linenumber = 7 THEN NULL ELSE product_id END AS product_id,
                    CASE WHEN l_linenumber = 6 AND quantity > 45 THEN NULL ELSE price END AS price)
  FROM fact_sales)"""


def _dirty(spark, sf_dir):
    line = F.col("l_linenumber")
    return fact_sales(spark, sf_dir).withColumns(
        {
            "product_id": F.when(line != 7, F.col("product_id")),
            "price": F.when(~((line == 6) & (F.col("quantity") > 45)), F.col("price")),
        }
    )


def _result(name, kind, passed, violations, total, pct, message):
    return (
        f"SELECT '{name}' AS rule_name, '{kind}' AS rule_type, {passed} AS passed, "
        f"CAST({violations} AS BIGINT) AS violations, CAST({total} AS BIGINT) AS total, "
        f"round(CAST({pct} AS DOUBLE), 6) AS pct, {message} AS message"
    )


def _counted(name, kind, violation, source, what, allowed=0):
    return (
        _result(name, kind, f"v <= {allowed}", "v", "t", "v * 100.0 / t", f"v || ' {what}'")
        + f" FROM (SELECT count(*) FILTER (WHERE {violation}) AS v, count(*) AS t FROM {source})"
    )


_NULLS_SQL = (
    _result(
        "critical", "null_check", "a * 100.0 / t <= 1 AND b * 100.0 / t <= 1 AND c * 100.0 / t <= 1", "a + b + c", "t",
        "greatest(a, b, c) * 100.0 / t",
        "CASE WHEN a * 100.0 / t <= 1 AND b * 100.0 / t <= 1 THEN 'no column lacks too many values' ELSE "
        "'too many values missing in: ' || concat_ws(', ', CASE WHEN a * 100.0 / t > 1 THEN 'product_id' END, "
        "CASE WHEN b * 100.0 / t > 1 THEN 'price' END) END",
    )
    + """ FROM (SELECT count(*) AS t, count(*) - count(product_id) AS a, count(*) - count(price) AS b,
         count(*) - count(quantity) AS c FROM dirty)"""
)


@query("dq_nulls", "DQ-01", f"WITH {_DIRTY_SQL} {_NULLS_SQL}")
def dq_nulls(spark, sf_dir):
    rules = [dq.NullRule("critical", ["product_id", "price", "quantity"], 1.0)]
    return _round(dq.check_rules(_dirty(spark, sf_dir), rules), 6)


_DUP_GROUPS = "(SELECT count(*) AS n FROM fact_sales GROUP BY transaction_id)"


@query("dq_duplicates", "DQ-02 DQ-03", f"""WITH {FACT_SALES_SQL}
{_result("copies", "duplicate_check", "v = 0", "v", "t", "v * 100.0 / t", "v || ' rows share their key'")}
FROM (SELECT CAST(sum(n) FILTER (WHERE n > 1) AS BIGINT) AS v, sum(n) AS t FROM {_DUP_GROUPS})
UNION ALL
{_result("keys", "duplicate_check", "v = 0", "v", "t", "v * 100.0 / t", "v || ' keys occur more than once'")}
FROM (SELECT count(*) FILTER (WHERE n > 1) AS v, sum(n) AS t FROM {_DUP_GROUPS})""")
def dq_duplicates(spark, sf_dir):
    rules = [
        dq.DuplicateRule("copies", ["transaction_id"]),
        dq.DuplicateRule("keys", ["transaction_id"], count="keys"),
    ]
    return _round(dq.check_rules(fact_sales(spark, sf_dir), rules), 6)


@query("dq_range", "DQ-04", f"""WITH {FACT_SALES_SQL}
{_counted("quantity", "range_check", "quantity < 2 OR quantity > 49", "fact_sales", "values outside [2, 49]")}
UNION ALL
{_counted("amount", "range_check", "total_amount < 0", "fact_sales", "values outside [0, None]")}""")
def dq_range(spark, sf_dir):
    rules = [dq.RangeRule("quantity", "quantity", 2, 49), dq.RangeRule("amount", "total_amount", 0)]
    return _round(dq.check_rules(fact_sales(spark, sf_dir), rules), 6)


@query("dq_range_details", "DQ-04", """
SELECT min(l_quantity) AS actual_min, max(l_quantity) AS actual_max, 2.0::DOUBLE AS min_value,
  49.0::DOUBLE AS max_value FROM lineitem""")
def dq_range_details(spark, sf_dir):
    return dq.range_details(table(spark, sf_dir, "lineitem"), dq.RangeRule("q", "l_quantity", 2, 49))


@query("dq_pattern", "DQ-05 SCL-07", f"""
{_counted("brand", "pattern_check", "NOT regexp_matches(p_brand, '^(?:Brand#[1-4])')", "part",
          "values do not match the pattern")}""")
def dq_pattern(spark, sf_dir):
    rules = [dq.PatternRule("brand", "p_brand", "Brand#[1-4]")]
    return _round(dq.check_rules(table(spark, sf_dir, "part"), rules), 6)


@query("dq_samples", "DQ-02 DQ-05 SRT-02", """
SELECT * FROM (SELECT 'pattern' AS kind, CAST(p_partkey AS VARCHAR) AS sample FROM part
  WHERE NOT regexp_matches(p_brand, '^(?:Brand#[1-4])') ORDER BY p_partkey LIMIT 5)
UNION ALL
SELECT * FROM (SELECT 'duplicate', l_orderkey || '-' || l_linenumber FROM lineitem
  WHERE (l_orderkey, l_linenumber) IN
    (SELECT (l_orderkey, l_linenumber) FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)
  ORDER BY l_orderkey, l_linenumber LIMIT 10)""")
def dq_samples(spark, sf_dir):
    rule = dq.PatternRule("brand", "p_brand", "Brand#[1-4]")
    bad = dq.pattern_samples(table(spark, sf_dir, "part"), rule, "p_partkey")
    dup = dq.duplicate_rows(
        table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber"), ["l_orderkey", "l_linenumber"]
    )
    return bad.select(F.lit("pattern").alias("kind"), F.col("p_partkey").cast("string").alias("sample")).union(
        dup.select(F.lit("duplicate"), F.concat_ws("-", "l_orderkey", "l_linenumber"))
    )


_SMALL_PARTS = "(SELECT p_partkey FROM part WHERE p_size <= 40)"


@query("dq_referential", "DQ-06 JN-03 SET-03", f"""
{_result("product", "referential_check", "v = 0", "v", "t", "v * 100.0 / t", "v || ' distinct values are not in the reference set'")}
FROM (SELECT count(DISTINCT l_partkey) FILTER (WHERE l_partkey NOT IN {_SMALL_PARTS}) AS v,
             count(DISTINCT l_partkey) AS t FROM lineitem)""")
def dq_referential(spark, sf_dir):
    parts = table(spark, sf_dir, "part").filter("p_size <= 40").select("p_partkey")
    rules = [dq.ReferenceRule("product", "l_partkey", parts)]
    return _round(dq.check_rules(table(spark, sf_dir, "lineitem"), rules), 6)


@query("dq_orphans", "JN-02 DQ-06", f"""
SELECT l_suppkey, count(*) AS orphan_records FROM lineitem WHERE l_partkey NOT IN {_SMALL_PARTS} GROUP BY 1""")
def dq_orphans(spark, sf_dir):
    parts = table(spark, sf_dir, "part").filter("p_size <= 40")
    lost = joins.orphans(table(spark, sf_dir, "lineitem"), parts, "l_partkey", "p_partkey")
    return lost.groupBy("l_suppkey").agg(F.count("*").alias("orphan_records"))


@query("dq_freshness", "DQ-11", f"""
SELECT CAST(max(o_orderdate)::DATE AS VARCHAR) AS latest_date,
  datediff('day', max(o_orderdate)::DATE, DATE '{AS_OF}')::INTEGER AS days_lag,
  datediff('day', max(o_orderdate)::DATE, DATE '{AS_OF}') <= 2 AS passed FROM orders""")
def dq_freshness(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("d"))
    return dq.freshness(orders, "d", _today()).withColumn("latest_date", F.col("latest_date").cast("string"))


@query("dq_volume", "DQ-12", f"""
WITH d AS (SELECT o_orderdate::DATE AS d, count(*) AS n FROM orders
  WHERE o_orderdate::DATE BETWEEN DATE '{AS_OF}' - 30 AND DATE '{AS_OF}' GROUP BY 1),
s AS (SELECT count(*) AS record_count, avg(n) AS m, stddev(n) AS s,
  CAST(coalesce(sum(n) FILTER (WHERE d = DATE '{AS_OF}'), 0) AS BIGINT) AS today_count FROM d)
SELECT record_count, round(m, 6) AS avg_daily_count, round(s, 6) AS stddev_daily_count, today_count,
  abs(today_count - m) <= 3 * s AS passed FROM s""")
def dq_volume(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("d"))
    return _round(dq.volume(orders, "d", _today()), 6)


@query("dq_business", "DQ-13 DQ-16 PRJ-16", f"""WITH {FACT_SALES_SQL}
{_counted("positive_amounts", "business_rule", "quantity <= 0 OR price <= 0 OR total_amount <= 0", "fact_sales", "rows break the rule")}
UNION ALL
{_counted("amount_calculation", "business_rule", "abs(total_amount - quantity * price) > 0.01", "fact_sales", "rows break the rule")}
UNION ALL
{_counted("date_consistency", "business_rule", "transaction_date > DATE '2000-01-01'", "fact_sales", "rows break the rule")}""")
def dq_business(spark, sf_dir):
    rules = dq.sales_rules(F.lit(datetime.date(2000, 1, 1)))
    return _round(dq.check_rules(fact_sales(spark, sf_dir), rules), 6)


@query("dq_sql_check", "DQ-14 DQ-15 SRC-09", """
SELECT name, actual, expected, comparison,
  CASE comparison WHEN 'equals' THEN actual = expected WHEN 'greater_than' THEN actual > expected
    ELSE actual <= expected END AS passed
FROM (
  SELECT 'rows' AS name, count(*)::DOUBLE AS actual, 100.0::DOUBLE AS expected, 'greater_than' AS comparison FROM orders
  UNION ALL SELECT 'negative', count(*)::DOUBLE, 0.0, 'equals' FROM orders WHERE o_totalprice < 0
  UNION ALL SELECT 'large', count(*)::DOUBLE, 10.0, 'less_than_or_equals' FROM orders WHERE o_totalprice > 400000)""")
def dq_sql_check(spark, sf_dir):
    checks = [
        dq.SqlCheck("rows", "SELECT count(*) FROM {data}", 100, "greater_than"),
        dq.SqlCheck("negative", "SELECT count(*) FROM {data} WHERE o_totalprice < 0", 0),
        dq.SqlCheck("large", "SELECT count(*) FROM {data} WHERE o_totalprice > :top", 10, "less_than_or_equals",
                    {"top": 400000}),
    ]
    return dq.sql_checks(table(spark, sf_dir, "orders"), checks)


@query("dq_source_gate", "DQ-19 DQ-07 UDF-05", f"""
SELECT 'required_columns' AS rule_name, true AS passed
UNION ALL SELECT 'min_records', count(*) >= 100 FROM orders
UNION ALL SELECT 'date_format', count(*) FILTER (WHERE try_strptime(CAST(o_orderdate AS VARCHAR), '%Y-%m-%d %H:%M:%S') IS NULL) = 0
FROM orders""")
def dq_source_gate(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    rules = dq.source_rules(["o_orderkey", "o_orderdate"], 100, "o_orderdate", "yyyy-MM-dd HH:mm:ss")
    return dq.check_rules(orders, rules).select("rule_name", "passed")


@query("dq_report", "DQ-09 DQ-08 PRJ-12", f"""WITH {_DIRTY_SQL}
SELECT rule_name, passed FROM ({_NULLS_SQL})
UNION ALL SELECT 'unique', (SELECT max(n) FROM (SELECT count(*) AS n FROM dirty GROUP BY transaction_id)) = 1
UNION ALL SELECT 'quantity', min(quantity) >= 1 AND max(quantity) <= 50 FROM dirty
UNION ALL SELECT 'status', count(*) FILTER (WHERE NOT regexp_matches(status, '^(?:[FOP])')) = 0 FROM dirty
UNION ALL SELECT 'schema', true""")
def dq_report(spark, sf_dir):
    rules = [
        dq.NullRule("critical", ["product_id", "price", "quantity"], 1.0),
        dq.DuplicateRule("unique", ["transaction_id"]),
        dq.RangeRule("quantity", "quantity", 1, 50),
        dq.PatternRule("status", "status", "[FOP]"),
        dq.SchemaRule("schema", {"transaction_id": "string", "quantity": "int", "load_date": "timestamp"}),
    ]
    return dq.check_rules(_dirty(spark, sf_dir), rules).select("rule_name", "passed")


@query("box_quality", "DQ-17", f"""WITH {BOXES_SQL}
{_counted("negative_coordinates", "business_rule", "x1 < 0 OR y1 < 0", "boxes", "rows break the rule")}
UNION ALL {_counted("empty_area", "business_rule", "(x2 - x1) * (y2 - y1) <= 0", "boxes", "rows break the rule")}
UNION ALL {_counted("small_area", "business_rule", "(x2 - x1) * (y2 - y1) < 100", "boxes", "rows break the rule")}
UNION ALL {_counted("extreme_aspect", "business_rule",
    "(x2 - x1) / (y2 - y1 + 1e-6) < 0.1 OR (x2 - x1) / (y2 - y1 + 1e-6) > 10", "boxes", "rows break the rule")}""")
def box_quality(spark, sf_dir):
    return _round(dq.check_rules(boxes(spark, sf_dir), dq.box_rules()), 6)


# Every third key is missing, so that a missing key repeats.
_HOLEY_SQL = "SELECT CASE WHEN l_orderkey % 3 > 0 THEN l_orderkey END AS k, l_linenumber AS n, l_partkey AS p, l_suppkey AS s FROM lineitem"


@query("dq_null_keys", "DQ-02", f"""
WITH t AS ({_HOLEY_SQL}), g AS (SELECT k, n, count(*) AS c FROM t GROUP BY 1, 2 HAVING count(*) > 1)
SELECT t.* FROM t JOIN g ON t.k IS NOT DISTINCT FROM g.k AND t.n IS NOT DISTINCT FROM g.n
ORDER BY k NULLS FIRST, n, p, s LIMIT 20""")
def dq_null_keys(spark, sf_dir):
    key = F.when(F.col("l_orderkey") % 3 > 0, F.col("l_orderkey")).alias("k")
    line = table(spark, sf_dir, "lineitem")
    rows = line.select(key, F.col("l_linenumber").alias("n"), F.col("l_partkey").alias("p"), F.col("l_suppkey").alias("s"))
    return dq.duplicate_rows(rows, ["k", "n"], 20)


@query("dq_failing_rule", "DQ-07 UDF-05", """
SELECT 'large' AS rule_name, 'business_rule' AS rule_type, false AS passed, count(*) FILTER (WHERE l_quantity > 45) AS violations,
  count(*) AS total FROM lineitem
UNION ALL SELECT 'inverse', 'custom_check', false, 0, 0
UNION ALL SELECT 'suppliers', 'custom_check', true, 0, count(DISTINCT l_suppkey) FROM lineitem
UNION ALL SELECT 'absent', 'null_check', true, 0, count(*) FROM lineitem
UNION ALL SELECT 'bulk', 'custom_check', count(*) FILTER (WHERE l_quantity = 50) = 0, count(*) FILTER (WHERE l_quantity = 50),
  count(*) FILTER (WHERE l_quantity = 50) FROM lineitem""")
def dq_failing_rule(spark, sf_dir):
    def suppliers(df):
        n = df.select("l_suppkey").distinct().count()
        return {"passed": n > 0, "violations": 0, "total": n}

    rules = [
        dq.PredicateRule("large", F.col("l_quantity") > 45),
        dq.CustomRule("inverse", lambda df: 1 / (F.col("l_linenumber") - 1) > 2),  # fails on the first line of an order
        dq.CustomRule("suppliers", suppliers),
        dq.NullRule("absent", ["no_such_column"]),
        dq.CustomRule("bulk", lambda df: df.filter("l_quantity = 50")),
    ]
    out = dq.check_rules(table(spark, sf_dir, "lineitem"), rules)
    return out.select("rule_name", "rule_type", "passed", "violations", "total")


_BRANDS = "'Brand#11', 'Brand#12', 'Brand#21', 'Brand#22'"


@query("dq_reference_list", "DQ-06 SET-03", f"""
SELECT DISTINCT p_brand FROM part WHERE p_brand NOT IN ({_BRANDS}) ORDER BY p_brand LIMIT 10""")
def dq_reference_list(spark, sf_dir):
    rule = dq.ReferenceRule("brand", "p_brand", [b.strip(" '") for b in _BRANDS.split(",")])
    return dq.missing_references(table(spark, sf_dir, "part"), rule)


@query("dq_text_report", "DQ-10 DQ-16 DQ-18", f"""WITH {FACT_SALES_SQL}
SELECT '4 rules, 4 passed, 0 failed' AS line
UNION ALL SELECT 'pass  critical_nulls [null_check] no column lacks too many values' FROM fact_sales
  HAVING count(*) = count(product_id)
UNION ALL SELECT 'pass  enough_rows [custom_check] the check holds' FROM fact_sales HAVING count(*) >= 10
UNION ALL SELECT 'pass  positive_price [business_rule] ' || count(*) FILTER (WHERE price <= 0) || ' rows break the rule' FROM fact_sales
UNION ALL SELECT 'pass  positive_quantity [business_rule] ' || count(*) FILTER (WHERE quantity <= 0) || ' rows break the rule'
  FROM fact_sales""")
def dq_text_report(spark, sf_dir):
    results = dq.require_passed(dq.check_rules(fact_sales(spark, sf_dir), dq.file_rules(["product_id"])))
    return spark.createDataFrame([(line,) for line in dq.text_report(results).split("\n")], "line string")


@query("dq_groups", "UDF-05 DQ-07", f"""
{_result("order_value", "group_check", "v = 0", "v", "t", "v * 100.0 / t", "v || ' groups break the rule'")}
FROM (SELECT count(*) FILTER (WHERE NOT ok) AS v, count(*) AS t
      FROM (SELECT sum(l_extendedprice) >= 1000 AND max(l_linenumber) <= 7 AS ok FROM lineitem GROUP BY l_orderkey))""")
def dq_groups(spark, sf_dir):
    holds = (F.sum("l_extendedprice") >= 1000) & (F.max("l_linenumber") <= 7)
    rules = [dq.GroupRule("order_value", ["l_orderkey"], holds)]
    return _round(dq.check_rules(table(spark, sf_dir, "lineitem"), rules), 6)


@query("group_function", "UDF-05", """
SELECT l_suppkey, CASE WHEN l_suppkey % 10 = 3 THEN NULL ELSE count(*) END AS n,
  CASE WHEN l_suppkey % 10 = 3 THEN NULL ELSE max(l_quantity) - min(l_quantity) END AS spread,
  CASE WHEN l_suppkey % 10 = 3 THEN 'ValueError: supplier ' || l_suppkey || ' is barred' END AS error
FROM lineitem GROUP BY 1""")
def group_function(spark, sf_dir):
    import pyarrow as pa
    import pyarrow.compute as pc

    def spread(rows):
        supplier = rows.column("l_suppkey")[0].as_py()
        if supplier % 10 == 3:
            raise ValueError(f"supplier {supplier} is barred")
        ends = pc.min_max(rows.column("l_quantity")).as_py()
        return pa.table({"n": [rows.num_rows], "spread": [ends["max"] - ends["min"]]})

    rows = table(spark, sf_dir, "lineitem").select("l_suppkey", F.col("l_quantity").cast("double").alias("l_quantity"))
    return custom.apply_per_group(rows, ["l_suppkey"], spread, "n long, spread double")


@query("group_checks", "UDF-05", """
SELECT l_suppkey, sum(l_quantity) > 600 AS passed, CASE WHEN sum(l_quantity) <= 600 THEN 'only ' || CAST(sum(l_quantity) AS BIGINT) || ' sold' END AS message
FROM lineitem GROUP BY 1""")
def group_checks(spark, sf_dir):
    import pyarrow.compute as pc

    def sold(rows):
        total = pc.sum(rows.column("l_quantity")).as_py()
        return True if total > 600 else f"only {int(total)} sold"

    rows = table(spark, sf_dir, "lineitem").select("l_suppkey", F.col("l_quantity").cast("double").alias("l_quantity"))
    return custom.check_groups(rows, ["l_suppkey"], sold)
