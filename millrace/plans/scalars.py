"""Scalar functions applied to whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions import health, scalar
from millrace.plans.sales import _round
from millrace.registry import query
from millrace.tables import table


@query("metrics_ratio_pct_diff", "SCL-01 SCL-02 SCL-03 SCL-05", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  round(l_extendedprice / nullif(l_discount, 0), 4) AS price_ratio,
  round(l_tax / nullif(l_discount, 0) * 100, 4) AS tax_pct, round(l_extendedprice - l_quantity, 4) AS diff,
  round(l_extendedprice * (1 - l_discount), 4) AS net
FROM lineitem""")
def metrics_ratio_pct_diff(spark, sf_dir):
    return _round(table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        scalar.ratio("l_extendedprice", "l_discount").alias("price_ratio"),
        scalar.percentage("l_tax", "l_discount").alias("tax_pct"),
        scalar.difference("l_extendedprice", "l_quantity").alias("diff"),
        F.expr("l_extendedprice * (1 - l_discount)").alias("net"),
    ))


@query("safe_divide", "SCL-04", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  CASE WHEN l_discount = 0 THEN -1.0 ELSE round(l_tax / l_discount, 6) END AS share FROM lineitem""")
def safe_divide(spark, sf_dir):
    return _round(table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        scalar.safe_divide("l_tax", "l_discount", -1.0).alias("share"),
    ), 6)


@query("email_and_truncate", "SCL-06 SCL-08", r"""
SELECT doc_id, regexp_matches(e, '^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$') AS valid,
  CASE WHEN length(text) <= 40 THEN text ELSE substr(text, 1, 37) || '...' END AS short
FROM (SELECT doc_id, text, CASE WHEN doc_id % 2 = 0 THEN source || '@' || lang || '.org' ELSE source END AS e FROM documents)""")
def email_and_truncate(spark, sf_dir):
    even = F.col("doc_id") % 2 == 0
    email = F.when(even, F.concat("source", F.lit("@"), "lang", F.lit(".org"))).otherwise(F.col("source"))
    return table(spark, sf_dir, "documents").select(
        "doc_id", scalar.valid_email(email).alias("valid"), scalar.truncate("text", 40).alias("short")
    )


@query("sanitize_names", "SCL-09 SCL-14", r"""
WITH c AS (SELECT page_id, url, regexp_replace(translate(url || '. ', '<>:"/\|?*', '_________'), '^[. ]+|[. ]+$', '', 'g') AS s FROM pages)
SELECT page_id, s AS name, regexp_extract(url, '[^/.][^/]*\.([^./]*)$', 1) AS extension FROM c""")
def sanitize_names(spark, sf_dir):
    return table(spark, sf_dir, "pages").select(
        "page_id",
        scalar.sanitize_name(F.concat("url", F.lit(". "))).alias("name"),
        scalar.file_extension("url").alias("extension"),
    )


@query("human_bytes", "SCL-10", """
SELECT doc_id, CASE WHEN b < 1024 THEN printf('%.2f B', b) WHEN b < 1048576 THEN printf('%.2f KB', b / 1024)
  WHEN b < 1073741824 THEN printf('%.2f MB', b / 1048576) ELSE printf('%.2f GB', b / 1073741824) END AS size
FROM (SELECT doc_id, (n_chars * n_chars)::DOUBLE AS b FROM documents)""")
def human_bytes(spark, sf_dir):
    size = (F.col("n_chars") * F.col("n_chars")).cast("double")
    return table(spark, sf_dir, "documents").select("doc_id", scalar.human_bytes(size).alias("size"))


@query("connection_parts", "SCL-11", """
SELECT s_suppkey, 'postgresql' AS scheme, 'u' || s_suppkey AS user, 'pw' AS password, 'host' || s_nationkey AS host,
  5432 AS port, 'db' || s_nationkey AS database, CAST(s_nationkey AS VARCHAR) AS shard FROM supplier""")
def connection_parts(spark, sf_dir):
    url = F.format_string("postgresql://u%d:pw@host%d:5432/db%d?shard=%d", "s_suppkey", *["s_nationkey"] * 3)
    rows = table(spark, sf_dir, "supplier").select("s_suppkey", scalar.connection_parts(url).alias("p"))
    return rows.select("s_suppkey", "p.scheme", "p.user", "p.password", "p.host", "p.port", "p.database",
                       F.col("p.params")["shard"].alias("shard"))


@query("safe_json", "SCL-12 SCL-13", """
SELECT event_id, CASE WHEN event_id % 4 = 0 THEN -1 ELSE CAST(json_extract(props, '$.k') AS BIGINT) END AS k,
  CASE WHEN event_id % 4 = 0 THEN 0 ELSE 1 END AS n FROM events""")
def safe_json(spark, sf_dir):
    broken = F.when(F.col("event_id") % 4 == 0, F.lit("{not json")).otherwise(F.col("props"))
    default = F.named_struct(F.lit("k"), F.lit(-1).cast("bigint"))
    kind = F.when(F.col("event_id") % 4 != 0, F.col("event_type"))
    return table(spark, sf_dir, "events").select(
        "event_id",
        scalar.safe_json(broken, "struct<k:bigint>", default)["k"].alias("k"),
        F.size(scalar.ensure_list(kind, "string")).alias("n"),
    )


@query("content_hashes", "SCL-15", """
SELECT doc_id, md5(text) AS md5, sha1(text) AS sha1, sha256(text) AS sha256 FROM documents""")
def content_hashes(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        "doc_id", *[scalar.content_hash("text", a).alias(a) for a in ("md5", "sha1", "sha256")]
    )


@query("date_parts", "SCL-16 PRJ-09", """
SELECT event_id, year(ts) AS year, month(ts) AS month, day(ts) AS day, hour(ts) AS hour, quarter(ts) AS quarter,
  isodow(ts) - 1 AS day_of_week, weekofyear(ts) AS week FROM events""")
def date_parts(spark, sf_dir):
    ts = F.col("ts")
    parts = {
        "year": F.year(ts), "month": F.month(ts), "day": F.dayofmonth(ts), "hour": F.hour(ts),
        "quarter": F.quarter(ts), "day_of_week": F.weekday(ts), "week": F.weekofyear(ts),
    }
    return table(spark, sf_dir, "events").select("event_id", *[c.cast("long").alias(n) for n, c in parts.items()])


@query("weather_indices", "SCL-17 SCL-18", """
WITH w AS (SELECT event_id, value / 10 - 5 AS t, value % 100 AS h, value % 40 AS v FROM events)
SELECT event_id, CASE WHEN t < 27 THEN t ELSE round(t + 0.5 * (h + t - 30), 1) END AS heat_index,
  CASE WHEN t > 10 OR v < 4.8 THEN t
    ELSE round(13.12 + 0.6215 * t - 11.37 * v ** 0.16 + 0.3965 * t * v ** 0.16, 1) END AS wind_chill
FROM w""")
def weather_indices(spark, sf_dir):
    w = table(spark, sf_dir, "events").select(
        "event_id", (F.col("value") / 10 - 5).alias("t"), (F.col("value") % 100).alias("h"),
        (F.col("value") % 40).alias("v"),
    )
    return w.select("event_id", scalar.heat_index("t", "h").alias("heat_index"),
                    scalar.wind_chill("t", "v").alias("wind_chill"))


# A patient-like table out of the customers: every field follows from the key.
_PATIENT_SQL = """
p AS (SELECT c_custkey, c_custkey % 90 + 5 AS age, c_custkey % 97 + 85.0::DOUBLE AS sysbp, c_custkey % 61 + 50.0::DOUBLE AS diabp,
  (c_custkey % 290) / 10.0 + 14.0::DOUBLE AS bmi, c_custkey % 180 + 120 AS chol, c_custkey % 90 + 60 AS glucose,
  CASE WHEN c_custkey % 3 = 0 THEN 0 ELSE c_custkey % 45 END AS cigs FROM customer)"""


def _patients(spark, sf_dir):
    k = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        "c_custkey", (k % 90 + 5).alias("age"), (k % 97 + 85.0).alias("sysbp"), (k % 61 + 50.0).alias("diabp"),
        ((k % 290) / 10.0 + 14.0).alias("bmi"), (k % 180 + 120).alias("chol"), (k % 90 + 60).alias("glucose"),
        F.when(k % 3 == 0, F.lit(0)).otherwise(k % 45).alias("cigs"),
    )


@query("bins_cut", "SCL-20 SCL-21", f"""WITH {_PATIENT_SQL}
SELECT c_custkey,
  CASE WHEN age > 0 AND age <= 30 THEN '<30' WHEN age <= 40 THEN '30-40' WHEN age <= 50 THEN '40-50'
    WHEN age <= 60 THEN '50-60' WHEN age <= 70 THEN '60-70' WHEN age <= 100 THEN '70+' END AS age_group,
  CASE WHEN bmi <= 18.5 THEN 'underweight' WHEN bmi <= 25 THEN 'normal' WHEN bmi <= 30 THEN 'overweight'
    WHEN bmi <= 35 THEN 'obese_1' WHEN bmi <= 100 THEN 'obese_2' END AS bmi_category,
  CASE WHEN chol <= 200 THEN 'normal' WHEN chol <= 240 THEN 'borderline' ELSE 'high' END AS chol_risk,
  CASE WHEN age < 45 THEN 'low' WHEN age < 65 THEN 'medium' ELSE 'high' END AS age_risk,
  CASE WHEN bmi < 25 THEN 0 WHEN bmi < 30 THEN 1 WHEN bmi < 35 THEN 2 ELSE 3 END AS bmi_risk
FROM p""")
def bins_cut(spark, sf_dir):
    return _patients(spark, sf_dir).select(
        "c_custkey",
        health.cut("age", health.AGE_BINS, health.AGE_LABELS).alias("age_group"),
        health.cut("bmi", health.BMI_BINS, health.BMI_LABELS).alias("bmi_category"),
        health.cut("chol", health.CHOLESTEROL_BINS, health.CHOLESTEROL_LABELS).alias("chol_risk"),
        health.step("age", *health.AGE_RISK).alias("age_risk"),
        health.step("bmi", *health.BMI_SCORE).alias("bmi_risk"),
    )


@query("pressure_features", "SCL-22 SCL-23", f"""WITH {_PATIENT_SQL}
SELECT c_custkey, sysbp - diabp AS pulse_pressure, round(diabp + (sysbp - diabp) / 3, 6) AS map,
  round(sysbp / (diabp + 1), 6) AS bp_ratio, round(sysbp / diabp, 6) AS plain_ratio,
  round(bmi / ((age / 100) * (age / 100)), 4) AS body,
  CASE WHEN c_custkey % 11 = 0 THEN 'unknown' WHEN sysbp < 120 AND diabp < 80 THEN 'normal'
    WHEN sysbp < 130 AND diabp < 80 THEN 'elevated' WHEN sysbp < 140 OR diabp < 90 THEN 'stage1'
    ELSE 'stage2' END AS stage, cigs + chol + glucose AS factors
FROM p""")
def pressure_features(spark, sf_dir):
    known = F.when(F.col("c_custkey") % 11 != 0, F.col("sysbp"))
    return _round(_patients(spark, sf_dir).select(
        "c_custkey",
        health.pulse_pressure("sysbp", "diabp").alias("pulse_pressure"),
        health.mean_arterial_pressure("sysbp", "diabp").alias("map"),
        health.pressure_ratio("sysbp", "diabp").alias("bp_ratio"),
        health.pressure_ratio("sysbp", "diabp", 0).alias("plain_ratio"),
        F.round(health.bmi("bmi", "age"), 4).alias("body"),
        health.hypertension_stage(known, "diabp").alias("stage"),
        health.risk_factor_count("cigs", "chol", "glucose").alias("factors"),
    ), 6)


@query("risk_scores", "SCL-24 SCL-25 SCL-26 SCL-27", f"""WITH {_PATIENT_SQL}
SELECT c_custkey,
  CASE WHEN cigs <= 0 THEN 'non_smoker' WHEN cigs <= 10 THEN 'light' WHEN cigs <= 20 THEN 'moderate' ELSE 'heavy' END AS smoking_intensity,
  CASE WHEN cigs > 0 THEN 1 ELSE 0 END AS is_smoker,
  CASE WHEN cigs > 0 THEN round(cigs / 20 * greatest(0, age - 18), 6) ELSE 0 END AS pack_years,
  CASE WHEN age < 35 THEN 0 WHEN age < 45 THEN 2 WHEN age < 55 THEN 4 WHEN age < 65 THEN 6 ELSE 8 END
  + CASE WHEN chol < 200 THEN 0 WHEN chol < 240 THEN 1 ELSE 2 END
  + CASE WHEN sysbp < 120 THEN 0 WHEN sysbp < 140 THEN 1 WHEN sysbp < 160 THEN 2 ELSE 3 END AS composite,
  (bmi >= 30)::INT + (glucose >= 100)::INT + (sysbp >= 130)::INT AS metabolic,
  CASE WHEN age / 100 < 0.3 THEN 'Low' WHEN age / 100 < 0.7 THEN 'Medium' ELSE 'High' END AS level,
  least(100, greatest(0, (age - 30) * 2)) AS age_part, least(100, greatest(0, (sysbp - 120) * 2))::DOUBLE AS pressure_part
FROM p""")
def risk_scores(spark, sf_dir):
    parts = health.risk_contributions("age", "sysbp", F.lit(1), F.lit(0), F.lit(2), F.lit(1))
    smoking = health.smoking_features("cigs", "age")
    return _round(_patients(spark, sf_dir).select(
        "c_custkey",
        *[c.alias(n) for n, c in smoking.items()],
        health.composite_risk_score("age", "chol", "sysbp").alias("composite"),
        health.metabolic_score("bmi", "glucose", "sysbp").alias("metabolic"),
        health.risk_level(F.col("age") / 100).alias("level"),
        parts["age_part"].alias("age_part"), parts["pressure_part"].alias("pressure_part"),
    ), 6)


@query("risk_level_table", "AGG-22", f"""WITH {_PATIENT_SQL},
r AS (SELECT CASE WHEN age > 0 AND age <= 40 THEN 'young' WHEN age <= 55 THEN 'middle_aged' WHEN age <= 70 THEN 'senior'
  WHEN age <= 100 THEN 'elderly' END AS age_group,
  CASE WHEN glucose / 200 < 0.3 THEN 'Low' WHEN glucose / 200 < 0.7 THEN 'Medium' ELSE 'High' END AS level FROM p)
SELECT age_group, count(*) FILTER (WHERE level = 'High') AS High, count(*) FILTER (WHERE level = 'Low') AS Low,
  count(*) FILTER (WHERE level = 'Medium') AS Medium FROM r GROUP BY 1""")
def risk_level_table(spark, sf_dir):
    from millrace.operators.aggregate import pivot_aggregation

    rows = _patients(spark, sf_dir).select(
        health.cut("age", health.AGE_GROUP_BINS, health.AGE_GROUP_LABELS).alias("age_group"),
        health.risk_level(F.col("glucose") / 200).alias("level"), F.lit(1).alias("one"),
    )
    return pivot_aggregation(rows, "age_group", "level", "one", "count", pivot_values=["High", "Low", "Medium"])


@query("zscore_features", "SCL-19", f"""WITH {_PATIENT_SQL}
SELECT c_custkey, round((age - avg(age) OVER ()) / stddev(age) OVER (), 6) AS age_normalized, age * age AS age_squared,
  round(ln(1 + chol), 6) AS chol_log, age * cigs AS age_smoker, round(chol * age / 100, 6) AS chol_age FROM p""")
def zscore_features(spark, sf_dir):
    from millrace.operators.features import zscore

    rows = zscore(_patients(spark, sf_dir), ["age"], population=False, suffix="_normalized")
    return _round(rows.select(
        "c_custkey", "age_normalized", (F.col("age") * F.col("age")).alias("age_squared"),
        F.log1p("chol").alias("chol_log"), (F.col("age") * F.col("cigs")).alias("age_smoker"),
        (F.col("chol") * F.col("age") / 100).alias("chol_age"),
    ), 6)


@query("polynomial_terms", "SCL-28", f"""WITH {_PATIENT_SQL}
SELECT c_custkey, age * age AS "poly_age^2", age * chol AS "poly_age chol", age * glucose AS "poly_age glucose",
  chol * chol AS "poly_chol^2", chol * glucose AS "poly_chol glucose", glucose * glucose AS "poly_glucose^2" FROM p""")
def polynomial_terms(spark, sf_dir):
    terms = health.polynomial_terms(["age", "chol", "glucose"])
    return _patients(spark, sf_dir).select("c_custkey", *[c.alias(n) for n, c in terms.items()])
