"""Cleaning, enrichment and reshaping of rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions import scalar
from millrace.operators import clean, joins
from millrace.plans.sales import _round
from millrace.registry import query
from millrace.tables import FACT_SALES_SQL, fact_sales, table

_KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
_KEYS_SQL = ", ".join(_KEYS)
_HOLES_SQL = f"""(SELECT {_KEYS_SQL},
  CASE WHEN l_linenumber = 7 THEN NULL ELSE l_quantity END AS l_quantity,
  CASE WHEN l_partkey % 5 = 0 THEN NULL ELSE l_extendedprice END AS l_extendedprice FROM lineitem)"""


def _holes(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        *_KEYS,
        F.when(F.col("l_linenumber") != 7, F.col("l_quantity")).alias("l_quantity"),
        F.when(F.col("l_partkey") % 5 != 0, F.col("l_extendedprice")).alias("l_extendedprice"),
    )


@query("configured_rules", "PRJ-01 PRJ-02 PRJ-03", f"""WITH {FACT_SALES_SQL}
SELECT l_orderkey, l_linenumber, product_id, l_suppkey, strftime(transaction_date, '%Y-%m-%d') AS transaction_date,
  round(quantity * price, 2) AS total_amount
FROM fact_sales WHERE l_linenumber <> 7""")
def configured_rules(spark, sf_dir):
    rows = fact_sales(spark, sf_dir).withColumn("product_key", F.when(F.col("l_linenumber") != 7, F.col("product_id")))
    rows = rows.withColumn("transaction_date", F.col("transaction_date").cast("string"))
    rules = [
        {"type": "remove_nulls", "columns": ["product_key", "quantity", "price"]},
        {"type": "date_format", "columns": ["transaction_date"], "format": "yyyy-MM-dd"},
        {"type": "derived_column", "expression": "round(quantity * price, 2)", "output_column": "total_amount"},
    ]
    return clean.apply_rules(rows, rules).select(
        "l_orderkey", "l_linenumber", "product_id", "l_suppkey", "transaction_date", "total_amount"
    )


@query("complete_distinct_rows", "PRJ-04 SET-02", f"""
SELECT DISTINCT l_orderkey, l_quantity, CAST(l_shipdate::DATE AS VARCHAR) AS ship_date, year(l_shipdate) AS year,
  month(l_shipdate) AS month, day(l_shipdate) AS day
FROM lineitem WHERE l_linenumber <> 7""")
def complete_distinct_rows(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        F.when(F.col("l_linenumber") != 7, F.col("l_quantity")).alias("l_quantity"),
        F.to_date("l_shipdate").alias("ship_date"),
    )
    out = clean.complete_distinct_rows(rows, "ship_date").withColumn("ship_date", F.col("ship_date").cast("string"))
    return out.withColumns({c: F.col(c).cast("long") for c in ("year", "month", "day")})


@query("keep_first_copy", "SET-02", """
SELECT doc_id, source FROM documents QUALIFY row_number() OVER (PARTITION BY text ORDER BY doc_id) = 1""")
def keep_first_copy(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", F.sha2("text", 256).alias("digest"))
    return clean.drop_duplicates(docs, ["digest"], [F.col("doc_id")]).drop("digest")


@query("impute_mean", "PRJ-05", f"""
SELECT {_KEYS_SQL}, round(coalesce(l_quantity, (SELECT avg(l_quantity) FROM {_HOLES_SQL})), 4) AS l_quantity,
  round(coalesce(l_extendedprice, (SELECT avg(l_extendedprice) FROM {_HOLES_SQL})), 4) AS l_extendedprice
FROM {_HOLES_SQL}""")
def impute_mean(spark, sf_dir):
    out = clean.impute(_holes(spark, sf_dir), ["l_quantity", "l_extendedprice"], "mean")
    return _round(out)


@query("impute_median", "PRJ-05", f"""
SELECT {_KEYS_SQL}, coalesce(l_quantity, (SELECT median(l_quantity) FROM {_HOLES_SQL})) AS l_quantity,
  round(coalesce(l_extendedprice, (SELECT median(l_extendedprice) FROM {_HOLES_SQL})), 4) AS l_extendedprice
FROM {_HOLES_SQL}""")
def impute_median(spark, sf_dir):
    return _round(clean.impute(_holes(spark, sf_dir), ["l_quantity", "l_extendedprice"], "median"))


@query("clean_rows", "PRJ-06", """
WITH d AS (SELECT DISTINCT lower(trim(p_type)) AS p_type, lower(trim(p_brand)) AS p_brand,
  CASE WHEN p_size % 4 = 0 THEN NULL ELSE p_size END AS p_size FROM part)
SELECT p_type, p_brand, round(coalesce(p_size, (SELECT avg(p_size) FROM d)), 6) AS p_size FROM d""")
def clean_rows(spark, sf_dir):
    rows = table(spark, sf_dir, "part").select(
        F.concat(F.lit("  "), "p_type", F.lit(" ")).alias("p_type"), F.upper("p_brand").alias("p_brand"),
        F.when(F.col("p_size") % 4 != 0, F.col("p_size")).alias("p_size"),
    )
    return _round(clean.clean_data(rows, ["p_size"], ["p_type", "p_brand"]), 6)


_FENCE = """(SELECT q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM
  (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3 FROM {t}))"""
_NUM = "(SELECT conv_id, turn, length(text)::DOUBLE AS len, turn::DOUBLE AS t FROM conversations)"


def _conversation_numbers(spark, sf_dir):
    return table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", F.length("text").cast("double").alias("len"), F.col("turn").cast("double").alias("t")
    )


@query("iqr_filter", "PRJ-14", f"""
SELECT conv_id, turn, len, t FROM {_NUM}, {_FENCE.format(c='len', t=_NUM)} a, {_FENCE.format(c='t', t=_NUM)} b
WHERE len BETWEEN a.lo AND a.hi AND t BETWEEN b.lo AND b.hi""")
def iqr_filter(spark, sf_dir):
    return clean.iqr_filter(_conversation_numbers(spark, sf_dir), ["len", "t"])


@query("iqr_filter_sequential", "PRJ-14", f"""
WITH s AS (SELECT conv_id, turn, len, t FROM {_NUM}, {_FENCE.format(c='len', t=_NUM)} a WHERE len BETWEEN a.lo AND a.hi)
SELECT conv_id, turn, len, t FROM s, {_FENCE.format(c='t', t='s')} b WHERE t BETWEEN b.lo AND b.hi""")
def iqr_filter_sequential(spark, sf_dir):
    return clean.iqr_filter(_conversation_numbers(spark, sf_dir), ["len", "t"], sequential=True)


@query("iqr_clip", "PRJ-15", f"""
SELECT doc_id, greatest(least(n_chars::DOUBLE, hi), lo) AS n_chars FROM documents,
{_FENCE.format(c='n_chars::DOUBLE', t='documents')}""")
def iqr_clip(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", F.col("n_chars").cast("double"))
    return clean.iqr_clip(docs, ["n_chars"])


@query("iqr_flag", "PRJ-15", f"""
SELECT doc_id, n_chars::DOUBLE AS n_chars, n_chars < lo OR n_chars > hi AS n_chars_outlier FROM documents,
{_FENCE.format(c='n_chars::DOUBLE', t='documents')}""")
def iqr_flag(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", F.col("n_chars").cast("double"))
    return clean.iqr_clip(docs, ["n_chars"], flag=True)


@query("missing_fields", "PRJ-17 PRJ-18", f"""
SELECT {_KEYS_SQL}, concat_ws(',', CASE WHEN l_quantity IS NULL THEN 'l_quantity' END,
  CASE WHEN l_extendedprice IS NULL THEN 'l_extendedprice' END) AS missing, 0 AS l_tax
FROM {_HOLES_SQL}""")
def missing_fields(spark, sf_dir):
    rows = _holes(spark, sf_dir).withColumn(
        "missing", F.array_join(clean.missing_fields(["l_quantity", "l_extendedprice"]), ",")
    )
    return clean.align_columns(rows, [*_KEYS, "missing", "l_tax"])


@query("email_text_valid", "PRJ-13", """
SELECT doc_id, length(trim(text)) >= 10 AND length(text) <= 50000 AS valid FROM documents""")
def email_text_valid(spark, sf_dir):
    from millrace.functions.text import valid_email_text

    return table(spark, sf_dir, "documents").select("doc_id", valid_email_text("text").alias("valid"))


@query("hash_sample", "PRJ-20", """
SELECT event_id, user_id FROM events
WHERE ('0x' || substr(md5(CAST(event_id AS VARCHAR)), 1, 8))::BIGINT % 100 < 10""")
def hash_sample(spark, sf_dir):
    return clean.hash_sample(table(spark, sf_dir, "events").select("event_id", "user_id"), "event_id", 10)


@query("every_nth_frame", "PRJ-20", "SELECT event_id, value FROM events WHERE event_id % 5 = 0")
def every_nth_frame(spark, sf_dir):
    return clean.every_nth(table(spark, sf_dir, "events").select("event_id", "value"), "event_id", 5)


@query("flatten_json", "PRJ-21 SCL-12", """
SELECT event_id, event_type AS detail_kind, CAST(json_extract(props, '$.k') AS BIGINT) AS detail_props_k,
  CAST(user_id AS DOUBLE) AS tags_0, value AS tags_1 FROM events""")
def flatten_json(spark, sf_dir):
    nested = table(spark, sf_dir, "events").select(
        "event_id",
        F.struct(
            F.col("event_type").alias("kind"), scalar.safe_json("props", "struct<k:bigint>").alias("props")
        ).alias("detail"),
        F.array(F.col("user_id").cast("double"), F.col("value")).alias("tags"),
    )
    return clean.flatten(nested)


@query("flatten_lists", "PRJ-21", """
WITH o AS (SELECT l_orderkey, list(struct_pack(part := l_partkey, n := l_linenumber)
  ORDER BY l_linenumber, l_partkey, l_suppkey) AS lines FROM lineitem GROUP BY 1),
i AS (SELECT l_orderkey, unnest(range(len(lines))) AS i, unnest(lines) AS line FROM o)
SELECT l_orderkey, 'lines_' || i || '_part' AS path, CAST(line.part AS VARCHAR) AS value FROM i
UNION ALL SELECT l_orderkey, 'lines_' || i || '_n', CAST(line.n AS VARCHAR) FROM i
UNION ALL SELECT l_orderkey, 'count', CAST(len(lines) AS VARCHAR) FROM o""")
def flatten_lists(spark, sf_dir):
    line = F.struct("l_linenumber", "l_partkey", "l_suppkey")
    orders = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(line)).alias("all"))
    nested = orders.select(
        "l_orderkey", F.size("all").alias("count"),
        F.transform("all", lambda x: F.struct(x["l_partkey"].alias("part"), x["l_linenumber"].alias("n"))).alias("lines"),
    )
    return clean.flatten_long(nested, ["l_orderkey"])


@query("deep_merge", "PRJ-22", """
SELECT c_custkey, CASE WHEN c_custkey % 7 > 0 THEN c_name END AS name,
  CASE WHEN c_custkey % 3 = 0 THEN 0.0 ELSE c_acctbal END AS balance,
  CASE WHEN c_custkey % 3 = 0 THEN 'NEW' ELSE c_mktsegment END AS segment
FROM customer WHERE c_custkey % 7 > 0 OR c_custkey % 3 = 0""")
def deep_merge(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    # Some customers are only on the other side.
    base = c.filter(F.col("c_custkey") % 7 > 0).select("c_custkey", F.struct(
        F.col("c_name").alias("name"),
        F.struct(F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment")).alias("account"),
    ).alias("info"))
    change = c.filter(F.col("c_custkey") % 3 == 0).select("c_custkey", F.struct(
        F.struct(F.lit(0.0).alias("balance"), F.lit("NEW").alias("segment")).alias("account")
    ).alias("info"))
    merged = clean.deep_merge(base, change, ["c_custkey"])
    return merged.select("c_custkey", "info.name", "info.account.balance", "info.account.segment")


@query("transaction_money", "PRJ-11", f"""WITH {FACT_SALES_SQL}
SELECT l_orderkey, l_linenumber, product_id, l_suppkey, round(price * quantity, 2) AS total_amount,
  round(price * quantity * 0.08, 2) AS tax, round(round(price * quantity, 2) + round(price * quantity * 0.08, 2), 2) AS final_amount
FROM fact_sales""")
def transaction_money(spark, sf_dir):
    rows = fact_sales(spark, sf_dir)
    keys = ["l_orderkey", "l_linenumber", "product_id", "l_suppkey"]
    return rows.select(*keys, *[c.alias(n) for n, c in scalar.transaction_amounts("quantity", "price", F.lit(0.0)).items()])


@query("join_chain", "JN-01", """
SELECT o_orderkey, c_name, n_name FROM orders JOIN customer ON o_custkey = c_custkey
LEFT JOIN nation ON c_nationkey = n_nationkey AND c_acctbal > 0 WHERE o_totalprice > 1000""")
def join_chain(spark, sf_dir):
    return joins.join_chain(
        table(spark, sf_dir, "orders"),
        [
            joins.Join(table(spark, sf_dir, "customer"), "o_custkey = c_custkey"),
            joins.Join(table(spark, sf_dir, "nation"), "c_nationkey = n_nationkey AND c_acctbal > 0", "left"),
        ],
        ["o_orderkey", "c_name", "n_name"],
        "o_totalprice > 1000",
    )


@query("name_lookup", "JN-05", """
SELECT s_suppkey, s_nationkey, coalesce(n_name, 'class_' || s_nationkey) AS n_name FROM supplier
LEFT JOIN (SELECT * FROM nation WHERE n_regionkey <> 2) ON s_nationkey = n_nationkey""")
def name_lookup(spark, sf_dir):
    names = table(spark, sf_dir, "nation").filter("n_regionkey <> 2").withColumnRenamed("n_nationkey", "s_nationkey")
    rows = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    return joins.lookup_name(rows, names, "s_nationkey", "n_name")


@query("union_columns", "SET-01 SRC-07", """
SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment FROM customer
UNION ALL SELECT s_suppkey, s_name, NULL FROM supplier""")
def union_columns(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment")
    )
    s = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))
    return c.unionByName(s, allowMissingColumns=True)
