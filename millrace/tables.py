"""Access to the input tables and the views the queries derive from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Hand the rows of a scan with fewer splits than cores to all cores.

    For heavy work per row on a few large files; a scan with enough splits, as
    on large tables, is left as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "documents"))


def fact_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales fact table at line level with its customer region.

    Catalyst prunes the columns a caller does not use; the dimension joins are
    broadcast only when the table statistics show they are small enough.
    """
    line = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders")
    customer = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    return (
        line.join(orders, line.l_orderkey == orders.o_orderkey)
        .join(customer, orders.o_custkey == customer.c_custkey)
        .join(nation, customer.c_nationkey == nation.n_nationkey)
        .join(region, nation.n_regionkey == region.r_regionkey)
        .select(
            F.concat_ws("-", "l_orderkey", "l_linenumber").alias("transaction_id"),
            "l_orderkey",
            "l_linenumber",
            "l_suppkey",
            F.col("l_partkey").alias("product_id"),
            F.col("o_custkey").alias("customer_id"),
            F.col("l_quantity").alias("quantity"),
            (F.floor(F.col("l_extendedprice") / F.col("l_quantity") * 100 + 0.5) / 100).alias("price"),
            F.col("l_extendedprice").alias("total_amount"),
            F.col("r_name").alias("region"),
            F.col("n_name").alias("country"),
            F.col("o_orderpriority").alias("payment_method"),
            F.col("o_orderstatus").alias("status"),
            F.to_date("o_orderdate").alias("transaction_date"),
            F.to_date("l_shipdate").alias("load_date"),
        )
    )


# The same view for the SQL side.
FACT_SALES_SQL = """
fact_sales AS (
  SELECT concat_ws('-', l_orderkey, l_linenumber) AS transaction_id,
         l_orderkey, l_linenumber, l_suppkey,
         l_partkey AS product_id, o_custkey AS customer_id,
         l_quantity AS quantity,
         floor(l_extendedprice / l_quantity * 100 + 0.5) / 100 AS price,
         l_extendedprice AS total_amount, r_name AS region, n_name AS country,
         o_orderpriority AS payment_method, o_orderstatus AS status,
         CAST(o_orderdate AS DATE) AS transaction_date,
         CAST(l_shipdate AS DATE) AS load_date
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey)
"""


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event rows with ``ts`` as an instant (the files store zone-less times)."""
    return table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))


def boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bounding boxes derived from line items; odd line numbers are the targets."""
    line = table(spark, sf_dir, "lineitem")
    x1 = (F.col("l_partkey") * 7 % 500).cast("double")
    y1 = (F.col("l_partkey") * 13 % 500).cast("double")
    return line.select(
        F.col("l_orderkey").alias("image_id"),
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("box_id"),
        (F.col("l_suppkey") % 20).alias("class_id"),
        x1.alias("x1"),
        y1.alias("y1"),
        (x1 + 10 + F.col("l_quantity") * 4).alias("x2"),
        (y1 + 10 + F.col("l_partkey") % 90).alias("y2"),
        F.round(F.col("l_discount") * 10, 1).alias("score"),
        (F.col("l_linenumber") % 2 == 1).alias("is_target"),
    )


BOXES_SQL = """
boxes AS (
  SELECT l_orderkey AS image_id,
         concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS box_id,
         l_suppkey % 20 AS class_id,
         CAST(l_partkey * 7 % 500 AS DOUBLE) AS x1,
         CAST(l_partkey * 13 % 500 AS DOUBLE) AS y1,
         CAST(l_partkey * 7 % 500 AS DOUBLE) + 10 + l_quantity * 4 AS x2,
         CAST(l_partkey * 13 % 500 AS DOUBLE) + 10 + l_partkey % 90 AS y2,
         round(l_discount * 10, 1) AS score,
         l_linenumber % 2 = 1 AS is_target
  FROM lineitem)
"""
