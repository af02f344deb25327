"""Round trips through the writers and readers, and table reads."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from millrace.functions import boxes as bx
from millrace.operators import aggregate as agg
from millrace.operators.ordered import chunk_rows
from millrace.plans.sales import _round
from millrace.registry import query
from millrace.session import new_path
from millrace.sources import readers, tables, writers
from millrace.tables import BOXES_SQL, FACT_SALES_SQL, boxes, fact_sales, table

_PART_SQL = "SELECT p_partkey, p_name, p_brand, p_size, p_retailprice FROM part"
_PART = ["p_partkey", "p_name", "p_brand", "p_size", "p_retailprice"]
_PART_SCHEMA = "p_partkey bigint, p_name string, p_brand string, p_size int, p_retailprice double"


def _part(spark, sf_dir):
    return table(spark, sf_dir, "part").select(*_PART)


@query("roundtrip_csv", "SRC-01 SNK-01", _PART_SQL)
def roundtrip_csv(spark, sf_dir):
    path = new_path(spark, "csv")
    writers.write(_part(spark, sf_dir), path, "csv")
    return readers.read(spark, path, "csv", schema=_PART_SCHEMA)


@query("roundtrip_json", "SRC-02 SNK-02 SRC-12", "SELECT * FROM (" + _PART_SQL + ") WHERE p_size > 10")
def roundtrip_json(spark, sf_dir):
    path = new_path(spark, "json")
    writers.write(_part(spark, sf_dir), path, "json")
    docs = readers.read(spark, path, "json", schema=_PART_SCHEMA, multi_line=False)
    return tables.find_documents(docs, "p_size > 10", _PART)


@query("roundtrip_parquet", "SRC-03 SRC-06 SNK-03 SNK-06 SNK-11 SNK-18", """
SELECT *, 'batch_1' AS batch_id FROM (""" + _PART_SQL + ")")
def roundtrip_parquet(spark, sf_dir):
    path = new_path(spark, "part") + ".parquet"
    writers.write(writers.stamp(_part(spark, sf_dir), "batch_1"), path)
    return readers.read(spark, path)


@query("roundtrip_yaml", "SRC-05", "SELECT s_suppkey, s_name, s_acctbal FROM supplier")
def roundtrip_yaml(spark, sf_dir):
    path = new_path(spark, "yaml")
    line = F.format_string("- {s_suppkey: %d, s_name: '%s', s_acctbal: %s}", "s_suppkey", "s_name", F.col("s_acctbal").cast("string"))
    table(spark, sf_dir, "supplier").select(line).write.option("maxRecordsPerFile", 10_000).text(path)
    return readers.read(spark, path, "yaml", schema="s_suppkey bigint, s_name string, s_acctbal double")


@query("roundtrip_partitioned", "SNK-07 SRC-11", """
SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders WHERE o_orderstatus = 'F'""")
def roundtrip_partitioned(spark, sf_dir):
    path = new_path(spark, "orders")
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    writers.write_partitioned(rows, path, ["o_orderstatus"])
    return tables.read_partition(spark.read.parquet(path), "o_orderstatus", "F")


@query("roundtrip_append", "SNK-08 SRC-07", _PART_SQL + " UNION ALL " + _PART_SQL)
def roundtrip_append(spark, sf_dir):
    path = new_path(spark, "append")
    for _ in range(2):
        writers.write_incremental(_part(spark, sf_dir), path, "append", "csv")
    return readers.read_many(spark, [path], "csv", schema=_PART_SCHEMA)


@query("roundtrip_copy_files", "SNK-10", "SELECT s_suppkey, s_name, CASE WHEN s_nationkey > 12 THEN s_acctbal END AS s_acctbal FROM supplier")
def roundtrip_copy_files(spark, sf_dir):
    path = new_path(spark, "copy")
    rows = table(spark, sf_dir, "supplier").select(
        "s_suppkey", "s_name", F.when(F.col("s_nationkey") > 12, F.col("s_acctbal")).alias("s_acctbal")
    )
    writers.write_copy_files(rows, path)
    return spark.read.options(sep="\t", header=False).schema("s_suppkey bigint, s_name string, s_acctbal double").csv(path)


@query("incremental_read", "SRC-10", "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderdate > TIMESTAMP '1999-06-30 00:00:00'")
def incremental_read(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return tables.read_incremental(orders, "o_orderdate", datetime.datetime(1999, 6, 30)).select("o_orderkey", "o_custkey")


@query("catalog_scan", "SRC-08 SNK-15", """
SELECT s_nationkey, count(*) AS suppliers, round(sum(s_acctbal), 2) AS balance FROM supplier GROUP BY 1""")
def catalog_scan(spark, sf_dir):
    supplier = table(spark, sf_dir, "supplier")
    summary = supplier.groupBy("s_nationkey").agg(
        F.count("*").alias("suppliers"), F.round(F.sum("s_acctbal"), 2).alias("balance"), F.max("s_suppkey").alias("newest")
    )
    # An outdated result, then the refreshed one under the same name.
    for rows in (summary.limit(0), summary):
        writers.refresh_table(rows, "millrace_supplier_summary", new_path(spark, "summary"))
    return tables.scan_table(spark, "millrace_supplier_summary", columns=["s_nationkey", "suppliers", "balance"])


@query("parameter_query", "SRC-09", """
SELECT c_mktsegment, count(*) AS n FROM customer WHERE c_acctbal > 1000 GROUP BY 1""")
def parameter_query(spark, sf_dir):
    return tables.run_query(
        spark, "SELECT c_mktsegment, count(*) AS n FROM {customer} WHERE c_acctbal > :low GROUP BY c_mktsegment",
        {"low": 1000}, customer=table(spark, sf_dir, "customer"),
    )


@query("table_info", "SRC-13", """
SELECT unnest(['n_nationkey', 'n_name', 'n_regionkey']) AS column_name, unnest(['int', 'string', 'int']) AS data_type,
  (SELECT count(*) FROM nation) AS row_count""")
def table_info(spark, sf_dir):
    return tables.table_info(table(spark, sf_dir, "nation")).select("column_name", "data_type", "row_count")


@query("summary_upsert", "AGG-04 SNK-12", f"""WITH {FACT_SALES_SQL}
SELECT CAST(transaction_date AS VARCHAR) AS date, region, count(*) AS transaction_count, sum(quantity) AS total_quantity,
  round(sum(total_amount), 2) AS total_revenue,
  CASE WHEN day(transaction_date) <> 13 THEN strftime(transaction_date, '%Y-%m') END AS month
FROM fact_sales GROUP BY 1, 2, transaction_date""")
def summary_upsert(spark, sf_dir):
    path = new_path(spark, "summary")
    sales = fact_sales(spark, sf_dir)
    # One day of each month is in the partition of NULL.
    month = F.when(F.dayofmonth("date") != 13, F.date_format("date", "yyyy-MM"))
    rows = sales.groupBy(F.col("transaction_date").alias("date"), "region").agg(
        F.count("*").alias("transaction_count"), F.sum("quantity").alias("total_quantity"),
        F.round(F.sum("total_amount"), 2).alias("total_revenue"),
    ).withColumn("month", month)
    # A first load with wrong numbers, and some of them in a partition of their own, from 2001 on; then the corrected days.
    stale = F.col("date") >= "2001-01-01"
    first = rows.withColumns({
        "total_revenue": F.when(stale, F.lit(0.0)).otherwise(F.col("total_revenue")),
        "month": F.when(stale & (F.dayofmonth("date") == 5), F.lit("unsorted")).otherwise(F.col("month")),
    })
    writers.upsert(spark, path, first.filter(F.col("date") < "2001-07-15"), ["date", "region"], ["month"])
    writers.upsert(spark, path, rows.filter(stale), ["date", "region"], ["month"])
    schema = "date date, region string, transaction_count bigint, total_quantity double, total_revenue double, month string"
    return spark.read.schema(schema).parquet(path).withColumn("date", F.col("date").cast("string"))


@query("yesterday_summary", "AGG-04", f"""WITH {FACT_SALES_SQL}
SELECT CAST(transaction_date AS VARCHAR) AS date, region, count(*) AS transaction_count, sum(quantity) AS total_quantity,
  round(sum(total_amount), 2) AS total_revenue, round(avg(total_amount), 6) AS avg_transaction_value
FROM fact_sales WHERE transaction_date = DATE '1998-03-14' GROUP BY 1, 2""")
def yesterday_summary(spark, sf_dir):
    out = agg.daily_summary(fact_sales(spark, sf_dir), F.lit("1998-03-15").cast("date"), F.current_timestamp())
    out = out.withColumns({"date": F.col("date").cast("string"), "total_revenue": F.round("total_revenue", 2)})
    return _round(out.drop("created_at"), 6)


@query("retention", "SNK-14", """
SELECT * FROM (SELECT CASE WHEN o_orderkey % 50 > 0 THEN o_orderkey // 1000 END AS part, count(*) AS n FROM orders GROUP BY 1)
WHERE part >= 5 OR part IS NULL""")
def retention(spark, sf_dir):
    path = new_path(spark, "retention")
    # Numbers without padding, and a partition of NULL.
    part = F.when(F.col("o_orderkey") % 50 > 0, F.floor(F.col("o_orderkey") / 1000))
    rows = table(spark, sf_dir, "orders").select("o_orderkey", part.alias("part"))
    writers.write_partitioned(rows, path, ["part"])
    writers.drop_old_partitions(spark, path, "part", 5)
    kept = spark.read.schema("o_orderkey bigint, part bigint").parquet(path)
    return kept.groupBy("part").agg(F.count("*").alias("n"))


@query("topic_records", "SNK-13 SRC-14", "SELECT CAST(user_id AS VARCHAR) AS key, event_id, event_type, value FROM events")
def topic_records(spark, sf_dir):
    records = writers.topic_records(table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value"), "user_id")
    body = F.from_json("value", "event_id bigint, event_type string, value double")
    return records.select("key", body.alias("b")).select("key", "b.*")


@query("paged_records", "SRC-15", "SELECT event_id, value FROM events")
def paged_records(spark, sf_dir):
    rows = chunk_rows(table(spark, sf_dir, "events").select("event_id", "value"), ["event_id"], 100)
    pages = rows.groupBy((F.col("chunk") + 1).alias("page")).agg(F.collect_list(F.struct("event_id", "value")).alias("results"))
    total = table(spark, sf_dir, "events").agg(F.ceil(F.count("*") / 100)).scalar()
    path = new_path(spark, "pages")
    writers.write_json(pages.withColumn("total_pages", total), path)
    schema = "page bigint, total_pages bigint, results array<struct<event_id: bigint, value: double>>"
    return readers.paged_records(spark.read.schema(schema).json(path))


@query("ohlcv_series", "SRC-16", """
SELECT o_orderpriority AS symbol, CAST(o_orderdate::DATE AS VARCHAR) AS date, min(o_totalprice) AS low, max(o_totalprice) AS high,
  count(*)::DOUBLE AS volume FROM orders GROUP BY 1, 2""")
def ohlcv_series(spark, sf_dir):
    daily = table(spark, sf_dir, "orders").groupBy(
        F.col("o_orderpriority").alias("symbol"), F.to_date("o_orderdate").alias("d")
    ).agg(F.min("o_totalprice").alias("low"), F.max("o_totalprice").alias("high"), F.count("*").alias("volume"))
    # One document per symbol and month: at most 31 days each.
    entry = F.struct(F.col("d").cast("string"), F.struct("low", "high", "volume"))
    docs = daily.groupBy("symbol", F.date_trunc("month", "d")).agg(
        F.to_json(F.map_from_entries(F.collect_list(entry))).alias("payload")
    )
    out = readers.ohlcv_series(docs, "payload", ["symbol"], ["low", "high", "volume"])
    return out.withColumn("date", F.col("date").cast("string"))


@query("coco_boxes", "SRC-17 JN-04", f"""WITH {BOXES_SQL}
SELECT o_orderkey AS image_id, count(box_id) AS n, round(coalesce(sum(x2), 0), 2) AS sum_x2, max(class_id)::DOUBLE AS top_class
FROM orders LEFT JOIN boxes ON o_orderkey = image_id AND image_id % 10 > 0 GROUP BY 1""")
def coco_boxes(spark, sf_dir):
    images = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"))
    # Some images lose their boxes, so that images without any are there.
    found = boxes(spark, sf_dir).filter("image_id % 10 > 0").select(
        "image_id", "box_id", F.col("class_id").cast("int").alias("category_id"), F.array(*bx.to_xywh(bx.corners())).alias("bbox")
    )
    path = new_path(spark, "coco")
    image = F.struct("id", F.concat("id", F.lit(".jpg")).alias("file_name"), F.lit(800).alias("width"), F.lit(600).alias("height"))
    writers.write_json(
        chunk_rows(images, ["id"], 1000).groupBy("chunk").agg(F.collect_list(image).alias("images")).drop("chunk"), path
    )
    box = F.struct("image_id", "category_id", "bbox")
    writers.write_json(
        chunk_rows(found, ["box_id"], 1000).groupBy("chunk").agg(F.collect_list(box).alias("annotations")).drop("chunk"), path, "append"
    )
    rows = readers.read_coco(spark, path, multi_line=False)
    return rows.groupBy("image_id").agg(
        F.count("x1").alias("n"), F.round(F.coalesce(F.sum("x2"), F.lit(0.0)), 2).alias("sum_x2"),
        F.max("class_id").cast("double").alias("top_class"),
    )


_XY_SQL = "round(x1, 3) AS x1, round(y1, 3) AS y1, round(x2, 3) AS x2, round(y2, 3) AS y2"


@query("yolo_boxes", "SRC-18 BOX-06", f"WITH {BOXES_SQL} SELECT image_id, box_id, class_id::INT AS class_id, {_XY_SQL} FROM boxes")
def yolo_boxes(spark, sf_dir):
    b = bx.normalise(bx.to_center(bx.corners()), F.lit(800.0), F.lit(600.0))
    line = F.concat_ws(" ", F.col("class_id").cast("string"), *[c.cast("string") for c in b])
    lines = boxes(spark, sf_dir).select(F.col("image_id").alias("image"), "box_id", line.alias("value"))
    sizes = lines.select("image").distinct().withColumns({"width": F.lit(800.0), "height": F.lit(600.0)})
    return _round(readers.yolo_boxes(lines, sizes).withColumnRenamed("image", "image_id"), 3)


@query("voc_boxes", "SRC-19 BOX-06", f"WITH {BOXES_SQL} SELECT box_id, class_id, {_XY_SQL} FROM boxes WHERE class_id < 10")
def voc_boxes(spark, sf_dir):
    xml = F.format_string(
        "<object><name>class_%d</name><bndbox><xmin>%s</xmin><ymin>%s</ymin><xmax>%s</xmax><ymax>%s</ymax></bndbox></object>",
        "class_id", "x1", "y1", "x2", "y2",
    )
    rows = boxes(spark, sf_dir)
    classes = rows.filter("class_id < 10").select("class_id").distinct().withColumn("class_name", F.concat(F.lit("class_"), "class_id"))
    objects = rows.select("box_id", F.from_xml(xml, readers.VOC_OBJECT).alias("object"))
    return _round(readers.voc_boxes(objects, classes).drop("class_name"), 3)
