"""Readers, writers, upserts and streams on small files."""

import json

import pytest
from pyspark.sql import functions as F

from millrace.sources import readers, tables, writers
from millrace.streaming import jobs, messages
from tests.conftest import rows


@pytest.fixture
def small(spark):
    return spark.createDataFrame([(1, "test1", 100), (2, "test2", 200)], "id int, name string, value int")


def test_json_shapes(spark, tmp_path):
    records = [{"id": 1, "name": "a"}, {"id": 2, "name": "b"}]
    for name, doc in (("list", records), ("wrapped", {"data": records}), ("single", records[0])):
        path = tmp_path / f"{name}.json"
        path.write_text(json.dumps(doc, indent=1))
        assert readers.read(spark, str(path)).count() == (1 if name == "single" else 2)


def test_csv_yaml_and_dispatch(spark, small, tmp_path):
    writers.write(small, f"{tmp_path}/out.csv")
    assert readers.read(spark, f"{tmp_path}/out.csv").columns == ["id", "name", "value"]
    (tmp_path / "list.yaml").write_text("- {id: 1, name: a}\n- {id: 2}\n")
    (tmp_path / "one.yml").write_text("id: 3\nname: c\n")
    both = readers.read_many(spark, [f"{tmp_path}/list.yaml", f"{tmp_path}/one.yml"], schema="id int, name string")
    assert rows(both, "id") == [(1, "a"), (2, None), (3, "c")]
    with pytest.raises(FileNotFoundError):
        readers.read(spark, f"{tmp_path}/none.csv")
    (tmp_path / "x.doc").write_text("x")
    with pytest.raises(ValueError, match="Unsupported format"):
        readers.read(spark, f"{tmp_path}/x.doc")
    with pytest.raises(ValueError, match="Unsupported format"):
        writers.write(small, f"{tmp_path}/x.doc")
    with pytest.raises(ValueError):
        writers.write_incremental(small, f"{tmp_path}/y", "merge")


def test_partition_directories_and_pruning(spark, tmp_path):
    df = spark.createDataFrame([(2023, 1, 100), (2023, 2, 200), (2024, 1, 300), (2024, 2, 400)], "year int, month int, value int")
    path = f"{tmp_path}/parts"
    writers.write_partitioned(df, path, ["year", "month"])
    assert (tmp_path / "parts" / "year=2023" / "month=1").is_dir()
    one = tables.read_partition(spark.read.parquet(path), "year", 2023)
    assert one.count() == 2
    assert "PartitionFilters: [isnotnull(year" in one._jdf.queryExecution().executedPlan().toString()
    assert writers.drop_old_partitions(spark, path, "year", 2024) == ["2023"]
    assert not (tmp_path / "parts" / "year=2023").exists()


def test_upsert_replaces_and_inserts(spark, tmp_path):
    path, schema = f"{tmp_path}/up", "day string, region string, n int"
    writers.upsert(spark, path, spark.createDataFrame([("d1", "A", 1), ("d1", "B", 2), ("d2", "A", 3)], schema), ["day", "region"], ["day"])
    writers.upsert(spark, path, spark.createDataFrame([("d1", "A", 9), ("d3", "A", 4)], schema), ["day", "region"], ["day"])
    got = rows(spark.read.parquet(path).select("day", "region", "n"), "day", "region")
    assert got == [("d1", "A", 9), ("d1", "B", 2), ("d2", "A", 3), ("d3", "A", 4)]


def test_annotation_files(spark, tmp_path):
    coco = {"images": [{"id": 1, "file_name": "a.jpg", "width": 100, "height": 50}, {"id": 2, "file_name": "b.jpg", "width": 10, "height": 10}],
            "annotations": [{"id": 7, "image_id": 1, "category_id": 3, "bbox": [10, 10, 20, 5]}], "categories": [{"id": 3, "name": "cat"}]}
    (tmp_path / "coco.json").write_text(json.dumps(coco))
    got = rows(readers.read_coco(spark, f"{tmp_path}/coco.json").select("image_id", "class_name", "x2", "y2"), "image_id")
    assert got == [(1, "cat", 30.0, 15.0), (2, None, None, None)]
    (tmp_path / "labels").mkdir()
    (tmp_path / "labels" / "a.txt").write_text("3 0.5 0.5 0.2 0.4\nbad line\n")
    sizes = spark.createDataFrame([("a", 100.0, 50.0)], "image string, width double, height double")
    assert rows(readers.read_yolo(spark, f"{tmp_path}/labels", sizes)) == [("a", 3, 40.0, 15.0, 60.0, 35.0)]
    (tmp_path / "v.xml").write_text(
        "<annotation><object><name>cat</name><bndbox><xmin>1</xmin><ymin>2</ymin><xmax>3</xmax><ymax>4</ymax></bndbox></object>"
        "<object><name>alien</name><bndbox><xmin>1</xmin><ymin>2</ymin><xmax>3</xmax><ymax>4</ymax></bndbox></object></annotation>"
    )
    classes = spark.createDataFrame([("cat", 3)], "class_name string, class_id int")
    got = readers.read_voc(spark, f"{tmp_path}/v.xml", classes).collect()
    assert [(r.image, r.class_id, r.x1, r.y2) for r in got] == [("v", 3, 1.0, 4.0)]


def test_named_table_and_scan(spark, small, tmp_path):
    writers.refresh_table(small, "millrace_small", f"{tmp_path}/named")
    got = tables.scan_table(spark, "millrace_small", columns=["id"], limit=1)
    assert got.columns == ["id"] and got.count() == 1
    spark.sql("DROP TABLE millrace_small")
    assert tables.high_water_mark(small, "value") == 200


def test_file_digests(spark, tmp_path):
    (tmp_path / "h.bin").write_bytes(b"abc")
    assert readers.hash_files(spark, f"{tmp_path}/h.bin").first().digest == "900150983cd24fb0d6963f7d28e17f72"


def test_kafka_options():
    got = tables.kafka_options("b:9092", ["t1", "t2"], max_per_batch=100)
    assert got["subscribe"] == "t1,t2" and got["maxOffsetsPerTrigger"] == "100"


MESSAGE = {"transaction_id": "t", "product_id": "p", "quantity": 5, "price": 100.0, "region": "north", "product_name": "  Lap TOP ", "timestamp": "2024-01-15T10:30:00"}


def test_message_states(spark):
    lacking = {k: v for k, v in MESSAGE.items() if k != "price"}
    texts = [json.dumps(MESSAGE), json.dumps(lacking), json.dumps({**MESSAGE, "quantity": -1}), "{oops", json.dumps({**MESSAGE, "timestamp": "x"})]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, value string")
    got = messages.process_messages(messages.parse_messages(df)).orderBy("i").collect()
    assert [r.message_status for r in got] == ["processed", "invalid", "invalid", "error", "processed"]
    first = got[0]
    assert (first.total_amount, first.region_code, first.product_name, first.hour) == (500.0, "NO", "lap top", 10)
    assert got[1].reason == "missing price" and got[4].hour is None


def test_stream_restarts_without_loss_or_repeats(spark, tmp_path):
    events = spark.range(100).select("id", (F.lit("2024-01-01").cast("timestamp") + F.make_interval(secs=F.col("id") * 30)).alias("ts"))
    out, state, seen = f"{tmp_path}/out", f"{tmp_path}/state", f"{tmp_path}/in"
    for low, high in ((0, 50), (40, 100)):  # ten messages are sent twice
        events.filter(F.col("id").between(low, high - 1)).write.mode("append").parquet(seen)
        stream = tables.read_topic_files(spark, seen, events.schema, "parquet")
        jobs.run_to_files(jobs.distinct_messages(stream, ["id"], "ts", "1 hour"), out, state)
    assert [r.id for r in spark.read.parquet(out).orderBy("id").collect()] == list(range(100))


def test_repeated_batch_writes_once(spark, small, tmp_path):
    write = jobs.route_batches(f"{tmp_path}/r", F.when(F.col("value") > 150, "high").otherwise("low"))
    for _ in range(2):
        write(small, 0)
    write(small, 1)
    assert spark.read.parquet(f"{tmp_path}/r").groupBy("route").count().orderBy("route").collect()[0]["count"] == 2
