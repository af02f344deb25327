"""Multi-line JSON documents against Python's parser, in many layouts and cut into small splits."""

import json

import pytest
from pyspark.sql import functions as F

from millrace.sources import documents, readers
from tests.conftest import rows

RECORDS = [
    {"id": i, "name": name, "tags": [{"t": i}, {"t": None}], "box": {"x": [i, {"y": "]"}]}}
    for i, name in enumerate(["a", 'quote " } ] , {', "back\\slash", "\\", "", 'ends \\"', "new\nline", "é漢", "{[", '"k": ['])
]
RECORDS += [RECORDS[2], RECORDS[2]]
LAYOUTS = {
    "indented": lambda d: json.dumps(d, indent=2),
    "flat": lambda d: json.dumps(d),
    "wide": lambda d: json.dumps(d, ensure_ascii=False, separators=(" , ", " : ")),
    "per_line": lambda d: json.dumps(d).replace(', {"id"', ',\n{"id"'),
    "comma_first": lambda d: json.dumps(d).replace(', {"id"', '\n, {"id"'),
    "own_lines": lambda d: json.dumps(d, indent=1).replace(": [", ":\n[").replace("}, {", "},\n\n{"),
    "joined": lambda d: json.dumps(d, indent=1).replace("},\n {", "}, {"),
}


@pytest.fixture
def small_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "150")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def _sorted(items):
    return sorted(json.dumps(i, sort_keys=True) for i in items)


@pytest.mark.parametrize("layout", LAYOUTS)
def test_items_as_python_reads_them(spark, small_splits, tmp_path, layout):
    wrapped = {"info": {"data": [1]}, "n": 2, "data": RECORDS, 'od"d': RECORDS[:3], "none": [], "plain": [1, "x", [{"no": 1}]], "end": None}
    for name, doc in (("list", RECORDS), ("wrapped", wrapped)):
        (tmp_path / f"{name}.json").write_text(LAYOUTS[layout](doc))
    found = documents.json_items(spark, str(tmp_path)).select(F.regexp_extract("file", r"(\w+)\.json", 1).alias("file"), "member", "item").collect()
    by = {}
    for r in found:
        by.setdefault((r["file"], r["member"]), []).append(json.loads(r["item"]))
    assert {k: _sorted(v) for k, v in by.items()} == {
        ("list", None): _sorted(RECORDS), ("wrapped", "data"): _sorted(RECORDS), ("wrapped", 'od"d'): _sorted(RECORDS[:3]),
    }


def test_typed_rows_variants_and_empty_files(spark, tmp_path):
    (tmp_path / "a.json").write_text("")
    (tmp_path / "b.json").write_text("[]\n")
    path = str(tmp_path)
    assert documents.read_json_list(spark, path, "id int, name string").collect() == []
    (tmp_path / "c.json").write_text(json.dumps(RECORDS[:2], indent=1) + "\n" + json.dumps(RECORDS[4:5], indent=1))
    (tmp_path / "d.json").write_text('[{"id": 9, "name": "x"}, {"id": oops}, null, 3]')
    typed = documents.read_json_list(spark, path, "id int, name string")
    assert rows(typed, "id") == [(None, None), (0, "a"), (1, 'quote " } ] , {'), (4, ""), (9, "x")]
    ids = documents.read_json_list(spark, path).select(F.expr("variant_get(item, '$.id', 'int')").alias("id"))
    assert rows(ids, "id") == [(None,), (0,), (1,), (4,), (9,)]


def test_one_document_is_read_by_many_tasks(spark, small_splits, tmp_path):
    (tmp_path / "big.json").write_text(json.dumps({"data": [{"id": i} for i in range(500)]}, indent=1))
    got = documents.read_json_list(spark, f"{tmp_path}/big.json", "id int", member="data")
    assert sorted(r[0] for r in got.collect()) == list(range(500))
    assert documents._pieces(spark, f"{tmp_path}/big.json").rdd.getNumPartitions() > 10


def test_very_long_line(spark, tmp_path):
    doc = [{"id": i, "name": "x\\" * 50_000 if i == 7 else "y"} for i in range(20_000)]
    (tmp_path / "line.json").write_text(json.dumps(doc))
    got = documents.read_json_list(spark, f"{tmp_path}/line.json", "id int, name string")
    assert got.agg(F.count("id"), F.sum("id"), F.max(F.length("name"))).first() == (20_000, sum(range(20_000)), 100_000)


def test_coco_in_one_document(spark, small_splits, tmp_path):
    doc = {
        "images": [{"id": i, "file_name": f"{i}.jpg", "width": 10, "height": 10} for i in range(20)],
        "annotations": [{"id": i, "image_id": i // 2, "category_id": 1, "bbox": [0.0, 0.0, i, 1.0]} for i in range(30)],
        "categories": [{"id": 1, "name": "thing"}],
    }
    (tmp_path / "coco.json").write_text(json.dumps(doc, indent=2))
    got = rows(readers.read_coco(spark, f"{tmp_path}/coco.json").select("image_id", "box_id", "class_name", "x2"), "image_id", "box_id")
    want = [(i // 2, i, "thing", float(i)) for i in range(30)] + [(i, None, None, None) for i in range(15, 20)]
    assert got == want
