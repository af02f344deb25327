"""Readers by format, and readers of nested documents and annotation files."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions import boxes as bx

Schema = str | T.StructType


# --- formats ---------------------------------------------------------------------


def read_csv(
    spark: SparkSession, path: str | list[str], schema: Schema | None = None, sep: str = ",", encoding: str = "utf-8",
    mode: str = "PERMISSIVE", **options,
) -> DataFrame:
    """CSV with a header. Give a schema for large input: inferring reads it twice."""
    reader = spark.read.options(header=True, sep=sep, encoding=encoding, mode=mode, **options)
    reader = reader.schema(schema) if schema else reader.option("inferSchema", True)
    return reader.csv(path)


def read_json(spark: SparkSession, path: str | list[str], schema: Schema | None = None, multi_line: bool = True) -> DataFrame:
    """JSON lists of records, ``{"data": [...]}`` wrappers or single objects.

    Files of one object per line (``multi_line=False``) can be split among tasks.
    """
    reader = spark.read.option("multiLine", multi_line)
    df = (reader.schema(schema) if schema else reader).json(path)
    return unwrap(df, ["data"])


def read_parquet(spark: SparkSession, path: str | list[str], schema: Schema | None = None) -> DataFrame:
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(*([path] if isinstance(path, str) else path))


def read_yaml(spark: SparkSession, path: str | list[str], schema: Schema) -> DataFrame:
    """YAML files, each a list of mappings or one mapping; one task per file."""

    def parse(batches: Iterator) -> Iterator:
        import pandas as pd
        import yaml

        names = spark_schema.fieldNames()
        for batch in batches:
            for text in batch["value"]:
                items = yaml.safe_load(text)
                rows = items if isinstance(items, list) else [items] if items else []
                yield pd.DataFrame([{n: r.get(n) for n in names} for r in rows], columns=names)

    spark_schema = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    return spark.read.text(path, wholetext=True).mapInPandas(parse, spark_schema)


READERS: dict[str, Callable[..., DataFrame]] = {
    "csv": read_csv, "json": read_json, "parquet": read_parquet, "yaml": read_yaml, "yml": read_yaml,
}


def exists(spark: SparkSession, path: str) -> bool:
    """Does the path, or a file that matches it, exist on its file system?"""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = jvm_path.getFileSystem(spark._jsc.hadoopConfiguration())
    found = fs.globStatus(jvm_path)
    return found is not None and len(found) > 0


def read(spark: SparkSession, path: str, fmt: str | None = None, **options) -> DataFrame:
    """Read by format name or file suffix."""
    if not exists(spark, path):
        raise FileNotFoundError(f"File not found: {path}")
    name = (fmt or path.rstrip("/").rsplit("/", 1)[-1].rpartition(".")[2]).lower()
    if name not in READERS:
        raise ValueError(f"Unsupported format: {name}")
    return READERS[name](spark, path, **options)


def read_many(spark: SparkSession, paths: Sequence[str], fmt: str | None = None, **options) -> DataFrame:
    """Read several files into one table; columns are united by name."""
    out = None
    for path in paths:
        part = read(spark, path, fmt, **options)
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    if out is None:
        raise ValueError("no files given")
    return out


# --- nested documents -----------------------------------------------------------------


def unwrap(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Rows of the first list-of-records column among ``names``, if that is how
    the documents are wrapped; otherwise the table as it is."""
    for name in names:
        if name in df.columns:
            dtype = df.schema[name].dataType
            if isinstance(dtype, T.ArrayType) and isinstance(dtype.elementType, T.StructType):
                return df.select(F.inline(F.col(name)))
    return df


def paged_records(pages: DataFrame, max_pages: int | None = None) -> DataFrame:
    """Records of landed page documents (``results`` or ``data`` lists), up to
    the page count they state."""
    if "page" in pages.columns and "total_pages" in pages.columns:
        pages = pages.filter(F.col("page") <= F.col("total_pages"))
    if max_pages is not None:
        pages = pages.filter(F.col("page") <= max_pages)
    lists = [F.col(n) for n in ("results", "data") if n in pages.columns]
    return pages.select(F.explode(F.coalesce(*lists)).alias("_r")).select("_r.*")


def ohlcv_series(df: DataFrame, payload: str, keys: Sequence[str] = (), fields: Sequence[str] = ("open", "high", "low", "close", "volume")) -> DataFrame:
    """Date-keyed price documents to rows of date and numbers."""
    value = ", ".join(f"{f}: string" for f in fields)
    days = F.from_json(F.col(payload), f"map<string, struct<{value}>>")
    rows = df.select(*keys, F.explode(days).alias("day", "v"))
    numbers = [F.col(f"v.{f}").try_cast("double").alias(f) for f in fields]
    return rows.select(*keys, F.to_date("day").alias("date"), *numbers)


# --- annotations ------------------------------------------------------------------------

COCO_SCHEMA = """
images array<struct<id: bigint, file_name: string, width: int, height: int>>,
annotations array<struct<id: bigint, image_id: bigint, category_id: int, bbox: array<double>>>,
categories array<struct<id: int, name: string>>"""


def read_coco(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    return coco_boxes(spark.read.schema(COCO_SCHEMA).option("multiLine", multi_line).json(path))


def coco_boxes(docs: DataFrame) -> DataFrame:
    """Annotation documents to one row per box in corner format; images without
    boxes keep one row. The lists may be spread over many files."""
    images = docs.select(F.inline("images")).select(
        F.col("id").alias("image_id"), "file_name", "width", "height"
    )
    b = tuple(F.col("bbox")[i] for i in range(4))
    found = docs.select(F.inline("annotations")).select(
        "image_id", F.col("id").alias("box_id"), F.col("category_id").alias("class_id"),
        *[c.alias(n) for c, n in zip(bx.from_xywh(b), ("x1", "y1", "x2", "y2"))],
    )
    names = docs.select(F.inline("categories")).select(F.col("id").alias("class_id"), F.col("name").alias("class_name")).distinct()
    return images.join(found.join(names, "class_id", "left"), "image_id", "left")


def read_yolo(spark: SparkSession, path: str, sizes: DataFrame) -> DataFrame:
    """Label files ``<image>.txt``; ``sizes`` holds (image, width, height)."""
    name = F.regexp_extract("_metadata.file_path", r"([^/]*)\.txt$", 1)
    return yolo_boxes(spark.read.text(path).select(name.alias("image"), "value"), sizes)


def yolo_boxes(lines: DataFrame, sizes: DataFrame) -> DataFrame:
    """Label lines (class, centre, size as shares) to corner boxes in pixels;
    lines with fewer than five fields are skipped."""
    p = F.col("_p")
    centre = tuple(p[i].try_cast("double") for i in range(1, 5))
    fields = lines.withColumn("_p", F.split(F.trim("value"), r"\s+")).filter(F.size("_p") >= 5)
    joined = fields.join(sizes, "image")
    pixels = bx.denormalise(centre, F.col("width"), F.col("height"))
    keep = [c for c in lines.columns if c not in ("image", "value")]
    return joined.select(
        "image", *keep, p[0].try_cast("int").alias("class_id"),
        *[c.alias(n) for c, n in zip(bx.from_center(pixels), ("x1", "y1", "x2", "y2"))],
    )


VOC_OBJECT = "name string, bndbox struct<xmin: double, ymin: double, xmax: double, ymax: double>"


def read_voc(spark: SparkSession, path: str, classes: DataFrame) -> DataFrame:
    """XML annotation files; each ``object`` element is a row."""
    rows = spark.read.format("xml").option("rowTag", "object").schema(VOC_OBJECT).load(path)
    image = F.regexp_extract("_metadata.file_path", r"([^/]*)\.xml$", 1)
    return voc_boxes(rows.select(image.alias("image"), F.struct("name", "bndbox").alias("object")), classes)


def voc_boxes(objects: DataFrame, classes: DataFrame) -> DataFrame:
    """Parsed objects to boxes of the known classes (class_name, class_id)."""
    keep = [c for c in objects.columns if c != "object"]
    box = [F.col(f"object.bndbox.{a}").alias(n) for a, n in (("xmin", "x1"), ("ymin", "y1"), ("xmax", "x2"), ("ymax", "y2"))]
    rows = objects.select(*keep, F.col("object.name").alias("class_name"), *box)
    return rows.join(classes, "class_name")


def hash_files(spark: SparkSession, path: str, algorithm: str = "md5") -> DataFrame:
    """Digest of each file's content."""
    from millrace.functions.scalar import content_hash

    files = spark.read.format("binaryFile").load(path)
    return files.select("path", "length", content_hash("content", algorithm).alias("digest"))


def when_valid(df: DataFrame, valid: Column) -> tuple[DataFrame, DataFrame]:
    """Split rows into valid ones and the rest."""
    ok = F.coalesce(valid, F.lit(False))
    return df.filter(ok), df.filter(~ok)
