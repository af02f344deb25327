"""Large multi-line JSON documents, read by many tasks.

Spark reads a multi-line document in one task. JSON strings hold no line breaks, so every line
starts outside of strings: lines can be read as splittable text, brackets counted per piece
of a line, and their depth carried over the splits of a file by one row per split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.session import pin

_STRING = r'"(?:[^"\\]++|\\.)*+"'
# A piece ends after a closing brace or an opening bracket. Possessive, so that a long line needs no deep stack.
_PIECE = rf'(?:{_STRING}|[^"}}\[]++)*+[}}\[]?'
_KEY = rf'({_STRING})\s*:\s*\[?\s*$'
_AT = ["_split", "_line", "_piece"]


def _depth_change(text: Column) -> Column:
    bare = F.regexp_replace(text, _STRING, "")
    opened = F.length(F.regexp_replace(bare, r"[^\[{]", ""))
    return (opened - F.length(F.regexp_replace(bare, r"[^\]}]", ""))).cast("long")


def _pieces(spark: SparkSession, path: str | list[str]) -> DataFrame:
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("_split"),
        F.monotonically_increasing_id().alias("_line"), "value",
    )
    found = lines.select("file", *_AT[:2], F.posexplode(F.regexp_extract_all("value", F.lit(_PIECE), F.lit(0))).alias("_piece", "_text"))
    return found.filter(F.trim("_text") != "").withColumn("_change", _depth_change(F.col("_text")))


def json_items(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Records of the lists in multi-line documents: (file, member, item), the item as JSON text.

    A document is a list of records (``member`` is NULL) or an object whose members may be such
    lists; a file may hold several documents of one kind. Other members, list entries that
    are no objects, and empty files give no rows. Repeated records are all kept. An item must
    fit in a row, a list or a document need not. A file of one line is still read by one task.

    The pieces are written once, to the shared work folder, before the result is returned.
    """
    pieces = _pieces(spark, path)
    place = F.struct(*_AT)
    earlier = Window.partitionBy("file").orderBy("_split").rowsBetween(Window.unboundedPreceding, -1)
    whole_file = Window.partitionBy("file").orderBy("_split").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    # One row per split: the depth it starts at, and whether the file's documents are lists.
    splits = pieces.groupBy("file", "_split").agg(
        F.sum("_change").alias("_sum"), F.min_by(F.substring(F.ltrim("_text"), 1, 1), F.struct("_line", "_piece")).alias("_head"),
    ).select(
        "file", "_split", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_base"),
        (F.first("_head").over(whole_file) == "[").alias("_listed"),
    )
    # A split is at most spark.sql.files.maxPartitionBytes long, so is the group of the window.
    inside = Window.partitionBy("file", "_split").orderBy("_line", "_piece")
    depth = F.col("_base") + F.coalesce(F.sum("_change").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = pieces.join(splits, ["file", "_split"]).withColumn("_depth", depth)
    before_bracket = F.col("_depth") + F.col("_change") - F.col("_text").endswith("[").cast("int")
    key = F.regexp_extract("_text", _KEY, 1)
    top = F.when(F.col("_listed"), 1).otherwise(2)
    item = F.regexp_replace("_text", r"^[\s,]+", "")
    opens = (F.col("_depth") == top) & item.startswith("{")
    marked = pin(placed.select(
        "file", *_AT, F.when(opens, item).otherwise(F.col("_text")).alias("_text"),
        F.when(~F.col("_listed") & (before_bracket == 1) & (key != ""), F.struct(place.alias("at"), key.alias("key"))).alias("_key"),
        # A list inside the list ends the item before it and is none itself.
        F.when(opens | (F.col("_depth") == top) & F.col("_text").endswith("["), F.struct(*_AT, opens.alias("_opens"))).alias("_start"),
        # Between items nothing belongs to one.
        ((F.col("_depth") > top) | opens).alias("_within"),
    ))
    # What a split inherits: the last key and the last start of an item before it.
    inherited = marked.groupBy("file", "_split").agg(F.max("_key").alias("_key"), F.max("_start").alias("_start")).select(
        "file", "_split", F.max("_key").over(earlier).alias("_old_key"), F.max("_start").over(earlier).alias("_old_start")
    )
    so_far = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    owned = marked.join(inherited, ["file", "_split"]).select(
        "file", *_AT, "_text", "_within",
        F.coalesce(F.max("_key").over(so_far), "_old_key")["key"].alias("_member"),
        F.coalesce(F.max("_start").over(so_far), "_old_start").alias("_item"),
    ).filter(F.col("_within") & F.col("_item._opens"))
    parts = F.sort_array(F.collect_list(F.struct(*_AT, "_text")))
    items = owned.groupBy("file", "_item").agg(F.min_by("_member", place).alias("_member"), parts.alias("_parts"))
    member = F.from_json(F.concat(F.lit('{"k":'), F.col("_member"), F.lit("}")), "k string")["k"]
    return items.select("file", member.alias("member"), F.array_join(F.transform("_parts", lambda p: p["_text"]), "").alias("item"))


def read_json_list(
    spark: SparkSession, path: str | list[str], schema: str | T.StructType | None = None, member: str | None = None
) -> DataFrame:
    """Typed records of one list of large multi-line documents, spread over tasks.

    ``member`` names the list inside an object; without it the documents are lists. Without
    a schema each record is one VARIANT, ``item``. A broken record gives NULLs.
    """
    items = json_items(spark, path)
    items = items.filter(F.col("member") == member) if member is not None else items.filter(F.col("member").isNull())
    if schema is None:
        return items.select(F.try_parse_json("item").alias("item"))
    return items.select(F.from_json("item", schema).alias("_r")).select("_r.*")
