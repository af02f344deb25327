"""Exact duplicates: frequent digests are settled on the map side, the rest by a shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import ROW, columns, lower_ascii, with_row
from millrace.session import pin

# A digest is heavy beyond 1/HEAVY of all rows, so at most HEAVY of them are broadcast.
HEAVY = 1_000
# Counters of the Misra-Gries summary; its error stays below rows / HEAVY.
COUNTERS = 16_384


def digest_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One short row per document: id, row number, and SHA-256 of the normalised text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return with_row(columns(docs, doc_id=id_col, text=text_col)).select(
        "doc_id", ROW, F.unhex(F.sha2(lower_ascii(text), 256)).alias("digest")
    )


def heavy_digests(rows: DataFrame) -> DataFrame:
    """Digests of more than 1/HEAVY of all rows, with exact size and winner.

    The Misra-Gries summary (Spark's mergeable frequent-items sketch) proposes
    candidates by key; a second pass counts them exactly. At most HEAVY rows.
    """
    key = F.xxhash64("digest")
    least = max(1, rows.count() // HEAVY)
    proposed = rows.agg(F.expr(f"approx_top_k(xxhash64(digest), {HEAVY}, {COUNTERS})").alias("top"))
    keys = proposed.select(F.explode("top.item").alias("key"))
    return (
        rows.withColumn("key", key)
        .join(F.broadcast(keys), "key", "left_semi")  # at most HEAVY keys
        .groupBy("digest")
        .agg(F.max(F.struct("doc_id", ROW)).alias("best"), F.count("*").alias("size"))
        .where(F.col("size") > least)
    )


def settle(rows: DataFrame) -> DataFrame:
    """Add ``best`` (id and row that stay) and ``size`` of its group to every digest row."""
    heavy = F.broadcast(heavy_digests(rows))  # at most HEAVY rows
    tagged = rows.join(heavy, "digest", "left")
    light = tagged.where(F.col("size").isNull()).select("doc_id", ROW, "digest")
    groups = light.groupBy("digest").agg(F.max(F.struct("doc_id", ROW)).alias("best"), F.count("*").alias("size"))
    return tagged.where(F.col("size").isNotNull()).unionByName(light.join(groups, "digest"))


def mark_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Say for every document which of its equals stays.

    Texts are equal when identical after lower-casing A-Z; a NULL text counts as
    empty. The largest id stays, NULL ids being smallest; of rows that repeat both id
    and text exactly one stays. An empty table gives no rows, further columns are
    ignored. Returns doc_id, keep_id, group_size, kept, text_sha256.
    """
    rows = pin(digest_rows(docs, id_col, text_col))
    return settle(rows).select(
        "doc_id",
        F.col("best.doc_id").alias("keep_id"),
        F.col("size").alias("group_size"),
        (F.col(ROW) == F.col(f"best.{ROW}")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def drop_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that ``mark_duplicates`` keeps, with all their columns, in one written copy."""
    numbered = pin(docs.withColumns({
        ROW: F.monotonically_increasing_id(),
        "__digest": F.unhex(F.sha2(lower_ascii(F.coalesce(F.col(f"`{text_col}`"), F.lit(""))), 256)),
    }))
    rows = numbered.select(F.col(f"`{id_col}`").alias("doc_id"), ROW, F.col("__digest").alias("digest"))
    gone = settle(rows).where(F.col(ROW) != F.col(f"best.{ROW}")).select(ROW)
    # The list of dropped rows is written, so that Spark knows its size and may hand it to the map side.
    return numbered.join(pin(gone), ROW, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
