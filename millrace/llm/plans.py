"""Registered queries of the corpus operators, each next to its SQL where SQL can express it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import (
    conversations, decontaminate, exact, html, langid, licenses, lm, packing, periods, pii, sharding, simhash, tokens,
)
from millrace.registry import Query, QueryFn
from millrace.tables import table

QUERIES: dict[str, Query] = {}


def query(name: str, oracle: str | None = None):
    """Register ``fn(spark, sf_dir)`` under ``name``."""

    def register(fn: QueryFn) -> QueryFn:
        QUERIES[name] = Query(name, (name.split("_")[0],), fn, oracle)
        return fn

    return register


@query("op2_exact_dedup", """
WITH d AS (
    SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                    'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
    FROM documents
)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, text_sha256
FROM d WINDOW g AS (PARTITION BY text_sha256)
""")
def exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.mark_duplicates(table(spark, sf_dir, "documents"))


@query("op5_packing")
def packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


@query("op7_sharding")
def sharded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign_shards(table(spark, sf_dir, "documents"))


@query("op8_license_scan")
def license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


@query("op9_language_id")
def language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(langid.split_of(F.col("doc_id")) == 2, F.lit(False))
    return langid.identify(docs, langid.fit(docs)).withColumn("held_out", held_out)


@query("op3_private_data")
def private_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.scan_private_data(table(spark, sf_dir, "documents"))

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind: str):
        return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("found", lambda s: s["kind"].isin(*pii.BASE))
    return found.select(
        "doc_id", *map(count, pii.BASE), F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("found")).alias("spans"), F.array_max(F.transform("found", lambda s: s["score"])).alias("score"),
    )


@query("op4_html_text")
def html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = html.extract_text(table(spark, sf_dir, "pages"))
    return text.withColumn("n_chars", F.char_length("text").cast("long"))


@query("op1_simhash")
def near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.mark_near_duplicates(table(spark, sf_dir, "documents"))


@query("op6_decontamination")
def contamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_passages(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op10_lm_scores", r"""
WITH w AS (
    SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^ \t\n\x0b\f\r]+') AS words
    FROM documents
), t AS (
    SELECT doc_id, i, words[i] AS w3, CASE WHEN i > 1 THEN words[i - 1] END AS w2,
           CASE WHEN i > 2 THEN words[i - 2] END AS w1
    FROM (SELECT doc_id, words, unnest(range(1, len(words) + 1)) AS i FROM w)
), counted AS (
    SELECT *, count(*) OVER (PARTITION BY w3) AS c1, count(*) OVER (PARTITION BY w2, w3) AS c2,
           count(*) OVER (PARTITION BY w1, w2, w3) AS c3, count(*) OVER () AS n
    FROM t
), uni AS (SELECT w3 AS word, count(*) AS c FROM t GROUP BY 1),
bi AS (SELECT w2 AS a, w3 AS b, count(*) AS c FROM t WHERE w2 IS NOT NULL GROUP BY 1, 2),
scored AS (
    SELECT doc_id,
           CASE WHEN w1 IS NOT NULL AND c3 >= 2 THEN ln(c3 / bi.c)
                WHEN w2 IS NOT NULL AND c2 >= 2 THEN ln(c2 / uni.c) + CASE WHEN w1 IS NULL THEN 0 ELSE ln(0.4) END
                ELSE ln(c1 / n) + CASE WHEN w2 IS NULL THEN 0 WHEN w1 IS NULL THEN ln(0.4) ELSE 2 * ln(0.4) END
           END AS score,
           (w1 IS NOT NULL AND c3 >= 2)::BIGINT AS good
    FROM counted LEFT JOIN bi ON bi.a = w1 AND bi.b = w2 LEFT JOIN uni ON uni.word = w2
)
SELECT doc_id, coalesce(len(words), 0) AS n_words, coalesce(round(log_score, 4), 0) AS log_score,
       round(log_score / len(words), 4) AS mean_log, coalesce(n_full, 0)::BIGINT AS n_full
FROM w LEFT JOIN (SELECT doc_id, sum(score) AS log_score, sum(good) AS n_full FROM scored GROUP BY 1) USING (doc_id)
""")
def lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = lm.score_documents(table(spark, sf_dir, "documents"))
    return scored.withColumns({"log_score": F.round("log_score", 4), "mean_log": F.round("mean_log", 4)})


@query("op13_token_counts")
def token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.count_tokens(table(spark, sf_dir, "documents"))


@query("op11_periodic_runs")
def periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periods.collapse_runs(periods.repeated_tails(table(spark, sf_dir, "documents")))
    # Greatest length, then smallest start, then smallest period.
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"], -r["start"], -r["period"], r["start"], r["period"])))
    listed = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    longest = found.withColumn("best", best).withColumns({
        "start": F.col("best.start"), "length": F.col("best.length"), "period": F.col("best.period"),
    })
    return longest.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "start", "length", "period",
        F.expr("1000 * length div period").alias("exponent_milli"), F.sha2(listed.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


@query("op12_conversation_repair")
def conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = conversations.damaged(table(spark, sf_dir, "conversations"))
    return conversations.repair_conversations(rows, absent_col="absent")
