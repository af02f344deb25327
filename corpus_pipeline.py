"""A corpus pipeline: language, exact copies, near copies, leaked test items, packing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return
the columns of documents. Each result is written to the shared folder and read again as
the next stage's input, so a lost executor costs one stage at most; what a stage wrote on
its way goes when its result is there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millrace.llm import decontaminate, exact, langid, packing, simhash
from millrace.session import scratch, unpin
from millrace.tables import table


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep what a language model explains; texts without letters go."""
    judged = langid.identify(docs, langid.fit(docs), carry=True)
    return judged.where("NOT __rejected").drop("__rejected")


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact.drop_duplicates(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest id of every group linked by SimHash, shingle length and bits as in ``op1_simhash``."""
    return simhash.drop_near_duplicates(docs)


def leaked_items(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs)


STAGES = [
    ("language", language),
    ("exact_copies", exact_copies),
    ("near_copies", near_copies),
    ("leaked_items", leaked_items),
    ("packing", packing_stage),
]

# Language models, similarity, alignment and tokenisers are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        with scratch() as keep:
            done = keep(stage(spark, docs, sf_dir))
        unpin(docs)
        docs = done
    return docs
