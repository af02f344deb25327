"""Detectors for suspicious transactions.

Sliding frames per customer are counted per second first and cut into blocks of
time, so one very busy customer is spread over many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Amounts and score that count as suspicious.
HIGH_VALUE = (10_000, 50_000)
SUSPICIOUS_SCORE = 0.8
# Transactions within so many seconds that count as rapid succession.
RAPID = (10, 300)


def high_value(df: DataFrame, amount: str, low: float = HIGH_VALUE[0], high: float = HIGH_VALUE[1]) -> DataFrame:
    """Transactions between the two amounts."""
    return df.filter(F.col(amount).between(low, high)).withColumn("fraud_type", F.lit("high_value"))


def suspicious(score: str | Column) -> Column:
    return (F.col(score) if isinstance(score, str) else score) > SUSPICIOUS_SCORE


def _time_blocks(df: DataFrame, seconds: int) -> DataFrame:
    """Blocks as long as the frame; each also holds the block before it."""
    home = F.floor(F.col("_t") / seconds)
    return df.withColumn("_home", home).withColumn("_block", F.explode(F.array(home, home + 1)))


def rapid_succession(df: DataFrame, customer: str, ts: str, count: int = 10, seconds: int = 300) -> DataFrame:
    """Moments at which a customer reached ``count`` transactions in the last ``seconds``."""
    per_second = df.groupBy(customer, F.unix_timestamp(F.col(ts).cast("timestamp")).alias("_t")).agg(F.count("*").alias("_n"))
    w = Window.partitionBy(customer, "_block").orderBy("_t").rangeBetween(-seconds, 0)
    counted = _time_blocks(per_second, seconds).withColumn("n_recent", F.sum("_n").over(w))
    return counted.filter((F.col("_block") == F.col("_home")) & (F.col("n_recent") >= count)).select(
        customer, F.col("_t").alias("epoch"), "n_recent"
    )


def rapid_alerts(df: DataFrame, customer: str, ts: str, count: int = RAPID[0], seconds: int = RAPID[1]) -> DataFrame:
    """Moments at which the transactions of a customer in the last ``seconds`` reach ``count``: one per burst.

    Without the moment's own second there were fewer. Rows without customer or time are no one's.
    """
    known = df.where(F.col(customer).isNotNull() & F.col(ts).isNotNull())
    per_second = known.groupBy(customer, F.unix_timestamp(F.col(ts).cast("timestamp")).alias("_t")).agg(F.count("*").alias("_n"))
    w = Window.partitionBy(customer, "_block").orderBy("_t").rangeBetween(-seconds, 0)
    counted = _time_blocks(per_second, seconds).withColumn("n_recent", F.sum("_n").over(w))
    reached = (F.col("n_recent") >= count) & (F.col("n_recent") - F.col("_n") < count)
    return counted.where((F.col("_block") == F.col("_home")) & reached).select(customer, F.col("_t").alias("epoch"), "n_recent")


def many_methods(df: DataFrame, customer: str, ts: str, method: str, count: int = 4, seconds: int = 300) -> DataFrame:
    """Moments at which a customer had used ``count`` payment methods in the last ``seconds``."""
    seen = df.select(customer, F.unix_timestamp(F.col(ts).cast("timestamp")).alias("_t"), method).distinct()
    w = Window.partitionBy(customer, "_block").orderBy("_t").rangeBetween(-seconds, 0)
    counted = _time_blocks(seen, seconds).withColumn("n_methods", F.size(F.collect_set(method).over(w)))
    hits = counted.filter((F.col("_block") == F.col("_home")) & (F.col("n_methods") >= count))
    return hits.select(customer, F.col("_t").alias("epoch"), "n_methods").distinct()


def usual_places(history: DataFrame, customer: str, place: str, min_share: float = 0.1) -> DataFrame:
    """(customer, place) pairs that make up at least this share of a customer's history."""
    counts = history.groupBy(customer, place).agg(F.count("*").alias("_n"))
    totals = counts.groupBy(customer).agg(F.sum("_n").alias("_total"))
    return counts.join(totals, customer).filter(F.col("_n") >= F.col("_total") * min_share).select(customer, place)


def unusual_location(df: DataFrame, usual: DataFrame, customer: str, place: str) -> DataFrame:
    """Transactions outside the customer's usual places."""
    return df.join(usual, [customer, place], "left_anti").withColumn("fraud_type", F.lit("unusual_location"))
