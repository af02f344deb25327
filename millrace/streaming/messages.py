"""Transaction messages: parse, validate, enrich, normalise. Works on batches and
streams alike."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MESSAGE_SCHEMA = (
    "transaction_id string, product_id string, product_name string, quantity double, price double, "
    "customer_id string, region string, payment_method string, status string, timestamp string"
)
REQUIRED = ("transaction_id", "product_id", "quantity", "price")
_BROKEN = "_broken"


def parse_messages(df: DataFrame, value: str = "value", schema: str = MESSAGE_SCHEMA) -> DataFrame:
    """JSON text to columns; ``parse_error`` keeps the text that is no record."""
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BROKEN}
    record = F.from_json(F.col(value), f"{schema}, {_BROKEN} string", options)
    keep = [c for c in df.columns if c != value]
    rows = df.select(*keep, record.alias("_m"), F.col(value).alias("_text"))
    broken = F.when(F.col("_m").isNull(), F.col("_text")).otherwise(F.col(f"_m.{_BROKEN}"))
    return rows.select(*keep, "_m.*", broken.alias("parse_error")).drop(_BROKEN)


def validity(required: Sequence[str] = REQUIRED) -> tuple[Column, Column]:
    """(is_valid, reason) of a message."""
    reason = F.when(F.lit(False), F.lit(""))
    for name in required:
        reason = reason.when(F.col(name).isNull(), F.lit(f"missing {name}"))
    reason = reason.when((F.col("quantity") <= 0) | (F.col("price") <= 0), F.lit("not positive"))
    return reason.isNull(), reason


def process_messages(df: DataFrame, processed_at: Column | None = None) -> DataFrame:
    """Status, derived amounts, codes and date parts per message.

    ``status`` is processed, invalid (a rule is broken) or error (no record).
    """
    now = F.current_timestamp() if processed_at is None else processed_at
    ok, reason = validity()
    broken = F.col("parse_error").isNotNull() if "parse_error" in df.columns else F.lit(False)
    state = F.when(broken, "error").when(ok, "processed").otherwise("invalid")
    good = F.col("message_status") == "processed"
    ts = F.try_to_timestamp(F.col("timestamp").cast("string"))

    def if_good(value: Column) -> Column:
        return F.when(good, value)

    return df.withColumns(
        {"message_status": state, "reason": F.when(broken, F.lit("not a record")).otherwise(reason), "processed_at": now}
    ).withColumns(
        {
            "total_amount": if_good(F.col("quantity") * F.col("price")),
            "processing_date": if_good(F.to_date("processed_at")),
            "region_code": if_good(F.upper(F.substring("region", 1, 2))),
            "product_name": F.when(good, F.lower(F.trim("product_name"))).otherwise(F.col("product_name")),
            "year": if_good(F.year(ts)),
            "month": if_good(F.month(ts)),
            "day": if_good(F.dayofmonth(ts)),
            "hour": if_good(F.hour(ts)),
        }
    )


def with_error_capture(function, return_type: str):
    """A vectorised function from a scalar one: struct of value and error text.

    Rows that raise keep their error instead of failing the job.
    """
    @F.pandas_udf(f"struct<value: {return_type}, error: string>")
    def run(batch):
        import pandas as pd

        values, errors = [], []
        for item in batch:
            try:
                values.append(function(item))
                errors.append(None)
            except Exception as err:
                values.append(None)
                errors.append(f"{type(err).__name__}: {err}")
        return pd.DataFrame({"value": values, "error": errors})

    run.__annotations__ = {}
    return run
