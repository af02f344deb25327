"""Time the headline queries and print one JSON line.

BENCH_SF_DIR and BENCH_CPUS choose the data and the number of local cores.
"""

from __future__ import annotations

import json
import os
import time

from millrace.plans import load_all
from millrace.session import get_session

HEADLINE = (
    "daily_sales_by_region", "daily_product_performance", "general_aggregate", "pivot_sales", "customer_ltv",
    "resample_daily", "resample_all_widths", "profile_numeric", "histogram", "corr_matrix",
    "rolling_7_rows", "cumulative_value", "average_rank", "dq_nulls", "dq_duplicates", "dq_business",
    "configured_rules", "impute_median", "iqr_filter", "clean_text", "word_features", "tfidf_weights",
    "top_terms_per_class", "message_processing", "stream_window_60s", "fraud_rapid", "roc_auc",
    "iou_join", "nms", "match_counts", "average_precision",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_session(
        "bench", f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus if cpus.isdigit() else "8",
        spark__ui__enabled="false", spark__ui__showConsoleProgress="false", spark__driver__memory="12g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    known = load_all()
    spark.read.parquet(f"{sf_dir}/nation.parquet").count()  # start the executor threads
    times = {}
    for name in HEADLINE:
        if name not in known:
            continue
        start = time.perf_counter()
        known[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()
    total = round(sum(times.values()), 3)
    print(json.dumps({
        "metric": "headline_queries_total", "value": total, "unit": "sec", "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "flagship_rows_per_sec": round(lines / times["daily_sales_by_region"]),
    }))


if __name__ == "__main__":
    main()
