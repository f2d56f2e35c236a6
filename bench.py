"""Time the headline queries: one JSON line on standard output.

BENCH_SF_DIR names the tables, BENCH_CPUS the number of local threads.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from reviewlab.catalog import QUERIES  # noqa: E402
from reviewlab.session import session  # noqa: E402

# One query or more of every part of the library.
HEADLINE = [
    "scan_parquet",
    "product_features",
    "orders_with_history",
    "item_order_agg",
    "item_product_agg",
    "payment_order_agg",
    "payments_with_total",
    "review_features",
    "drop_nulls",
    "drop_duplicates",
    "schema_report",
    "distinct_count",
    "describe",
    "share_of_total",
    "histogram",
    "quantiles",
    "outlier_counts",
    "correlation_matrix",
    "vif_base_table",
    "base_table",
    "base_table_scoring",
    "base_table_row_grain",
    "formula_features",
    "standardize",
    "hash_split",
    "roc_curve",
    "auc_roc",
    "classification_rates",
    "log_loss",
    "train_lr",
    "train_dt",
    "score_export",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 1))
    spark = session(
        "bench",
        master=f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf_dir}/orders.parquet").count()
    wanted = sys.argv[1:] or HEADLINE
    seconds = {}
    for name in wanted:
        start = time.perf_counter()
        # every row and column is computed, and none is brought to the driver
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
