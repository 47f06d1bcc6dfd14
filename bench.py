"""Seconds per headline query; one JSON line on standard output."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession

from tierwise.plans.queries import QUERIES

HEADLINES = [
    "first_slice",
    "bronze_layer",
    "cross_imputation",
    "outlier_counts",
    "silver_layer",
    "polynomial_features",
    "row_moments",
    "line_item_quantiles",
    "percent_rank",
    "power_lambdas",
    "target_encode_out_of_fold",
    "knn_impute",
    "gold_table",
    "select_features",
    "stratified_folds",
    "fold_auc",
    "boosted_model",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1_000_000).selectExpr("sum(id)").collect()  # start the JVM threads
    seconds = {}
    for name in sys.argv[1:] or HEADLINES:
        started = time.monotonic()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.monotonic() - started, 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "feature_pipeline_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
