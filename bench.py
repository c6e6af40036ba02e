"""Headline timings: ``BENCH_SF_DIR`` and ``BENCH_CPUS`` choose data and cores.

Prints one JSON line. Examples are prepared once (timed as ``prepare``); each
query then runs twice over all orders and the second time counts, written to
the noop sink so that every row is computed and none is collected.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from pairloom.plans import datasets
from pairloom.plans import queries as q

NAMES = (
    "dataset_stats", "fm_init", "fm_predict", "fm_predict_sharded", "fm_predict_documents", "fm_evaluate",
    "fm_gradient", "sgd_local_epoch", "adam_local_epoch", "rmsprop_local_epoch", "fm_train_history",
    "libsvm_scan", "fm_export_read",
)


def timed(action) -> float:
    begin = time.monotonic()
    action()
    return time.monotonic() - begin


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("pairloom-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "8g")
        # No Python stack capture per column expression.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    def prepare() -> None:
        datasets.order_examples(spark, sf_dir)
        datasets.document_counts(spark, sf_dir)

    took = {"prepare": timed(prepare)}
    first = {}
    for name in NAMES:
        runs = [
            timed(lambda: q.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save())
            for _ in range(2)
        ]
        first[name], took[name] = runs
    print(json.dumps({
        "metric": "factorization machine headline queries, second run",
        "value": round(sum(took.values()), 3),
        "unit": "sec",
        "queries": {name: round(seconds, 3) for name, seconds in took.items()},
        "first_run": {name: round(seconds, 3) for name, seconds in first.items()},
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "cpus": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
