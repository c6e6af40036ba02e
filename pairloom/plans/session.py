"""Session settings the plans rely on for speed (never for results)."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import SparkSession

SETTINGS = {
    # Examples are hash-partitioned by shard. With this off, a join on
    # (shard, j) uses that partitioning and sends only the parameter side.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    # Rows hold whole documents; a worker and its executor hold a batch of them each. Batches are bounded by rows only:
    # to bound them by bytes, Spark measures all columns anew at each row that goes to a grouped function.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2048",
    "spark.sql.execution.arrow.maxBytesPerBatch": "2147483647",
}


def apply_settings(spark: SparkSession) -> None:
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)


@contextmanager
def settings(spark: SparkSession, values: dict[str, str] = SETTINGS):
    """Apply the settings for a while and restore what was there before."""
    before = {name: spark.conf.get(name) for name in values}
    for name, value in values.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
