"""Training history: one row per epoch, epoch 0 is the untrained model."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.config import CLASSIFICATION

CLASSIFICATION_METRICS = (
    "train_log_loss", "valid_log_loss", "train_auc", "valid_auc",
    "train_pos_mean", "train_neg_mean", "valid_pos_mean", "valid_neg_mean",
)
REGRESSION_METRICS = ("train_rmse", "valid_rmse", "train_mae", "valid_mae")


def metric_columns(task: int) -> tuple[str, ...]:
    return CLASSIFICATION_METRICS if task == CLASSIFICATION else REGRESSION_METRICS


def history_schema(task: int) -> str:
    metrics = ", ".join(f"{c} double" for c in metric_columns(task))
    return f"epoch int, {metrics}, minutes double, finished_at timestamp"


def history_line(task: int) -> Column:
    """A history row as one line: epoch, metrics at 5 decimals, minutes, time."""
    numbers = [F.coalesce(F.format_string("%.5f", F.col(c)), F.lit("None")) for c in metric_columns(task)]
    minutes = F.when(F.col("minutes").isNull(), F.lit("None")).otherwise(F.format_string("%.1f", F.col("minutes")))
    when = F.date_format("finished_at", "yyyy-MM-dd HH:mm:ss")
    return F.concat_ws("  ", F.format_string("%02d", F.col("epoch")), *numbers, minutes, when)


def write_history(history: DataFrame, path: str, run: str = "") -> None:
    """Write rows under ``path`` by run and epoch; a run's epoch that is there already is replaced, all else stays.

    So an epoch can be written as it ends, a repeated write adds nothing, and a run that fails leaves what it reported.
    """
    rows = history.withColumn("run", F.lit(run or "run")).withColumn("of_epoch", F.col("epoch"))
    rows.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        "run", "of_epoch").parquet(path)


def read_history(spark: SparkSession, path: str, task: int = CLASSIFICATION, run: str | None = None) -> DataFrame:
    """``run`` and the columns of the history; of one run if it is given."""
    rows = spark.read.schema(f"{history_schema(task)}, run string, of_epoch int").parquet(path).drop("of_epoch")
    return rows if run is None else rows.where(F.col("run") == run)
