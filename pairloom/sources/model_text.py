"""The model as text lines: ``w_0 <w0>``, ``w_<j> <w>``, ``v_<j> <v1> .. <vk>``."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.functions.text import double_text
from pairloom.plans.scratch import remove, replace_folder

EXPORT_FILES = 30


def export_lines(params: DataFrame, digits: int | None = None, k0: bool = True) -> DataFrame:
    """``part, j, value``: linear weights (part 0, bias first), then embeddings (part 1).

    A model without bias (``k0`` off) still has its line, with the value 0.
    """
    if not k0:
        row = params.sparkSession.range(1).select(
            F.lit(0).alias("j"), F.lit(0.0).alias("w"), F.array().cast("array<double>").alias("v")
        )
        params = params.select("j", "w", "v").unionByName(row)
    j = F.col("j").cast("string")
    linear = params.where(F.col("w").isNotNull()).select(
        F.lit(0).alias("part"), "j",
        F.concat(F.lit("w_"), j, F.lit(" "), double_text(F.col("w"), digits)).alias("value"),
    )
    numbers = F.concat_ws(" ", F.transform("v", lambda x: double_text(x, digits)))
    embeddings = params.where(F.col("j") > 0).select(
        F.lit(1).alias("part"), "j", F.concat(F.lit("v_"), j, F.lit(" "), numbers).alias("value")
    )
    return linear.unionByName(embeddings)


def write_params_text(params: DataFrame, path: str, files: int = EXPORT_FILES, k0: bool = True) -> None:
    """Write the lines in order over ``files`` text files, replacing the target.

    They are written beside the target and take its place when complete, so a failed export leaves the earlier one.
    """
    lines = export_lines(params, k0=k0).repartitionByRange(files, "part", "j").sortWithinPartitions("part", "j")
    staged = f"{path.rstrip('/')}._new-{uuid.uuid4().hex}"
    try:
        lines.select("value").write.text(staged)
        replace_folder(params.sparkSession, staged, path)
    finally:
        remove(params.sparkSession, staged)


def read_params_text(spark: SparkSession, path: str) -> DataFrame:
    """Parameters from exported text."""
    parts = F.split("value", " ")
    name = F.split(parts[0], "_")
    numbers = F.transform(F.slice(parts, 2, F.size(parts) - 1), lambda x: x.cast("double"))
    rows = spark.read.text(path).select(name[0].alias("kind"), name[1].cast("int").alias("j"), numbers.alias("numbers"))
    w = F.max(F.when(F.col("kind") == "w", F.get("numbers", F.lit(0))))
    v = F.max(F.when(F.col("kind") == "v", F.col("numbers")))
    return rows.groupBy("j").agg(
        w.alias("w"), F.coalesce(v, F.array().cast("array<double>")).alias("v")
    )
