"""Dataset description and checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.config import FMConfig, ModelMeta
from pairloom.operators.examples import positive


def last_index(indices: str = "indices") -> Column:
    """Highest active index of a row; 0 for a row without features."""
    return F.coalesce(F.array_max(indices), F.lit(0))


def feature_dim(examples: DataFrame) -> int:
    """Number of features: the highest index in use. At least one is required."""
    n = examples.agg(F.max(last_index())).first()[0]
    if n is None or n <= 0:
        raise ValueError("the training data has no features")
    return int(n)


def label_range(examples: DataFrame) -> DataFrame:
    """One row ``label_min, label_max``."""
    return examples.agg(F.min("label").alias("label_min"), F.max("label").alias("label_max"))


def describe(examples: DataFrame, by: str | None = "split") -> DataFrame:
    """Per split: size, dimension, class counts and ratios, label range, non-zeros."""
    pos = F.count_if(positive(F.col("label")))
    total = F.count("*")
    grouped = examples.groupBy(by) if by else examples.groupBy()
    return grouped.agg(
        total.alias("n_total"),
        pos.alias("n_pos"),
        F.max(last_index()).alias("n_features"),
        F.sum(F.size("indices")).cast("long").alias("n_nonzero"),
        F.round(F.try_divide(pos.cast("double") * 100.0, total.cast("double")), 2).alias("pos_percent"),
        F.round(F.try_divide((total - pos).cast("double"), pos.cast("double")), 1).alias("neg_per_pos"),
        F.min("label").alias("label_min"),
        F.max("label").alias("label_max"),
    )


def shard_profile(sharded: DataFrame) -> DataFrame:
    """Per shard: rows, non-zeros, positives and distinct features.

    The distinct features are counted from one row per shard and feature, so
    a feature that many rows share is collapsed before anything moves.
    """
    rows = sharded.groupBy("slot", "shard").agg(
        F.count("*").alias("n_rows"),
        F.sum(F.size("indices")).cast("long").alias("n_nonzero"),
        F.count_if(positive(F.col("label"))).alias("n_pos"),
    )
    used = (
        sharded.select("slot", "shard", F.explode("indices").alias("j"))
        .distinct()
        .groupBy("slot", "shard")
        .agg(F.count("*").alias("n_distinct"))
    )
    joined = rows.join(used, ["slot", "shard"], "left")
    return joined.withColumn("n_distinct", F.coalesce("n_distinct", F.lit(0))).drop("slot")


def not_one_hot(examples: DataFrame) -> DataFrame:
    """Rows with a value other than 1.0, and how many such values they have."""
    bad = F.size(F.filter("values", lambda x: x != F.lit(1.0)))
    return examples.select("example_id", bad.alias("n_bad")).where(F.col("n_bad") > 0)


def unseen_features(examples: DataFrame, params: DataFrame) -> DataFrame:
    """Features of the examples that the model has no parameters for: ``j, n_rows``."""
    used = examples.select(F.explode("indices").alias("j")).groupBy("j").agg(F.count("*").alias("n_rows"))
    return used.join(params.select("j"), "j", "left_anti")


def beyond_dimension(examples: DataFrame, n_features: int) -> DataFrame:
    """Rows whose highest index exceeds the model's dimension."""
    return examples.select("example_id", last_index().alias("max_index")).where(F.col("max_index") > n_features)


def check_examples(examples: DataFrame, cfg: FMConfig) -> None:
    """Raise if the training set is empty or, for SGD, not one-hot."""
    if examples.isEmpty():
        raise ValueError("the training data is empty")
    if cfg.optimizer == "sgd":
        bad = not_one_hot(examples).select("example_id").head(1)
        if bad:
            raise ValueError(f"SGD needs every value to be 1.0; example {bad[0][0]} has others")


def check_dimension(examples: DataFrame, meta: ModelMeta) -> None:
    bad = beyond_dimension(examples, meta.n_features).head(1)
    if bad:
        raise ValueError(
            f"example {bad[0].example_id} has index {bad[0].max_index}, the model has {meta.n_features} features"
        )
