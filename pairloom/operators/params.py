"""Model parameters as a table: one row per feature.

``j int, w double, v array<double>``. Row ``j = 0`` is the bias (``w`` = w0,
``v`` empty). Optimizer state sits in further columns, ``m_w, m_v, s_w, s_v``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.config import FMConfig
from pairloom.functions.math import gaussian


def _no_factors() -> Column:
    return F.array().cast("array<double>")


def init_params(spark: SparkSession, n_features: int, cfg: FMConfig) -> DataFrame:
    """w and V from N(0, init_std^2), bias 0; absent terms are not stored."""
    j = F.col("j")
    std = F.lit(float(cfg.init_std))
    v = F.array(*[gaussian(cfg.seed, "j", f"v{f}") * std for f in range(cfg.k2)])
    w = gaussian(cfg.seed, "j", "w") * std if cfg.k1 else F.lit(None).cast("double")
    rows = spark.range(0 if cfg.k0 else 1, n_features + 1).select(F.col("id").cast("int").alias("j"))
    return rows.select(
        "j",
        F.when(j == 0, F.lit(0.0)).otherwise(w).alias("w"),
        F.when(j == 0, _no_factors()).otherwise(v).alias("v"),
    )


def add_state(params: DataFrame, cfg: FMConfig) -> DataFrame:
    """Zero optimizer state for every parameter."""
    zeros = F.array_repeat(F.lit(0.0), F.size("v"))
    state = {}
    for slot in cfg.state_slots:
        state[f"{slot}_w"] = F.lit(0.0)
        state[f"{slot}_v"] = zeros
    return params.withColumns(state) if state else params


def bias(params: DataFrame) -> DataFrame:
    return params.where(F.col("j") == 0).select(F.col("w").alias("w0"))


def linear_weights(params: DataFrame) -> DataFrame:
    return params.where(F.col("j") > 0).select("j", "w")


def factors(params: DataFrame, k2: int) -> DataFrame:
    """``j, v_0 .. v_{k2-1}``"""
    return params.where(F.col("j") > 0).select("j", *[F.get("v", F.lit(f)).alias(f"v_{f}") for f in range(k2)])


def flat_values(params: DataFrame, n_features: int, k2: int) -> DataFrame:
    """Every stored number with its place in the flat order: V by feature, then w, then w0."""
    j, n = F.col("j").cast("long"), F.lit(n_features).cast("long")
    of_v = params.where(F.col("j") > 0).select(
        (j - 1).alias("before"), F.posexplode("v").alias("f", "value")
    ).select((F.col("before") * k2 + F.col("f")).alias("place"), "value")
    of_w = params.where(F.col("w").isNotNull()).select(
        F.when(F.col("j") > 0, n * k2 + j - 1).otherwise(n * k2 + n).alias("place"), F.col("w").alias("value")
    )
    return of_v.unionByName(of_w)


def param_health(params: DataFrame) -> DataFrame:
    """One row: count, NaN count, minimum and maximum over all stored numbers."""
    values = params.select(
        F.explode(F.concat(F.when(F.col("w").isNull(), _no_factors()).otherwise(F.array("w")), "v")).alias("value")
    )
    return values.agg(
        F.count("*").alias("n_values"),
        F.count_if(F.isnan("value")).alias("n_nan"),
        F.min("value").alias("min_value"),
        F.max("value").alias("max_value"),
    )


def param_edges(params: DataFrame, n_features: int, cfg: FMConfig, n: int = 20) -> DataFrame:
    """The first ``n`` numbers of the flat order and the ``n`` before its last one."""
    size = n_features * (cfg.k2 + 1 if cfg.k1 else cfg.k2) + (1 if cfg.k0 else 0)
    place = F.col("place")
    if not cfg.k1:
        # Without linear weights the bias follows V directly.
        flat = flat_values(params, n_features, cfg.k2).withColumn(
            "place", F.when(place > n_features * cfg.k2, F.lit(size - 1).cast("long")).otherwise(place)
        )
    else:
        flat = flat_values(params, n_features, cfg.k2)
    return flat.where((place < n) | ((place >= size - 1 - n) & (place < size - 1)))


def health_columns() -> list[Column]:
    """``n_values, n_nan, min_value, max_value`` over all stored numbers, as aggregates that can be observed in passing."""
    w, v, own = F.col("w"), F.col("v"), F.lit(1) - F.col("w").isNull().cast("int")
    nans = F.size("v") - F.size(F.array_remove(v, float("nan"))) + F.coalesce(F.isnan(w).cast("int"), F.lit(0))
    return [
        F.sum(F.size("v") + own).cast("long").alias("n_values"),
        F.sum(nans).cast("long").alias("n_nan"),
        F.min(F.least(w, F.array_min("v"))).alias("min_value"),
        F.max(F.greatest(w, F.array_max("v"))).alias("max_value"),
    ]
