"""Gradient of the loss over a whole set of examples."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.config import FMConfig, ModelMeta
from pairloom.operators.scoring import score


def residuals(examples: DataFrame, params: DataFrame, meta: ModelMeta, **how) -> DataFrame:
    """Scored examples with factor sums and ``residual`` = score - label."""
    scored = score(examples, params, meta, keep_sums=True, **how)
    return scored.withColumn("residual", F.col("score") - F.col("label"))


def gradient(sharded: DataFrame, params: DataFrame, meta: ModelMeta, cfg: FMConfig, **how) -> DataFrame:
    """``j, gw, gv`` summed over the rows in which ``j`` is active.

    The L2 term counts once per such row, as in the per-row step. Only sums
    that need no parameter are aggregated per feature; the parameters are
    joined afterwards, to one row per feature.
    """
    k2 = meta.k2
    # The non-zeros come along through the aggregation per example, so examples are read once and joined with nothing.
    scored = residuals(sharded, params, meta, keep_pairs=True, **how)
    long = scored.select("residual", *[f"s_{f}" for f in range(k2)], F.inline_outer("pairs")).where(F.col("j").isNotNull())
    per_feature = long.withColumn("xm", F.expr("x * residual")).groupBy("j").agg(
        F.expr("sum(xm) AS xm"),
        F.expr("sum(x * xm) AS xxm"),
        F.expr("cast(count(*) AS double) AS n_rows"),
        *[F.expr(f"sum(s_{f} * xm) AS sxm_{f}") for f in range(k2)],
    )
    r0, r1, r2 = (f"{r!r}D" for r in cfg.reg)
    gv = ", ".join(f"sxm_{f} - get(v, {f}) * xxm + {r2} * get(v, {f}) * n_rows" for f in range(k2))
    return per_feature.join(params.select("j", "w", "v"), "j").selectExpr(
        "j",
        f"xm + if(j = 0, {r0}, {r1}) * w * n_rows AS gw",
        f"if(j = 0, cast(array() AS array<double>), array({gv})) AS gv",
    )
