"""Numeric column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def gaussian(seed: int, j: str, name: str) -> Column:
    """Standard normal draw that depends only on ``(seed, j, name)``.

    Two 32-bit uniforms come from one md5 digest and go through Box-Muller, so
    the value is the same for every partitioning, retry and engine. ``j`` is
    the name of the column with the feature number.
    """
    digest = f"md5(concat_ws('|', '{seed}', cast({j} AS string), '{name}'))"
    u1, u2 = (f"cast(conv(substr({digest}, {start}, 8), 16, 10) AS double)" for start in (1, 9))
    return F.expr(f"sqrt(-2D * ln(({u1} + 1D) / 4294967297D)) * cos(2D * pi() * {u2} / 4294967296D)")


def logistic(z: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def clip(z: Column, low: float, high: float) -> Column:
    return F.greatest(F.least(z, F.lit(float(high))), F.lit(float(low)))


# Bound that keeps the logarithms of the log-loss finite.
PROBABILITY_FLOOR = 1e-15


def negative_log_likelihood(positive: Column, score: Column) -> Column:
    """-ln p for a positive row, -ln(1 - p) for a negative one, p clamped."""
    p = clip(score, PROBABILITY_FLOOR, 1.0 - PROBABILITY_FLOOR)
    return -F.log(F.when(positive, p).otherwise(F.lit(1.0) - p))

