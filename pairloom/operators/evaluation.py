"""Log-loss, AUC and mean score per class of scored examples."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pairloom.config import CLASSIFICATION, ModelMeta
from pairloom.functions.math import negative_log_likelihood
from pairloom.operators.examples import positive

_SUMS = ("n_pos", "n_neg", "twice_u", "nll", "pos_score", "neg_score")
_PARTIAL_SCHEMA = "split string, first_score double, " + ", ".join(f"{c} double" for c in _SUMS)


def _with_split(scored: DataFrame) -> DataFrame:
    return scored if "split" in scored.columns else scored.withColumn("split", F.lit("all"))


def log_loss(scored: DataFrame) -> DataFrame:
    """``split, n_rows, log_loss``"""
    loss = negative_log_likelihood(positive(F.col("label")), F.col("score"))
    return _with_split(scored).groupBy("split").agg(F.count("*").alias("n_rows"), F.avg(loss).alias("log_loss"))


def class_means(scored: DataFrame) -> DataFrame:
    """``split, n_pos, n_neg, pos_mean, neg_mean``; the mean of an empty class is NULL."""
    is_pos = positive(F.col("label"))
    return _with_split(scored).groupBy("split").agg(
        F.count_if(is_pos).alias("n_pos"),
        F.count_if(~is_pos).alias("n_neg"),
        F.avg(F.when(is_pos, F.col("score"))).alias("pos_mean"),
        F.avg(F.when(~is_pos, F.col("score"))).alias("neg_mean"),
    )


def _runs(keys: np.ndarray) -> list[tuple[int, int]]:
    """Start and end of each run of equal keys."""
    starts = np.r_[0, np.flatnonzero(keys[1:] != keys[:-1]) + 1]
    return list(zip(starts, np.r_[starts[1:], len(keys)]))


def _partition_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per split of a sorted partition of distinct scores.

    ``twice_u`` counts, doubled, the (positive, negative) pairs inside the
    partition that are in the right order, a tie as half.
    """
    rows: dict[str, list[float]] = {}
    for batch in batches:
        if batch.num_rows == 0:
            continue
        split = batch.column("split").to_numpy(zero_copy_only=False)
        pos, neg, score, nll = (
            batch.column(c).to_numpy().astype(float) for c in ("n_pos", "n_neg", "score", "nll")
        )
        for a, b in _runs(split):
            row = rows.setdefault(split[a], [score[a]] + [0.0] * len(_SUMS))
            p, n, s = pos[a:b], neg[a:b], score[a:b]
            below = row[2] + np.cumsum(n) - n
            for i, amount in enumerate((p.sum(), n.sum(), p @ (2.0 * below + n), nll[a:b].sum(), p @ s, n @ s)):
                row[i + 1] += amount
    columns = list(zip(*([name, *row] for name, row in rows.items()))) or [()] * (2 + len(_SUMS))
    names = ["split", "first_score", *_SUMS]
    types = [pa.string()] + [pa.float64()] * (1 + len(_SUMS))
    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)


def evaluate(scored: DataFrame) -> DataFrame:
    """``split, n_pos, n_neg, log_loss, auc, pos_mean, neg_mean`` in one pass.

    Rows collapse to one per distinct score first, so a score that many rows
    share costs no more than any other. The distinct scores are range-sorted;
    each partition reduces to one row per split, and only those rows (as many
    as there are partitions) meet to add the negatives of lower partitions.
    AUC is exact, ties count half, and it is NULL when a class is missing.
    """
    is_pos = positive(F.col("label"))
    counts = _with_split(scored).groupBy("split", "score").agg(
        F.count_if(is_pos).alias("n_pos"), F.count_if(~is_pos).alias("n_neg")
    )
    loss = F.col("n_pos") * negative_log_likelihood(F.lit(True), F.col("score")) + F.col(
        "n_neg"
    ) * negative_log_likelihood(F.lit(False), F.col("score"))
    partials = (
        counts.withColumn("nll", loss)
        .repartitionByRange("split", "score")
        .sortWithinPartitions("split", "score")
        .mapInArrow(_partition_sums, _PARTIAL_SCHEMA)
    )
    lower = Window.partitionBy("split").orderBy("first_score").rowsBetween(Window.unboundedPreceding, -1)
    below = F.coalesce(F.sum("n_neg").over(lower), F.lit(0.0))
    totals = (
        partials.withColumn("twice_u", F.col("twice_u") + F.lit(2.0) * F.col("n_pos") * below)
        .groupBy("split")
        .agg(*[F.sum(c).alias(c) for c in _SUMS])
        .alias("totals")
    )
    return totals.selectExpr(
        "split",
        "cast(n_pos AS long) AS n_pos",
        "cast(n_neg AS long) AS n_neg",
        "try_divide(nll, totals.n_pos + totals.n_neg) AS log_loss",
        "try_divide(twice_u, 2D * totals.n_pos * totals.n_neg) AS auc",
        "try_divide(pos_score, totals.n_pos) AS pos_mean",
        "try_divide(neg_score, totals.n_neg) AS neg_mean",
    )


def auc(scored: DataFrame) -> DataFrame:
    """``split, n_pos, n_neg, auc``"""
    return evaluate(scored).select("split", "n_pos", "n_neg", "auc")


def regression_metrics(scored: DataFrame) -> DataFrame:
    """``split, n_rows, rmse, mae``"""
    error = F.col("score") - F.col("label")
    return _with_split(scored).groupBy("split").agg(
        F.count("*").alias("n_rows"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.avg(F.abs(error)).alias("mae"),
    )


def metrics(scored: DataFrame, meta: ModelMeta) -> DataFrame:
    return evaluate(scored) if meta.task == CLASSIFICATION else regression_metrics(scored)
