"""The training loop."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from pairloom.config import REGRESSION, FMConfig, ModelMeta
from pairloom.operators.describe import check_dimension, check_examples, feature_dim, label_range
from pairloom.operators.evaluation import metrics
from pairloom.operators.examples import (
    assign_shard, binarise_label, number_steps, shard_weights, spread_for_scoring, wide_form, with_shard_rows,
)
from pairloom.operators.local_epoch import local_epoch, needed_features, plan_runs, rows_per_file, walk_slots
from pairloom.operators.params import add_state, health_columns, init_params
from pairloom.operators.scoring import SLOT_VALUES, fits_broadcast, score, wanted_features
from pairloom.plans.scratch import new_run_dir, scratch_scope
from pairloom.plans.session import settings
from pairloom.sources.history import history_schema, metric_columns, write_history

HEALTH_SCHEMA = "epoch int, n_values long, n_nan long, min_value double, max_value double"


@dataclass(frozen=True)
class FMModel:
    """A trained model: parameters, description, training history, and the parameters' health after each epoch."""

    params: DataFrame
    meta: ModelMeta
    history: DataFrame
    health: DataFrame

    def predict(self, examples: DataFrame, **how) -> DataFrame:
        """Scores of wide examples or of rows with vectors; ``unseen`` says what unknown features do (see ``score``)."""
        return score(wide_form(examples), self.params, self.meta, **how)


class ParamStore:
    """Parameters between epochs, in two alternating tables of one run folder.

    Writing cuts the lineage; the table being read is never the one being
    written, so a lost executor can always recompute from complete data, and
    a run leaves at most two copies however many epochs it has.
    """

    def __init__(self, spark) -> None:
        self._spark = spark
        self.folder = new_run_dir(spark, "fit")
        self.health: list[tuple] = []

    def save(self, params: DataFrame, epoch: int) -> DataFrame:
        seen = Observation()
        path = f"{self.folder}/slot{epoch % 2}"
        params.observe(seen, *health_columns()).write.mode("overwrite").parquet(path)
        found = seen.get
        self.health.append((epoch, found["n_values"], found["n_nan"], found["min_value"], found["max_value"]))
        if found["n_nan"]:
            raise ValueError(f"a parameter is NaN after epoch {epoch}")
        return self._spark.read.schema(params.schema).parquet(path)


def _placed(train: DataFrame, valid: DataFrame, cfg: FMConfig, slots: int) -> tuple[DataFrame, int]:
    """Both sets with ``split``, placed by slot and numbered, ready for every epoch; and the number of their non-zeros with a bias."""
    both = wide_form(train).withColumn("split", F.lit("train")).unionByName(
        wide_form(valid).withColumn("split", F.lit("valid")), allowMissingColumns=True
    )
    labelled = both if cfg.task == REGRESSION else binarise_label(both)
    columns = labelled.select("split", "example_id", F.col("label").cast("double"), "indices", "values")
    weights = shard_weights(columns, cfg.num_shards, cfg.shard_method)
    placed = assign_shard(columns, cfg.num_shards, slots, cfg.shard_method, weights)
    stepped = number_steps(placed)
    ready = with_shard_rows(stepped) if cfg.counts_steps else stepped
    return ready.persist(StorageLevel.MEMORY_AND_DISK), sum(weights)


def _by_feature(asked: DataFrame) -> DataFrame:
    """Placed by feature, so that each epoch's join moves the parameters only."""
    return asked.repartition(int(asked.sparkSession.conf.get("spark.sql.shuffle.partitions")), "j")


def _metric_row(examples: DataFrame, params: DataFrame, meta: ModelMeta, cfg: FMConfig, wanted, slots: int) -> dict:
    """Metrics of both sets from one job."""
    scored = score(examples, params, meta, limit_bytes=cfg.broadcast_limit_bytes, wanted=wanted, slots=slots)
    rows = {row["split"]: row.asDict() for row in metrics(scored, meta).collect()}
    found = {}
    for column in metric_columns(meta.task):
        split, _, name = column.partition("_")
        found[column] = rows.get(split, {}).get(name)
    return found


def fit(
    train: DataFrame,
    valid: DataFrame,
    cfg: FMConfig,
    *,
    params: DataFrame | None = None,
    n_features: int | None = None,
    on_epoch: Callable[[dict], None] | None = None,
    history_path: str | None = None,
    run: str = "",
) -> FMModel:
    """Train on wide examples, or rows ``example_id, label, features`` with vectors; ``params`` may give a start other than random.

    Per epoch: every shard trains from the same parameters over its own rows
    in id order, the changes are averaged, and both sets are evaluated. Rows
    are not reshuffled between epochs and the step size stays constant.
    ``on_epoch`` receives the metrics of each reported epoch as it ends, and ``history_path`` its row, under the name
    ``run``. Tables written on the way are removed at the end, also of a failure, but for the parameters of the model.
    """
    with settings(train.sparkSession), scratch_scope(train.sparkSession) as scratch:
        keep = []
        try:
            return _fit(train, valid, cfg, params, n_features, on_epoch, history_path, run, keep)
        finally:
            scratch.remove(*keep)


def _fit(train, valid, cfg, params, n_features, on_epoch, history_path, run, keep) -> FMModel:
    spark = train.sparkSession
    slots = cfg.slots or walk_slots(wide_form(train), cfg)
    held = []
    try:
        both, n_values = _placed(train, valid, cfg, slots)
        train = both.where(F.col("split") == "train")
        needed = _by_feature(needed_features(train, cfg)).persist(StorageLevel.MEMORY_AND_DISK)
        held = [both, needed]
        check_examples(train, cfg)
        n = n_features or feature_dim(train)
        low, high = label_range(train).first() if cfg.task == REGRESSION else (None, None)
        meta = ModelMeta.of(cfg, n, low, high)
        if n_features:
            check_dimension(train, meta)
        # Shards bind training to their slots, but not scoring.
        tasks = cfg.score_tasks or max(slots, spark.sparkContext.defaultParallelism, -(-n_values // SLOT_VALUES))
        scoring_rows = both
        if tasks > slots:
            scoring_rows = spread_for_scoring(both, tasks).persist(StorageLevel.MEMORY_AND_DISK)
            held.append(scoring_rows)
        wanted = None
        if not fits_broadcast(meta, cfg.broadcast_limit_bytes):
            wanted = _by_feature(wanted_features(scoring_rows, meta)).persist(StorageLevel.MEMORY_AND_DISK)
            held.append(wanted)
        runs = plan_runs(train, needed, cfg, rows_per_file(cfg))
        if runs[1] > 1:
            held.append(runs[0].persist(StorageLevel.MEMORY_AND_DISK))
        store = ParamStore(spark)
        start = params if params is not None else init_params(spark, n, cfg)
        current = store.save(add_state(start, cfg), 0)

        lines = []

        def report(epoch: int, begin: float | None) -> None:
            found = _metric_row(scoring_rows, current, meta, cfg, wanted, max(tasks, slots))
            minutes = None if begin is None else (time.monotonic() - begin) / 60.0
            lines.append((epoch, *found.values(), minutes, datetime.now()))
            if history_path is not None:
                write_history(spark.createDataFrame(lines[-1:], history_schema(cfg.task)), history_path, run)
            if on_epoch is not None:
                on_epoch({"epoch": epoch, **found, "minutes": minutes})

        report(0, None)
        for epoch in range(1, cfg.epochs + 1):
            begin = time.monotonic()
            updated = local_epoch(train, current, meta, cfg, slots=slots, needed=needed, runs=runs, epoch=epoch)
            current = store.save(updated, epoch)
            if epoch % cfg.eval_every == 0 or epoch == cfg.epochs:
                report(epoch, begin)
        history = spark.createDataFrame(lines, history_schema(cfg.task))
        keep.append(store.folder)
        health = spark.createDataFrame(store.health, HEALTH_SCHEMA)
        return FMModel(current.select("j", "w", "v"), meta, history, health)
    finally:
        for df in held:
            df.unpersist()
