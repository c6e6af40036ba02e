"""The complete job: load, describe, train, predict, export."""

from __future__ import annotations

import argparse
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.config import FMConfig
from pairloom.operators.describe import describe
from pairloom.operators.evaluation import class_means
from pairloom.operators.examples import binarise_label, preview
from pairloom.plans.fit import FMModel, fit
from pairloom.plans.scratch import new_run_dir, remove, scratch_scope, write_table
from pairloom.sources.history import history_line
from pairloom.sources.libsvm import read_libsvm
from pairloom.sources.model_text import write_params_text


@dataclass(frozen=True)
class JobResult:
    model: FMModel
    description: DataFrame
    samples: DataFrame
    final_means: DataFrame


def job_config(epochs: int, optimizer: str, step_size: float, num_shards: int = 256) -> FMConfig:
    """Settings of the job: classification, 8 factors, L2 on the factors only, shards by a hash of the position."""
    return FMConfig(
        task=1, optimizer=optimizer, step_size=step_size, epochs=epochs,
        k0=True, k1=True, k2=8, reg=(0.0, 0.0, 0.001), init_std=0.1, num_shards=num_shards,
        shard_method="hash",
    )


def run_job(
    spark: SparkSession, train_path: str, valid_path: str, export_path: str, cfg: FMConfig,
    history_path: str | None = None, on_epoch: Callable[[dict], None] | None = None, run: str = "",
    on_description: Callable[[DataFrame, DataFrame], None] | None = None,
) -> JobResult:
    """Train from libsvm files and export the parameters as text.

    The text is parsed once, into columnar tables that every later pass reads. The data are described before training
    begins (``on_description`` receives samples and description); each epoch's metrics are written to
    ``history_path`` as it ends. Of the scratch tables, only the model's parameters stay; a failed run leaves none.
    """
    results = new_run_dir(spark, "job-results")
    with scratch_scope(spark) as scratch:
        keep = []
        try:
            parsed = new_run_dir(spark, "job")
            train = write_table(binarise_label(read_libsvm(spark, train_path)), f"{parsed}/train")
            valid = write_table(binarise_label(read_libsvm(spark, valid_path)), f"{parsed}/valid")
            both = train.withColumn("split", F.lit("train")).unionByName(valid.withColumn("split", F.lit("valid")))
            # A few rows each, stored as they outlive the tables they come from.
            description = write_table(describe(both).coalesce(1), f"{results}/description")
            samples = write_table(preview(train).unionByName(preview(valid)).coalesce(1), f"{results}/samples")
            if on_description is not None:
                on_description(samples, description)
            model = fit(train, valid, cfg, on_epoch=on_epoch, history_path=history_path, run=run)
            means = write_table(class_means(model.predict(both)).coalesce(1), f"{results}/means")
            write_params_text(model.params, export_path, k0=cfg.k0)
            keep += [f for f in scratch.folders if "/pairloom-fit-" in f]
            return JobResult(model=model, description=description, samples=samples, final_means=means)
        except BaseException:
            remove(spark, results)
            raise
        finally:
            scratch.remove(*keep)


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Train a factorization machine on libsvm files.")
    parser.add_argument("date", help="name of the run in the history")
    parser.add_argument("epochs", type=int)
    parser.add_argument("optimizer", help="sgd, adam or rmsprop")
    parser.add_argument("step_size", type=float)
    parser.add_argument("--train", required=True)
    parser.add_argument("--valid", required=True)
    parser.add_argument("--export", required=True)
    parser.add_argument("--history")
    parser.add_argument("--shards", type=int, default=256)
    args = parser.parse_args(argv)
    cfg = job_config(args.epochs, args.optimizer, args.step_size, args.shards)
    spark = (
        SparkSession.builder.appName("pairloom")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    print(f"run {args.date}: {cfg}")

    def described(samples: DataFrame, description: DataFrame) -> None:
        samples.show(truncate=80)
        description.show()

    result = run_job(
        spark, args.train, args.valid, args.export, cfg, args.history, on_epoch=print, run=args.date, on_description=described)
    for row in result.model.history.orderBy("epoch").select(history_line(cfg.task).alias("line")).toLocalIterator():
        print(row.line)
    result.final_means.show()


if __name__ == "__main__":
    main()
