"""Paths for large inputs give the results of the plain ones."""

import os

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from pairloom.config import FMConfig, ModelMeta
from pairloom.operators import local_epoch as le
from pairloom.operators.examples import assign_shard, fill_slots, from_vectors, number_steps, shard_weights
from pairloom.operators.gradient import gradient
from pairloom.operators.params import add_state, init_params
from pairloom.operators.scoring import score
from pairloom.plans.fit import fit
from pairloom.plans import job, queries
from pairloom.plans.scratch import new_run_dir, scratch_root, scratch_scope, write_table
from pairloom.sources.history import read_history, write_history
from pairloom.sources.libsvm import read_libsvm, write_libsvm
from pairloom.sources.model_text import read_params_text, write_params_text
from test_training import frame, random_rows


@pytest.fixture
def split_bytes(spark):
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)
    yield lambda n: spark.conf.set(name, str(n))
    spark.conf.set(name, before)


def libsvm_files(folder):
    """Three files of different length, with comments, blank lines and lines without features; labels number the examples."""
    n = 0
    folder.mkdir()
    for name, size in (("part-0", 150), ("part-1", 1), ("part-2", 60)):
        lines = []
        for i in range(size):
            if i % 7 == 3:
                lines += ["# note", "", "   "]
            lines.append(f"{n}" + "".join(f" {j}:1" for j in range(1 + n % 5, 9)) if n % 11 else f"{n}")
            n += 1
        (folder / name).write_text("\n".join(lines) + "\n")
    return n


def test_positions_do_not_depend_on_splits(spark, tmp_path, split_bytes):
    n = libsvm_files(tmp_path / "in")
    seen, splits = [], []
    for size in (100, 777, 128 << 20):
        split_bytes(size)
        rows = read_libsvm(spark, str(tmp_path / "in"))
        splits.append(spark.read.text(str(tmp_path / "in")).select(
            F.col("_metadata.file_path"), F.col("_metadata.file_block_start")).distinct().count())
        seen.append(sorted((r.example_id, r.label, r.indices) for r in rows.collect()))
    assert splits[0] > splits[1] > splits[2]
    assert seen[0] == seen[1] == seen[2]
    assert [(i, y) for i, y, _ in seen[0]] == [(i, float(i)) for i in range(n)]


def test_training_does_not_depend_on_splits(spark, tmp_path, split_bytes):
    libsvm_files(tmp_path / "in")
    cfg = FMConfig(epochs=1, k2=2, num_shards=3, reg=(0.0, 0.01, 0.01))
    found = []
    for size in (100, 128 << 20):
        split_bytes(size)
        rows = read_libsvm(spark, str(tmp_path / "in")).withColumn("label", F.col("label") % 2)
        params = fit(rows, rows, cfg).params
        found.append(sorted((r.j, r.w, *r.v) for r in params.collect()))
    assert found[0] == found[1]


def test_empty_libsvm(spark, tmp_path):
    (tmp_path / "none.txt").write_text("# nothing\n\n")
    assert read_libsvm(spark, str(tmp_path / "none.txt")).collect() == []


@pytest.mark.parametrize("optimizer, k0", [("sgd", True), ("adam", False), ("rmsprop", True)])
def test_runs_equal_an_unbroken_walk(spark, optimizer, k0, monkeypatch):
    cfg = FMConfig(optimizer=optimizer, k0=k0, k2=3, num_shards=5, step_size=0.1, reg=(0.01, 0.02, 0.03))
    meta = ModelMeta.of(cfg, 12)
    rows = frame(spark, random_rows(60))
    stepped = number_steps(assign_shard(rows, cfg.num_shards, 2)).persist()
    params = write_back(spark, add_state(init_params(spark, 12, cfg), cfg))
    whole = le.local_epoch(stepped, params, meta, cfg, slots=2).orderBy("j").collect()
    limited = cfg.with_(task_bytes=le.row_bytes_in_task(cfg) * 20)
    needed = le.needed_features(stepped, limited)
    numbered, runs = le.plan_runs(stepped, needed, limited)
    assert runs > 2
    # No run of a slot uses more rows than a task may hold, beyond those of its last step.
    used = le.needed_features(numbered, limited).join(
        numbered.select("slot", "shard", "run", F.explode_outer("indices").alias("j")), ["slot", "shard", "j"])
    widest = numbered.groupBy("slot", "run", "step").agg(F.sum(F.size("indices") + 1).alias("n")).agg(F.max("n")).first()[0]
    most = used.select("slot", "run", "shard", "j").distinct().groupBy("slot", "run").count().agg(F.max("count")).first()[0]
    assert most <= le.rows_per_task(limited) + widest
    split = le.local_epoch(stepped, params, meta, limited, slots=2).orderBy("j").collect()
    for a, b in zip(whole, split, strict=True):
        for x, y in zip(a, b):
            assert np.allclose(np.array(x if x is not None else 0, float), np.array(y if y is not None else 0, float), rtol=0, atol=1e-12)
    stepped.unpersist()


def write_back(spark, df):
    return write_table(df, new_run_dir(spark, "test"))


def test_vectors_become_examples(spark):
    rows = [(1, Vectors.sparse(9, [0, 4, 8], [1.0, 0.0, -2.0])), (2, Vectors.dense([0.0, 3.0, 0.0])), (3, Vectors.sparse(4, [], [])),
            (4, Vectors.dense([])), (5, None)]
    got = from_vectors(spark.createDataFrame(rows, ["example_id", "features"]))
    assert [(r.example_id, r.indices, r["values"]) for r in got.orderBy("example_id").collect()] == [
        (1, [1, 9], [1.0, -2.0]), (2, [2], [3.0]), (3, [], []), (4, [], []), (5, None, None)]
    assert "Python" not in got._jdf.queryExecution().executedPlan().toString()


def test_fit_and_predict_take_vectors(spark):
    rows = random_rows(20)
    wide = frame(spark, rows)
    vectors = spark.createDataFrame(
        [(i, y, Vectors.sparse(12, [j - 1 for j, _ in row], [x for _, x in row])) for i, y, row in rows],
        ["example_id", "label", "features"])
    cfg = FMConfig(epochs=1, k2=2, num_shards=2)
    a, b = fit(wide, wide, cfg, n_features=12), fit(vectors, vectors, cfg, n_features=12)
    scores = [sorted((r.example_id, round(r.score, 12)) for r in m.predict(x).collect()) for m, x in ((a, wide), (b, vectors))]
    assert scores[0] == scores[1]


@pytest.mark.parametrize("limit_bytes", [64 << 20, 0])
def test_unknown_features_error_or_nothing(spark, limit_bytes):
    cfg = FMConfig(k2=2)
    params, meta = init_params(spark, 3, cfg), ModelMeta.of(cfg, 3)
    rows = frame(spark, [(1, 1.0, [(1, 1.0), (3, 1.0)]), (2, 0.0, [(2, 1.0), (7, 1.0)]), (3, 0.0, [])])
    how = {"limit_bytes": limit_bytes}
    with pytest.raises(PySparkException, match="no parameters for feature 7"):
        score(rows, params, meta, unseen="error", **how).collect()
    fine = rows.where("example_id != 2")
    both = [sorted(map(tuple, score(fine, params, meta, unseen=u, **how).collect())) for u in ("error", "ignore")]
    assert both[0] == both[1] and len(both[0]) == 2
    assert score(rows, params, meta, **how).count() == 3
    with pytest.raises(ValueError):
        score(rows, params, meta, unseen="warn")


def test_gradient_reads_examples_once(spark):
    cfg = FMConfig(k2=2)
    path = write_back(spark, frame(spark, random_rows(30)))
    params = write_back(spark, init_params(spark, 12, cfg))
    sharded = assign_shard(path, 4, 2)
    plan = gradient(sharded, params, ModelMeta.of(cfg, 12), cfg)._jdf.queryExecution().executedPlan().toString()
    assert plan.split("Initial Plan")[-1].count("indices#") and plan.count("FileScan parquet") <= 3
    assert "SortMergeJoin" not in plan


def test_heavy_shards_are_spread(spark):
    rows = frame(spark, [(256 * i, 1.0, [(j, 1.0) for j in range(1, 2 + i % 9)]) for i in range(2000)])
    assert sum(w > 0 for w in shard_weights(rows, 64)) == 1
    weights = shard_weights(rows, 64, "hash")
    assert all(weights)
    loads = [0] * 8
    for shard, slot in enumerate(fill_slots(weights, 8)):
        loads[slot] += weights[shard]
    assert max(loads) <= 1.2 * sum(loads) / 8
    placed = assign_shard(rows, 64, 8, "hash", weights).groupBy("slot").agg(F.sum(F.size("indices") + 1).alias("n")).collect()
    assert sorted(r.n for r in placed) == sorted(loads)
    assert assign_shard(rows, 64, 8, "hash", weights).groupBy("shard").agg(F.count_distinct("slot").alias("n")).where("n > 1").isEmpty()


def test_history_by_run_and_epoch(spark, tmp_path):
    rows = frame(spark, random_rows(40))
    path = str(tmp_path / "history")
    cfg = FMConfig(epochs=3, k2=2, num_shards=2)

    def fail_in_second(found):
        if found["epoch"] == 2:
            raise RuntimeError("stop")

    with pytest.raises(RuntimeError):
        fit(rows, rows, cfg, n_features=12, history_path=path, run="2024-01-01", on_epoch=fail_in_second)
    assert sorted(r.epoch for r in read_history(spark, path).collect()) == [0, 1, 2]
    model = fit(rows, rows, cfg, n_features=12, history_path=path, run="2024-01-01")
    write_history(model.history, path, "2024-01-01")
    write_history(model.history, path, "other")
    read = read_history(spark, path, run="2024-01-01").drop("run").orderBy("epoch").collect()
    assert read == model.history.orderBy("epoch").collect()
    assert read_history(spark, path).count() == 8
    health = model.health.orderBy("epoch").collect()
    assert [r.epoch for r in health] == [0, 1, 2, 3] and all(r.n_values == 1 + 12 * 3 and r.n_nan == 0 for r in health)


def test_failed_export_leaves_the_earlier_one(spark, tmp_path):
    path = str(tmp_path / "model")
    params = write_back(spark, init_params(spark, 5, FMConfig(k2=2)))
    write_params_text(params, path, files=2)
    before = sorted(map(tuple, read_params_text(spark, path).collect()))
    broken = params.withColumn("w", F.when(F.col("j") == 4, F.raise_error(F.lit("bad")).cast("double")).otherwise(F.col("w")))
    with pytest.raises(PySparkException):
        write_params_text(broken, path, files=2)
    assert sorted(map(tuple, read_params_text(spark, path).collect())) == before
    write_params_text(params.where("j < 3"), path, files=2)
    assert read_params_text(spark, path).count() == 3
    assert os.listdir(tmp_path) == ["model"]


def test_scratch_folders_are_removed(spark, tmp_path):
    folder = scratch_root(spark).removeprefix("file:")
    listed = lambda: set(os.listdir(folder)) if os.path.isdir(folder) else set()
    write_libsvm(frame(spark, random_rows(1, n=60)), str(tmp_path / "train"))
    cfg = job.job_config(2, "adam", 0.05, 4).with_(task_bytes=5_000)
    before = listed()
    result = job.run_job(spark, str(tmp_path / "train"), str(tmp_path / "train"), str(tmp_path / "model"), cfg)
    left = {name.split("-")[1] for name in listed() - before}
    assert len(listed() - before) == 2 and left == {"fit", "job"}
    # What the result refers to can still be read.
    assert result.model.params.count() == result.model.meta.n_features + 1
    assert result.description.count() == 2 and result.final_means.count() == 2 and result.samples.count() == 6
    before = listed()
    (tmp_path / "bad.txt").write_text("1 3:1 2:1\n")
    with pytest.raises(PySparkException):
        job.run_job(spark, str(tmp_path / "train"), str(tmp_path / "bad.txt"), str(tmp_path / "model2"), cfg)
    assert listed() == before
    with scratch_scope(spark) as scope:
        kept, gone = new_run_dir(spark, "a"), new_run_dir(spark, "b")
        for path in (kept, gone):
            write_table(spark.range(3), path)
        scope.remove(kept)
    assert spark.read.parquet(kept).count() == 3 and not os.path.exists(gone.removeprefix("file:"))


def test_standard_adam_counts_the_steps_of_a_shard(spark):
    cfg = FMConfig(optimizer="adam", bias_correction="standard", k2=1, num_shards=1, step_size=0.1, reg=(0, 0, 0), k0=True)
    meta = ModelMeta.of(cfg, 1)
    rows = frame(spark, [(i, 1.0, []) for i in range(3)])
    params = add_state(init_params(spark, 1, cfg), cfg)
    sharded = number_steps(assign_shard(rows, 1, 1))
    for epoch in (1, 2):
        params = write_back(spark, le.local_epoch(sharded, params, meta, cfg, slots=1, epoch=epoch))
    w = m = s = 0.0
    for t in range(1, 7):
        g = 1 / (1 + np.exp(-w)) - 1.0
        m, s = 0.9 * m + 0.1 * g, 0.999 * s + 0.001 * g * g
        w -= 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(s / (1 - 0.999**t)) + 1e-8)
    assert params.where("j = 0").first().w == pytest.approx(w, abs=1e-12)
    with pytest.raises(ValueError):
        FMConfig(bias_correction="none")


def test_evaluation_has_more_tasks_than_shards(spark):
    from pairloom.operators.examples import spread_for_scoring

    rows = frame(spark, random_rows(80))
    metrics = []
    for tasks in (1, 6):
        for limit in (64 << 20, 0):
            cfg = FMConfig(epochs=1, k2=2, num_shards=1, slots=1, score_tasks=tasks, broadcast_limit_bytes=limit)
            history = fit(rows, rows, cfg, n_features=12).history.drop("minutes", "finished_at")
            metrics.append([[round(x, 10) for x in r] for r in history.orderBy("epoch").collect()])
    assert all(m == metrics[0] for m in metrics)
    placed = spread_for_scoring(assign_shard(rows, 1, 1), 6)
    assert placed.rdd.getNumPartitions() == 6 and "shard" not in placed.columns
    assert placed.groupBy(F.spark_partition_id()).agg(F.count_distinct("slot").alias("n")).where("n > 1").isEmpty()


def test_training_slots_follow_cores_and_memory(spark):
    examples = frame(spark, random_rows(1, 400))
    cfg = FMConfig(k2=3, num_shards=64)
    cores = spark.sparkContext.defaultParallelism
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "60")
    try:
        assert le.walk_slots(examples, cfg) == min(64, cores)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    # Tasks for so few parameter rows that more slots are needed, up to one a shard.
    assert cores < le.walk_slots(examples, cfg.with_(task_bytes=30 * le.row_bytes_in_task(cfg))) <= 64
    assert le.walk_slots(examples, cfg.with_(task_bytes=1)) == 64


def test_epochs_read_rows_placed_once(spark, sf_dir, monkeypatch):
    seen = []

    def spy(sharded, params, meta, cfg, **given):
        seen.append((sharded, given))
        assert "step" in sharded.columns and sharded.storageLevel.useMemory
        assert given["needed"].storageLevel.useMemory and given["runs"][1] == 1
        return le.local_epoch(sharded, params, meta, cfg, **given)

    monkeypatch.setattr(queries, "local_epoch", spy)
    queries.QUERIES["adam_two_epochs_standard"](spark, sf_dir).count()
    assert [given["epoch"] for _, given in seen] == [1, 2]
    assert seen[0][0] is seen[1][0] and seen[0][1]["needed"] is seen[1][1]["needed"]
    assert not seen[0][0].storageLevel.useMemory
