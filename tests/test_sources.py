import glob
import os

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from pairloom.config import FMConfig, ModelMeta
from pairloom.operators.examples import assign_shard, default_slots, slot_labels
from pairloom.operators.params import init_params
from pairloom.plans import job
from pairloom.plans.scratch import scratch_root, write_table
from pairloom.sources.history import history_line, write_history
from pairloom.sources.libsvm import libsvm_lines, parse_libsvm, read_libsvm, write_libsvm
from pairloom.sources.model_text import read_params_text, write_params_text
from pairloom.sources.vocabulary import build_vocabulary, field_tokens, indexed_examples, text_tokens
from test_training import frame, random_rows


def test_libsvm_text(spark, tmp_path):
    (tmp_path / "in.txt").write_text("1 1:1 3:1\n\n# note\n-1 2:1 4:0.5\n0 1:1 2:0\n0.5\n")
    rows = read_libsvm(spark, str(tmp_path / "in.txt")).orderBy("example_id").collect()
    assert [(r.label, r.indices, r["values"]) for r in rows] == [
        (1.0, [1, 3], [1.0, 1.0]), (-1.0, [2, 4], [1.0, 0.5]), (0.0, [1], [1.0]), (0.5, [], [])
    ]


@pytest.mark.parametrize("bad", ["1 3:1 2:1", "1 2:1 2:1", "1 0:1", "1 a:1"])
def test_libsvm_errors(spark, bad):
    lines = spark.createDataFrame([(1, bad)], "example_id long, value string")
    with pytest.raises(PySparkException):
        parse_libsvm(lines).collect()


def test_libsvm_round_trip_and_builtin_reader(spark, tmp_path):
    rows = [r for r in random_rows(3, one_hot=False) if r[2]]
    path = str(tmp_path / "out")
    write_libsvm(frame(spark, rows), path)
    back = sorted((r.label, r.indices, r["values"]) for r in read_libsvm(spark, path).collect())
    assert back == sorted((y, [j for j, _ in row], [x for _, x in row]) for _, y, row in rows)
    builtin = spark.read.format("libsvm").option("numFeatures", 12).load(path).collect()
    assert back == sorted((r.label, (r.features.indices + 1).tolist(), r.features.values.tolist()) for r in builtin)
    assert libsvm_lines(frame(spark, [(1, 1.0, [(1, 1.0), (3, 2.5)])])).first().value == "1 1:1 3:2.5"


@pytest.mark.parametrize("k0,k1", [(True, True), (True, False), (False, True), (False, False)])
def test_export_and_read_back(spark, tmp_path, k0, k1):
    params = init_params(spark, 50, FMConfig(k2=3, k0=k0, k1=k1))
    path = str(tmp_path / "model")
    for _ in range(2):
        write_params_text(params, path, k0=k0)
    files = sorted(f for f in glob.glob(f"{path}/part-*") if os.path.getsize(f))
    lines = [line for f in files for line in open(f).read().splitlines()]
    assert len(glob.glob(f"{path}/part-*")) <= 30 and len(files) > 5
    linear = [f"w_{j}" for j in range(0, 51)] if k1 else ["w_0"]
    assert [line.split(" ")[0] for line in lines] == linear + [f"v_{j}" for j in range(1, 51)]
    back = {r.j: (r.w, r.v) for r in read_params_text(spark, path).collect()}
    want = {r.j: (r.w, r.v) for r in params.collect()}
    assert back == {0: (0.0, []), **want}


def test_vocabulary_numbers_tokens_in_order(spark):
    words = [f"t{(i * 7919) % 1000:04d}" for i in range(1000)]
    tokens = spark.createDataFrame([(w,) for w in words + words[:300]], "token string").repartition(9)
    vocabulary = build_vocabulary(tokens)
    assert vocabulary.size == 1000
    got = {r.token: r.j for r in vocabulary.frame.collect()}
    assert got == {w: n for n, w in enumerate(sorted(words), 1)}


@pytest.mark.parametrize("limit", [1 << 26, 0])
def test_examples_from_fields_and_texts(spark, limit):
    table = spark.createDataFrame([(1, "a", 5, 1.0), (2, "b", 5, 0.0)], "id long, c string, n int, y double")
    tokens = field_tokens(table, F.col("id"), F.col("y"), {"c": F.col("c"), "n": F.col("n")})
    rows = indexed_examples(tokens, build_vocabulary(tokens), limit).orderBy("example_id").collect()
    assert [(r.label, r.indices, r["values"]) for r in rows] == [(1.0, [1, 3], [1.0, 1.0]), (0.0, [2, 3], [1.0, 1.0])]
    texts = spark.createDataFrame([(1, "B a\n b", 1.0), (2, " ", 0.0)], "id long, t string, y double")
    tokens = text_tokens(texts, F.col("id"), F.col("y"), F.col("t"))
    vocabulary = build_vocabulary(tokens.where(F.col("token").isNotNull()))
    rows = indexed_examples(tokens, vocabulary, limit).orderBy("example_id").collect()
    assert [(r.indices, r["values"]) for r in rows] == [([1, 2], [1.0, 2.0]), ([], [])]


def test_slots_are_balanced(spark):
    labels = slot_labels(spark, 16)
    assert len(set(labels)) == 16
    placed = assign_shard(spark.range(1600).select(F.col("id").alias("example_id")), 64, 16)
    sizes = placed.groupBy(F.spark_partition_id()).count().collect()
    assert sorted(r["count"] for r in sizes) == [100] * 16
    hashed = assign_shard(spark.range(0, 160000, 64).select(F.col("id").alias("example_id")), 64, 16, method="hash")
    assert hashed.select("shard").distinct().count() > 48
    assert default_slots(spark, 3) == 3


def test_scratch_is_the_shared_folder(spark, tmp_path):
    assert scratch_root(spark) == spark.conf.get("spark.checkpoint.dir")
    table = write_table(spark.range(5), str(tmp_path / "t"))
    assert table.count() == 5


def test_config_and_meta_checks(spark):
    for bad in (
        {"task": 2}, {"optimizer": "ftrl"}, {"k2": 0}, {"num_shards": 0}, {"epochs": -1}, {"reg": (0, 1)},
        {"residual": "other"}, {"eval_every": 0},
    ):
        with pytest.raises(ValueError):
            FMConfig(**bad)
    assert FMConfig(optimizer="ADAM").optimizer == "adam"
    with pytest.raises(ValueError):
        ModelMeta(1, True, True, 2, 0)
    meta = ModelMeta(0, True, False, 2, 7, -1.0, 1.0)
    assert ModelMeta.from_frame(meta.frame(spark)) == meta


def test_job(spark, tmp_path):
    train, valid = random_rows(1, n=60), random_rows(2, n=30)
    write_libsvm(frame(spark, train), str(tmp_path / "train"))
    write_libsvm(frame(spark, valid), str(tmp_path / "valid"))
    cfg = job.job_config(2, "Adam", 0.05).with_(num_shards=4)
    assert job.job_config(500, "sgd", 0.1).epochs == 500
    result = job.run_job(
        spark, str(tmp_path / "train"), str(tmp_path / "valid"), str(tmp_path / "model"), cfg, str(tmp_path / "history")
    )
    sizes = {r.split: r.n_total for r in result.description.collect()}
    assert sizes == {"train": 60, "valid": 30}
    assert result.samples.count() == 6
    means = {r.split: r for r in result.final_means.collect()}
    last = result.model.history.orderBy(F.desc("epoch")).first()
    assert means["train"].pos_mean == pytest.approx(last.train_pos_mean, abs=1e-12)
    assert means["valid"].neg_mean == pytest.approx(last.valid_neg_mean, abs=1e-12)
    assert read_params_text(spark, str(tmp_path / "model")).count() == result.model.meta.n_features + 1
    assert spark.read.parquet(str(tmp_path / "history")).count() == 3
    write_history(result.model.history, str(tmp_path / "history"), "second")
    assert spark.read.parquet(str(tmp_path / "history")).count() == 6
    line = result.model.history.orderBy("epoch").select(history_line(1).alias("line")).first().line
    assert line.startswith("00  ") and "None" in line
