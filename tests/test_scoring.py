import math

import numpy as np
import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

import reference
from pairloom.config import FMConfig, ModelMeta
from pairloom.operators import evaluation
from pairloom.operators.describe import check_dimension, describe, not_one_hot, unseen_features
from pairloom.operators.examples import assign_shard, binarise_label, preview, to_long, to_wide
from pairloom.operators.params import init_params, param_edges, param_health
from pairloom.operators.scoring import score
from test_training import N_FEATURES, WIDE, frame, random_rows


def brute_auc(rows):
    pos = [s for y, s in rows if y > 0]
    neg = [s for y, s in rows if y <= 0]
    if not pos or not neg:
        return None
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))


@pytest.mark.parametrize("k0,k1", [(True, True), (True, False), (False, True), (False, False)])
def test_score_equals_the_double_sum(spark, k0, k1):
    cfg = FMConfig(k2=3, k0=k0, k1=k1, init_std=0.7)
    meta = ModelMeta.of(cfg, N_FEATURES)
    params = init_params(spark, N_FEATURES, cfg).withColumn("w", F.when(F.col("j") == 0, 0.3).otherwise(F.col("w")))
    theta = {r.j: (r.w, np.array(r.v)) for r in params.collect()}
    rows = random_rows(1, one_hot=False)
    want = {i: reference.score_raw(theta, row, k0, k1) for i, _, row in rows}
    placed = assign_shard(frame(spark, rows), 4, 3)
    for examples, limit in ((frame(spark, rows), 1 << 26), (frame(spark, rows), 0), (placed, 1 << 26), (placed, 0)):
        got = {r.example_id: r for r in score(examples, params, meta, limit_bytes=limit).collect()}
        assert set(got) == set(want)
        for i, z in want.items():
            assert got[i].raw == pytest.approx(z, abs=1e-12)
            assert got[i].score == pytest.approx(1.0 / (1.0 + math.exp(-z)), abs=1e-12)


def test_example_without_features_and_unseen_feature(spark):
    cfg = FMConfig(k2=2)
    params = init_params(spark, 3, cfg).withColumn("w", F.when(F.col("j") == 0, 0.3).otherwise(F.col("w")))
    rows = [(1, 1.0, []), (2, 0.0, [(9, 1.0)]), (3, 0.0, [(2, 1.0), (9, 1.0)])]
    meta = ModelMeta.of(cfg, 3)
    for limit in (1 << 26, 0):
        got = {r.example_id: r.raw for r in score(frame(spark, rows), params, meta, limit_bytes=limit).collect()}
        assert got[1] == 0.3 and got[2] == 0.3
        assert got[3] == pytest.approx(0.3 + params.where("j = 2").first().w, abs=1e-15)
    with pytest.raises(ValueError, match="index 9"):
        check_dimension(frame(spark, rows), meta)
    assert [tuple(r) for r in unseen_features(frame(spark, rows), params).collect()] == [(9, 2)]


def test_regression_scores_stay_in_range(spark):
    cfg = FMConfig(task=0, k2=2, init_std=3.0)
    meta = ModelMeta.of(cfg, N_FEATURES, -0.5, 0.5)
    params = init_params(spark, N_FEATURES, cfg)
    for r in score(frame(spark, random_rows(2)), params, meta).collect():
        assert r.score == pytest.approx(min(max(r.raw, -0.5), 0.5))


@pytest.mark.parametrize("seed,n,distinct,parts", [(0, 300, 7, 1), (1, 500, 40, 5), (2, 400, 400, 16)])
def test_metrics_equal_brute_force(spark, seed, n, distinct, parts):
    rng = np.random.default_rng(seed)
    rows = [
        (int(i), float(rng.integers(0, 2)), float(rng.integers(1, distinct + 1)) / (distinct + 2), s)
        for i, s in enumerate(rng.choice(["train", "valid"], n, p=[0.8, 0.2]).tolist())
    ]
    scored = spark.createDataFrame(rows, "example_id long, label double, score double, split string").repartition(parts)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {r.split: r for r in evaluation.evaluate(scored).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    evaluator = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="label", numBins=0)
    for split in ("train", "valid"):
        own = [(y, s) for _, y, s, name in rows if name == split]
        r = got[split]
        assert r.auc == pytest.approx(brute_auc(own), abs=1e-12)
        assert r.auc == pytest.approx(evaluator.evaluate(scored.where(F.col("split") == split)), abs=1e-9)
        losses = [-math.log(s if y > 0 else 1 - s) for y, s in own]
        assert r.log_loss == pytest.approx(sum(losses) / len(losses), abs=1e-12)
        assert r.pos_mean == pytest.approx(np.mean([s for y, s in own if y > 0]), abs=1e-12)
        assert (r.n_pos, r.n_neg) == (sum(y > 0 for y, _ in own), sum(y <= 0 for y, _ in own))


def test_one_score_shared_by_all(spark):
    rows = spark.range(5000).select(
        F.col("id").alias("example_id"), (F.col("id") % 2).cast("double").alias("label"), F.lit(0.5).alias("score")
    )
    assert evaluation.evaluate(rows).first().auc == 0.5


def test_scores_of_zero_and_one_have_a_finite_loss(spark):
    schema = StructType([
        StructField("example_id", LongType()), StructField("label", DoubleType()), StructField("score", DoubleType())
    ])
    scored = spark.createDataFrame([(1, 1.0, 0.0), (2, 0.0, 1.0)], schema)
    assert math.isfinite(evaluation.evaluate(scored).first().log_loss)
    assert math.isfinite(evaluation.log_loss(scored).first().log_loss)


def test_describe(spark):
    rows = [(1, 1.0, [(3, 1.0)]), (2, 0.0, []), (3, 0.0, [(1, 1.0), (7, 2.0)])]
    r = describe(frame(spark, rows), by=None).first()
    assert (r.n_total, r.n_pos, r.n_features, r.n_nonzero) == (3, 1, 7, 3)
    assert (r.pos_percent, r.neg_per_pos) == (33.33, 2.0)
    none = describe(frame(spark, [(1, 0.0, [])]), by=None).first()
    assert none.neg_per_pos is None and none.n_features == 0
    assert [tuple(r) for r in not_one_hot(frame(spark, rows)).collect()] == [(3, 1)]


def test_labels_and_forms(spark):
    rows = [(1, -1.0, [(2, 1.0)]), (2, 3.0, [(1, 1.0), (4, 0.5)]), (3, 0.0, [(1, 1.0)])]
    labels = {r.example_id: r.label for r in binarise_label(frame(spark, rows)).collect()}
    assert labels == {1: 0.0, 2: 1.0, 3: 0.0}
    back = to_wide(to_long(frame(spark, rows)))
    assert {r.example_id: (r.indices, r.values) for r in back.collect()} == {
        i: ([j for j, _ in row], [x for _, x in row]) for i, _, row in rows
    }
    assert [r.example_id for r in preview(frame(spark, rows), 2).collect()] == [1, 2]


def test_parameter_order_and_health(spark):
    cfg = FMConfig(k2=2)
    params = init_params(spark, 30, cfg)
    table = {r.j: r for r in params.collect()}
    flat = [x for j in range(1, 31) for x in table[j].v] + [table[j].w for j in range(1, 31)] + [table[0].w]
    edges = {r.place: r.value for r in param_edges(params, 30, cfg).collect()}
    size = len(flat)
    assert edges == {i: flat[i] for i in [*range(20), *range(size - 21, size - 1)]}
    health = param_health(params).first()
    assert (health.n_values, health.n_nan) == (size, 0)
    assert (health.min_value, health.max_value) == (min(flat), max(flat))
    no_linear = FMConfig(k2=2, k1=False)
    table = {r.j: r for r in init_params(spark, 30, no_linear).collect()}
    flat = [x for j in range(1, 31) for x in table[j].v] + [0.0]
    edges = {r.place: r.value for r in param_edges(init_params(spark, 30, no_linear), 30, no_linear).collect()}
    assert edges == {i: flat[i] for i in [*range(20), *range(len(flat) - 21, len(flat) - 1)]}


def test_init_is_gaussian_and_repeatable(spark):
    cfg = FMConfig(k2=4, init_std=0.1, seed=3)
    values = np.array([r.v for r in init_params(spark, 3000, cfg).where("j > 0").collect()])
    assert abs(values.mean()) < 0.005 and abs(values.std() - 0.1) < 0.005
    assert abs(np.corrcoef(values.T) - np.eye(4)).max() < 0.1
    again = init_params(spark, 3000, cfg).repartition(7)
    assert init_params(spark, 3000, cfg).exceptAll(again).count() == 0


def test_wide_schema_is_kept(spark):
    assert frame(spark, random_rows(0)).schema.simpleString() == "struct<" + ",".join(
        f"{name}:{kind.replace('long', 'bigint')}" for name, kind in (part.split(" ") for part in WIDE.split(", "))
    ) + ">"
