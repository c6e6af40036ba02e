import math

import numpy as np
import pytest
from pyspark.sql import functions as F

import reference
from pairloom.config import FMConfig, ModelMeta
from pairloom.operators.examples import assign_shard, split_examples
from pairloom.operators.gradient import gradient
from pairloom.operators.local_epoch import local_epoch, needed_features, number_steps
from pairloom.operators.params import add_state, init_params
from pairloom.operators.scoring import score
from pairloom.plans import datasets
from pairloom.plans.fit import fit

N_FEATURES = 12
WIDE = "example_id long, label double, indices array<int>, values array<double>"


def random_rows(seed, n=40, one_hot=True, ids=None):
    rng = np.random.default_rng(seed)
    rows = []
    for i in ids if ids is not None else range(n):
        size = int(rng.integers(0, 5))
        j = sorted(int(a) for a in rng.choice(np.arange(1, N_FEATURES), size, replace=False))
        x = [1.0 if one_hot else float(rng.normal()) for _ in j]
        rows.append((i, float(rng.integers(0, 2)), list(zip(j, x))))
    return rows


def frame(spark, rows):
    data = [(i, y, [j for j, _ in row], [x for _, x in row]) for i, y, row in rows]
    return spark.createDataFrame(data, WIDE)


def start_of(spark, cfg):
    params = init_params(spark, N_FEATURES, cfg)
    plain = {
        r.j: np.array([r.w or 0.0, *(r.v or [0.0] * cfg.k2)]) for r in params.collect()
    }
    return params, plain


def one_epoch(spark, rows, cfg, slots, meta=None):
    params, plain = start_of(spark, cfg)
    meta = meta or ModelMeta.of(cfg, N_FEATURES)
    sharded = assign_shard(frame(spark, rows), cfg.num_shards, slots)
    after = local_epoch(sharded, add_state(params, cfg), meta, cfg, slots=slots)
    return {r.j: r for r in after.collect()}, plain


def assert_same(after, want, cfg):
    assert set(after) == set(want)
    for j, parts in want.items():
        for name, part in zip(["", *(f"{s}_" for s in cfg.state_slots)], parts):
            w, v = after[j][f"{name}w"], after[j][f"{name}v"]
            if cfg.k1 or j == 0:
                assert w == pytest.approx(part[0], abs=1e-12)
            if j > 0:
                assert v == pytest.approx(list(part[1:]), abs=1e-12)


@pytest.mark.parametrize("optimizer", ["sgd", "adam", "rmsprop"])
@pytest.mark.parametrize("num_shards,slots", [(1, 1), (3, 2), (8, 3)])
def test_local_epoch_equals_the_formulas(spark, optimizer, num_shards, slots):
    cfg = FMConfig(optimizer=optimizer, k2=3, num_shards=num_shards, reg=(0.01, 0.02, 0.03), seed=num_shards)
    rows = random_rows(num_shards, one_hot=optimizer == "sgd")
    after, plain = one_epoch(spark, rows, cfg, slots)
    assert_same(after, reference.local_epoch(plain, rows, cfg), cfg)


@pytest.mark.parametrize(
    "changes",
    [
        {"k0": False},
        {"k1": False},
        {"k0": False, "k1": False},
        {"optimizer": "adam", "residual": "label_weighted"},
        {"optimizer": "rmsprop", "residual": "label_weighted"},
        {"task": 0, "optimizer": "adam"},
    ],
    ids=str,
)
def test_variants(spark, changes):
    cfg = FMConfig(k2=2, num_shards=4, reg=(0.01, 0.02, 0.03)).with_(**changes)
    rows = random_rows(5)
    meta = ModelMeta.of(cfg, N_FEATURES, 0.0, 1.0)
    after, plain = one_epoch(spark, rows, cfg, 2, meta)
    assert_same(after, reference.local_epoch(plain, rows, cfg, (0.0, 1.0)), cfg)


def test_more_shards_than_examples(spark):
    cfg = FMConfig(k2=2, num_shards=50)
    rows = random_rows(1, ids=[3, 9, 77])
    after, plain = one_epoch(spark, rows, cfg, 8)
    assert_same(after, reference.local_epoch(plain, rows, cfg), cfg)


def test_large_parameters_take_the_join_instead_of_the_broadcast(spark):
    cfg = FMConfig(k2=2, num_shards=6, broadcast_limit_bytes=0)
    rows = random_rows(2)
    after, plain = one_epoch(spark, rows, cfg, 3)
    assert_same(after, reference.local_epoch(plain, rows, cfg), cfg)


def test_a_feature_in_every_row(spark):
    """One feature holds all rows; it is one parameter row per shard and no more."""
    cfg = FMConfig(k2=2, num_shards=4)
    rows = [(i, y, sorted({*row, (N_FEATURES, 1.0)})) for i, y, row in random_rows(3)]
    after, plain = one_epoch(spark, rows, cfg, 4)
    assert_same(after, reference.local_epoch(plain, rows, cfg), cfg)
    sharded = assign_shard(frame(spark, rows), 4, 4)
    assert needed_features(sharded, cfg).where(F.col("j") == N_FEATURES).count() == 4


def test_sgd_keeps_parameters_in_bounds_and_leaves_others_alone(spark):
    cfg = FMConfig(k2=2, num_shards=1, step_size=50.0)
    rows = [(i, 1.0, [(1, 1.0), (2, 1.0)]) for i in range(5)]
    after, plain = one_epoch(spark, rows, cfg, 1)
    assert max(abs(after[j].w) for j in (0, 1, 2)) <= 20.0
    assert after[5].w == plain[5][0] and after[5].v == list(plain[5][1:])


def test_gradient_equals_the_formulas(spark):
    cfg = FMConfig(k2=3, reg=(0.1, 0.2, 0.3), num_shards=4)
    rows = random_rows(4, one_hot=False)
    params, plain = start_of(spark, cfg)
    meta = ModelMeta.of(cfg, N_FEATURES)
    sharded = assign_shard(frame(spark, rows), 4, 2)
    theta = {j: (a[0], a[1:]) for j, a in plain.items()}
    want = {}
    for _, y, row in rows:
        m = 1.0 / (1.0 + math.exp(-reference.score_raw(theta, row, True, True))) - y
        s = sum((theta[j][1] * x for j, x in row), np.zeros(3))
        want[0] = want.get(0, 0.0) + np.r_[m + 0.1 * theta[0][0], np.zeros(3)]
        for j, x in row:
            w, v = theta[j]
            want[j] = want.get(j, 0.0) + np.r_[x * m + 0.2 * w, (s * x - v * x * x) * m + 0.3 * v]
    for limit in (1 << 26, 0):
        got = {r.j: r for r in gradient(sharded, params, meta, cfg, limit_bytes=limit).collect()}
        assert set(got) == set(want)
        for j, g in want.items():
            assert got[j].gw == pytest.approx(g[0], abs=1e-12)
            if j:
                assert got[j].gv == pytest.approx(list(g[1:]), abs=1e-12)


def test_result_does_not_depend_on_spark_partitions(spark):
    cfg = FMConfig(k2=2, num_shards=8, optimizer="adam")
    rows = random_rows(6, n=100)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    found = []
    try:
        for shuffle, slots in (("1", 1), ("5", 8), ("13", 4)):
            spark.conf.set("spark.sql.shuffle.partitions", shuffle)
            after, _ = one_epoch(spark, rows, cfg, slots)
            found.append([after[j].w for j in sorted(after)])
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert found[1] == pytest.approx(found[0], abs=1e-14)
    assert found[2] == pytest.approx(found[0], abs=1e-14)


def test_examples_are_not_shuffled_in_an_epoch(spark):
    """Only parameter rows travel: no exchange was added above the union."""
    cfg = FMConfig(k2=2, num_shards=8)
    placed = number_steps(assign_shard(frame(spark, random_rows(7)), 8, 4)).persist()
    placed.count()
    params, _ = start_of(spark, cfg)
    after = local_epoch(placed, params, ModelMeta.of(cfg, N_FEATURES), cfg, slots=4)
    plan = after._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(slot" in plan
    moved = [line for line in plan.splitlines() if "hashpartitioning(slot" in line and "ENSURE_REQUIREMENTS" in line]
    assert not moved
    placed.unpersist()


def test_fit_two_epochs_equals_the_formulas(spark):
    cfg = FMConfig(k2=2, num_shards=3, epochs=2, optimizer="rmsprop")
    rows = random_rows(8)
    model = fit(frame(spark, rows), frame(spark, random_rows(9)), cfg, n_features=N_FEATURES)
    _, plain = start_of(spark, cfg)
    # The second epoch starts from averaged state, so the check continues from the first result.
    first = reference.local_epoch(plain, rows, cfg)
    after = {r.j: r for r in model.params.collect()}
    assert len(after) == N_FEATURES + 1
    one = fit(frame(spark, rows), frame(spark, random_rows(9)), cfg.with_(epochs=1), n_features=N_FEATURES)
    for r in one.params.collect():
        assert r.w == pytest.approx(first[r.j][0][0], abs=1e-12)
    history = model.history.orderBy("epoch").collect()
    assert [h.epoch for h in history] == [0, 1, 2]
    assert history[0].minutes is None and history[1].minutes > 0
    again = one.history.orderBy("epoch").collect()
    assert again[1].train_log_loss == pytest.approx(history[1].train_log_loss, abs=1e-12)


def test_no_epochs_is_the_start(spark):
    cfg = FMConfig(k2=2, num_shards=3, epochs=0)
    model = fit(frame(spark, random_rows(8)), frame(spark, random_rows(9)), cfg, n_features=N_FEATURES)
    _, plain = start_of(spark, cfg)
    assert {r.j: r.w for r in model.params.collect()} == {j: a[0] for j, a in plain.items()}
    assert model.history.count() == 1


def test_regression_fit(spark):
    rows = [(i, 3.0 * y + 1.0, row) for i, y, row in random_rows(10)]
    cfg = FMConfig(task=0, k2=2, num_shards=3, epochs=1, optimizer="adam")
    model = fit(frame(spark, rows), frame(spark, rows), cfg)
    assert (model.meta.label_min, model.meta.label_max) == (1.0, 4.0)
    scores = [r.score for r in model.predict(frame(spark, rows)).collect()]
    assert len(scores) == len(rows) and min(scores) >= 1.0 and max(scores) <= 4.0
    assert "train_rmse" in model.history.columns


def test_guards(spark):
    cfg = FMConfig(k2=2, num_shards=2, epochs=1)
    good = frame(spark, random_rows(1))
    with pytest.raises(ValueError, match="empty"):
        fit(good.limit(0), good, cfg)
    with pytest.raises(ValueError, match="1.0"):
        fit(frame(spark, random_rows(1, one_hot=False)), good, cfg)
    with pytest.raises(ValueError, match="NaN"):
        bad = init_params(spark, N_FEATURES, cfg).withColumn("w", F.lit(float("nan")))
        fit(good, good, cfg, params=bad, n_features=N_FEATURES)


def test_learns_from_documents(spark, sf_dir):
    data = datasets.document_examples(spark, sf_dir)
    examples = split_examples(data.examples)
    train, valid = (examples.where(F.col("split") == s).drop("split") for s in ("train", "valid"))
    cfg = FMConfig(
        k2=4, optimizer="adam", step_size=0.02, epochs=3, num_shards=2, init_std=0.05, reg=(0.0, 0.0, 0.001)
    )
    history = fit(train, valid, cfg, n_features=data.n_features).history.orderBy("epoch").collect()
    assert history[-1].train_log_loss < history[0].train_log_loss
    assert history[-1].train_auc > 0.9


def test_scores_of_untrained_model_stay_near_half(spark):
    cfg = FMConfig(k2=2)
    params, _ = start_of(spark, cfg)
    rows = random_rows(11)
    assert score(frame(spark, rows), params, ModelMeta.of(cfg, N_FEATURES)).count() == len(rows)
