"""Values that can be checked by hand: one example, its score and three updates."""

import pytest

from pairloom.config import FMConfig, ModelMeta
from pairloom.operators.evaluation import auc, class_means, evaluate, log_loss
from pairloom.operators.examples import assign_shard
from pairloom.operators.gradient import gradient
from pairloom.operators.local_epoch import local_epoch
from pairloom.operators.params import add_state
from pairloom.operators.scoring import score

PARAMS = [(0, 0.1, []), (1, 0.2, [0.1, 0.2]), (2, -0.3, [0.3, -0.1]), (3, 0.05, [-0.2, 0.4])]
META = ModelMeta(1, True, True, 2, 3)
CFG = FMConfig(k2=2, reg=(0.0, 0.001, 0.001), num_shards=1, step_size=0.1)

UPDATES = {
    "sgd": [(0, 0.137051944, []), (1, 0.237035916, [0.092037124, 0.215737889]), (3, 0.087047937, [-0.195994097, 0.407913348])],
    "adam": [(0, 0.199999997, []), (1, 0.299999997, [0.000000013, 0.299999994]), (3, 0.149999997, [-0.100000025, 0.499999987])],
    "rmsprop": [(0, 1.099996858, []), (1, 1.199996855, [-0.899921654, 1.199980313]), (3, 1.049996857, [0.799689065, 1.399920664])],
}


@pytest.fixture(scope="module")
def params(spark):
    return spark.createDataFrame(PARAMS, "j int, w double, v array<double>")


@pytest.fixture(scope="module")
def examples(spark):
    wide = spark.createDataFrame(
        [(7, 1.0, [1, 3], [1.0, 1.0])], "example_id long, label double, indices array<int>, values array<double>"
    )
    return assign_shard(wide, 1, 1)


def test_score(params, examples):
    row = score(examples, params, META).first()
    assert row.raw == pytest.approx(0.41, abs=1e-12)
    assert row.score == pytest.approx(0.601087879, abs=1e-9)
    assert log_loss(score(examples, params, META)).first().log_loss == pytest.approx(0.509014134, abs=1e-9)


def test_gradient(params, examples):
    rows = {r.j: r for r in gradient(examples, params, META, CFG).collect()}
    assert set(rows) == {0, 1, 3}
    assert rows[0].gw == pytest.approx(-0.398912121, abs=1e-9)
    assert rows[1].gw == pytest.approx(-0.398712121, abs=1e-9)
    assert rows[3].gw == pytest.approx(-0.398862121, abs=1e-9)
    assert rows[1].gv == pytest.approx([0.079882424, -0.159364848], abs=1e-9)
    assert rows[3].gv == pytest.approx([-0.040091212, -0.079382424], abs=1e-9)


@pytest.mark.parametrize("optimizer", sorted(UPDATES))
def test_update(params, examples, optimizer):
    cfg = CFG.with_(optimizer=optimizer)
    after = {r.j: r for r in local_epoch(examples, add_state(params, cfg), META, cfg, slots=1).collect()}
    for j, w, v in UPDATES[optimizer]:
        assert after[j].w == pytest.approx(w, abs=1e-9)
        assert after[j].v == pytest.approx(v, abs=1e-9)
    assert (after[2].w, after[2].v) == (-0.3, [0.3, -0.1])


def test_metrics(spark):
    scored = spark.createDataFrame(
        list(zip(range(5), [1.0, 0.0, 1.0, 0.0, 1.0], [0.9, 0.4, 0.4, 0.2, 0.7])),
        "example_id long, label double, score double",
    )
    row = evaluate(scored).first()
    assert row.log_loss == pytest.approx(0.422459073, abs=1e-9)
    assert row.auc == pytest.approx(0.916666667, abs=1e-9)
    assert row.pos_mean == pytest.approx(0.666666667, abs=1e-9)
    assert row.neg_mean == pytest.approx(0.3, abs=1e-9)
    assert log_loss(scored).first().log_loss == pytest.approx(row.log_loss, abs=1e-12)
    assert class_means(scored).first().pos_mean == pytest.approx(row.pos_mean, abs=1e-12)
    assert auc(scored).first().auc == row.auc


def test_one_class_only(spark):
    scored = spark.createDataFrame([(1, 1.0, 1.0), (2, 1.0, 0.5)], "example_id long, label double, score double")
    row = evaluate(scored).first()
    assert row.auc is None and row.neg_mean is None
    assert row.pos_mean == pytest.approx(0.75)
    assert 0.0 < row.log_loss < 1.0
