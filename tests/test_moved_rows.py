"""What moves between tasks: whole rows, never one row per word or non-zero."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from pairloom.config import FMConfig, ModelMeta
from pairloom.operators.examples import assign_shard
from pairloom.operators.gradient import gradient
from pairloom.operators.params import init_params
from pairloom.operators.scoring import example_sums, score
from pairloom.plans.session import settings
from pairloom.sources.vocabulary import build_vocabulary, gathered, indexed_examples, indexed_rows, text_tokens

SCHEMA = "example_id long, label double, indices array<int>, values array<double>"


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def texts(spark):
    rows = [(1, 1.0, "b a b"), (2, 0.0, ""), (3, 1.0, None), (1, 1.0, "a c"), (1, 0.0, "c")]
    return spark.createDataFrame(rows, "id long, y double, t string")


def test_counting_and_gathering_words_move_texts_only(spark):
    found = gathered(text_tokens(texts(spark), F.col("id"), F.col("y"), F.col("t"), 5))
    assert plan_of(found).count("Exchange ") == 1
    got = {(r.example_id, r.label): sorted((p.token, p.x) for p in r.tokens) for r in found.collect()}
    assert got == {
        (1, 1.0): [("a", 2.0), ("b", 2.0), ("c", 1.0)], (1, 0.0): [("c", 1.0)], (2, 0.0): [], (3, 1.0): []}


@pytest.mark.parametrize("limit", [0, 1 << 26])
def test_indexing_moves_whole_rows(spark, limit):
    tokens = text_tokens(texts(spark), F.col("id"), F.col("y"), F.col("t"))
    vocabulary = build_vocabulary(tokens.where(F.col("token").isNotNull()))
    with settings(spark):
        found = indexed_examples(tokens, vocabulary, limit)
        assert "SortMergeJoin" not in plan_of(found)
        got = {(r.example_id, r.label): (r.indices, r["values"]) for r in found.collect()}
    assert got[1, 1.0] == ([1, 2, 3], [2.0, 2.0, 1.0]) and got[2, 0.0] == ([], []) and got[3, 1.0] == ([], [])


def odd_examples(spark):
    rows = [(i % 90, float(i % 2), [1 + i % 7, 8 + i % 5], [1.0, 2.0]) for i in range(100)]
    rows += [(200, 1.0, [], []), (201, 1.0, None, None), (None, 0.0, [3], [1.0]), (202, None, [50], [1.0])]
    rows += [(203, 0.0, [2, None, 4], [1.0, 1.0, None])]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize("k0", [True, False])
def test_large_models_score_as_small_ones_without_a_row_per_nonzero(spark, k0):
    cfg = FMConfig(k2=3, k0=k0, init_std=0.5)
    meta, params = ModelMeta.of(cfg, 12), init_params(spark, 12, cfg)
    small, large = (example_sums(odd_examples(spark), params, meta, limit_bytes=n) for n in (1 << 26, 0))
    assert small.columns == large.columns
    # The only generator is the one below the distinct features of a slot.
    assert plan_of(large).count("Generate ") == 1
    rows = [sorted(map(tuple, df.collect()), key=repr) for df in (small, large)]
    assert len(rows[0]) == len(rows[1])
    by_key = [{r[:2]: r[2:] for r in found} for found in rows]
    assert by_key[0].keys() == by_key[1].keys()
    for key, sums in by_key[0].items():
        assert np.allclose(sums, by_key[1][key], atol=1e-12)


def test_gradient_of_large_models(spark):
    cfg = FMConfig(k2=3, init_std=0.5, num_shards=4)
    meta, params = ModelMeta.of(cfg, 12), init_params(spark, 12, cfg)
    rows = odd_examples(spark).where("example_id < 200")
    placed = assign_shard(rows, 4, 3)
    got = [
        {r.j: np.r_[r.gw, r.gv] for r in gradient(placed, params, meta, cfg, limit_bytes=n, slots=3).collect()} for n in (1 << 26, 0)
    ]
    assert got[0].keys() == got[1].keys()
    assert all(np.allclose(got[0][j], got[1][j], atol=1e-10) for j in got[0])


def test_a_wrong_number_of_slots_is_told_or_harmless(spark):
    cfg = FMConfig(k2=3, init_std=0.5)
    meta, params = ModelMeta.of(cfg, 12), init_params(spark, 12, cfg)
    placed = assign_shard(odd_examples(spark).where("example_id < 200"), 4, 3)
    want = {(r.example_id, r.label): r.raw for r in score(placed, params, meta).collect()}
    got = {(r.example_id, r.label): r.raw for r in score(placed, params, meta, limit_bytes=0).collect()}
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k]) for k in want)


def test_indexing_beyond_the_limit_makes_no_row_per_token(spark):
    pair = "array<struct<token string, x double>>"
    rows = [(i % 40, float(i % 2), [(f"t{i % 7}", 1.0), (f"u{i % 5}", 2.0), ("new", 3.0)]) for i in range(60)]
    rows += [(100, 1.0, []), (101, 1.0, None), (None, 0.0, [("t1", 1.0)]), (None, 0.0, [("t1", 1.0)]), (102, None, [("u2", 1.0)])]
    rows += [(103, float("nan"), [("t2", 1.0)]), (103, float("nan"), [("t1", 5.0)]), (104, -0.0, [(None, 1.0)]), (104, 0.0, [("u1", None)])]
    table = spark.createDataFrame(rows, f"example_id long, label double, tokens {pair}")
    tokens = table.select(F.explode("tokens.token").alias("token")).where("token is not null and token <> 'new'")
    vocabulary = build_vocabulary(tokens)
    with settings(spark):
        small, large = (indexed_rows(table, vocabulary, n) for n in (1 << 26, 0))
        plan = plan_of(large)
        assert "Generate" not in plan and "ObjectHashAggregate" not in plan
        assert small.dtypes == large.dtypes
        got = [sorted((tuple(map(str, r)) for r in df.collect())) for df in (small, large)]
    assert got[0] == got[1] and len(got[0]) == 46
