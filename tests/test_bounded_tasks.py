"""What a task holds in memory does not grow with the table."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pairloom.config import FMConfig, ModelMeta
from pairloom.operators import local_epoch as le
from pairloom.operators import scoring
from pairloom.operators.examples import assign_shard, number_steps
from pairloom.operators.params import add_state, init_params
from pairloom.plans import fit as fitting
from pairloom.plans.scratch import new_run_dir, write_table
from pairloom.sources import vocabulary as voc
from test_training import frame, random_rows


@pytest.mark.parametrize("optimizer, k0", [("sgd", True), ("adam", False), ("rmsprop", True)])
def test_parameters_in_a_file_train_as_in_memory(spark, optimizer, k0):
    cfg = FMConfig(optimizer=optimizer, k0=k0, k2=3, num_shards=5, step_size=0.1, reg=(0.01, 0.02, 0.03))
    meta = ModelMeta.of(cfg, 12)
    stepped = number_steps(assign_shard(frame(spark, random_rows(60)), cfg.num_shards, 2))
    params = write_table(add_state(init_params(spark, 12, cfg), cfg), new_run_dir(spark, "test"))
    found = [
        le.local_epoch(stepped, params, meta, c, slots=2, runs=(stepped, 1)).orderBy("j").collect()
        for c in (cfg, cfg.with_(task_bytes=1))
    ]
    assert found[0] == found[1]


def stream(n_params, width, examples):
    """One shard's parameter rows and then its examples, as a slot's task receives them."""
    names = ["slot", "shard", "step", "row_id", "label", "indices", "values"]

    def batch(step, row_id, label, indices, values):
        zeros = np.zeros(len(step), np.int32)
        return pa.RecordBatch.from_arrays([
            pa.array(zeros), pa.array(zeros), pa.array(step.astype(np.int32)), pa.array(row_id), pa.array(label), indices, values], names=names)

    for a in range(0, n_params, 50_000):
        j = np.arange(a, min(a + 50_000, n_params))
        empty = pa.ListArray.from_arrays(pa.array(np.zeros(len(j) + 1, np.int32)), pa.array([], pa.int32()))
        offsets = pa.array(np.arange(len(j) + 1, dtype=np.int32) * width)
        yield batch(0 * j, j, np.zeros(len(j)), empty, pa.ListArray.from_arrays(offsets, pa.array(np.full(len(j) * width, 0.01))))
    ids = np.arange(1, len(examples) + 1)
    lists = [pa.array(rows, kind) for rows, kind in (
        (examples, pa.list_(pa.int32())), ([[1.0] * len(e) for e in examples], pa.list_(pa.float64())))]
    yield batch(ids, ids, (ids % 2).astype(float), *lists)


def test_a_walk_does_not_hold_its_parameters(tmp_path):
    """Half a million parameter rows of 120 bytes: both copies and the changes lie in files, not in memory."""
    cfg = FMConfig(optimizer="adam", k2=4, num_shards=1, step_size=0.1)
    n = 500_000
    walk = le._walk(cfg, ModelMeta.of(cfg, n - 1))
    assert n * 15 * 8 > le._HELD_BYTES
    before, anonymous = read_anonymous(), []
    rows = 0
    for out in walk(stream(n, 15, [[1, 7, n - 1], [7], []])):
        rows += out.num_rows
        anonymous.append(read_anonymous())
    assert rows == n
    # 60 MB of parameters; two copies in memory and their changes would be 180.
    assert max(anonymous) - before < 100


def read_anonymous():
    with open("/proc/self/status") as f:
        return next(int(line.split()[1]) for line in f if line.startswith("RssAnon")) / 1024


def test_scoring_slots_follow_the_non_zeros(spark, monkeypatch):
    monkeypatch.setattr(fitting, "SLOT_VALUES", 10)
    seen = []
    plain = scoring.score

    def spy(*given, **how):
        seen.append(how["slots"])
        return plain(*given, **how)

    monkeypatch.setattr(fitting, "score", spy)
    rows = frame(spark, random_rows(3, n=60))
    cfg = FMConfig(epochs=1, k2=2, num_shards=2, broadcast_limit_bytes=0)
    few = fitting.fit(rows, rows, cfg.with_(score_tasks=2), n_features=12).history
    many = fitting.fit(rows, rows, cfg, n_features=12).history
    assert seen[0] == 2 and seen[-1] > spark.sparkContext.defaultParallelism
    numbers = [[[x if x is None else round(x, 10) for x in r] for r in h.drop("minutes", "finished_at").orderBy("epoch").collect()]
               for h in (few, many)]
    assert numbers[0] == numbers[1]


def test_pieces_of_a_batch_are_all_of_it():
    lists = pa.array([list(range(n)) for n in (0, 5, 300_000, 0, 7, 262_144, 1)], pa.list_(pa.int32()))
    for of, name in ((le._pieces, "indices"), (scoring._pieces, "j")):
        batch = pa.RecordBatch.from_arrays([lists], names=[name])
        pieces = list(of(batch))
        assert pa.Table.from_batches(pieces).column(name).combine_chunks().equals(lists)
        assert len(pieces) > 2


def test_parameters_beyond_a_task_need_no_runs(spark, monkeypatch):
    """A run reads what all runs before it left, so their number must not grow with the table."""
    seen = []

    def spy(*given, **how):
        seen.append(how["runs"][1])
        return le.local_epoch(*given, **how)

    monkeypatch.setattr(fitting, "local_epoch", spy)
    rows = frame(spark, random_rows(5, n=60))
    cfg = FMConfig(epochs=1, k2=2, num_shards=2)
    few, many = (fitting.fit(rows, rows, c, n_features=12).params for c in (cfg.with_(task_bytes=1000), cfg))
    assert seen == [1, 1]
    assert sorted((r.j, r.w, *r.v) for r in few.collect()) == sorted((r.j, r.w, *r.v) for r in many.collect())


TEXTS = [
    (1, 1.0, "b A a\tc\n\nB"), (1, 1.0, "a d"), (1, 0.0, "a"), (2, None, "x\vy x\vy \x1cz"), (3, 0.0, None), (4, 1.0, " \r\f "), (4, 1.0, ""),
    (5, -0.0, "\u00a0a\u2003b \u0130I \u03a3\u03a3 \u4e2d\u6587 \u03a3"), (5, 0.0, "a"), (None, 1.0, "q q"), (None, 1.0, "q"), (6, 2.0, "e" * 300 + " a"),
] + [(i, 1.0, f"w{i % 7} w{i % 3} a W{i % 7}") for i in range(10, 60)]


@pytest.mark.parametrize("slots", [1, 3])
def test_words_are_counted_and_numbered_by_slot(spark, slots):
    texts = spark.createDataFrame(TEXTS, "id long, y double, t string").repartition(4)
    columns = F.col("id"), F.col("y"), F.col("t")
    tokens = voc.text_tokens(texts, *columns)
    wanted_vocabulary = voc.build_vocabulary(tokens.where(F.col("token").isNotNull()))
    wanted = voc.indexed_examples(tokens, wanted_vocabulary)
    chunks = write_table(voc.text_chunks(texts, *columns, slots), new_run_dir(spark, "test"))
    # A word comes once a slot, however often it occurs.
    assert chunks.where("turn = 0").select("slot", F.explode("words").alias("w")).groupBy("slot", "w").count().where("count > 1").isEmpty()
    vocabulary = voc.build_vocabulary(voc.chunk_words(chunks))
    assert vocabulary.frame.orderBy("j").collect() == wanted_vocabulary.frame.orderBy("j").collect()
    order = lambda df: sorted(map(repr, df.select("example_id", "label", "indices", "values").collect()))
    assert order(voc.indexed_chunks(chunks, vocabulary, slots)) == order(wanted)
    # A word outside the vocabulary adds nothing.
    fewer = voc.Vocabulary(vocabulary.frame.where("token < 'w'"), vocabulary.size)
    assert order(voc.indexed_chunks(chunks, fewer, slots)) == order(voc.indexed_examples(tokens, fewer))


def test_counts_do_not_depend_on_pieces(monkeypatch):
    """Rows of one id and label become one, also if pieces or batches part them."""
    rows = [(i // 3, float(i // 3 % 2), f"a w{i % 4} w{i} a" if i % 5 else None) for i in range(60)]
    columns = [pa.array(c, kind) for c, kind in zip(zip(*rows), (pa.int64(), pa.float64(), pa.string()))]
    whole = pa.RecordBatch.from_arrays(columns, names=["example_id", "label", "text"])
    found = []
    for piece, step in ((4 << 20, 60), (4 << 20, 7), (1, 60), (25, 4)):
        monkeypatch.setattr(voc, "_PIECE_BYTES", piece)
        got = list(voc._counted([7])(whole.slice(a, step) for a in range(0, 60, step)))
        words = [w for b in got for r in b.to_pylist() if r["turn"] == 0 for w in r["words"]]
        assert len(words) == len(set(words)) and all(set(b.column("slot").to_pylist()) == {7} for b in got)
        found.append([(r["example_id"], r["label"], sorted(zip((words[i] for i in r["ids"]), r["x"])))
                      for b in got for r in b.to_pylist() if r["turn"] == 1])
    assert all(f == found[0] for f in found) and len(found[0]) == 20
    # Rows 1 and 2 of the first id; its row 0 has no text.
    assert found[0][0] == (0, 0.0, [("a", 4.0), ("w1", 2.0), ("w2", 2.0)])


def test_lists_of_different_length_are_filled_up(spark):
    rows = spark.createDataFrame(
        [(1, 1.0, [1, 2], [1.0]), (2, 1.0, [1], [1.0, 3.0]), (3, 0.0, None, None), (4, 0.0, [1, 3], [1.0, 2.0])],
        "example_id long, label double, indices array<int>, values array<double>")
    cfg = FMConfig(k2=2)
    meta, params = ModelMeta.of(cfg, 3), init_params(spark, 3, cfg)
    found = [[(r.example_id, round(r.raw, 12)) for r in scoring.score(rows, params, meta, limit_bytes=n).orderBy("example_id").collect()]
             for n in (1 << 26, 0)]
    assert found[0] == found[1]
