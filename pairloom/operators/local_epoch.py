"""One epoch: sequential local training in every shard, then averaging.

Row t + 1 of a shard sees the update of row t, so the walk over a shard
cannot be a set-based aggregate; it is the one step in Python. Shards do not
see each other, so the rows with the same step of all shards in a slot are
updated together, as one array operation. Spark brings each slot its own
examples and only the parameters these use, as one sorted stream (parameters
first, then examples by step), so a task holds the parameters of its shards
and one batch of rows, never the shards themselves. It returns the change of
each parameter; averaging is a plain aggregation.

A slot whose parameters exceed what a task may hold is walked in runs: stretches of steps that use a bounded number
of parameter rows. A run starts from the values its shards had after the run before, which are
kept as a table of one row per shard and touched feature, so a task never holds more than one run's parameters and the
result is that of an unbroken walk.

Within a run a task holds few of its parameter rows in memory: beyond ``_HELD_BYTES`` they lie in nameless files of its own
that are mapped, so each step touches the rows it uses and nothing else of them needs memory.
"""

from __future__ import annotations

import tempfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pairloom.config import CLASSIFICATION, FMConfig, ModelMeta
from pairloom.operators.examples import number_steps, shard_column, with_shard_rows
from pairloom.plans.scratch import new_run_dir, write_table

# Fixed values of the update rules.
SGD_BOUND = 20.0
ADAM_DECAY_1 = 0.9
ADAM_DECAY_2 = 0.999
ADAM_EPSILON = 1e-8
RMSPROP_DECAY = 0.99
RMSPROP_EPSILON = 1e-8

_CHUNK = 16384
# What a walk holds of its parameter rows in memory, of each of its two copies.
_HELD_BYTES = 32 << 20
# What the files of a walk may take; shards that need more are walked in runs.
FILE_BYTES = 8 << 30
# Non-zeros of a batch that are looked up at a time.
_WAVE_VALUES = 1 << 18


def sgd_rule(theta, g, state, step, clock):
    """Bounded step, then clipping of the parameter."""
    moved = theta - step * g / np.sqrt(g * g + 1.0)
    return np.minimum(np.maximum(moved, -SGD_BOUND), SGD_BOUND), ()


def adam_rule(theta, g, state, step, clock):
    """Adam; its bias correction is that of the step ``clock``, a column of numbers or 1."""
    m = ADAM_DECAY_1 * state[0] + (1.0 - ADAM_DECAY_1) * g
    s = ADAM_DECAY_2 * state[1] + (1.0 - ADAM_DECAY_2) * g * g
    move = m / (1.0 - ADAM_DECAY_1**clock) / (np.sqrt(s / (1.0 - ADAM_DECAY_2**clock)) + ADAM_EPSILON)
    return theta - step * move, (m, s)


def rmsprop_rule(theta, g, state, step, clock):
    """RMSProp with epsilon inside the root."""
    s = RMSPROP_DECAY * state[0] + (1.0 - RMSPROP_DECAY) * g * g
    return theta - step * g / np.sqrt(s + RMSPROP_EPSILON), (s,)


RULES = {"sgd": sgd_rule, "adam": adam_rule, "rmsprop": rmsprop_rule}


def residual_of(cfg: FMConfig, meta: ModelMeta) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    """dLoss/dz as a function of raw scores and labels."""
    if meta.task != CLASSIFICATION:
        low, high = meta.label_min, meta.label_max
        return lambda z, y: np.minimum(np.maximum(z, low), high) - y
    if cfg.residual == "label_weighted" and cfg.optimizer != "sgd":
        return lambda z, y: -y * (1.0 - 1.0 / (1.0 + np.exp(-y * (0.5 + 0.5 * np.tanh(0.5 * z)))))
    return lambda z, y: 0.5 + 0.5 * np.tanh(0.5 * z) - y


class _Rows:
    """Rows of numbers that come piece by piece: in memory up to ``limit`` bytes, beyond that in a file without a name."""

    def __init__(self, width: int, limit: int, dtype=np.float64) -> None:
        self._width, self._limit, self._dtype = width, limit, np.dtype(dtype)
        self._parts: list[np.ndarray] = []
        self._file, self._n = None, 0

    def add(self, part: np.ndarray) -> None:
        self._n += len(part)
        self._parts.append(np.array(part, self._dtype))
        if self._file is None and self._n * self._width * self._dtype.itemsize > self._limit:
            self._file = tempfile.TemporaryFile()
        if self._file is not None:
            for held in self._parts:
                self._file.write(held)
            self._parts.clear()

    def whole(self) -> np.ndarray:
        shape = (self._n, self._width)
        if self._file is not None:
            self._file.flush()
            # A plain view: the class of mapped arrays costs time at each use.
            return np.asarray(np.memmap(self._file, self._dtype, "r+", shape=shape))
        parts, self._parts = self._parts, []
        return np.concatenate(parts).reshape(shape) if parts else np.empty(shape, self._dtype)


def _update(now, rows, x, example, starts, y, clock, cfg, residual, rule):
    """Update, in place, the parameter rows that one example of each shard touches.

    A row of ``now`` is a parameter row and its state, side by side. ``rows``, ``x`` and ``example`` (number of the
    example) are the concatenated non-zeros of the examples, which begin at ``starts``. With a
    bias, each example begins with its row, x = 1.
    """
    width = 1 + cfg.k2
    held = now.take(rows, axis=0)
    block = held[:, :width]
    vx = block[:, 1:] * x[:, None]
    s = np.add.reduceat(vx, starts, axis=0)
    own = np.add.reduceat(block[:, 0] * x - 0.5 * np.einsum("ij,ij->i", vx, vx), starts)
    m = residual(own + 0.5 * np.einsum("ij,ij->i", s, s), y)
    mx = m.take(example) * x
    r0, r1, r2 = cfg.reg
    g = np.empty(block.shape)
    g[:, 0] = mx + r1 * block[:, 0] if cfg.k1 else 0.0
    g[:, 1:] = (s.take(example, axis=0) - vx) * mx[:, None] + r2 * block[:, 1:]
    if cfg.k0:
        g[starts, 0] = m + r0 * block[starts, 0]
        g[starts, 1:] = 0.0
    steps = 1 if clock is None else clock.take(example)[:, None]
    state = [held[:, a : a + width] for a in range(width, held.shape[1], width)]
    theta, new_state = rule(block, g, state, cfg.step_size, steps)
    now[rows] = np.concatenate([theta, *new_state], axis=1)


def _keys(shard: np.ndarray, j: np.ndarray, n_features: int) -> np.ndarray:
    """One sortable number per shard and feature."""
    return shard.astype(np.int64) * (n_features + 1) + j


def _waves(batch: pa.RecordBatch, known: np.ndarray, n_features: int, with_bias: bool):
    """Per step in a batch of examples: parameter rows, values, example numbers, starts, labels, step counters if given."""
    indices = batch.column("indices")
    j, x = indices.flatten().to_numpy(), batch.column("values").flatten().to_numpy()
    lengths = indices.value_lengths().to_numpy()
    bounds = np.r_[0, np.cumsum(lengths)]
    if len(j) and (j.min() < 1 or j.max() > n_features):
        raise ValueError(f"an example uses a feature outside 1 to {n_features}")
    if with_bias:
        j, x = np.insert(j, bounds[:-1], 0), np.insert(x, bounds[:-1], 1.0)
        lengths, bounds = lengths + 1, bounds + np.arange(len(bounds))
    wanted = _keys(np.repeat(batch.column("shard").to_numpy(), lengths), j, n_features)
    rows = np.searchsorted(known, wanted)
    if len(rows) and (rows.max() >= len(known) or (known[rows] != wanted).any()):
        raise ValueError("an example uses a feature without parameters")
    example = np.repeat(np.arange(batch.num_rows), lengths)
    labels, step = batch.column("label").to_numpy(), batch.column("step").to_numpy()
    clock = batch.column("clock").to_numpy() if "clock" in batch.schema.names else None
    first = np.r_[0, np.flatnonzero(np.diff(step)) + 1, len(step)].tolist()
    for a, b in zip(first[:-1], first[1:]):
        p, q = bounds[a], bounds[b]
        yield rows[p:q], x[p:q], example[p:q] - a, bounds[a:b] - p, labels[a:b], None if clock is None else clock[a:b]


def _pieces(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """A batch of examples in pieces of about ``_WAVE_VALUES`` non-zeros; shards of one step don't see each other, so it may be cut."""
    ends = np.cumsum(batch.column("indices").value_lengths().to_numpy() + 1)
    a = 0
    while a < batch.num_rows:
        before = ends[a - 1] if a else 0
        b = max(a + 1, int(np.searchsorted(ends, before + _WAVE_VALUES, "right")))
        yield batch.slice(a, b - a)
        a = b


def _check_order(batch: pa.RecordBatch, last: tuple) -> tuple:
    """Raise unless rows strictly ascend by (step, shard, id); return the last."""
    columns = [batch.column(c).to_numpy().astype(np.int64) for c in ("step", "shard", "row_id")]
    ascends = np.zeros(batch.num_rows - 1, dtype=bool)
    for c in reversed(columns):
        d = np.diff(c)
        ascends = (d > 0) | ((d == 0) & ascends)
    if not ascends.all() or tuple(c[0] for c in columns) <= last:
        raise ValueError("the rows of a slot arrived unsorted or with repeated ids")
    return tuple(c[-1] for c in columns)


def _batches(names: list[str], columns: list[np.ndarray], rows: np.ndarray) -> Iterator[pa.RecordBatch]:
    """``columns`` and, as an array per row, ``rows``, in pieces."""
    for a in range(0, len(rows), _CHUNK):
        part = rows[a : a + _CHUNK]
        offsets = pa.array(np.arange(len(part) + 1, dtype=np.int32) * rows.shape[1])
        lists = pa.ListArray.from_arrays(offsets, pa.array(part.ravel()))
        yield pa.RecordBatch.from_arrays([*[pa.array(c[a : a + _CHUNK].astype(np.int32)) for c in columns], lists], names=names)


def _shard_bases(known: np.ndarray, n_features: int) -> np.ndarray:
    """The key of feature 0 of each shard in the ascending keys."""
    bases, at = [], 0
    while at < len(known):
        bases.append(int(known[at]) // (n_features + 1) * (n_features + 1))
        at = int(np.searchsorted(known, bases[-1] + n_features + 1))
    return np.array(bases, np.int64)


def _summed(known: np.ndarray, start: np.ndarray, now: np.ndarray, n_features: int) -> Iterator[pa.RecordBatch]:
    """The change of each feature, summed over shards, by ranges of features: no more than a range is taken into memory."""
    bases = _shard_bases(known, n_features)
    each = max(1, 4 * _CHUNK // len(bases))
    ends = np.searchsorted(known, bases)
    for low in range(0, n_features + 1, each):
        begins, ends = ends, np.searchsorted(known, bases + min(low + each, n_features + 1))
        parts = [slice(a, b) for a, b in zip(begins, ends) if b > a]
        if not parts:
            continue
        feature = np.concatenate([known[p] - base for p, base in zip(
            parts, bases[ends > begins])])
        change = np.concatenate([now[p] - start[p] for p in parts])
        order = np.argsort(feature, kind="stable")
        j, first = np.unique(feature[order], return_index=True)
        yield from _batches(["j", "change"], [j], np.add.reduceat(change[order], first, axis=0))


def _walk(cfg: FMConfig, meta: ModelMeta, by_shard: bool = False):
    """The function that trains the shards of one slot from their sorted stream.

    Parameter rows have step 0, examples count from 1. It returns the change of each feature, or, with
    ``by_shard``, the values that each shard ends with.
    """
    width = (1 + cfg.k2) * (1 + len(cfg.state_slots))
    residual, rule = residual_of(cfg, meta), RULES[cfg.optimizer]
    limit = min(_HELD_BYTES, cfg.task_bytes)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, before, after = _Rows(1, limit, np.int64), _Rows(width, limit), _Rows(width, limit)
        now, last = None, (-1, -1, -1)
        for batch in batches:
            if batch.num_rows == 0:
                continue
            last = _check_order(batch, last)
            n_params = int(np.searchsorted(batch.column("step").to_numpy(), 1))
            if n_params:
                sent = batch.slice(0, n_params)
                keys.add(_keys(sent.column("shard").to_numpy(), sent.column("row_id").to_numpy(), meta.n_features))
                loaded = sent.column("values").flatten().to_numpy().reshape(n_params, width)
                after.add(loaded)
                if not by_shard:
                    before.add(loaded)
            if n_params == batch.num_rows:
                continue
            if now is None:
                known, start, now = keys.whole()[:, 0], before.whole(), after.whole()
            for piece in _pieces(batch.slice(n_params)):
                for wave in _waves(piece, known, meta.n_features, cfg.k0):
                    _update(now, *wave, cfg, residual, rule)
        if now is None or not len(known):
            return
        if not by_shard:
            yield from _summed(known, start, now, meta.n_features)
            return
        for a in range(0, len(known), _CHUNK):
            shard, feature = np.divmod(known[a : a + _CHUNK], meta.n_features + 1)
            yield from _batches(["shard", "j", "values"], [shard, feature], now[a : a + _CHUNK])

    return walk


def needed_features(sharded: DataFrame, cfg: FMConfig) -> DataFrame:
    """``slot, shard, j``: the parameter rows each shard uses, its bias included.

    It depends on the examples only, so a training run computes it once.
    """
    indices = F.col("indices")
    if cfg.k0:
        indices = F.concat(F.array(F.lit(0)), indices)
    return sharded.select("slot", "shard", F.explode(indices).alias("j")).distinct()


def _slot_columns(cfg: FMConfig) -> list[tuple[str, str]]:
    return [("w", "v")] + [(f"{slot}_w", f"{slot}_v") for slot in cfg.state_slots]


def _packed(cfg: FMConfig) -> str:
    """A parameter row and its state as one array; the bias has zero factors."""
    zeros = f"array_repeat(0D, {cfg.k2})"
    parts = [f"array(coalesce({w}, 0D)), if(j = 0, {zeros}, {v})" for w, v in _slot_columns(cfg)]
    return f"concat({', '.join(parts)})"


def _row_bytes(cfg: FMConfig) -> int:
    return 8 * (1 + cfg.k2) * (1 + len(cfg.state_slots)) + 64


def _table(params: DataFrame, meta: ModelMeta, cfg: FMConfig) -> DataFrame:
    """The parameters, broadcast if they are known to be small."""
    fits = (meta.n_features + 1) * _row_bytes(cfg) <= cfg.broadcast_limit_bytes
    return F.broadcast(params) if fits else params


def _stream(stepped: DataFrame, sent: DataFrame, cfg: FMConfig, slots: int, epoch: int) -> DataFrame:
    """Per slot its parameter rows ``slot, shard, j, values``, then its examples, in order.

    Both sides of the union have the same hash partitioning by slot, which it
    keeps: the examples stay where they are and only parameter rows travel.
    """
    rows = sent.selectExpr(
        "slot", "shard", "0 AS step", "cast(j AS long) AS row_id", "0D AS label",
        "cast(array() AS array<int>) AS indices", "values", *(["0L AS clock"] if cfg.counts_steps else []),
    ).repartition(slots, "slot")
    clock = []
    if cfg.counts_steps:
        # Earlier epochs went over all rows of the shard.
        before = (epoch - 1) * F.col("shard_rows") if epoch > 1 else F.lit(0)
        clock = [(F.col("step") + before).cast("long").alias("clock")]
    used = stepped if cfg.k0 else stepped.where(F.size("indices") > 0)
    examples = used.select("slot", "shard", "step", F.col("example_id").alias("row_id"), "label", "indices", "values", *clock)
    return examples.unionByName(rows).sortWithinPartitions("slot", "step", "shard", "row_id").groupBy("slot")


def local_changes(
    stepped: DataFrame, needed: DataFrame, params: DataFrame, meta: ModelMeta, cfg: FMConfig, slots: int,
    epoch: int = 1,
) -> DataFrame:
    """``j, change``: what the local epochs of a slot's shards changed, summed per feature."""
    sent = needed.join(_table(params, meta, cfg), "j").selectExpr("slot", "shard", "j", f"{_packed(cfg)} AS values")
    return _stream(stepped, sent, cfg, slots, epoch).applyInArrow(_walk(cfg, meta), "j int, change array<double>")


def row_bytes_in_task(cfg: FMConfig) -> int:
    """What a parameter row takes in a task: as sent, at the start and now, with its key."""
    return 3 * 8 * (1 + cfg.k2) * (1 + len(cfg.state_slots)) + 16


def rows_per_task(cfg: FMConfig) -> int:
    return max(1, cfg.task_bytes // row_bytes_in_task(cfg))


def rows_per_file(cfg: FMConfig) -> int:
    """Parameter rows of a task that may lie in its files."""
    return max(rows_per_task(cfg), FILE_BYTES // (2 * 8 * (1 + cfg.k2) * (1 + len(cfg.state_slots)) + 8))


def walk_slots(examples: DataFrame, cfg: FMConfig) -> int:
    """Slots for training: enough for all cores and for the parameter rows of each to fit a task, and no more.

    A walk takes the rows at one step of all its shards together, so it costs the less the more shards a slot has. The
    parameter rows are estimated; ``plan_runs`` counts them.
    """
    cores = examples.sparkSession.sparkContext.defaultParallelism
    if cfg.num_shards <= cores:
        return cfg.num_shards
    used = examples.select(shard_column(cfg.num_shards, cfg.shard_method).alias("shard"), F.explode("indices").alias("j"))
    found = used.groupBy("shard").agg(F.approx_count_distinct("j").alias("n")).agg(F.sum("n")).first()[0] or 0
    # A quarter more: the estimate is off by a few hundredths, and slots aren't quite equal.
    fitting = -(-(found + cfg.num_shards) * 5 // (4 * rows_per_task(cfg)))
    return max(1, min(cfg.num_shards, max(cores, fitting)))


def plan_runs(stepped: DataFrame, needed: DataFrame, cfg: FMConfig, limit: int | None = None) -> tuple[DataFrame, int]:
    """The examples with the number of their ``run``, and the number of runs.

    One run, without a column, if every slot needs ``limit`` parameter rows at most: those that fit a task unless given. Otherwise a run ends with the step in which the
    non-zeros since its begin reach the limit, and these are at least as many as the features they use. The sum follows
    the order the examples are in already.
    """
    limit = limit or rows_per_task(cfg)
    most = needed.groupBy("slot").count().agg(F.max("count")).first()[0] or 0
    if most <= limit:
        return stepped, 1
    earlier = Window.partitionBy("slot").orderBy("step").rangeBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum(F.size("indices") + F.lit(1)).over(earlier), F.lit(0))
    numbered = stepped.withColumn("run", F.floor(before / F.lit(limit)).cast("int"))
    return numbered, numbered.agg(F.max("run")).first()[0] + 1


def changes_by_runs(
    numbered: DataFrame, runs: int, params: DataFrame, meta: ModelMeta, cfg: FMConfig, slots: int,
    epoch: int = 1,
) -> DataFrame:
    """As ``local_changes``, one run after the other; what a run leaves is stored and cuts the lineage."""
    spark = numbered.sparkSession
    folder = new_run_dir(spark, "runs")
    start = f"{_packed(cfg)} AS start"
    schema = "shard int, j int, values array<double>"
    done: list[DataFrame] = []

    def latest() -> DataFrame | None:
        """What each shard has made of each feature it has touched so far."""
        if not done:
            return None
        every = done[0]
        for part in done[1:]:
            every = every.unionByName(part)
        return every.groupBy("shard", "j").agg(F.max_by("values", "run").alias("now"))

    for run in range(runs):
        mine = numbered.where(F.col("run") == run)
        sent = needed_features(mine, cfg).join(_table(params, meta, cfg), "j").selectExpr("slot", "shard", "j", start)
        now = latest()
        if now is not None:
            sent = sent.join(now, ["shard", "j"], "left").selectExpr("slot", "shard", "j", "coalesce(now, start) AS start")
        sent = sent.withColumnRenamed("start", "values")
        ended = _stream(mine, sent, cfg, slots, epoch).applyInArrow(_walk(cfg, meta, True), schema)
        done.append(write_table(ended, f"{folder}/run{run}").withColumn("run", F.lit(run)))
    return latest().join(_table(params, meta, cfg), "j").selectExpr("j", start, "now").selectExpr(
        "j", "zip_with(now, start, (a, b) -> a - b) AS change")


def average_changes(params: DataFrame, changes: DataFrame, cfg: FMConfig) -> DataFrame:
    """Parameters plus the mean change over all shards.

    A shard that never touches a feature contributes a change of zero, so this
    equals the mean of the shards' complete parameter sets.
    """
    width = 1 + cfg.k2
    slots = _slot_columns(cfg)
    means = [f"sum(get(change, {i})) / {float(cfg.num_shards)!r}D" for i in range(width * len(slots))]
    mean = changes.groupBy("j").agg(F.expr(f"array({', '.join(means)}) AS change"))
    updated = []
    for i, (w, v) in enumerate(slots):
        own = ", ".join(f"get({v}, {f}) + get(change, {i * width + 1 + f})" for f in range(cfg.k2))
        updated.append(f"{w} + coalesce(get(change, {i * width}), 0D) AS {w}")
        updated.append(f"if(j = 0 OR change IS NULL, {v}, array({own})) AS {v}")
    return params.join(mean, "j", "left").selectExpr("j", *updated)


def local_epoch(
    sharded: DataFrame,
    params: DataFrame,
    meta: ModelMeta,
    cfg: FMConfig,
    *,
    slots: int,
    needed: DataFrame | None = None,
    runs: tuple[DataFrame, int] | None = None,
    epoch: int = 1,
) -> DataFrame:
    """Parameters (and optimizer state) after one epoch over examples placed in ``slots`` slots.

    ``needed`` and ``runs`` depend on the examples only; a caller with many epochs gives them.
    """
    stepped = sharded if "step" in sharded.columns else number_steps(sharded)
    if cfg.counts_steps and epoch > 1 and "shard_rows" not in stepped.columns:
        stepped = with_shard_rows(stepped)
    needed = needed if needed is not None else needed_features(stepped, cfg)
    numbered, n_runs = runs if runs is not None else plan_runs(stepped, needed, cfg)
    if n_runs == 1:
        changes = local_changes(stepped, needed, params, meta, cfg, slots, epoch)
    else:
        changes = changes_by_runs(numbered, n_runs, params, meta, cfg, slots, epoch)
    return average_changes(params, changes, cfg)
