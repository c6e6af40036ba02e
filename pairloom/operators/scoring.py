"""Scoring: linear and pairwise term of many examples in one aggregation."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StructType

from pairloom.config import CLASSIFICATION, FMConfig, ModelMeta
from pairloom.functions.math import clip, logistic
from pairloom.operators.examples import spread_for_scoring

BROADCAST_LIMIT_BYTES = FMConfig.broadcast_limit_bytes
# What tells scored examples apart.
KEYS = ("slot", "shard", "split", "example_id", "label")
# Examples without slots get one for each so many features of the model.
SLOT_FEATURES = 1 << 15
# Non-zeros, the bias included, of the examples that one slot scores, and those summed up at a time.
SLOT_VALUES = 8_000_000
_PIECE_VALUES = 1 << 18


def scoring_table(params: DataFrame, k2: int) -> DataFrame:
    """``j, w, v_0 .. v_{k2-1}, norm2`` with ``norm2`` the squared length of v."""
    v = [f"get(v, {f}) AS v_{f}" for f in range(k2)]
    norm2 = " + ".join(f"v_{f} * v_{f}" for f in range(k2))
    return params.selectExpr("j", "w", *v, f"{norm2} AS norm2")


def fits_broadcast(meta: ModelMeta, limit_bytes: int) -> bool:
    """Whether a scoring table of this many features is small enough to send to every task."""
    return (meta.n_features + 1) * scoring_row_bytes(meta) <= limit_bytes


def scoring_row_bytes(meta: ModelMeta) -> int:
    return 8 * (meta.k2 + 2) + 64


def wanted_features(examples: DataFrame, meta: ModelMeta) -> DataFrame:
    """Distinct ``slot, j`` of the examples, the bias included."""
    return examples.select("slot", F.explode(with_bias(meta)[0]).alias("j")).distinct()


def with_bias(meta: ModelMeta) -> tuple[Column, Column]:
    """Indices and values of an example; the bias is feature 0 with value 1."""
    indices, values = F.col("indices"), F.col("values")
    if meta.k0:
        indices = F.concat(F.array(F.lit(0)), indices)
        values = F.concat(F.array(F.lit(1.0)), values)
    return indices, values


def example_sums(
    examples: DataFrame,
    params: DataFrame,
    meta: ModelMeta,
    *,
    limit_bytes: int = BROADCAST_LIMIT_BYTES,
    wanted: DataFrame | None = None,
    unseen: str = "ignore",
    keep_pairs: bool = False,
    slots: int | None = None,
) -> DataFrame:
    """Per example: ``linear`` = w0 + sum w x, ``sum_sqr`` = sum |v|^2 x^2, ``s_f`` = sum v_f x.

    The bias takes part as feature 0 with value 1 in every example, which also
    keeps examples without features. Features without parameters add nothing, or, with
    ``unseen="error"``, end the query with an error as soon as one is looked up. ``keep_pairs`` adds the example's
    non-zeros, the bias included, as ``pairs``.
    Parameters of up to ``limit_bytes`` are broadcast, and examples that are not placed are aggregated to one row each before
    they move. Beyond it examples are summed up slot by slot; ``slots`` tells how many there are, if ``assign_shard`` placed them.
    """
    if unseen not in ("ignore", "error"):
        raise ValueError(f"unseen must be ignore or error, got {unseen!r}")
    if not fits_broadcast(meta, limit_bytes):
        return _sums_by_slot(examples, params, meta, wanted, unseen, keep_pairs, slots)
    keys = [c for c in KEYS if c in examples.columns]
    indices, values = with_bias(meta)
    long = examples.select(*keys, F.inline_outer(F.arrays_zip(indices.alias("j"), values.alias("x"))))
    table = scoring_table(params, meta.k2)
    attached = long.join(F.broadcast(table.withColumn("known", F.lit(True)) if unseen == "error" else table), "j", "left")
    if unseen == "error":
        missing = F.col("j").isNotNull() & F.col("known").isNull()
        message = F.concat(F.lit("the model has no parameters for feature "), F.col("j"))
        attached = attached.withColumn("x", F.when(missing, F.raise_error(message).cast("double")).otherwise(F.col("x")))
    totals = {"linear": "w * x", "sum_sqr": "norm2 * x * x", **{f"s_{f}": f"v_{f} * x" for f in range(meta.k2)}}
    return attached.groupBy(*keys).agg(
        *[F.expr(f"coalesce(sum({term}), 0D) AS {name}") for name, term in totals.items()],
        *([F.expr("collect_list(if(j IS NULL, NULL, struct(j, x))) AS pairs")] if keep_pairs else []),
    )


def _sums_by_slot(
    examples: DataFrame, params: DataFrame, meta: ModelMeta, wanted: DataFrame | None, unseen: str, keep_pairs: bool,
    slots: int | None,
) -> DataFrame:
    """``example_sums`` for parameters too large to broadcast.

    A slot's task receives one sorted stream: the parameters of the distinct features it uses, then its examples, whole.
    Examples that ``assign_shard`` has placed stay in place; others get slots, the more the larger the model is, so
    that a task's share does not grow with the data. No row per non-zero is made, sorted or moved.
    """
    spark = examples.sparkSession
    at_least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    own_slot = "slot" not in examples.columns
    keys = [c for c in KEYS if c in examples.columns]
    if own_slot:
        slots = max(at_least, -(-meta.n_features // SLOT_FEATURES))
        keys = ["slot", *[c for c in keys if c != "slot"]]
        examples = spread_for_scoring(examples, slots, drop=())
        wanted = None
    elif slots is None:
        # Where the slots lie is not known, so both sides of the stream are placed here.
        slots = at_least
        examples = examples.repartition(slots, "slot")
    if wanted is None:
        wanted = wanted_features(examples, meta)
    numbers = [f"coalesce({c}, 0D)" for c in ("w", *[f"v_{f}" for f in range(meta.k2)], "norm2")]
    table = scoring_table(params, meta.k2).selectExpr("j", f"array({', '.join(numbers)}) AS numbers")
    indices, values = with_bias(meta)
    listed = examples.select(*keys, indices.alias("indices"), values.alias("values"))
    # Lists of different length are filled up with nulls; zipping all would cost an object per non-zero.
    zipped, equal = F.arrays_zip("indices", "values"), F.size("indices") == F.size("values")
    rows = listed.select(
        *keys, F.lit(1).alias("turn"), *[F.when(equal, F.col(c)).otherwise(zipped[c]).alias(a) for c, a in (("indices", "j"), ("values", "x"))])
    types = {f.name: f.dataType for f in rows.schema}
    sent = wanted.where(F.col("j").isNotNull()).join(table, "j").select(*[
        F.col("slot") if c == "slot" else (F.col("j") if c == "example_id" else F.lit(None)).cast(types[c]).alias(c)
        for c in keys
    ], F.lit(0).alias("turn"), F.array("j").alias("j"), F.col("numbers").alias("x")).repartition(slots, "slot")
    order = [c for c in ("shard", "split", "example_id", "label") if c in keys]
    stream = rows.unionByName(sent).sortWithinPartitions("slot", "turn", *order)
    sums = ["linear", "sum_sqr", *[f"s_{f}" for f in range(meta.k2)]]
    schema = StructType([field for field in rows.schema if field.name in keys])
    for name in sums:
        schema = schema.add(name, "double")
    if keep_pairs:
        schema = schema.add("pairs", ArrayType(StructType().add("j", IntegerType()).add("x", DoubleType())))
    found = stream.groupBy("slot").applyInArrow(_slot_sums(keys, sums, unseen, keep_pairs), schema)
    # A slot made here is internal: the columns are the same at every model size.
    return found.drop("slot") if own_slot else found


def _slot_sums(keys: list[str], sums: list[str], unseen: str, keep_pairs: bool):
    """The function that sums up the examples of one slot's stream."""
    width = len(sums)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent_j, sent, known, numbers = [], [], None, None
        held, held_sums, last = None, np.empty((0, width)), 0
        for batch in batches:
            if batch.num_rows == 0:
                continue
            turns = np.r_[last, batch.column("turn").to_numpy()]
            if (np.diff(turns) < 0).any():
                raise ValueError("the rows of a slot arrived unsorted: the examples are not placed in as many slots as given")
            n_sent, last = int((turns[1:] == 0).sum()), turns[-1]
            if n_sent:
                part = batch.slice(0, n_sent)
                # Copies, so that no batch is held for them.
                sent_j.append(np.array(part.column("j").flatten().to_numpy()))
                sent.append(np.array(part.column("x").flatten().to_numpy()).reshape(n_sent, width))
            if n_sent == batch.num_rows:
                continue
            if known is None:
                known, numbers = _by_feature(sent_j, sent, width)
                sent_j.clear(), sent.clear()
            own = batch.slice(n_sent)
            totals = np.vstack([_example_totals(piece, known, numbers, unseen) for piece in _pieces(own)])
            columns = [own.column(c) for c in keys]
            if keep_pairs:
                columns.append(_pairs(own))
            rows = pa.RecordBatch.from_arrays(columns, names=[*keys, *(["pairs"] if keep_pairs else [])])
            if held is not None:
                rows, totals = pa.concat_batches([held, rows]), np.vstack([held_sums, totals])
            # Rows of the same keys are neighbours and become one; the last may go on in the next batch.
            starts = first_of_equal(rows, keys)
            held, held_sums = _merged(rows, starts[-1:], keep_pairs), totals[starts[-1] :].sum(axis=0, keepdims=True)
            if len(starts) > 1:
                ended = rows.slice(0, starts[-1])
                yield _with_sums(
                    _merged(ended, starts[:-1], keep_pairs), np.add.reduceat(totals[: starts[-1]], starts[:-1], axis=0), sums, keys)
        if held is not None:
            yield _with_sums(held, held_sums, sums, keys)

    return each


def _by_feature(j: list[np.ndarray], numbers: list[np.ndarray], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Ascending features and their numbers; those of a feature that comes twice are added."""
    if not j:
        return np.empty(0, np.int64), np.empty((0, width))
    j, numbers = np.concatenate(j), np.concatenate(numbers)
    if (np.diff(j) > 0).all():
        # As the stream brings them.
        return j, numbers
    order = np.argsort(j, kind="stable")
    known, first = np.unique(j[order], return_index=True)
    numbers = numbers[order]
    return known, numbers if len(known) == len(numbers) else np.add.reduceat(numbers, first, axis=0)


def _pieces(own: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """A batch of examples in pieces of about ``_PIECE_VALUES`` non-zeros."""
    ends = np.cumsum(pc.fill_null(own.column("j").value_lengths(), 0).to_numpy())
    a = 0
    while a < own.num_rows:
        before = ends[a - 1] if a else 0
        b = max(a + 1, int(np.searchsorted(ends, before + _PIECE_VALUES, "right")))
        yield own.slice(a, b - a)
        a = b


def _example_totals(own: pa.RecordBatch, known: np.ndarray, numbers: np.ndarray, unseen: str) -> np.ndarray:
    """Per example ``linear, sum_sqr, s_0 ..``; nulls and features without parameters add nothing."""
    lists = own.column("j")
    j, x = lists.flatten(), own.column("x").flatten()
    here = pc.and_(pc.is_valid(j), pc.is_valid(x)).to_numpy(zero_copy_only=False)
    given = pc.is_valid(j).to_numpy(zero_copy_only=False)
    lengths = pc.fill_null(lists.value_lengths(), 0).to_numpy()
    j, x = pc.fill_null(j, -1).to_numpy(), pc.fill_null(x, 0.0).to_numpy()
    at = np.minimum(np.searchsorted(known, j), max(len(known) - 1, 0))
    found = known[at] == j if len(known) else np.zeros(len(j), dtype=bool)
    if unseen == "error" and (given & ~found).any():
        raise ValueError(f"the model has no parameters for feature {j[given & ~found][0]}")
    used = found & here
    x, taken = x[used], numbers[at[used]]
    terms = taken * x[:, None]
    parts = np.column_stack([terms[:, 0], terms[:, -1] * x, terms[:, 1:-1]])
    counts = np.bincount(np.repeat(np.arange(len(lengths)), lengths)[used], minlength=len(lengths))
    totals = np.zeros((len(lengths), parts.shape[1]))
    filled = np.flatnonzero(counts)
    if len(filled):
        totals[filled] = np.add.reduceat(parts, (np.cumsum(counts) - counts)[filled], axis=0)
    return totals


def _pairs(own: pa.RecordBatch) -> pa.ListArray:
    """The non-zeros of each example as ``(j, x)``; those without a feature are left out."""
    lists = own.column("j")
    j, x = lists.flatten(), own.column("x").flatten()
    lengths = pc.fill_null(lists.value_lengths(), 0).to_numpy()
    kept = pc.is_valid(j).to_numpy(zero_copy_only=False)
    counts = np.bincount(np.repeat(np.arange(len(lengths)), lengths)[kept], minlength=len(lengths))
    both = pa.StructArray.from_arrays([j.filter(pa.array(kept)), x.filter(pa.array(kept))], names=["j", "x"])
    return pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(counts)].astype(np.int32)), both)


def first_of_equal(rows: pa.RecordBatch, keys: list[str]) -> np.ndarray:
    """Where runs of neighbours with equal keys begin, nulls being equal, and NaNs."""
    differs = np.zeros(rows.num_rows - 1, dtype=bool)
    for name in keys:
        before, after = rows.column(name)[:-1], rows.column(name)[1:]
        same = pc.or_(pc.fill_null(pc.equal(before, after), False), pc.and_(pc.is_null(before), pc.is_null(after)))
        if pa.types.is_floating(before.type):
            same = pc.or_(same, pc.fill_null(pc.and_(pc.is_nan(before), pc.is_nan(after)), False))
        differs |= ~same.to_numpy(zero_copy_only=False)
    return np.r_[0, np.flatnonzero(differs) + 1]


def _merged(rows: pa.RecordBatch, starts: np.ndarray, keep_pairs: bool) -> pa.RecordBatch:
    """The rows at ``starts``, each with the pairs of all rows up to the next."""
    firsts = rows.take(pa.array(starts))
    if not keep_pairs:
        return firsts
    lists = rows.column("pairs").slice(int(starts[0]))
    bounds = np.r_[0, np.cumsum(lists.value_lengths().to_numpy())]
    offsets = np.r_[bounds[starts - starts[0]], bounds[-1]].astype(np.int32)
    joined = pa.ListArray.from_arrays(pa.array(offsets), lists.flatten())
    return firsts.set_column(firsts.schema.get_field_index("pairs"), "pairs", joined)


def _with_sums(rows: pa.RecordBatch, totals: np.ndarray, sums: list[str], keys: list[str]) -> pa.RecordBatch:
    pairs = [c for c in rows.schema.names if c not in keys]
    columns = [*[rows.column(c) for c in keys], *[pa.array(totals[:, i]) for i in range(len(sums))]]
    return pa.RecordBatch.from_arrays([*columns, *[rows.column(c) for c in pairs]], names=[*keys, *sums, *pairs])


def _pairwise(k2: int) -> str:
    squares = " + ".join(f"s_{f} * s_{f}" for f in range(k2))
    return f"0.5D * ({squares} - sum_sqr)"


def link(sums: DataFrame, meta: ModelMeta, keep_sums: bool = False) -> DataFrame:
    """``raw`` and ``score`` from the sums: probability, or value inside the label range."""
    factor_sums = [f"s_{f}" for f in range(meta.k2)]
    kept = [c for c in sums.columns if c not in ("linear", "sum_sqr", *factor_sums)]
    raw = sums.selectExpr(*kept, *(factor_sums if keep_sums else []), f"linear + {_pairwise(meta.k2)} AS raw")
    if meta.task == CLASSIFICATION:
        return raw.withColumn("score", logistic(F.col("raw")))
    if meta.label_min is None or meta.label_max is None:
        raise ValueError("regression scores need the label range of the training data")
    return raw.withColumn("score", clip(F.col("raw"), meta.label_min, meta.label_max))


def score(examples: DataFrame, params: DataFrame, meta: ModelMeta, *, keep_sums: bool = False, **how) -> DataFrame:
    """``example_id, label, raw, score`` (and ``slot``, ``shard``, ``split`` where given) of every example.

    ``unseen`` is what features without parameters do: ``ignore`` (add nothing) or ``error``.
    """
    return link(example_sums(examples, params, meta, **how), meta, keep_sums)


def linear_term(examples: DataFrame, params: DataFrame, meta: ModelMeta, **how) -> DataFrame:
    """``example_id, label, linear``: w0 + sum w x."""
    return example_sums(examples, params, meta, **how).select("example_id", "label", "linear")


def pairwise_term(examples: DataFrame, params: DataFrame, meta: ModelMeta, **how) -> DataFrame:
    """``example_id, pairwise, s_0 ..``: half of sum_f s_f^2 minus sum of squares."""
    sums = example_sums(examples, params, meta, **how)
    return sums.selectExpr("example_id", f"{_pairwise(meta.k2)} AS pairwise", *[f"s_{f}" for f in range(meta.k2)])
