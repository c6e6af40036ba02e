"""Turning categorical columns and texts into indexed one-hot examples."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pairloom.functions.text import words
from pairloom.operators.examples import slot_labels, spread_for_scoring
from pairloom.operators.lookup import lookup
from pairloom.operators.scoring import first_of_equal
from pairloom.plans.scratch import new_run_dir, write_table

# Rows of a partition sit in the low bits of monotonically_increasing_id.
_ROW_BITS = 33
_ROW_MASK = (1 << _ROW_BITS) - 1
# Tokens that one task looks up.
SLOT_TOKENS = 1_000_000
# Tokens in one batch of those that a slot asks for.
_SENT_ROWS = 16384
# Bytes of text that are counted at a time, and non-zeros that are numbered at a time.
_PIECE_BYTES = 4 << 20
_PIECE_VALUES = 1 << 18
_CHUNKS = (
    "slot int, turn int, example_id long, label double, ids array<int>, x array<double>, words array<string>"
)


@dataclass(frozen=True)
class Vocabulary:
    """``frame(token, j)`` with ``j`` = 1..size in token order."""

    frame: DataFrame
    size: int


def build_vocabulary(tokens: DataFrame) -> Vocabulary:
    """Number the distinct values of ``token`` from 1 in sorted order.

    The result equals ``row_number() over (order by token)``, but no task sees
    all tokens: a range sort spreads them, each partition numbers its own
    rows, and the partition sizes (one row per partition) give the offsets.
    """
    spark = tokens.sparkSession
    run = new_run_dir(spark, "vocabulary")
    ordered = tokens.select("token").distinct().orderBy("token")
    placed = write_table(ordered.select("token", F.monotonically_increasing_id().alias("place")), f"{run}/placed")
    part = F.shiftright("place", _ROW_BITS).alias("part")
    sizes = placed.groupBy(part).agg(F.count("*").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    numbered = placed.withColumn("part", part).join(F.broadcast(offsets), "part").select(
        "token", (F.col("place").bitwiseAND(F.lit(_ROW_MASK)) + F.col("offset") + 1).cast("int").alias("j")
    )
    frame = write_table(numbered, f"{run}/numbered")
    return Vocabulary(frame, frame.count())


def slots_for(spark: SparkSession, amount: int, each: int) -> int:
    """Tasks that take about ``each`` of ``amount``, and no fewer than a shuffle has."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-amount // each))


def gathered(tokens: DataFrame) -> DataFrame:
    """``example_id, label, tokens`` from ``tokens(example_id, label, token, x)``; a null token adds nothing."""
    pair = F.when(F.col("token").isNotNull(), F.struct("token", "x"))
    return tokens.groupBy("example_id", "label").agg(F.collect_list(pair).alias("tokens"))


def indexed_rows(rows: DataFrame, vocabulary: Vocabulary, limit_bytes: int = 64 << 20) -> DataFrame:
    """Wide examples from a stored table ``rows(example_id, label, tokens array<struct<token, x>>)``.

    Rows move once, whole, to slots of about ``SLOT_TOKENS`` tokens, so a task's share does not grow with the table. A
    vocabulary beyond ``limit_bytes`` is sent to the slots by the distinct tokens of each; a slot's task receives these first
    and then its rows, as one sorted stream. Rows of the same id and label become one.
    """
    spark = rows.sparkSession
    n_tokens = rows.agg(F.sum(F.size("tokens"))).first()[0] or 0
    slots = slots_for(spark, n_tokens, SLOT_TOKENS)
    placed = spread_for_scoring(rows, slots)
    if vocabulary.size * 96 <= limit_bytes:
        long = placed.select("slot", "example_id", "label", F.inline_outer("tokens"))
        found = lookup(long, vocabulary.frame, "token", table_rows=vocabulary.size, row_bytes=96, limit_bytes=limit_bytes)
        pair = F.when(F.col("j").isNotNull(), F.struct("j", "x"))
        pairs = F.sort_array(F.collect_list(pair))
        return found.groupBy("slot", "example_id", "label").agg(pairs.alias("pairs")).select(
            "example_id", "label", F.col("pairs.j").alias("indices"), F.col("pairs.x").alias("values")
        )
    # Whole rows go in, so that both sides read the one shuffle of them.
    used = placed.mapInArrow(_distinct_tokens, "slot int, token string")
    sent = used.join(vocabulary.frame, "token").selectExpr(
        "slot", "0 AS turn", "cast(NULL AS long) AS example_id", "cast(NULL AS double) AS label", "array(token) AS token",
        "array(cast(j AS double)) AS x",
    ).repartition(slots, "slot")
    # The sum with zero removes -0, as grouping does.
    own = placed.selectExpr(
        "slot", "1 AS turn", "example_id", "label + 0D AS label", "tokens.token AS token", "tokens.x AS x")
    stream = own.unionByName(sent).sortWithinPartitions("slot", "turn", "example_id", "label")
    return stream.groupBy("slot").applyInArrow(
        _indexed_slot, "example_id long, label double, indices array<int>, values array<double>")


def _distinct_tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct tokens of each slot that lies in a partition."""
    found: dict[int, pa.Array] = {}
    for batch in batches:
        slot = batch.column("slot")
        for number in pc.unique(slot).to_pylist():
            mine = batch.column("tokens").filter(pc.equal(slot, number)).flatten().field("token")
            known = [found[number]] if number in found else []
            found[number] = pc.drop_null(pc.unique(pa.chunked_array([*known, pc.unique(mine)])))
    for number, tokens in found.items():
        for at in range(0, len(tokens), _SENT_ROWS):
            part = tokens.slice(at, _SENT_ROWS)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(part), number, np.int32)), part], names=["slot", "token"])


def _indexed_slot(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Wide examples of one slot's stream: its tokens with their numbers, then its rows by id and label."""
    tokens, numbers, table, held = [], [], None, None
    for batch in batches:
        n_sent = int((batch.column("turn").to_numpy() == 0).sum())
        if n_sent:
            part = batch.slice(0, n_sent)
            tokens.append(part.column("token").flatten())
            numbers.append(part.column("x").flatten().to_numpy())
        if n_sent == batch.num_rows:
            continue
        if table is None:
            table = pa.concat_arrays(tokens) if tokens else pa.array([], pa.string())
            number_of = np.concatenate([*numbers, [0.0]]).astype(np.int32)
        own = batch.slice(n_sent)
        if held is not None:
            own = pa.concat_batches([held, own])
        # Rows of the same keys are neighbours; the last may go on in the next batch.
        starts = first_of_equal(own, ["example_id", "label"])
        held = own.slice(int(starts[-1]))
        if len(starts) > 1:
            yield _indexed_batch(own.slice(0, int(starts[-1])), starts[:-1], table, number_of)
    if held is not None:
        yield _indexed_batch(held, np.zeros(1, np.int64), table, number_of)


def _indexed_batch(rows: pa.RecordBatch, starts: np.ndarray, table: pa.Array, number_of: np.ndarray) -> pa.RecordBatch:
    """One example per run of rows that begins at ``starts``; tokens outside the table add nothing."""
    token = rows.column("token").flatten()
    at = pc.fill_null(pc.index_in(token, table, skip_nulls=True), -1).to_numpy()
    kept = at >= 0
    lengths = pc.fill_null(rows.column("token").value_lengths(), 0).to_numpy()
    run = np.repeat(np.arange(len(starts)), np.diff(np.r_[starts, rows.num_rows]))
    example = np.repeat(run, lengths)[kept]
    j, x = number_of[at[kept]], rows.column("x").flatten().filter(pa.array(kept))
    order = np.lexsort((pc.fill_null(x, -np.inf).to_numpy(), j, example))
    offsets = pa.array(np.r_[0, np.cumsum(np.bincount(example, minlength=len(starts)))].astype(np.int32))
    lists = [pa.ListArray.from_arrays(offsets, values) for values in (pa.array(j[order]), x.take(pa.array(order)))]
    first = rows.take(pa.array(starts))
    return pa.RecordBatch.from_arrays(
        [first.column("example_id"), first.column("label"), *lists], names=["example_id", "label", "indices", "values"])


def indexed_examples(tokens: DataFrame, vocabulary: Vocabulary, limit_bytes: int = 64 << 20) -> DataFrame:
    """Wide examples from ``tokens(example_id, label, token, x)``.

    A token outside the vocabulary, or the null token of an example that has
    none, adds no feature; the example stays.
    """
    return indexed_rows(gathered(tokens), vocabulary, limit_bytes)


def field_rows(df: DataFrame, example_id: Column, label: Column, fields: dict[str, Column]) -> DataFrame:
    """Per row ``example_id, label, tokens``: one ``name=value`` token with value 1.0 per field."""
    tokens = [
        F.struct(F.concat(F.lit(f"{name}="), value.cast("string")).alias("token"), F.lit(1.0).alias("x"))
        for name, value in fields.items()
    ]
    return df.select(
        example_id.cast("long").alias("example_id"), label.cast("double").alias("label"), F.array(*tokens).alias("tokens"))


def field_tokens(df: DataFrame, example_id: Column, label: Column, fields: dict[str, Column]) -> DataFrame:
    """``field_rows`` with a row per token."""
    return field_rows(df, example_id, label, fields).select("example_id", "label", F.inline("tokens"))


def text_tokens(df: DataFrame, example_id: Column, label: Column, text: Column, slots: int | None = None) -> DataFrame:
    """One row per distinct word of the whole text with its count.

    A text without words has one row with a null token. Texts are placed by example first, over ``slots`` tasks if
    given, so that neither counting words nor gathering them moves a row per word.
    """
    placed = df.select(example_id.cast("long").alias("example_id"), label.cast("double").alias("label"), text.alias("text"))
    placed = placed.repartition(*([slots] if slots else []), "example_id")
    return (
        placed.select("example_id", "label", F.explode_outer(words(F.col("text"))).alias("token"))
        .groupBy("example_id", "label", "token")
        .agg(F.count("token").cast("double").alias("x"))
    )


def text_chunks(df: DataFrame, example_id: Column, label: Column, text: Column, slots: int) -> DataFrame:
    """The words of whole texts with their counts, as ``gathered(text_tokens(...))`` has them, in ``slots`` slots.

    Words are numbered within a slot, so a word is handled once a slot and not once an occurrence. A row of turn 1 is an
    example, of the words ``ids`` with the counts ``x``. A row of turn 0 gives ``words`` of the slot, numbered from
    ``ids[0]``. Rows of the same id and label become one. ``indexed_chunks`` makes wide examples of it.
    """
    placed = df.select(
        example_id.cast("long").alias("example_id"), label.cast("double").alias("label"), F.lower(text).alias("text"))
    # The sum with zero removes -0, as grouping does.
    placed = placed.withColumn("label", F.col("label") + F.lit(0.0)).repartition(slots, "example_id")
    labels = sorted(slot_labels(df.sparkSession, slots))
    return placed.sortWithinPartitions("example_id", "label").mapInArrow(_counted(labels), _CHUNKS)


def _text_pieces(rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """A batch in pieces of about ``_PIECE_BYTES`` of text."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(rows.column("text")), 0).to_numpy().astype(np.int64))
    a = 0
    while a < rows.num_rows:
        before = ends[a - 1] if a else 0
        b = max(a + 1, int(np.searchsorted(ends, before + _PIECE_BYTES, "right")))
        yield rows.slice(a, b - a)
        a = b


def _split_words(text: pa.Array) -> pa.ListArray:
    """Texts split at white space, which is as in ``functions.text.words``; some parts are empty."""
    # Arrow's white space has the vertical tab besides.
    if pc.any(pc.match_substring(text, "\v")).as_py():
        return pc.split_pattern_regex(text, pattern=r"[ \t\n\r\f]+")
    return pc.ascii_split_whitespace(text)


def _counted(labels: list[int]):
    """The function that counts the words of a partition of texts in order of id and label."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        slot = labels[context.partitionId()] if context is not None else labels[0]
        known, held = pa.array([], pa.string()), None
        for batch in batches:
            for rows in _text_pieces(batch):
                if held is not None:
                    rows = pa.concat_batches([held, rows])
                # Rows of the same keys are neighbours; the last may go on in the next piece.
                starts = first_of_equal(rows, ["example_id", "label"])
                held = rows.slice(int(starts[-1]))
                if len(starts) > 1:
                    known, counted = _count_piece(rows.slice(0, int(starts[-1])), starts[:-1], known, slot)
                    yield counted
        if held is not None:
            known, counted = _count_piece(held, np.zeros(1, np.int64), known, slot)
            yield counted
        for at in range(0, len(known), _SENT_ROWS):
            part = known.slice(at, _SENT_ROWS)
            yield _chunk_rows(
                slot, 0, pa.array([None], pa.int64()), pa.array([None], pa.float64()), pa.array([[at]], pa.list_(pa.int32())),
                pa.array([[]], pa.list_(pa.float64())), pa.ListArray.from_arrays(pa.array([0, len(part)], pa.int32()), part))

    return each


def _chunk_rows(slot: int, turn: int, *columns) -> pa.RecordBatch:
    n = len(columns[0])
    both = [pa.array(np.full(n, value, np.int32)) for value in (slot, turn)]
    return pa.RecordBatch.from_arrays(
        [*both, *columns], names=["slot", "turn", "example_id", "label", "ids", "x", "words"])


def _count_piece(rows: pa.RecordBatch, starts: np.ndarray, known: pa.Array, slot: int) -> tuple[pa.Array, pa.RecordBatch]:
    """The words known now, and one example per run of rows that begins at ``starts``."""
    parts = _split_words(rows.column("text"))
    lengths = pc.fill_null(parts.value_lengths(), 0).to_numpy()
    token = parts.flatten()
    kept = pc.not_equal(token, "")
    run = np.repeat(np.arange(len(starts)), np.diff(np.r_[starts, rows.num_rows]))
    example = np.repeat(run, lengths)[kept.to_numpy(zero_copy_only=False)]
    coded = token.filter(kept).dictionary_encode()
    at = pc.index_in(coded.dictionary, known)
    new = coded.dictionary.filter(pc.is_null(at))
    number = np.empty(len(at), np.int64)
    is_new = pc.is_null(at).to_numpy(zero_copy_only=False)
    number[is_new] = len(known) + np.arange(len(new))
    number[~is_new] = pc.drop_null(at).to_numpy()
    known = pa.concat_arrays([known, new])
    both, counts = np.unique((example.astype(np.int64) << 32) | number[coded.indices.to_numpy()], return_counts=True)
    sizes = np.bincount(both >> 32, minlength=len(starts))
    offsets = pa.array(np.r_[0, np.cumsum(sizes)].astype(np.int32))
    ids = pa.ListArray.from_arrays(offsets, pa.array((both & 0xFFFFFFFF).astype(np.int32)))
    x = pa.ListArray.from_arrays(offsets, pa.array(counts.astype(np.float64)))
    first = rows.take(pa.array(starts))
    words_of = pa.nulls(len(starts), pa.list_(pa.string()))
    return known, _chunk_rows(slot, 1, first.column("example_id"), first.column("label"), ids, x, words_of)


def chunk_words(chunks: DataFrame) -> DataFrame:
    """``token``: the words of a stored table of ``text_chunks``, each once a slot."""
    return chunks.where(F.col("turn") == 0).select(F.explode("words").alias("token"))


def indexed_chunks(chunks: DataFrame, vocabulary: Vocabulary, slots: int) -> DataFrame:
    """Wide examples from a stored table of ``text_chunks`` in ``slots`` slots; a word outside the vocabulary adds nothing.

    A slot's task receives the numbers of its words and then its rows, as one sorted stream.
    """
    words_of = chunks.where(F.col("turn") == 0).select("slot", F.col("ids")[0].alias("first"), F.posexplode("words").alias("at", "token"))
    sent = words_of.join(vocabulary.frame, "token").selectExpr(
        "slot", "0 AS turn", "cast(first + at AS long) AS example_id", "cast(j AS double) AS label",
        "cast(array() AS array<int>) AS ids", "cast(array() AS array<double>) AS x",
    ).repartition(slots, "slot")
    own = chunks.where(F.col("turn") == 1).select("slot", "turn", "example_id", "label", "ids", "x").repartition(slots, "slot")
    stream = own.unionByName(sent).sortWithinPartitions("slot", "turn")
    return stream.groupBy("slot").applyInArrow(
        _numbered_slot, "example_id long, label double, indices array<int>, values array<double>")


def _numbered_slot(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Wide examples of one slot's stream: the numbers of its words, then its rows."""
    at, numbers, number_of, last = [], [], None, 0
    for batch in batches:
        turns = np.r_[last, batch.column("turn").to_numpy()]
        if (np.diff(turns) < 0).any():
            raise ValueError("the rows of a slot arrived unsorted")
        n_sent, last = int((turns[1:] == 0).sum()), turns[-1]
        if n_sent:
            at.append(np.array(batch.column("example_id")[:n_sent].to_numpy()))
            numbers.append(batch.column("label")[:n_sent].to_numpy().astype(np.int32))
        if n_sent == batch.num_rows:
            continue
        if number_of is None:
            places = np.concatenate([*at, np.empty(0, np.int64)])
            number_of = np.zeros(places.max(initial=-1) + 1, np.int32)
            number_of[places] = np.concatenate([*numbers, np.empty(0, np.int32)])
            at.clear(), numbers.clear()
        own = batch.slice(n_sent)
        ends = np.cumsum(own.column("ids").value_lengths().to_numpy())
        a = 0
        while a < own.num_rows:
            b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + _PIECE_VALUES, "right")))
            yield _numbered_piece(own.slice(a, b - a), number_of)
            a = b


def _numbered_piece(rows: pa.RecordBatch, number_of: np.ndarray) -> pa.RecordBatch:
    """The examples with the numbers of their words, ascending; a word without a number is left out."""
    ids = rows.column("ids").flatten().to_numpy()
    # Words after the last one that has a number have none either.
    j = np.where(ids < len(number_of), number_of[np.minimum(ids, max(len(number_of) - 1, 0))], 0) if len(number_of) else 0 * ids
    example = np.repeat(np.arange(rows.num_rows), rows.column("ids").value_lengths().to_numpy())
    order = np.argsort((example.astype(np.int64) << 32) | j)
    order = order[j[order] > 0]
    offsets = pa.array(np.r_[0, np.cumsum(np.bincount(example[order], minlength=rows.num_rows))].astype(np.int32))
    lists = [pa.ListArray.from_arrays(offsets, pa.array(v)) for v in (
        j[order].astype(np.int32), rows.column("x").flatten().to_numpy()[order])]
    return pa.RecordBatch.from_arrays(
        [rows.column("example_id"), rows.column("label"), *lists], names=["example_id", "label", "indices", "values"])
