"""Best-fit packing with linear grouping.

Documents are tokenized and cut into pieces of at most ``capacity`` tokens.
Packing needs only how many pieces there are of each length, a table of at most
``capacity`` rows whatever the corpus. On it the plan is made:

1. Large lengths (over ``capacity // SMALL``) are sorted and dealt into groups of
   equal cardinality; in a group all lengths are rounded up to the longest.
2. Configurations of these few sizes are optimised by column generation: a
   linear program over patterns, new patterns from a knapsack on the duals.
   Rounded-down pattern counts are used, the rest is filled best-fit.
3. Real pieces take the rounded slots of all configurations, longest first.
4. Large pieces left over, then small lengths, go best-fit against the real room, longest first.

Bins that hold the same lengths are one class, so the plan is a list of runs:
"pieces a to b of length l go to sequences s, s+1, .. at offset o". Pieces are
numbered within their length by block counts, never by one task per length,
and joined with the runs, whose number is bounded by the number of lengths and
classes.

Null text is empty: one piece, the end token alone. Empty input gives no rows.
Repeated rows and null ids are packed like any other row; ties in length are
dealt by row order within a block, any assignment being as good. Columns other
than id and text aren't read.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pairloom.llm.common import stored_by_texts, texts

# Lengths up to capacity // SMALL are small; the number of equal-cardinality groups.
SMALL, GROUPS = 4, 48
REMEMBERED, LONGEST, ENCODED, ENCODED_WHOLE = 200_000, 64, 20_000, 200
# What the last token of a word ends with, and no other.
WORD_END = "</w>"
# A character of one id, between blanks: where it stands, a chunk ends.
MARK = "\x01"
# What the word pattern below is equal to, as a tokenizer file states it.
NORMALIZER = {"type": "Sequence", "normalizers": [
    {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]}
SPLITTER = {"type": "Sequence", "pretokenizers": [
    {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"},
     "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]}
# Plain: ASCII and the Latin letters and signs up to U+017F, which NFC leaves alone and whose lower case is one character.
# A special token, which the library looks for before it lowers a text, begins with "<|".
NOT_PLAIN = re.compile("[^\x00-\x7f\xa1-\u012f\u0131-\u017f]")
_LETTERS, _DIGITS = "a-z\xaa\xb5\xba\xdf-\xf6\xf8-\u017f", "0-9\xb2\xb3\xb9\xbc-\xbe"
WORD = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[{_DIGITS}]|[^\\x09-\\x0d {_LETTERS}{_DIGITS}]+|\n")
# Bytes as the printable characters that byte-level vocabularies are made of: visible ones stand for themselves, and
# the blank stays, as words are joined by it.
_VISIBLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
BYTE_POINTS = np.arange(256, dtype="<u4")
BYTE_POINTS[np.setdiff1d(BYTE_POINTS, _VISIBLE)] = 0x100 + np.arange(256 - len(_VISIBLE))
BYTE_POINTS[0x20] = 0x20
# Pieces of one length are numbered in so many blocks at least.
BLOCKS = 64
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


@dataclass
class BinClass:
    """``count`` bins, each holding ``items``: (length, how often), with ``free`` tokens left."""

    count: int
    free: int
    items: tuple[tuple[int, int], ...]


def knapsack(sizes: np.ndarray, values: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """Best multiset of ``sizes`` within ``capacity``: its value and the number of each."""
    best, chosen = np.zeros(capacity + 1), []
    for _ in range(capacity // int(sizes.min())):
        options = np.full((len(sizes), capacity + 1), -1.0)
        for i, (s, v) in enumerate(zip(sizes.tolist(), values.tolist())):
            if v > 0:
                options[i, s:] = best[: capacity + 1 - s] + v
        pick = options.argmax(axis=0)
        value = options[pick, np.arange(capacity + 1)]
        better = value > best + 1e-12
        if not better.any():
            break
        chosen.append(np.where(better, pick, -1))
        best = np.where(better, value, best)
    counts, at = np.zeros(len(sizes), dtype=np.int64), capacity
    for step in reversed(chosen):
        if step[at] >= 0:
            counts[step[at]] += 1
            at -= int(sizes[step[at]])
    return float(best[capacity]), counts


def configurations(sizes: np.ndarray, demand: np.ndarray, capacity: int, rounds: int = 400) -> list[tuple[int, np.ndarray]]:
    """(bins, number of each size) covering at most ``demand``, from the fractional optimum rounded down."""
    k = len(sizes)
    basis = np.diag((capacity // sizes).astype(float))
    for _ in range(rounds):
        inverse = np.linalg.inv(basis)
        duals = np.ones(k) @ inverse
        value, pattern = knapsack(sizes, duals, capacity)
        if value <= 1 + 1e-7:
            break
        amounts, direction = inverse @ demand, inverse @ pattern
        ratio = np.full(k, np.inf)
        up = direction > 1e-10
        ratio[up] = amounts[up] / direction[up]
        basis[:, int(ratio.argmin())] = pattern
    amounts = np.maximum(np.linalg.inv(basis) @ demand, 0)
    return [(int(n), basis[:, i].astype(np.int64)) for i, n in enumerate(np.floor(amounts + 1e-9)) if n >= 1]


def grouped_bins(large: list[tuple[int, int]], capacity: int, groups: int) -> tuple[list[BinClass], list[tuple[int, int]]]:
    """Classes from rounded configurations with real lengths in them, and the lengths left over."""
    total = sum(n for _, n in large)
    edges = [round(total * (g + 1) / groups) for g in range(groups)]
    pools: list[list[list[int]]] = []
    for g in range(groups):
        pools.append([])
        if g and edges[g] <= edges[g - 1]:
            continue
    at, g = 0, 0
    for length, n in large:  # longest first
        while n:
            while at >= edges[g]:
                g += 1
            take = min(n, edges[g] - at)
            pools[g].append([length, take])
            at, n = at + take, n - take
    pools = [p for p in pools if p]
    # Groups rounded to the same length are one size.
    merged: dict[int, list[list[int]]] = {}
    for p in pools:
        merged.setdefault(p[0][0], []).extend(p)
    sizes = np.array(list(merged), dtype=np.int64)
    demand = np.array([sum(n for _, n in p) for p in merged.values()], dtype=float)
    classes = []
    pools = list(merged.values())
    for bins, pattern in configurations(sizes, demand, capacity):
        slots = [i for i, n in enumerate(pattern.tolist()) for _ in range(n)]
        while bins:
            # Every slot takes the longest piece left of its group; a run lasts while all lengths stay.
            wanted: dict[int, int] = {}
            for i in slots:
                wanted[i] = wanted.get(i, 0) + 1
            if any(not pools[i] for i in wanted):
                slots = [i for i in slots if pools[i]]
                if not slots:
                    break
                continue
            run = bins
            for i, n in wanted.items():
                if pools[i][0][1] >= n:
                    run = min(run, pools[i][0][1] // n)
                else:
                    run = 1
            items: list[tuple[int, int]] = []
            for i, n in wanted.items():
                need = n * run
                while need and pools[i]:
                    length, have = pools[i][0]
                    take = min(need, have)
                    items.append((length, take // run))
                    need -= take
                    if have == take:
                        pools[i].pop(0)
                    else:
                        pools[i][0][1] -= take
            classes.append(BinClass(run, capacity - sum(a * b for a, b in items), tuple(items)))
            bins -= run
    rest: dict[int, int] = {}
    for p in pools:
        for length, n in p:
            rest[length] = rest.get(length, 0) + n
    return classes, sorted(rest.items(), reverse=True)


def best_fit(classes: list[BinClass], lengths: list[tuple[int, int]], capacity: int) -> list[BinClass]:
    """Put ``lengths`` (longest first) where the least room is left, classes of equal bins at a time."""
    out: list[BinClass] = []
    open_: list[tuple[int, int]] = []
    store: dict[int, BinClass] = {}

    def add(c: BinClass) -> None:
        if c.free:
            store[len(store)] = c
            insort(open_, (c.free, len(store) - 1))
        else:
            out.append(c)

    for c in classes:
        add(c)
    for length, n in lengths:
        while n:
            at = bisect_left(open_, (length, -1))
            if at == len(open_):
                each = capacity // length
                bins, odd = divmod(n, each)
                if bins:
                    add(BinClass(bins, capacity - each * length, ((length, each),)))
                if odd:
                    add(BinClass(1, capacity - odd * length, ((length, odd),)))
                break
            c = store[open_.pop(at)[1]]
            each = c.free // length
            bins, odd = (c.count, 0) if n >= c.count * each else divmod(n, each)
            if bins:
                add(BinClass(bins, c.free - each * length, (*c.items, (length, each))))
            if odd:
                add(BinClass(1, c.free - odd * length, (*c.items, (length, odd))))
            if c.count - bins - bool(odd):
                add(BinClass(c.count - bins - bool(odd), c.free, c.items))
            n -= bins * each + odd
    return out + [store[i] for _, i in open_]


def pack_plan(histogram: dict[int, int], capacity: int, groups: int = GROUPS) -> list[tuple[int, int, int, int, int, int]]:
    """Runs (length, first rank, pieces, first sequence, pieces of it per sequence, offset)."""
    border = capacity // SMALL
    large = sorted(((a, n) for a, n in histogram.items() if a > border), reverse=True)
    small = sorted(((a, n) for a, n in histogram.items() if a <= border), reverse=True)
    classes: list[BinClass] = []
    if large:
        classes, rest = grouped_bins(large, capacity, groups)
        classes = best_fit(classes, rest, capacity)
    classes = best_fit(classes, small, capacity)
    runs, used, sequence = [], dict.fromkeys(histogram, 0), 0
    for c in classes:
        offset = 0
        for length, each in c.items:
            runs.append((length, used[length], c.count * each, sequence, each, offset))
            used[length] += c.count * each
            offset += length * each
        sequence += c.count
    assert used == histogram, "every piece has one place"
    return runs


def plain(text: str) -> bool:
    return "<|" not in text and (text.isascii() or not NOT_PLAIN.search(text))


def chunks_of(text: str) -> list[str]:
    """Parts of a text between blanks and line ends.

    The vocabulary is in lower case; a text of plain characters may be lowered as a whole, so that more parts are equal.
    """
    return (text.lower() if plain(text) else text).replace("\n", " ").split(" ")


def encode_chunks(tokenizer, chunks: list[str]) -> list[bytes]:
    """The ids of each chunk, as bytes; all chunks are encoded as one text and cut at marks between them."""
    joined = f" {MARK} ".join(chunks)
    ids, mark = (np.array(tokenizer.encode_batch_fast([t], add_special_tokens=False)[0].ids, dtype="<u4") for t in (joined, MARK))
    at = np.flatnonzero(ids == mark[0])
    if len(mark) != 1 or len(at) != len(chunks) - 1:
        # A chunk holds the mark itself.
        return [np.array(e.ids, dtype="<u4").tobytes() for e in tokenizer.encode_batch_fast(chunks, add_special_tokens=False)]
    whole = ids.tobytes()
    return [whole[a:b] for a, b in zip([0, *(4 * at + 4).tolist()], [*(4 * at).tolist(), len(whole)])]


class WordEncoder:
    """The ids of chunks, word by word.

    The library's merges run without its normalizer and splitter, which cost several times as much, so words are
    cut here. That is done for chunks of plain characters only, where lower case and the classes of characters are
    those of the vocabulary's own pattern; other chunks, and all with another pattern, go through the whole library.
    """

    def __init__(self, tokenizer, path: str) -> None:
        from tokenizers import Tokenizer, models, pre_tokenizers

        normalizer, splitter = (
            json.loads(x.__getstate__()) if x else None for x in (tokenizer.normalizer, tokenizer.pre_tokenizer))
        self._whole, self._path = tokenizer, path
        self._by_word = (
            normalizer == NORMALIZER and splitter == SPLITTER
            and isinstance(tokenizer.model, models.BPE) and tokenizer.model.end_of_word_suffix == WORD_END
            and all(t.content.startswith("<|") for t in tokenizer.get_added_tokens_decoder().values())
        )
        if self._by_word:
            self._merges = Tokenizer(tokenizer.model)
            self._merges.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
            vocabulary = tokenizer.get_vocab(with_added_tokens=False)
            self._ends = np.zeros(1 + max(vocabulary.values()), dtype=bool)
            self._ends[[i for token, i in vocabulary.items() if token.endswith(WORD_END)]] = True

    def encode(self, chunks: list[str]) -> Iterator[tuple[str, bytes]]:
        """Every chunk, none of which holds a line end, with its ids, in any order."""
        for block, ids in self.blocks(chunks):
            yield from zip(block, ids)

    def blocks(self, chunks: list[str]) -> Iterator[tuple[list[str], list[bytes]]]:
        """``encode``, block by block."""
        for i in range(0, len(chunks), ENCODED):
            block = chunks[i : i + ENCODED]
            other = []
            if not self._by_word:
                block, other = [], block
            elif not plain("\n".join(block)):
                other = [c for c in block if not plain(c)]
                block = [c for c in block if plain(c)]
            if block:
                yield block, self._plain(block)
            for at in range(0, len(other), ENCODED_WHOLE):
                part = other[at : at + ENCODED_WHOLE]
                yield part, encode_chunks(self._whole, part)

    def _plain(self, chunks: list[str]) -> list[bytes]:
        words = WORD.findall("\n".join(chunks).lower())
        # A line end is no word to the merges.
        distinct = set(words) - {"\n"}
        place = {word: i for i, word in enumerate(distinct)}
        place["\n"] = len(distinct)
        joined = " ".join(distinct)
        if not (joined.isascii() and joined.isprintable()):
            joined = BYTE_POINTS[np.frombuffer(joined.encode(), np.uint8)].tobytes().decode("utf-32-le")
        ids = np.array(self._merges.encode_batch_fast([joined], add_special_tokens=False)[0].ids, dtype="<u4")
        ends = np.flatnonzero(self._ends[ids]) + 1
        if len(ends) != len(distinct) or len(ids) and ends[-1] != len(ids):
            raise ValueError(f"{self._path}: a word of the vocabulary's pattern did not end with one token")
        lengths = np.append(np.diff(ends, prepend=0), 0)
        starts = np.append(ends, 0) - lengths
        at = np.fromiter(map(place.__getitem__, words), np.int64, len(words))
        many = lengths[at]
        until = np.cumsum(many)
        whole = ids[np.repeat(starts[at] - until + many, many) + np.arange(many.sum())].tobytes()
        cuts = [0, *(4 * until[at == len(distinct)]).tolist(), len(whole)]
        return [whole[a:b] for a, b in zip(cuts, cuts[1:])]


@lru_cache(maxsize=1)
def word_encoder(path: str) -> WordEncoder:
    """Read once by a worker, for all its tasks."""
    # One task, one core: threads of the library would multiply its memory and compete with other tasks.
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return WordEncoder(tokenizer, path)


def tokenize_pieces(docs: DataFrame, path: str, capacity: int, end_id: int, text: str, id_column: str) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` of every piece.

    The vocabulary's words never hold white space, so texts are encoded chunk by
    chunk between spaces and line ends, each distinct chunk once per task, and a new chunk word by word.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_encoder(path)
        known: dict[str, bytes] = {}
        end = np.array([end_id], dtype="<u4").tobytes()
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                batch = whole.slice(at, 500)
                chunks: list[str] = []
                parts: list[bytes | None] = []
                ends = []
                for t in texts(batch["text"]):
                    words = chunks_of(t)
                    chunks += words
                    parts += map(known.get, words)
                    ends.append(len(chunks))
                missing = [i for i, part in enumerate(parts) if part is None]
                new = list({chunks[i] for i in missing})
                for block, ids in encoder.blocks(new):
                    known.update(zip(block, ids))
                for i in missing:
                    parts[i] = known[chunks[i]]
                rows: list[list] = [[], [], [], [], []]
                for doc_id, first, last in zip(batch["doc_id"].to_pylist(), [0, *ends], ends):
                    ids = b"".join(parts[first:last]) + end
                    for piece, start in enumerate(range(0, len(ids), 4 * capacity)):
                        part = ids[start : start + 4 * capacity]
                        for column, x in zip(rows, (doc_id, piece, start // 4, len(part) // 4, zlib.crc32(part))):
                            column.append(x)
                if len(known) > REMEMBERED:
                    # Those of this batch stay, frequent ones among them.
                    known = dict(zip(chunks, parts))
                for w in new:
                    if len(w) > LONGEST:
                        del known[w]
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(rows, kinds)], ["doc_id", "piece", "start", "length", "ids_crc32"])

    source = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return source.mapInArrow(run, PIECES)


def pack_pieces(pieces: DataFrame, capacity: int) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to a stored table with ``doc_id, piece, length``."""
    spark = pieces.sparkSession
    # At most `capacity` rows reach the driver.
    histogram = {r[0]: r[1] for r in pieces.groupBy("length").count().collect()}
    runs = pack_plan(histogram, capacity)
    # Ranks within a length: position in a block plus the sizes of earlier blocks.
    # Frequent lengths have more blocks, so that no block grows with the corpus.
    rows_per_block = 50_000
    blocks = spark.createDataFrame(
        [(a, max(BLOCKS, -(-n // rows_per_block))) for a, n in histogram.items()], "length long, blocks long")
    keyed = pieces.join(F.broadcast(blocks), "length").withColumn(
        "block", F.pmod(F.xxhash64("doc_id", "piece"), F.col("blocks"))).drop("blocks")
    before = Window.partitionBy("length").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = keyed.groupBy("length", "block").count().select(
        "length", "block", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("first"))
    within = Window.partitionBy("length", "block").orderBy("doc_id", "piece")
    ranked = keyed.withColumn("at", F.row_number().over(within) - 1).join(offsets, ["length", "block"]).withColumn(
        "rank", F.col("first") + F.col("at")).drop("first", "at", "block")
    # The runs of a length as one array, searched per row: the last run that starts at or before the rank.
    plan = spark.createDataFrame(
        [(a, b, n, s, e, o) for a, b, n, s, e, o in runs],
        "length long, run_rank long, run_pieces long, run_sequence long, run_each long, run_offset long")
    # A run is at most a bucket of ranks long, so (length, bucket) is an equi-join key.
    width = F.greatest(F.lit(1), F.expr("run_width"))
    widths = spark.createDataFrame(
        [(a, max(1, n // 64)) for a, n in histogram.items()], "length long, run_width long")
    cut = plan.join(F.broadcast(widths), "length").withColumn(
        "bucket", F.explode(F.sequence(F.floor(F.col("run_rank") / width), F.floor((F.col("run_rank") + F.col("run_pieces") - 1) / width))))
    placed = (
        ranked.join(F.broadcast(widths), "length")
        .withColumn("bucket", F.floor(F.col("rank") / width)).drop("run_width")
        .join(F.broadcast(cut.drop("run_width")), ["length", "bucket"])
        .where((F.col("rank") >= F.col("run_rank")) & (F.col("rank") < F.col("run_rank") + F.col("run_pieces"))))
    nth = F.col("rank") - F.col("run_rank")
    return placed.select(
        *[c for c in pieces.columns],
        (F.col("run_sequence") + F.floor(nth / F.col("run_each"))).cast("long").alias("sequence_id"),
        (F.col("run_offset") + (nth % F.col("run_each")) * F.col("length")).cast("long").alias("offset"))


def pack_documents(
    docs: DataFrame, path: str, capacity: int = 4096, end_id: int = 1, text: str = "text", id_column: str = "doc_id",
) -> DataFrame:
    """Tokenize, cut and pack; one row per piece with its sequence and offset."""
    pieces = stored_by_texts(tokenize_pieces(docs, path, capacity, end_id, text, id_column), "pieces")
    return pack_pieces(pieces, capacity)
