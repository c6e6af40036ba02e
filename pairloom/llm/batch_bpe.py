"""Byte-level BPE: words are merged together in rounds, all symbols in one flat array.

Every new word of an Arrow batch contributes its byte symbols to one array. A
round looks up the rank of each adjacent pair by binary search over the sorted
pair keys, finds each word's lowest rank and merges its occurrences from left
to right, for all words at once. Words end when no pair of theirs has a rank.
Word results are kept in a table of bounded size, so frequent words are merged
once per task. A word above ``LONG`` bytes would need as many rounds as it has ranks, so
it is merged by itself from a queue of its pairs, lowest rank and leftmost first, in
time near its length.

Null text counts as empty: no tokens, decoded as the empty text. Each input row
gives one output row, also repeated rows and null ids; other columns are not
read. Texts are processed whole; a long run without word break is one word.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.llm.common import texts

# The word pattern of the public byte-level vocabulary.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
# Words remembered per task, and the longest remembered one in characters.
REMEMBERED, LONGEST = 200_000, 64
# Words above this many bytes are merged by a queue.
LONG = 512
SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
NO_RANK = np.int64(1 << 62)


def byte_letters() -> dict[str, int]:
    """The printable letter that the vocabulary file uses for each byte, as letter -> byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    moved = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(moved)}


class Vocabulary:
    """Pair table and token bytes of a vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters, ids = byte_letters(), spec["model"]["vocab"]
        self.pieces = [b""] * (max([*ids.values(), *(t["id"] for t in spec["added_tokens"])]) + 1)
        for token, i in ids.items():
            self.pieces[i] = bytes(letters[c] for c in token)
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        for content, i in self.specials.items():
            self.pieces[i] = content.encode()
        self.of_byte = np.array([ids[c] for c, _ in sorted(letters.items(), key=lambda x: x[1])], dtype=np.int64)
        merges = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        self.base = len(self.pieces)
        keys = np.array([ids[a] * self.base + ids[b] for a, b in merges], dtype=np.int64)
        self.order = np.argsort(keys, kind="stable")
        self.keys = keys[self.order]
        self.rank_of = dict(zip(self.keys.tolist(), self.order.tolist()))
        self.merged = np.array([ids[a + b] for a, b in merges], dtype=np.int64)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left * self.base + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.order[at], NO_RANK)

    def encode_long(self, word: bytes) -> np.ndarray:
        """Token ids of one long word, from a queue of (rank, place) and links between the symbols left."""
        start = self.of_byte[np.frombuffer(word, np.uint8)]
        ranks = np.append(self.ranks(start[:-1], start[1:]), NO_RANK)
        queue = [(r, i) for i, r in enumerate(ranks.tolist()) if r != NO_RANK]
        heapq.heapify(queue)
        symbols, pair, n = start.tolist(), ranks.tolist(), len(start)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        while queue:
            rank, i = heapq.heappop(queue)
            if pair[i] != rank:  # one of its symbols was merged since
                continue
            gone = after[i]
            right = after[i] = after[gone]
            symbols[i], symbols[gone], pair[gone] = int(self.merged[rank]), -1, -1
            if right < n:
                before[right] = i
            for a, b in ((before[i], i), (i, right)):
                if a >= 0:
                    pair[a] = self.rank_of.get(symbols[a] * self.base + symbols[b], NO_RANK) if b < n else NO_RANK
                    if pair[a] != NO_RANK:
                        heapq.heappush(queue, (pair[a], a))
        return np.array([s for s in symbols if s >= 0], dtype=np.int64)

    def encode_words(self, words: list[bytes]) -> list[np.ndarray]:
        """Token ids of each word, found in rounds over all words."""
        out = [self.encode_long(w) if len(w) > LONG else np.empty(0, np.int64) for w in words]
        words = [b"" if len(w) > LONG else w for w in words]
        sizes = np.array([len(w) for w in words], dtype=np.int64)
        symbols = self.of_byte[np.frombuffer(b"".join(words), np.uint8)]
        word = np.repeat(np.arange(len(words)), sizes)
        while len(symbols):
            rank = np.full(len(symbols), NO_RANK)
            same = word[1:] == word[:-1]
            rank[:-1][same] = self.ranks(symbols[:-1][same], symbols[1:][same])
            starts = np.flatnonzero(np.concatenate(([True], ~same)))
            lowest = np.minimum.reduceat(rank, starts)
            ended = lowest == NO_RANK
            lengths = np.diff(np.append(starts, len(symbols)))
            if ended.any():
                for w, s, n in zip(word[starts[ended]].tolist(), starts[ended].tolist(), lengths[ended].tolist()):
                    out[w] = symbols[s : s + n]
            of_symbol = np.repeat(lowest, lengths)
            hit = (rank == of_symbol) & (rank != NO_RANK)
            # Of adjacent hits (a a a), every second one starts a merge, from the left.
            places = np.flatnonzero(hit)
            fresh = np.concatenate(([True], np.diff(places) != 1))
            run = np.maximum.accumulate(np.where(fresh, np.arange(len(places)), 0))
            places = places[(np.arange(len(places)) - run) % 2 == 0]
            symbols[places] = self.merged[rank[places]]
            keep = ~np.repeat(ended, lengths)
            keep[places + 1] = False
            symbols, word = symbols[keep], word[keep]
        return out


@lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


class Encoder:
    """Encodes texts with a bounded memory of words; one per task."""

    def __init__(self, path: str):
        self.vocabulary = vocabulary(path)
        self.pattern = regex.compile(WORDS)
        specials = sorted(self.vocabulary.specials, key=len, reverse=True)
        self.special = regex.compile("(" + "|".join(map(regex.escape, specials)) + ")") if specials else None
        self.known: dict[str, np.ndarray] = {}

    def split(self, text: str) -> list[str]:
        """Words and special tokens in order."""
        if self.special is None or not any(s in text for s in self.vocabulary.specials):
            return self.pattern.findall(text)
        parts = self.special.split(text)
        return [w for i, p in enumerate(parts) for w in ([p] if i % 2 else self.pattern.findall(p))]

    def learn(self, words: set[str]) -> None:
        if len(self.known) > REMEMBERED:
            self.known = {}
        new = sorted(words - self.known.keys())
        # Blocks bound the flat array.
        block, size = [], 0
        for w in [*new, None]:
            if block and (w is None or size > 1 << 20):
                self.known.update(zip(block, self.vocabulary.encode_words([b.encode() for b in block])))
                block, size = [], 0
            if w is not None:
                if w in self.vocabulary.specials:
                    self.known[w] = np.array([self.vocabulary.specials[w]])
                else:
                    block.append(w)
                    size += len(w)

    def forget_long(self) -> None:
        for w in [w for w in self.known if len(w) > LONGEST]:
            del self.known[w]


def _digests(encoder: Encoder, column: pa.Array, known: dict) -> tuple[list, list, list]:
    """Per text: number of ids, digest of the decimal ids, digest of the decoded text."""
    split = [encoder.split(t) for t in texts(column)]
    every: set[str] = set().union(*split)
    encoder.learn(every)
    pieces = encoder.vocabulary.pieces
    if len(known) > REMEMBERED:
        known.clear()
    for w in every - known.keys():
        ids = encoder.known[w].tolist()
        known[w] = (len(ids), ",".join(map(str, ids)), b"".join(pieces[i] for i in ids))
    counts, ids_sha, decoded_sha = [], [], []
    for words in split:
        found = [known[w] for w in words]
        counts.append(sum(f[0] for f in found))
        ids_sha.append(hashlib.sha256(",".join([f[1] for f in found]).encode()).hexdigest())
        decoded = b"".join([f[2] for f in found]).decode("utf-8", "replace")
        decoded_sha.append(hashlib.sha256(decoded.encode()).hexdigest())
    encoder.forget_long()
    for w in [w for w in every if len(w) > LONGEST]:
        known.pop(w, None)
    return counts, ids_sha, decoded_sha


def encode(docs: DataFrame, path: str, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """``doc_id, ids`` (array of long) of every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(path)
        for batch in batches:
            for part in _parts(batch):
                split = [encoder.split(t) for t in texts(part["text"])]
                encoder.learn(set().union(*split))
                ids = [np.concatenate([encoder.known[w] for w in ws]) if ws else np.empty(0, np.int64) for ws in split]
                encoder.forget_long()
                yield pa.RecordBatch.from_arrays(
                    [part["doc_id"], pa.array(ids, pa.list_(pa.int64()))], ["doc_id", "ids"])

    source = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return source.mapInArrow(run, "doc_id long, ids array<long>")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``doc_id, text`` of ``doc_id, ids``; bytes that are no UTF-8 become U+FFFD."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = vocabulary(path).pieces
        for batch in batches:
            back = [b"".join(pieces[i] for i in ids or []).decode("utf-8", "replace") for ids in batch["ids"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(back, pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def _parts(batch: pa.RecordBatch, rows: int = 500) -> Iterator[pa.RecordBatch]:
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def encode_digests(docs: DataFrame, path: str, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """Encode and decode every text; return counts and digests of ids and decoded text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, known = Encoder(path), {}
        for batch in batches:
            for part in _parts(batch):
                counts, ids_sha, decoded_sha = _digests(encoder, part["text"], known)
                yield pa.RecordBatch.from_arrays(
                    [part["doc_id"], pa.array(counts, pa.int64()), pa.array(ids_sha), pa.array(decoded_sha)],
                    ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    source = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return source.mapInArrow(run, SCHEMA)
