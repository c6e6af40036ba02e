"""Language identification with hyperdimensional letter n-gram profiles.

Every letter has a random vector of +1 and -1, drawn from its code point. A
trigram is bound by multiplying its letters' vectors, permuted (rotated) by their
place; a text is the bundle (sum) of its trigrams' vectors; a language is the
bundle of its documents' unit vectors. A text gets the language whose prototype has the
largest cosine; ties go to the first in alphabetical order.

Texts are lower-cased; every run of characters that aren't letters is one gap
symbol. Letters that no learned document has share one vector. A batch counts
trigrams per text and bundles all its texts in one matrix product.

Prototypes are fit on at most about ``per_language`` documents of each language, chosen
by a hash of the id; every text is predicted whole. Prototypes and
alphabet are bounded by the number of languages and letters.

Null text and text without a letter give ``und`` with score 0, and so does every text
if nothing was learned. Each row gives one row, also repeated rows and null ids
(these are never learned from). ``lang`` is read for learning only, other columns not at all.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.llm.common import learning_row, stored, texts

UNDETERMINED = "und"
GAP, UNSEEN = 0, 1
# Trigram tables up to this many cells are addressed directly, larger ones by sorting.
DIRECT_CELLS = 1 << 24


@dataclass(frozen=True)
class Profiles:
    alphabet: np.ndarray  # code points, sorted; symbol = place + 2
    languages: tuple[str, ...]
    prototypes: np.ndarray  # unit rows


def letter_vectors(alphabet: np.ndarray, size: int) -> np.ndarray:
    """Rows for gap, unseen letter and the alphabet."""
    keys = [0, 1, *alphabet.tolist()]
    return np.stack([np.random.default_rng([size, k]).integers(0, 2, size, dtype=np.int8) * 2 - 1 for k in keys])


class Bundler:
    """Vectors of texts."""

    def __init__(self, alphabet: np.ndarray, size: int):
        vectors = letter_vectors(alphabet, size)
        self.first, self.second, self.third = np.roll(vectors, 2, axis=1), np.roll(vectors, 1, axis=1), vectors
        self.n = len(vectors)
        self.known: dict[int, int] = {}
        self.symbols = np.full(0x110000, -1, dtype=np.int32)
        self.symbols[alphabet] = np.arange(len(alphabet)) + 2

    def of_text(self, text: str) -> np.ndarray:
        """Trigram numbers of a text; none without a letter."""
        points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
        symbols = self.symbols[points]
        for p in set(points[symbols < 0].tolist()):
            # Decided once per code point.
            self.symbols[p] = UNSEEN if chr(p).isalpha() else GAP
        symbols = self.symbols[points]
        if not symbols.any():
            return np.empty(0, np.int64)
        symbols = np.concatenate(([GAP], symbols, [GAP])).astype(np.int64)
        keep = np.ones(len(symbols), bool)
        keep[1:] = (symbols[1:] != GAP) | (symbols[:-1] != GAP)
        symbols = symbols[keep]
        return (symbols[:-2] * self.n + symbols[1:-1]) * self.n + symbols[2:]

    def __call__(self, batch: list[str]) -> np.ndarray:
        """One row per text; zero without a letter."""
        grams = [self.of_text(t) for t in batch]
        every = np.concatenate(grams) if grams else np.empty(0, np.int64)
        if not len(every):
            return np.zeros((len(batch), self.first.shape[1]), np.float32)
        if self.n**3 <= DIRECT_CELLS:
            present = np.zeros(self.n**3, bool)
            present[every] = True
            distinct = np.flatnonzero(present)
            place = np.empty(self.n**3, np.int32)
            place[distinct] = np.arange(len(distinct))
            at = place[every]
        else:
            distinct, at = np.unique(every, return_inverse=True)
        text = np.repeat(np.arange(len(batch)), [len(g) for g in grams])
        counts = np.bincount(text * len(distinct) + at, minlength=len(batch) * len(distinct))
        counts = counts.reshape(len(batch), len(distinct)).astype(np.float32)
        a, b, c = distinct // self.n**2, distinct // self.n % self.n, distinct % self.n
        bound = self.first[a] * self.second[b] * self.third[c]
        return counts @ bound.astype(np.float32)


def unit(rows: np.ndarray) -> np.ndarray:
    norms = np.linalg.norm(rows, axis=1, keepdims=True)
    return np.divide(rows, norms, out=np.zeros_like(rows), where=norms > 0)


def _parts(column: pa.Array, rows: int = 400) -> Iterator[tuple[int, list[str]]]:
    for at in range(0, len(column), rows):
        yield at, texts(column.slice(at, rows))


def fit(
    docs: DataFrame, learn: F.Column, text: str = "text", lang: str = "lang", id_column: str = "doc_id",
    size: int = 1024, per_language: int = 4000,
) -> Profiles:
    """Prototypes from rows for which ``learn`` holds."""
    labelled = docs.where(learn & F.col(lang).isNotNull() & F.col(text).isNotNull()).select(
        F.col(id_column).alias("doc_id"), F.col(lang).alias("lang"), F.col(text).alias("text"))
    counts = labelled.groupBy("lang").count()
    drawn = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < F.col("chance")
    chances = counts.select("lang", (F.least(F.lit(1.0), per_language / F.col("count")) * F.lit(1 << 30)).alias("chance"))
    sample = stored(labelled.join(F.broadcast(chances), "lang").where(drawn).select("lang", "text"), "languages")

    def letters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[str] = set()
        for batch in batches:
            for t in texts(batch["text"]):
                seen.update(t.lower())
        yield pa.RecordBatch.from_arrays([pa.array([ord(c) for c in seen if c.isalpha()], pa.int32())], ["point"])

    points = sample.select("text").mapInArrow(letters, "point int").distinct().collect()
    alphabet = np.array(sorted(r[0] for r in points), dtype=np.int64)

    def bundles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bundle, sums = Bundler(alphabet, size), {}
        for batch in batches:
            langs = batch["lang"].to_pylist()
            for at, part in _parts(batch["text"]):
                for name, row in zip(langs[at:], unit(bundle(part)).astype(np.float64)):
                    sums[name] = sums.get(name, 0) + row
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.string()), pa.array(list(sums.values()), pa.list_(pa.float64()))], ["lang", "sums"])

    by_lang: dict[str, np.ndarray] = {}
    # One row per task and language, at most per_language documents behind each language.
    for name, row in sample.mapInArrow(bundles, "lang string, sums array<double>").orderBy("lang", "sums").collect():
        by_lang[name] = by_lang.get(name, 0) + np.array(row)
    names = tuple(n for n in sorted(by_lang) if by_lang[n].any())
    rows = unit(np.stack([by_lang[n] for n in names])) if names else np.empty((0, size))
    return Profiles(alphabet, names, rows.astype(np.float32))


def annotate(docs: DataFrame, model: Profiles, text: str = "text") -> DataFrame:
    """``row`` (a struct of all columns of ``docs``), ``lang_pred, score`` of every row."""
    return _labelled(docs.select(F.struct(*docs.columns).alias("row"), labels(model)(F.col(text)).alias("found")))


def predict(docs: DataFrame, model: Profiles, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of every row."""
    row = F.struct(F.col(id_column).cast("long").alias("doc_id"), (~learning_row(F.col(id_column))).alias("held_out"))
    found = _labelled(docs.select(row.alias("row"), labels(model)(F.col(text)).alias("found")))
    return found.select("row.doc_id", "row.held_out", "lang_pred", "score")


def _labelled(found: DataFrame) -> DataFrame:
    return found.select("row", "found.lang_pred", "found.score")


def labels(model: Profiles):
    """A function of a text column: ``lang_pred, score``. Only the texts go to Python workers, not the rows they stand in."""
    size = model.prototypes.shape[1]

    def run(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        bundle = Bundler(model.alphabet, size)
        for column in columns:
            found, scores = [], []
            for _, part in _parts(column):
                vectors = unit(bundle(part))
                cosines = vectors @ model.prototypes.T
                known = vectors.any(axis=1) & bool(len(model.languages))
                best = cosines.argmax(axis=1) if len(model.languages) else np.zeros(len(part), int)
                for i, b in enumerate(best.tolist()):
                    found.append(model.languages[b] if known[i] else UNDETERMINED)
                    scores.append(min(1.0, max(0.0, float(cosines[i, b]))) if known[i] else 0.0)
            yield pa.StructArray.from_arrays([pa.array(found, pa.string()), pa.array(scores, pa.float64())], ["lang_pred", "score"])

    # Called so, a filter on the result does not have it computed twice.
    return F.arrow_udf(run, "lang_pred string, score double").asNondeterministic()


def identify(docs: DataFrame, **names: str) -> DataFrame:
    """Learn from rows outside the held-out fifth and predict all rows."""
    model = fit(docs, learning_row(F.col(names.get("id_column", "doc_id"))), **names)
    return predict(docs, model, **{k: v for k, v in names.items() if k != "lang"})
