"""Near-duplicates by one-permutation hashing with optimal densification.

A document's set holds its distinct ``width``-word shingles (words
``[^\\x20\\x09-\\x0D]+``, A-Z lower-cased) as 64-bit hashes. One hash per shingle
fills all bins: the bin is given by the hash's high bits, its value is the
smallest hash in it. An empty bin borrows from the first filled bin in a fixed
random order of its own, so equal sets of filled bins borrow alike. Bins are read
in bands; documents that agree in a band share a bucket.

Links are confirmed on full sets. Within a bucket candidates are a star: every
member against the bucket's centre, the member with the smallest share of
shingles that no other candidate holds; copies of one text lie nearest to it.
A member may be linked to another member and not to the centre, so buckets whose
members then lie in different components are closed exactly. A member of ``n``
shingles of which ``u`` are held by no other open member can only be linked with
members of at most ``(n - u) (100 + percent) / percent - n`` shingles; where no
member of another component is that small, it leaves. This is repeated while it
helps. Who is left is compared across components, by counting common shingles
in blocks of bounded size against each other; no pair rows are made. No link
between bucket mates that would join components is lost.

Equal sets are one node, whatever their number. Documents without words have an
empty set and link with nothing; null text counts as empty. Fewer than ``width``
words make one shingle. Rows with the same id are taken as one document,
compared by its smallest set, and each keeps its row; a row without id keeps its row with a null component and is
kept. Ties don't matter: components are named by their smallest id. Other
columns aren't read.

The chance that a pair at the threshold shares no bucket is about
``(1 - t ** rows) ** bands``: 3e-6 with 40 bands of 8 rows at 0.85.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.llm.common import small, stored, stored_by_texts, texts
from pairloom.llm.components import component_labels

REMEMBERED = 300_000
# Members that one copy of a star's centre serves; members and shingles of a block; rounds go on below this share.
STAR = 1000
BLOCK, BLOCK_SHINGLES = 256, 1 << 19
HELPS = 0.8


@dataclass(frozen=True)
class NearDuplicates:
    """Linked if 100 * intersection >= ``percent`` * union of ``width``-word shingles."""

    width: int = 5
    percent: int = 80
    bands: int = 50
    rows: int = 8


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class Shingler:
    """Sorted distinct shingle hashes of texts; remembers word hashes up to a bound."""

    def __init__(self, width: int):
        self.width, self.known = width, {}

    def __call__(self, text: str) -> np.ndarray:
        known = self.known
        if len(known) > REMEMBERED:
            known.clear()
        hashes = []
        for w in text.encode().lower().split():
            h = known.get(w)
            if h is None:
                h = xxhash.xxh3_64_intdigest(w)
                if len(w) < 64:
                    known[w] = h
            hashes.append(h)
        n = len(hashes)
        if not n:
            return np.empty(0, np.uint64)
        words = np.array(hashes, dtype=np.uint64)
        span = min(n, self.width)
        # A short sequence is marked by its length.
        out = np.full(n - span + 1, span, dtype=np.uint64)
        for i in range(span):
            out = mix(out * np.uint64(0x9E3779B97F4A7C15) + words[i : n - span + 1 + i])
        return np.unique(out)


@lru_cache(maxsize=4)
def borrowing(bins: int) -> np.ndarray:
    """For each bin the order in which it asks others when it is empty."""
    rng = np.random.default_rng(bins)
    return np.stack([rng.permutation(bins) for _ in range(bins)])


def band_keys(hashes: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key per band of the densified bins."""
    bins = bands * rows
    of = ((hashes >> np.uint64(32)) * np.uint64(bins) >> np.uint64(32)).astype(np.int64)
    first = np.flatnonzero(np.concatenate(([True], of[1:] != of[:-1])))
    values, filled = np.zeros(bins, np.uint64), np.zeros(bins, bool)
    values[of[first]], filled[of[first]] = hashes[first], True
    empty = np.flatnonzero(~filled)
    if len(empty):
        # Most find a filled bin among the first few; the rest ask on.
        for asked in (16, bins):
            order = borrowing(bins)[empty, :asked]
            hit = filled[order]
            found = hit.any(axis=1)
            values[empty[found]] = values[order[found, hit[found].argmax(axis=1)]]
            empty = empty[~found]
            if not len(empty):
                break
    grid = values.reshape(bands, rows)
    key = np.arange(bands, dtype=np.uint64)
    for i in range(rows):
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + grid[:, i])
    return key


def sketches(docs: DataFrame, how: NearDuplicates, text: str, id_column: str) -> DataFrame:
    """``doc_id, n_shingles, digest, keys``; digest is null for an empty set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle = Shingler(how.width)
        for batch in batches:
            sizes, digests, keys = [], [], []
            for t in texts(batch["text"]):
                s = shingle(t)
                sizes.append(len(s))
                digests.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
                keys.append(band_keys(s, how.bands, how.rows).view(np.int64) if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(keys, pa.list_(pa.int64()))],
                ["doc_id", "n_shingles", "digest", "keys"])

    source = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return source.mapInArrow(run, "doc_id long, n_shingles long, digest binary, keys array<long>")


def shingle_sets(docs: DataFrame, how: NearDuplicates) -> DataFrame:
    """``id, s`` of documents ``id, text``: the sorted shingle hashes, of repeated ids the smallest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle = Shingler(how.width)
        for batch in batches:
            for at in range(0, len(batch), 256):
                part = batch.slice(at, 256)
                sets = [shingle(t).view(np.int64) for t in texts(part["text"])]
                yield pa.RecordBatch.from_arrays([part["id"], pa.array(sets, pa.list_(pa.int64()))], ["id", "s"])

    return docs.mapInArrow(run, "id long, s array<long>").where("size(s) > 0").groupBy("id").agg(F.min("s").alias("s"))


def linked(shared: F.Column, a: F.Column, b: F.Column, percent: int) -> F.Column:
    return 100 * shared >= percent * (a + b - shared)


def star_links(stars: DataFrame, sets: DataFrame, how: NearDuplicates) -> DataFrame:
    """Pairs ``a, b`` of ``stars`` whose full sets reach the threshold. A centre is shipped once per ``STAR`` of its members."""
    parts = stars.groupBy("a").agg(F.ceil(F.count("*") / STAR).cast("int").alias("parts"))
    centres = parts.join(sets.select(F.col("id").alias("a"), F.col("s").alias("sa")), "a").select(
        "a", "parts", "sa", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    members = stars.join(parts, "a").withColumn("part", F.pmod(F.xxhash64("b"), F.col("parts")).cast("int"))
    members = members.join(sets.select(F.col("id").alias("b"), F.col("s").alias("sb")), "b")
    pairs = members.select("a", "part", "b", "sb").join(centres.select("a", "part", "sa"), ["a", "part"])
    shared = F.size(F.array_intersect("sa", "sb"))
    return pairs.where(linked(shared, F.size("sa"), F.size("sb"), how.percent)).select("a", "b")


def private(sets: DataFrame) -> DataFrame:
    """``id, u``: how many shingles of a set no other set holds, where there are any."""
    held = sets.select("id", F.explode("s").alias("h")).groupBy("h").agg(F.count("*").alias("c"), F.min("id").alias("id"))
    return held.where("c = 1").groupBy("id").agg(F.count("*").alias("u"))


def still_open(members: DataFrame, sets: DataFrame, how: NearDuplicates) -> DataFrame:
    """Those ``bucket, id, n, label`` that may be linked with a bucket mate of another label."""
    live = members.select("id").distinct()
    lone = private(sets.join(live, "id", "left_semi"))
    most = F.floor((F.col("n") - F.coalesce("u", F.lit(0))) * (100 + how.percent) / how.percent) - F.col("n")
    members = members.join(lone, "id", "left").select("bucket", "id", "n", "label", most.alias("most"))
    first = members.groupBy("bucket").agg(F.min(F.struct("n", "label")).alias("first"))
    members = members.join(first, "bucket")
    other = members.where("label != first.label").groupBy("bucket").agg(F.min("n").alias("second"))
    least = F.when(F.col("label") == F.col("first.label"), F.col("second")).otherwise(F.col("first.n"))
    # A bucket of one label has no second and goes.
    return members.join(other, "bucket").where(least <= F.col("most")).select("bucket", "id", "n", "label")


def closing_links(members: DataFrame, sets: DataFrame, how: NearDuplicates) -> DataFrame:
    """Links ``a, b`` between bucket mates of different labels: at least one for each member and label it is linked with."""
    blocks = members.groupBy("bucket").agg(
        F.greatest(F.ceil(F.count("*") / BLOCK), F.ceil(F.sum("n") / BLOCK_SHINGLES)).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("id", "bucket"), F.col("blocks")).cast("int")
    spread = members.join(blocks, "bucket").withColumn("own", own).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    spread = spread.select(
        "bucket", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"), "own", "id", "label")

    def run(group: pa.Table) -> pa.Table:
        ids, label, block = (group[c].to_numpy() for c in ("id", "label", "own"))
        lists = group["s"].combine_chunks()
        values, sizes = lists.flatten().to_numpy(), lists.value_lengths().to_numpy().astype(np.int64)
        ends = np.cumsum(sizes)
        owner = np.repeat(np.arange(len(ids)), sizes)
        order = np.argsort(values, kind="stable")
        holders = owner[order]
        _, of, counts = np.unique(values, return_inverse=True, return_counts=True)
        starts = np.cumsum(counts) - counts
        crossing = group["x"][0].as_py() != group["y"][0].as_py()
        a, b = [], []
        for i, n in enumerate(sizes):
            mine = of[ends[i] - n : ends[i]]
            many = counts[mine]
            at = np.repeat(starts[mine] - np.cumsum(many) + many, many) + np.arange(many.sum())
            shared = np.bincount(holders[at], minlength=len(ids))
            hit = (100 * shared >= how.percent * (n + sizes - shared)) & (label != label[i])
            if crossing:
                hit &= block != block[i]
            hit = np.flatnonzero(hit)
            _, one = np.unique(label[hit], return_index=True)
            a += [int(ids[i])] * len(one)
            b += ids[hit[one]].tolist()
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    full = spread.join(sets, "id")
    return full.groupBy("bucket", "x", "y").applyInArrow(run, "a long, b long").distinct()


def near_duplicates(
    docs: DataFrame, how: NearDuplicates = NearDuplicates(), text: str = "text", id_column: str = "doc_id",
) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every row."""
    rows = stored_by_texts(sketches(docs, how, text, id_column), "sketches")
    named = rows.where("digest is not null and doc_id is not null")
    sets = stored(named.groupBy("digest").agg(F.min("doc_id").alias("id")), "sets")
    nodes = named.join(sets.select("id", F.col("digest").alias("own")), (F.col("doc_id") == F.col("id")) & (F.col("digest") == F.col("own")))
    members = nodes.select("id", F.explode("keys").alias("bucket")).distinct()
    shared = members.groupBy("bucket").agg(F.count("*").alias("m")).where("m > 1").select("bucket")
    buckets = stored(members.join(shared, "bucket"), "buckets")
    source = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text).alias("text")).where("text is not null")
    ids = stored(buckets.select("id").distinct(), "ids")
    # Else all texts are shuffled; a row of a hash table takes several times its eight bytes.
    ids = small(ids, ids.count(), 64)
    candidates = stored_by_texts(shingle_sets(source.join(ids, "id", "left_semi"), how), "candidates")
    # Too many shingles of its own: linked with nobody.
    n, u = F.col("n"), F.coalesce("u", F.lit(0))
    worth = candidates.select("id", F.size("s").cast("long").alias("n")).join(private(candidates), "id", "left").where(
        100 * (n - u) >= how.percent * n).select("id", "n", (u / n).alias("apart"))
    alive = stored(buckets.join(worth, "id"), "alive")
    centre = alive.groupBy("bucket").agg(F.min(F.struct("apart", "id", "n")).alias("c"))
    stars = alive.join(centre, "bucket").where("id != c.id").where(
        100 * F.least("n", "c.n") >= how.percent * F.greatest("n", "c.n"))
    stars = stored(stars.select(F.col("c.id").alias("a"), F.col("id").alias("b")).distinct(), "pairs")
    links = stored(star_links(stars, candidates, how), "links")
    labels = component_labels(links)
    left = alive.join(labels, "id", "left").select("bucket", "id", "n", F.coalesce("label", "id").alias("label"))
    split = left.groupBy("bucket").agg(F.min("label").alias("x"), F.max("label").alias("y"), F.count("*").alias("m")).where(
        "x != y and m > 2").select("bucket")  # a bucket of two is settled by its star
    left = stored(left.join(split, "bucket"), "open")
    before, now = None, left.count()
    while now and (before is None or now < HELPS * before):
        left = stored(still_open(left, candidates, how), "open")
        before, now = now, left.count()
    if now:
        more = stored(closing_links(left, candidates, how), "links")
        if not more.isEmpty():
            labels = component_labels(links.union(more))
    of_set = sets.join(labels, "id", "left").select(F.col("digest").alias("own"), F.coalesce("label", "id").alias("component"))
    # Rows without a set are apart from the join, so they aren't one hot null key.
    has = rows.where("digest is not null and doc_id is not null").select("doc_id", "n_shingles", F.col("digest").alias("own"))
    linked = has.join(of_set, "own").select("doc_id", "n_shingles", F.col("component").alias("component_id"))
    alone = rows.where("digest is null or doc_id is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return linked.union(alone).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
