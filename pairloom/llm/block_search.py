"""Exact ranked lexical search over posting lists in geometric blocks.

Documents become sparse vectors of integer impacts, one coordinate per query term they hold; a score is the sum
of the impacts at the query's terms. Each task builds an index over segments of its documents. A term's posting list
is ordered by a signature of the documents (signs of random projections of their vectors, turned by the
term), so similar documents are neighbours, and cut into blocks of ``BLOCK`` postings. A block's summary holds, for every coordinate, the
largest impact among its documents. Summed over a query's terms it bounds the score of every document in the block, and
the block is skipped only if that bound is below the query's current k-th best score (or equals it while
all ids in the block come later). Lists are left out by the same rule: a query's terms whose largest impacts
together stay below the k-th best score can't lift a document by themselves, so only the other lists are visited.
Blocks that are not skipped are scored exactly, best bounds first, whereupon the k-th best score rises.

The k-th best score starts from a search over a share of the documents chosen by a hash. It is a lower bound of
the final one, so results do not depend on that share. Tasks return at most k documents for each query; the
final ranking is a window over these. Texts are read once; what is stored and never shuffled is one row of
term numbers and counts per document.

Queries are worked through in groups whose text is below ``GROUP_BYTES``, which bounds what tasks receive.

Null text and text without a term has no vector, yet is returned nowhere and counts in nothing. An item without a term
gives no rows; repeated items, also under one id, give rows of their own. Equal scores rank by id, null ids last; a
repeated row ranks as often as it occurs. Empty tables give no rows. Only the named columns are read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pairloom.llm.common import stored, texts

# Bytes that belong to terms; A-Z map to a-z, all others to a blank.
TERM_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))

BLOCK = 64
SIGNATURE_BITS = 16
# A segment ends with the document that reaches this many postings.
SEGMENT_POSTINGS = 1_000_000
# Entries of summaries and vectors that are expanded at once.
CHUNK_ENTRIES = 2_000_000
GROUP_BYTES = 4 << 20
NO_ID = np.iinfo(np.int64).max

VECTORS = "doc_id long, n long, terms array<int>, counts array<int>"
FOUND = "query int, doc_id long, score long"


def terms_of(text: str) -> list[bytes]:
    """Terms in order, as UTF-8."""
    return text.encode().translate(TERM_BYTES).split()


@dataclass
class Queries:
    """The queries of a group: their ids, distinct terms (numbers into ``vocabulary``) and starts."""

    ids: list
    terms: list[np.ndarray]
    vocabulary: dict[bytes, int]
    weights: np.ndarray | None = None

    @classmethod
    def read(cls, rows) -> Queries:
        vocabulary: dict[bytes, int] = {}
        ids, terms = [], []
        for item, text in rows:
            mine = sorted({vocabulary.setdefault(t, len(vocabulary)) for t in terms_of(text or "")})
            if mine:
                ids.append(item)
                terms.append(np.array(mine, np.int64))
        return cls(ids, terms, vocabulary)


def vectors(docs: DataFrame, vocabulary: dict[bytes, int], text: str, id_column: str) -> DataFrame:
    """``doc_id, n, terms, counts``: all terms counted in ``n``, those of the vocabulary listed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, terms, counts, ends = [], [], [], [0]
            for t in texts(batch["text"]):
                held = Counter(terms_of(t))
                n.append(sum(held.values()))
                for w in held.keys() & vocabulary.keys():
                    terms.append(vocabulary[w])
                    counts.append(held[w])
                ends.append(len(terms))
            borders = pa.array(ends, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(n, pa.int64()), pa.ListArray.from_arrays(borders, pa.array(terms, pa.int32())),
                 pa.ListArray.from_arrays(borders, pa.array(counts, pa.int32()))], ["doc_id", "n", "terms", "counts"])

    return docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, VECTORS)


@dataclass
class Best:
    """Per query the k best found so far, best first, and the score a document must reach."""

    k: int
    floor: np.ndarray
    scores: list[np.ndarray] = field(default_factory=list)
    ids: list[np.ndarray] = field(default_factory=list)

    def __post_init__(self) -> None:
        self.scores = [np.empty(0, np.int64) for _ in self.floor]
        self.ids = [np.empty(0, np.int64) for _ in self.floor]

    def add(self, q: int, scores: np.ndarray, ids: np.ndarray) -> None:
        good = scores >= self.floor[q]
        s, i = np.concatenate([self.scores[q], scores[good]]), np.concatenate([self.ids[q], ids[good]])
        order = np.lexsort((i, -s))[: self.k]
        self.scores[q], self.ids[q] = s[order], i[order]
        if len(order) == self.k:
            self.floor[q] = max(self.floor[q], self.scores[q][-1])

    def last_id(self, q: int) -> int:
        """The id that a document with just the floor's score must stay below."""
        full = len(self.ids[q]) == self.k and self.scores[q][-1] == self.floor[q]
        return int(self.ids[q][-1]) if full else NO_ID


def expand(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Places ``start, start + 1, ...`` of all ranges, one after the other."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + lengths, lengths)


def chunks(weights: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Ranges whose weights sum to about ``limit``, one element at least."""
    total = np.concatenate(([0], np.cumsum(weights)))
    at = 0
    while at < len(weights):
        end = max(at + 1, int(np.searchsorted(total, total[at] + limit, "right")) - 1)
        yield at, end
        at = end


class Segment:
    """An index over some documents: their vectors, and posting lists in blocks with summaries."""

    def __init__(self, ids, lengths, terms, impacts, n_terms: int) -> None:
        self.ids, self.lengths, self.terms, self.impacts, self.n_terms = ids, lengths, terms, impacts, n_terms
        self.starts = np.cumsum(lengths) - lengths
        self.doc = np.repeat(np.arange(len(ids)), lengths)
        self.largest = np.zeros(n_terms, np.int64)
        np.maximum.at(self.largest, terms, impacts)

    def signatures(self) -> np.ndarray:
        """Signs of random projections of the documents' vectors, as one number each."""
        bits = np.zeros(len(self.ids), np.int64)
        filled = self.lengths > 0
        for b in range(SIGNATURE_BITS):
            side = np.random.default_rng(b).choice((-1.0, 1.0), self.n_terms)
            sums = np.zeros(len(self.ids))
            if filled.any():
                sums[filled] = np.add.reduceat(self.impacts * side[self.terms], self.starts[filled])
            bits |= (sums > 0).astype(np.int64) << b
        return bits

    def build(self, wanted: np.ndarray) -> None:
        """Order the lists of the wanted terms and cut them into blocks."""
        at = np.flatnonzero(wanted[self.terms] & (self.impacts > 0))
        term, doc = self.terms[at], self.doc[at]
        turn = term % SIGNATURE_BITS
        s = self.signatures()[doc]
        turned = ((s << turn) | (s >> (SIGNATURE_BITS - turn))) & ((1 << SIGNATURE_BITS) - 1)
        order = np.lexsort((doc, turned, term))
        term, self.members = term[order], doc[order]
        first = np.flatnonzero(np.diff(term, prepend=-1))
        place = np.arange(len(term)) - np.repeat(first, np.diff(np.append(first, len(term))))
        self.block_start = np.flatnonzero(place % BLOCK == 0)
        self.block_size = np.diff(np.append(self.block_start, len(term)))
        self.block_term = term[self.block_start]
        self.block_id = np.minimum.reduceat(self.ids[self.members], self.block_start) if len(term) else np.empty(0, np.int64)

    def bounds(self, blocks: np.ndarray, queries: np.ndarray, terms: list[np.ndarray]) -> np.ndarray:
        """For pairs of a block and a query (blocks ascending), the sum of the block's summary over the query's terms."""
        found = np.zeros(len(blocks), np.int64)
        own, pair_of = np.unique(blocks, return_inverse=True)
        size = np.add.reduceat(self.lengths[self.members], self.block_start)[own]
        # A chunk's summaries are one dense table: coordinates by block.
        for a, b in chunks(np.maximum(size, self.n_terms), CHUNK_ENTRIES):
            places = expand(self.block_start[own[a:b]], self.block_size[own[a:b]])
            docs = self.members[places]
            entries = expand(self.starts[docs], self.lengths[docs])
            row = np.repeat(np.repeat(np.arange(b - a), self.block_size[own[a:b]]), self.lengths[docs])
            summary = np.zeros((b - a) * self.n_terms, np.int64)
            np.maximum.at(summary, row * self.n_terms + self.terms[entries], self.impacts[entries])
            mine = np.flatnonzero((pair_of >= a) & (pair_of < b))
            for c, d in chunks(np.array([len(terms[q]) for q in queries[mine]]), CHUNK_ENTRIES):
                part = mine[c:d]
                width = np.array([len(terms[q]) for q in queries[part]])
                flat = np.concatenate([terms[q] for q in queries[part]])
                values = summary[np.repeat((pair_of[part] - a) * self.n_terms, width) + flat]
                found[part] = np.add.reduceat(values, np.cumsum(width) - width)
        return found

    def score(self, docs: np.ndarray, query_terms: np.ndarray) -> np.ndarray:
        """Exact scores of documents (each with a term at least) for one query."""
        asked = np.zeros(self.n_terms, bool)
        asked[query_terms] = True
        out = np.empty(len(docs), np.int64)
        for a, b in chunks(self.lengths[docs], CHUNK_ENTRIES):
            lengths = self.lengths[docs[a:b]]
            entries = expand(self.starts[docs[a:b]], lengths)
            out[a:b] = np.add.reduceat(np.where(asked[self.terms[entries]], self.impacts[entries], 0), np.cumsum(lengths) - lengths)
        return out

    def search(self, terms: list[np.ndarray], best: Best) -> None:
        """Bring the best of this segment's documents into ``best``."""
        essential = []
        for q, mine in enumerate(terms):
            held = mine[self.largest[mine] > 0]
            held = held[np.argsort(self.largest[held], kind="stable")]
            # Without the essential terms a document stays below the floor.
            essential.append(held[np.cumsum(self.largest[held]) >= best.floor[q]])
        wanted = np.zeros(self.n_terms, bool)
        for e in essential:
            wanted[e] = True
        self.build(wanted)
        if not len(self.members):
            return
        first_block = np.searchsorted(self.block_term, np.arange(self.n_terms + 1))
        pairs = [expand(first_block[e], first_block[e + 1] - first_block[e]) for e in essential]
        queries = np.repeat(np.arange(len(terms)), [len(p) for p in pairs])
        blocks = np.concatenate(pairs)
        order = np.argsort(blocks, kind="stable")
        blocks, queries = blocks[order], queries[order]
        bound = self.bounds(blocks, queries, terms)
        for q, mine in enumerate(terms):
            own = np.flatnonzero(queries == q)
            own = own[np.argsort(-bound[own], kind="stable")]
            seen = np.zeros(len(self.ids), bool)
            at, step = 0, 1
            while at < len(own):
                part = own[at : at + step]
                at, step = at + step, step * 2
                may = (bound[part] > best.floor[q]) | ((bound[part] == best.floor[q]) & (self.block_id[blocks[part]] <= best.last_id(q)))
                if not may.any():
                    if bound[part[-1]] < best.floor[q]:
                        break  # bounds only fall from here
                    continue
                visited = blocks[part[may]]
                docs = np.unique(self.members[expand(self.block_start[visited], self.block_size[visited])])
                docs = docs[~seen[docs]]
                seen[docs] = True
                best.add(q, self.score(docs, mine), self.ids[docs])


def impacts(counts: np.ndarray, n: np.ndarray, weights: np.ndarray, total: int, all_terms: int) -> np.ndarray:
    """The integer part of a score that a term of weight ``weights`` gives, ``n`` being the text's terms."""
    m = 10 + (90 * n * total) // all_terms
    return weights * ((1_000_000_000 * counts) // (1000 * counts + 8 * m))


def best_of(table: DataFrame, queries: Queries, floor: np.ndarray, k: int, total: int, all_terms: int) -> DataFrame:
    """``query, doc_id, score``: of every task the k best documents with at least the floor's score."""
    terms, weights, n_terms = queries.terms, queries.weights, len(queries.vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(k, floor.copy())
        held, postings = [], 0

        def finish() -> None:
            ids, n, lengths, t, c = (np.concatenate(x) for x in zip(*held))
            value = impacts(c, np.repeat(n, lengths), weights[t], total, all_terms)
            Segment(ids, lengths, t, value, n_terms).search(terms, best)

        for batch in batches:
            lists = batch["terms"]
            size = np.asarray(lists.value_lengths(), np.int64)
            for a, b in chunks(size, SEGMENT_POSTINGS):
                part = batch.slice(a, b - a)
                held.append((
                    np.asarray(part["doc_id"].fill_null(NO_ID), np.int64), np.asarray(part["n"], np.int64), size[a:b],
                    np.asarray(part["terms"].flatten(), np.int64), np.asarray(part["counts"].flatten(), np.int64)))
                postings += int(size[a:b].sum())
                if postings >= SEGMENT_POSTINGS:
                    finish()
                    held, postings = [], 0
        if held:
            finish()
        q = np.repeat(np.arange(len(terms)), [len(s) for s in best.scores]).astype(np.int32)
        ids = np.concatenate([*best.ids, np.empty(0, np.int64)])
        yield pa.RecordBatch.from_arrays(
            [pa.array(q), pa.array(ids, mask=ids == NO_ID), pa.array(np.concatenate([*best.scores, np.empty(0, np.int64)]))],
            ["query", "doc_id", "score"])

    return table.mapInArrow(run, FOUND)


def ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _search_group(docs: DataFrame, queries: Queries, k: int, start_share: float, text: str, id_column: str) -> DataFrame:
    spark = docs.sparkSession
    table = stored(vectors(docs, queries.vocabulary, text, id_column).where("n > 0"), "vectors")
    total, all_terms = table.agg(F.count("*"), F.sum("n")).first()
    # At most as many rows as the queries have terms.
    df = np.zeros(len(queries.vocabulary), np.int64)
    for term, n in table.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
        df[term] = n
    queries.weights = np.array([math.floor(1000 * math.log((2 * total + 2) / (2 * int(x) + 1))) for x in df], np.int64)
    # Documents without a query term have no score above 0.
    held = table.where("size(terms) > 0")
    floor = np.ones(len(queries.ids), np.int64)
    if total:
        part = held.where(F.pmod(F.xxhash64("doc_id", "n", "terms"), F.lit(1 << 20)) < int(start_share * (1 << 20)))
        first = ranked(best_of(part, queries, floor, k, total, all_terms), k)
        for q, score in first.where(F.col("rank") == k).select("query", "score").collect():
            floor[q] = max(floor[q], score)
    # The k best of the whole table: one row per query and rank.
    found = ranked(best_of(held, queries, floor, k, total, all_terms or 1), k)
    kind = "long" if all(isinstance(i, (int, type(None))) for i in queries.ids) else "string"
    names = spark.createDataFrame(list(enumerate(queries.ids)), f"query int, item_id {kind}")
    return found.join(F.broadcast(names), "query").select("item_id", F.col("rank").cast("int"), "doc_id", "score")


def search(
    docs: DataFrame, items: DataFrame, k: int = 10, start_share: float = 1 / 16, text: str = "text", id_column: str = "doc_id",
    item_text: str = "text", item_id: str = "item_id", group_bytes: int = GROUP_BYTES,
) -> DataFrame:
    """``item_id, rank, doc_id, score``: the k highest-scoring documents of each item, score above 0."""
    asked = items.select(F.col(item_id).alias("item_id"), F.col(item_text).alias("text")).where(F.col("text").isNotNull())
    size = asked.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    groups = -(-size // group_bytes)
    group = F.pmod(F.xxhash64("item_id", "text"), F.lit(groups or 1))
    results = []
    for g in range(groups):
        # The texts of one group of queries, about `group_bytes`.
        queries = Queries.read(asked.where(group == g).collect())
        if queries.ids:
            results.append(_search_group(docs, queries, k, start_share, text, id_column))
    kind = asked.schema["item_id"].dataType.simpleString()
    if not results:
        return docs.sparkSession.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    return reduce(DataFrame.unionByName, results).withColumn("item_id", F.col("item_id").cast(kind))


def sql(k: int = 10) -> str:
    """The contract in SQL: every document is scored."""
    terms = lambda t: (
        f"regexp_extract_all(translate({t}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
        "'[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')")
    return f"""
WITH d AS (SELECT row_number() OVER () AS k, doc_id, {terms('text')} AS t FROM documents),
n AS (SELECT k, doc_id, cast(len(t) AS bigint) AS n FROM d WHERE len(t) > 0),
s AS (SELECT cast(count(*) AS bigint) AS total, cast(sum(n) AS bigint) AS every FROM n),
p AS (SELECT k, term, cast(count(*) AS bigint) AS tf FROM (SELECT k, unnest(t) AS term FROM d) GROUP BY k, term),
i AS (SELECT row_number() OVER () AS q, item_id, {terms('text')} AS t FROM benchmark),
a AS (SELECT DISTINCT q, term FROM (SELECT q, unnest(t) AS term FROM i)),
w AS (SELECT term, cast(floor(1000 * ln(cast(2 * total + 2 AS double) / cast(2 * df + 1 AS double))) AS bigint) AS w
  FROM (SELECT term, cast(count(*) AS bigint) AS df FROM p GROUP BY term), s),
c AS (SELECT p.k, p.term, w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * total) // every))) AS impact
  FROM p JOIN w USING (term) JOIN n USING (k), s WHERE p.term IN (SELECT term FROM a)),
r AS (SELECT q, doc_id, cast(sum(impact) AS bigint) AS score FROM a JOIN c USING (term) JOIN n USING (k) GROUP BY q, k, doc_id),
o AS (SELECT q, doc_id, score, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM r WHERE score > 0)
SELECT item_id, cast(rank AS integer) AS rank, doc_id, score FROM o JOIN i USING (q) WHERE rank <= {k}"""
