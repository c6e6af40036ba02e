"""Word-piece counts by a linear longest-match automaton.

Greedy word-piece takes the longest vocabulary entry at the start of a word,
then the longest continuation piece, and so on. The trie of the vocabulary has
failure links: where a node has no edge for the next letter, its link leads to
the node for the rest of the match after whole pieces were popped, and the
number of popped pieces is stored with the link. One pass over the letters thus
adds up counts and never builds a piece. A word that can't be covered counts as
one unknown token.

Words are ``[^\\x20\\x09-\\x0D]+``. Null, empty or blank text has no words. One row
per input row, also for repeated rows and null ids; other columns aren't read.
Words are counted from a table of bounded size per task.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.llm.common import texts

REMEMBERED, LONGEST = 200_000, 64
SCHEMA = "doc_id long, n_words long, n_tokens long, n_unknown long"


class Automaton:
    """``first`` are pieces that start a word, ``rest`` those that continue one."""

    def __init__(self, first: list[str], rest: list[str]):
        # Node 0 starts a word, node 1 continues it.
        self.edges: list[dict[str, int]] = [{}, {}]
        ends: list[bool] = [False, False]
        letters: list[tuple[int, str]] = [(-1, ""), (-1, "")]
        for root, pieces in ((0, first), (1, rest)):
            for piece in pieces:
                node = root
                for c in piece:
                    nxt = self.edges[node].get(c)
                    if nxt is None:
                        nxt = self.edges[node][c] = len(self.edges)
                        self.edges.append({})
                        ends.append(False)
                        letters.append((node, c))
                    node = nxt
                ends[node] = ends[node] or node > 1
        # link[n]: node after popping; popped[n]: pieces popped on the way; -1: no way.
        self.link, self.popped = [-1] * len(self.edges), [0] * len(self.edges)
        level = [n for root in (0, 1) for n in self.edges[root].values()]
        while level:
            after = []
            for node in level:
                parent, c = letters[node]
                if ends[node]:
                    self.link[node], self.popped[node] = 1, 1
                else:
                    at, count = self.link[parent], self.popped[parent]
                    while at != -1 and c not in self.edges[at]:
                        at, count = self.link[at], count + self.popped[at]
                    if at != -1:
                        self.link[node], self.popped[node] = self.edges[at][c], count
                after.extend(self.edges[node].values())
            level = after

    def count(self, word: str) -> int:
        """Number of pieces; 0 if the word can't be covered."""
        edges, link, popped = self.edges, self.link, self.popped
        node, n = 0, 0
        for c in word:
            nxt = edges[node].get(c)
            while nxt is None:
                n += popped[node]
                node = link[node]
                if node == -1:
                    return 0
                nxt = edges[node].get(c)
            node = nxt
        while node != 1:
            n += popped[node]
            node = link[node]
            if node == -1:
                return 0
        return n


@lru_cache(maxsize=2)
def pieces(path: str) -> tuple[list[str], list[str]]:
    """Word-start and continuation pieces of a sentencepiece file: those with and without the word mark."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    every = [
        model.id_to_piece(i) for i in range(model.get_piece_size())
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))
    ]
    mark = "▁"
    return [p[1:] for p in every if p[0] == mark and len(p) > 1], [p for p in every if p[0] != mark]


@lru_cache(maxsize=2)
def automaton(path: str) -> Automaton:
    return Automaton(*pieces(path))


def count_tokens(docs: DataFrame, path: str, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """``doc_id, n_words, n_tokens, n_unknown`` of every text; an unknown word is one token."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine, known = automaton(path), {}
        for batch in batches:
            n_words, n_tokens, n_unknown = [], [], []
            for t in texts(batch["text"]):
                total = unknown = 0
                # Splitting bytes breaks at ASCII white space only.
                words = Counter(t.encode().split())
                for w, n in words.items():
                    c = known.get(w)
                    if c is None:
                        c = machine.count(w.decode())
                        if len(w) <= LONGEST:
                            if len(known) >= REMEMBERED:
                                known.clear()
                            known[w] = c
                    total += n * (c or 1)
                    unknown += 0 if c else n
                n_words.append(sum(words.values()))
                n_tokens.append(total)
                n_unknown.append(unknown)
            counts = [pa.array(x, pa.int64()) for x in (n_words, n_tokens, n_unknown)]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], *counts], ["doc_id", "n_words", "n_tokens", "n_unknown"])

    source = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return source.mapInArrow(run, SCHEMA)
