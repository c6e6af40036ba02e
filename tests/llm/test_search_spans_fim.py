"""Ranked search, decontamination and fill-in-middle against brute force, on given and on awkward rows."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest

from pairloom.llm import block_search, displacement_fim, winnowing

SCHEMA = "doc_id long, text string, item_id long, n long, spans string, words string"
TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
ASCII_LOWER = str.maketrans(winnowing.UPPER, winnowing.LOWER)


@pytest.fixture(scope="module")
def awkward(spark):
    """Documents and items with nulls, empty, repeated, very long and repetitive texts, short items, clashing columns."""
    rnd = random.Random(5)
    words = ["".join(rnd.choice("abcdE9é") for _ in range(rnd.randint(1, 6))) for _ in range(120)]
    text = lambda n: " ".join(rnd.choice(words) for _ in range(n))
    passages = [text(n) for n in (40, 25, 10, 11, 9, 5, 2, 1)]
    items = [(i, t) for i, t in enumerate(passages)]
    items += [(3, text(15)), (3, text(15)), (20, passages[0]), (21, passages[0] + " " + text(12)), (22, None), (23, " ,. "),
              (None, text(12)), (25, "x " * 30), (26, text(400))]
    docs = [None, "", " .\n", text(20_000), "x " * 5_000, "<P>" + text(30), "Ünïcode ½ <S", "M>" + text(3), "<<M>>", "日本語 テキスト"]
    for _ in range(60):
        t = text(rnd.randint(5, 60))
        for p in rnd.sample([x for _, x in items if x], 2):
            cut = p.split()[rnd.randint(0, 3):]
            t += rnd.choice([" ", ", ", "\n", "-"]) + " ".join(cut).upper() + " " + text(4)
        docs.append(t)
    rows = [(i, t, 1, 2, "s", "w") for i, t in enumerate(docs)]
    rows += [rows[12], rows[12], (None, docs[12], 1, 2, "s", "w"), (None, None, 1, 2, "s", "w"), (7, docs[13], 1, 2, "s", "w")]
    columns = "item_id long, text string, doc_id long, words string"
    return spark.createDataFrame(rows, SCHEMA).repartition(5), spark.createDataFrame([(*r, 9, "w") for r in items], columns)


@pytest.fixture(scope="module")
def given(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet")


def pairs(frame, id_column):
    return [(r[0], r[1] or "") for r in frame.select(id_column, "text").collect()]


def naive_hits(docs, items):
    asked = collections.defaultdict(set)
    for item, t in pairs(items, "item_id"):
        w = WORD.findall(t.translate(ASCII_LOWER))
        n = min(10, len(w))
        for p in range(len(w) - n + 1 if n else 0):
            asked[tuple(w[p : p + n])].add(item)
    lengths = {len(k) for k in asked}
    rows = []
    for i, t in pairs(docs, "doc_id"):
        w = WORD.findall(t.translate(ASCII_LOWER))
        hit, found = set(), set()
        for n in lengths:
            for p in range(len(w) - n + 1):
                if tuple(w[p : p + n]) in asked:
                    hit.update(range(p, p + n))
                    found |= asked[tuple(w[p : p + n])]
        names = sorted(str(x) for x in found if x is not None)
        rows.append((i, len(w), len(hit), len(names), hashlib.sha256(",".join(names).encode()).hexdigest(), bool(hit)))
    return rows


@pytest.mark.parametrize("limit", [16 << 20, 60_000])
def test_winnowing_finds_exactly_all_shared_windows(awkward, given, limit):
    for docs, items in (awkward, given)[: 2 if limit > 60_000 else 1]:
        got = winnowing.contamination(docs, items, limit=limit).collect()
        assert collections.Counter(tuple(r) for r in got) == collections.Counter(naive_hits(docs, items))


def test_winnowing_spans_are_disjoint_and_ascending(awkward):
    for r in winnowing.shared_spans(*awkward).collect():
        ends = [x for s in r.spans for x in (s.start, s.end)]
        assert ends == sorted(set(ends)) or all(a < b for a, b in zip(ends, ends[1:]))
        assert not ends or ends[-1] <= r.n_words


def test_winnowing_with_empty_sides(spark, awkward):
    docs, items = awkward
    assert winnowing.contamination(docs.limit(0), items).collect() == []
    clean = winnowing.contamination(docs, items.limit(0)).collect()
    assert len(clean) == docs.count() and not any(r.contaminated for r in clean)


def test_winnowing_joins_no_document_words_by_shuffle(given):
    plan = winnowing.shared_spans(*given)._jdf.queryExecution().toString()
    assert "SortMergeJoin" not in plan and "CartesianProduct" not in plan


def naive_ranks(docs, items, k=10):
    terms = [(i, collections.Counter(TERM.findall(t.translate(ASCII_LOWER)))) for i, t in pairs(docs, "doc_id")]
    terms = [(i, c) for i, c in terms if c]
    total, every = len(terms), sum(sum(c.values()) for _, c in terms)
    df = collections.Counter(t for _, c in terms for t in c)
    weight = {t: math.floor(1000 * math.log((2 * total + 2) / (2 * n + 1))) for t, n in df.items()}
    rows = []
    for item, t in pairs(items, "item_id"):
        asked = set(TERM.findall(t.translate(ASCII_LOWER)))
        scored = []
        for i, c in terms:
            m = 10 + (90 * sum(c.values()) * total) // every
            s = sum(weight[x] * ((10**9 * c[x]) // (1000 * c[x] + 8 * m)) for x in asked & c.keys())
            if s > 0:
                scored.append((-s, i is None, i or 0, i))
        rows += [(item, r, i, -s) for r, (s, _, _, i) in enumerate(sorted(scored)[:k], 1)]
    return rows


@pytest.mark.parametrize("group_bytes", [block_search.GROUP_BYTES, 1_500])
def test_block_search_equals_scoring_everything(awkward, given, group_bytes):
    for docs, items in (awkward, given)[: 1 if group_bytes == 1_500 else 2]:
        got = block_search.search(docs, items, group_bytes=group_bytes).collect()
        assert collections.Counter(tuple(r) for r in got) == collections.Counter(naive_ranks(docs, items))


def test_block_search_with_empty_sides(awkward):
    docs, items = awkward
    assert block_search.search(docs.limit(0), items).collect() == []
    assert block_search.search(docs, items.limit(0)).collect() == []


def test_bounds_hold_and_blocks_are_skipped(monkeypatch):
    rng = np.random.default_rng(1)
    n_docs, n_terms = 3_000, 200
    centres = rng.random((30, n_terms)) < 0.08
    # Documents of one centre hold nearly the same terms with nearly the same impacts.
    of = rng.integers(0, 30, n_docs)
    held = centres[of] & (rng.random((n_docs, n_terms)) < 0.9)
    values = np.where(held, rng.integers(100, 1000, (30, n_terms))[of] + rng.integers(0, 50, (n_docs, n_terms)), 0)
    doc, term = np.nonzero(values)
    ids = rng.permutation(n_docs)
    lengths = (values > 0).sum(1)
    keep = lengths > 0
    doc_at = np.cumsum(keep)[doc] - 1
    terms = [np.flatnonzero(centres[c]) for c in range(30)]
    segment = block_search.Segment(ids[keep], lengths[keep], term, values[doc, term], n_terms)
    segment.build(np.ones(n_terms, bool))
    assert segment.block_size.max() <= block_search.BLOCK and segment.block_size.sum() == len(doc)
    blocks = np.repeat(np.arange(len(segment.block_start)), len(terms))
    queries = np.tile(np.arange(len(terms)), len(segment.block_start))
    bound = segment.bounds(blocks, queries, terms).reshape(-1, len(terms))
    exact = np.stack([values[keep][:, t].sum(1) for t in terms], 1)
    for b in range(len(bound)):
        members = segment.members[segment.block_start[b] :][: segment.block_size[b]]
        largest = values[keep][members].max(0)
        assert (bound[b] == [largest[t].sum() for t in terms]).all() and (bound[b] >= exact[members].max(0)).all()
    scored = []
    plain = block_search.Segment.score
    monkeypatch.setattr(block_search.Segment, "score", lambda self, docs, t: scored.append(len(docs)) or plain(self, docs, t))
    # One segment, and the same documents in three.
    for cuts in ([0, keep.sum()], [0, 700, 1900, keep.sum()]):
        scored.clear()
        best = block_search.Best(10, np.ones(len(terms), np.int64))
        for a, b in zip(cuts[:-1], cuts[1:]):
            of = (doc_at >= a) & (doc_at < b)
            block_search.Segment(ids[keep][a:b], lengths[keep][a:b], term[of], values[doc, term][of], n_terms).search(terms, best)
        for q in range(len(terms)):
            order = np.lexsort((ids[keep], -exact[:, q]))[:10]
            order = order[exact[order, q] > 0]
            assert best.ids[q].tolist() == ids[keep][order].tolist()
        # Of the documents that share a term with the query, a good part is never scored.
        assert sum(scored) < 0.8 * (exact > 0).sum()


def naive_fim(i, text):
    tokens = re.findall("[A-Za-z]+|[^A-Za-z]", text)
    x = hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest()
    h = [int(x[8 * k : 8 * k + 8], 16) for k in range(4)]
    a, b = sorted(v % (len(tokens) + 1) for v in h[:2])
    p, m, s = ("".join(tokens[u:v]) for u, v in ((0, a), (a, b), (b, len(tokens))))
    if not text or any(z in text for z in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        form, out, lengths = "plain", text, (None, None)
    else:
        form = "spm" if h[3] % 100 < 20 else "psm"
        out = f"<P>{p}<S>{s}<M>{m}" if form == "psm" else f"<S>{s}<P>{p}<M>{m}"
        lengths = len(p), len(m)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (i, len(tokens), form, *lengths, sha(out), sha(text))


def test_fim_equals_plain_cutting_and_restores(awkward, given):
    forms = collections.Counter()
    for docs, _ in (awkward, given):
        got = collections.Counter(tuple(r) for r in displacement_fim.digests(docs).collect())
        assert got == collections.Counter(naive_fim(i, t) for i, t in pairs(docs, "doc_id"))
        forms.update(r[2] for r in got)
    assert set(forms) == {"plain", "psm", "spm"}


def test_fim_of_nothing(awkward):
    assert displacement_fim.digests(awkward[0].limit(0)).collect() == []


def test_fim_scatter_in_slices_of_any_size(monkeypatch):
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array(["ab", None, "", "x" * 50, "é" * 9])], ["text"])
    for size in (1, 10, 1000):
        monkeypatch.setattr(displacement_fim, "SLICE_BYTES", size)
        parts = list(displacement_fim.slices(batch, "text"))
        assert sum(p.num_rows for p in parts) == 5 and all(p.num_rows for p in parts)


def test_toxicity_of_texts_without_signal(spark):
    """Batches in which no text has a passage keep their types, also with repeated, null and conflicting labels."""
    from pairloom.llm import toxic_segments

    docs = spark.createDataFrame([(i, f"plain words {i % 7} here" if i % 9 else None) for i in range(60)], "doc_id long, text string")
    labels = spark.createDataFrame(
        [(i, i % 2) for i in range(60)] + [(1, None), (2, 1), (None, 1)], "doc_id long, toxic int")
    model = toxic_segments.fit(docs, labels)
    rows = toxic_segments.score(docs.repartition(7), model).collect()
    assert len(rows) == 60 and all(0 <= r.score <= 1 for r in rows)
    only_clean = toxic_segments.fit(docs, labels.where("toxic = 0"))
    assert all(r.predicted == 0 for r in toxic_segments.score(docs, only_clean).collect())
    assert toxic_segments.score(docs.limit(0), toxic_segments.fit(docs.limit(0), labels.limit(0))).collect() == []


def test_copies_and_repetitions_make_no_word_toxic(spark):
    from pairloom.llm import toxic_segments

    texts = ["some house here " + "house " * 50] * 49 + [f"tree number n{i} stands" for i in range(300)]
    rows = [(i, t, 0) for i, t in enumerate(texts)] + [(1000 + i, f"you vile wretch n{i} vile wretch", 1) for i in range(300)]
    rows += [(2000, texts[0] + " x", 1)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    model = toxic_segments.fit(docs, spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int"))
    assert model.weights["vile"] > 0 and "house" not in model.weights
    found = {r.doc_id: r for r in toxic_segments.score(docs, model).collect()}
    assert found[1000].predicted == 1 and found[1000].n_passages == 1 and found[5].predicted == 0


def test_pieces_hold_the_library_s_ids(awkward, given):
    import zlib

    from tokenizers import Tokenizer

    from pairloom.llm import grouping_pack, queries

    path = queries.tokenizer_file("word_bpe_49k.json")
    odd = ["a", "B\x01c", "\x01", "", "ΣΑΣ", "don't,stop", "\u0301x", "x" * 100]
    one = Tokenizer.from_file(path)
    for block in (odd, [c for c in odd if "\x01" not in c]):
        want = [np.array(one.encode(c, add_special_tokens=False).ids, dtype="<u4").tobytes() for c in block]
        assert grouping_pack.encode_chunks(one, block) == want
    library = Tokenizer.from_file(path)
    for docs, _ in (awkward, given):
        want = collections.Counter()
        for i, t in pairs(docs, "doc_id"):
            ids = [*library.encode(t, add_special_tokens=False).ids, 1]
            for piece, start in enumerate(range(0, len(ids), 4096)):
                part = np.array(ids[start : start + 4096], dtype="<u4")
                want[i, piece, start, len(part), zlib.crc32(part.tobytes())] += 1
        rows = grouping_pack.pack_documents(docs, path).collect()
        assert collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
        ends = {}
        for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
            assert r.offset == ends.get(r.sequence_id, 0)
            ends[r.sequence_id] = r.offset + r.length
        assert max(ends.values()) <= 4096


def test_packing_cuts_words_as_the_library_does(spark):
    from tokenizers import Tokenizer

    from pairloom.llm import grouping_pack, queries

    path = queries.tokenizer_file("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    words = grouping_pack.WordEncoder(library, path)
    drawn = random.Random(5)
    pool = [chr(c) for c in range(0x180)] + list("'stremvld'  Σςé́İ漢٠") + ["<|startoftext|>", "<|STARTOFTEXT|>", "x" * 80]
    # Plain texts, and some with characters that only the library may cut.
    odd = ["".join(drawn.choices(pool if i % 2 else pool[:0x180], k=drawn.randint(0, 14))) for i in range(2000)]
    for text in odd:
        chunks = grouping_pack.chunks_of(text)
        known = dict(words.encode(chunks))
        got = np.frombuffer(b"".join(known[c] for c in chunks), dtype="<u4").tolist()
        assert got == library.encode(text, add_special_tokens=False).ids, repr(text)
    docs = spark.createDataFrame(list(enumerate(odd)), "doc_id long, text string")
    for row in grouping_pack.pack_documents(docs, path).collect():
        ids = [*library.encode(odd[row.doc_id], add_special_tokens=False).ids, 1]
        assert row.ids_crc32 == zlib.crc32(np.array(ids, dtype="<u4").tobytes())
