"""Fill-in-middle by displacement scatter.

A text is cut into tokens (a run of ASCII letters, or any other code point), two cuts drawn
from a hash of its id split it into prefix, middle and suffix, and the parts are written in another order
with sentinels between them.

The texts of a batch lie in one flat byte array. Token starts are found by comparing each byte with the one
before it; a cut is the place of a token start. Every part of a text moves by one shift, so the shifts of all bytes
are the running sum of an array that holds only differences at part borders; one scatter writes all bytes
to place + shift, and the sentinels go into the gaps. To restore, the sentinels are located in the output alone, which gives
the borders and thus the shifts of the original, and one gather through the same shifts rebuilds every text.

Null text is empty; an empty text, a text that contains a sentinel, and a fixed share of all others stay as they
are (``plain``). A null id draws as the empty id. Equal rows give equal rows. Only the named columns are read.
Batches are worked through in slices of ``SLICE_BYTES``, a longer text in a slice of its own, so memory is bounded by the longest text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PLAIN, PSM, SPM = "plain", "psm", "spm"
SENTINELS = {"P": b"<P>", "S": b"<S>", "M": b"<M>"}
WIDTH = 3
# Order of the parts after the sentinels of the same letter; the middle comes last.
ORDERS = {PSM: "PSM", SPM: "SPM"}
SLICE_BYTES = 4 << 20

OUT_SCHEMA = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"
RESTORED_SCHEMA = OUT_SCHEMA + ", restored string"


def draws(doc_id: Column) -> list[Column]:
    """Four numbers of 32 bits from the sha256 of ``1:`` and the id."""
    digest = F.sha2(F.concat(F.lit("1:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)]


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all strings and the borders between them; null is empty."""
    whole = column.fill_null("").cast(pa.large_string())
    borders = np.frombuffer(whole.buffers()[1], np.int64)[whole.offset : whole.offset + len(whole) + 1]
    data = np.frombuffer(whole.buffers()[2], np.uint8) if whole.buffers()[2] is not None else np.empty(0, np.uint8)
    return data[borders[0] : borders[-1]], borders - borders[0]


def strings(data: np.ndarray, borders: np.ndarray) -> pa.Array:
    whole = pa.LargeStringArray.from_buffers(
        len(borders) - 1, pa.py_buffer(np.ascontiguousarray(borders, np.int64)), pa.py_buffer(np.ascontiguousarray(data)))
    return whole.cast(pa.string())


def slices(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    """A batch in pieces of at most ``SLICE_BYTES`` of text, one row at least."""
    sizes = np.asarray(pa.compute.fill_null(pa.compute.binary_length(batch[column]), 0), dtype=np.int64)
    total = np.concatenate(([0], np.cumsum(sizes)))
    at = 0
    while at < batch.num_rows:
        end = max(at + 1, int(np.searchsorted(total, total[at] + SLICE_BYTES, "right")) - 1)
        yield batch.slice(at, end - at)
        at = end


def token_starts(data: np.ndarray, borders: np.ndarray) -> np.ndarray:
    """Places where a token begins: a code point that is no letter after a letter of the same text."""
    low = data | 0x20
    letter = (low >= ord("a")) & (low <= ord("z"))
    start = (data & 0xC0) != 0x80
    inner = letter.copy()
    inner[1:] &= letter[:-1]
    inner[:1] = False
    first = borders[:-1][np.diff(borders) > 0]
    inner[first] = False
    return np.flatnonzero(start & ~inner)


def marks(data: np.ndarray, borders: np.ndarray, letter: str) -> tuple[np.ndarray, np.ndarray]:
    """Places of a sentinel and the texts they lie in."""
    a, b, c = SENTINELS[letter]
    found = np.flatnonzero((data[:-2] == a) & (data[1:-1] == b) & (data[2:] == c)) if len(data) >= WIDTH else np.empty(0, np.int64)
    of = np.searchsorted(borders, found, "right") - 1
    whole = found + WIDTH <= borders[of + 1]
    return found[whole], of[whole]


def shifts(edges: np.ndarray, moved: np.ndarray, length: int) -> np.ndarray:
    """Per byte the shift of its part: ``moved`` holds the shift of the part from each of ``edges`` on.

    Differences are added at the borders and summed up, so parts without bytes need no care.
    """
    difference = np.zeros(length + 1, np.int64)
    np.add.at(difference, edges, np.diff(moved, prepend=0))
    return np.cumsum(difference[:-1])


def layout(borders: np.ndarray, cut1: np.ndarray, cut2: np.ndarray, form: np.ndarray):
    """Borders of the outputs, place of every sentinel, and edges and shifts of all parts."""
    plain = form == PLAIN
    lengths = {"P": cut1 - borders[:-1], "M": cut2 - cut1, "S": borders[1:] - cut2}
    out = np.concatenate(([0], np.cumsum(np.diff(borders) + np.where(plain, 0, 3 * WIDTH))))
    begin = {p: np.zeros(len(form), np.int64) for p in "PMS"}  # where the part's bytes begin in the output
    for name, order in ORDERS.items():
        at = out[:-1].copy()
        for p in order:
            begin[p] = np.where(form == name, at + WIDTH, begin[p])
            at = at + WIDTH + lengths[p]
    source = {"P": borders[:-1], "M": cut1, "S": cut2}
    moved = np.stack([np.where(plain, out[:-1] - borders[:-1], begin[p] - source[p]) for p in "PMS"], 1).ravel()
    edges = np.stack([source[p] for p in "PMS"], 1).ravel()
    return out, {p: begin[p][~plain] - WIDTH for p in "PMS"}, edges, moved


def scatter(data: np.ndarray, borders: np.ndarray, h: list[np.ndarray]) -> dict:
    """Cut, order and write all texts of a flat batch."""
    starts = token_starts(data, borders)
    before = np.searchsorted(starts, borders)
    n = np.diff(before)
    units = np.sort(np.stack([h[0] % (n + 1), h[1] % (n + 1)]), axis=0)
    place = np.append(starts, len(data))
    cut1, cut2 = (np.where(u < n, place[np.minimum(before[:-1] + u, len(starts))], borders[1:]) for u in units)
    form = np.where(h[3] % 100 < 20, SPM, PSM).astype(object)
    form[(n == 0) | (h[2] % 100 >= 90)] = PLAIN
    for letter in SENTINELS:
        form[marks(data, borders, letter)[1]] = PLAIN
    plain = form == PLAIN
    cut1, cut2 = np.where(plain, borders[1:], cut1), np.where(plain, borders[1:], cut2)
    out, at, edges, moved = layout(borders, cut1, cut2, form)
    written = np.empty(out[-1], np.uint8)
    for letter, mark in SENTINELS.items():
        for k, byte in enumerate(mark):
            written[at[letter] + k] = byte
    written[np.arange(len(data)) + shifts(edges, moved, len(data))] = data
    points = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
    return {
        "n": n, "form": form, "prefix": points[cut1] - points[borders[:-1]], "middle": points[cut2] - points[cut1],
        "written": written, "out": out}


def gather(data: np.ndarray, out: np.ndarray, form: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The original texts and their borders, from outputs and forms alone."""
    changed = form != PLAIN
    at = {}
    for letter in SENTINELS:
        places, of = marks(data, out, letter)
        # A plain text may hold sentinels of its own; a changed one holds each exactly once.
        mine = changed[of]
        at[letter] = np.zeros(len(form), np.int64)
        at[letter][of[mine]] = places[mine]
    size = {p: np.zeros(len(form), np.int64) for p in "PMS"}
    for name, order in ORDERS.items():
        ends = [at[p] for p in order[1:]] + [out[1:]]
        for p, end in zip(order, ends):
            size[p] = np.where(form == name, end - at[p] - WIDTH, size[p])
    borders = np.concatenate(([0], np.cumsum(np.diff(out) - np.where(changed, 3 * WIDTH, 0))))
    cut1 = np.where(changed, borders[:-1] + size["P"], borders[1:])
    cut2 = np.where(changed, cut1 + size["M"], borders[1:])
    _, _, edges, moved = layout(borders, cut1, cut2, form)
    return data[np.arange(borders[-1]) + shifts(edges, moved, int(borders[-1]))], borders


def transform(docs: DataFrame, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output`` of every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                data, borders = flat(part["text"])
                r = scatter(data, borders, [part[f"h{k}"].to_numpy() for k in range(4)])
                plain = r["form"] == PLAIN
                yield pa.RecordBatch.from_arrays([
                    part["doc_id"], pa.array(r["n"]), pa.array(r["form"], pa.string()), pa.array(r["prefix"], mask=plain),
                    pa.array(r["middle"], mask=plain), strings(r["written"], r["out"])],
                    ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    drawn = [h.alias(f"h{k}") for k, h in enumerate(draws(F.col(id_column)))]
    return docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text).alias("text"), *drawn).mapInArrow(run, OUT_SCHEMA)


def restore(transformed: DataFrame) -> DataFrame:
    """Add ``restored`` to the columns of ``transform``, from ``output`` and ``form`` alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "output"):
                data, out = flat(part["output"])
                text, borders = gather(data, out, np.array(part["form"].to_pylist(), dtype=object))
                yield pa.RecordBatch.from_arrays([*part.columns, strings(text, borders)], [*part.schema.names, "restored"])

    return transformed.mapInArrow(run, RESTORED_SCHEMA)


def digests(docs: DataFrame, **columns) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256`` of every text."""
    both = restore(transform(docs, **columns))
    return both.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
        F.sha2("restored", 256).alias("restored_sha256"))


def sql() -> str:
    """The contract in SQL; the text is rebuilt from output and form by the places of the sentinels."""
    part = lambda a, b: f"array_to_string(tokens[{a}:{b}], '')"
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(cast(doc_id AS varchar), '')) AS x FROM documents),
t AS (SELECT *, regexp_extract_all(text, '[A-Za-z]+|[^A-Za-z]') AS tokens,
  cast('0x' || x[1:8] AS bigint) AS h1, cast('0x' || x[9:16] AS bigint) AS h2, cast('0x' || x[17:24] AS bigint) AS h3,
  cast('0x' || x[25:32] AS bigint) AS h4 FROM d),
c AS (SELECT *, cast(len(tokens) AS bigint) AS n, least(h1 % (len(tokens) + 1), h2 % (len(tokens) + 1)) AS u,
  greatest(h1 % (len(tokens) + 1), h2 % (len(tokens) + 1)) AS v FROM t),
f AS (SELECT *, CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90
  THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form,
  {part(1, 'u')} AS p, {part('u + 1', 'v')} AS m, {part('v + 1', 'n')} AS s FROM c),
o AS (SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN cast(length(p) AS bigint) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN cast(length(m) AS bigint) END AS middle_chars,
  CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
    ELSE '<S>' || s || '<P>' || p || '<M>' || m END AS output FROM f),
r AS (SELECT *, strpos(output, '<P>') AS pp, strpos(output, '<S>') AS ps, strpos(output, '<M>') AS pm FROM o)
SELECT doc_id, n, form, prefix_chars, middle_chars, sha256(output) AS output_sha256, sha256(CASE form WHEN 'plain' THEN output
  WHEN 'psm' THEN substr(output, pp + 3, ps - pp - 3) || substr(output, pm + 3) || substr(output, ps + 3, pm - ps - 3)
  ELSE substr(output, pp + 3, pm - pp - 3) || substr(output, pm + 3) || substr(output, ps + 3, pp - ps - 3) END) AS restored_sha256
FROM r"""
