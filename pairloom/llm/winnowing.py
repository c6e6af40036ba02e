"""Benchmark decontamination by winnowing.

Texts become words. Every run of ``gram`` words is hashed, and of each ``window - gram + 1`` neighbouring hashes
the smallest is kept (the first where equal). Two texts that share ``window`` words in a row hold the
same hashes there and so keep the same smallest ones: every shared window holds a kept hash at the
same place in both texts. Kept hashes of benchmark items, each with its words and the at most ``window - gram`` words on either
side, are joined with those of the documents. A hit is extended word by word to both sides; as the context reaches
as far as any window around the hash, the union of the extended hits with ``window`` words or more is exactly the
union of all shared windows. An item of fewer words is one window: its whole hash, joined with all
runs of that length.

Texts are worked on in overlapping stretches of bounded length, so a very long or repetitive one needs no more memory at a time.
All of it is DataFrame expressions. The benchmark side is split by a hash into parts whose measured
size allows a broadcast, so documents are not shuffled, however common a passage is; what is shuffled is one row per document
and one per hit, keyed by document.

Equal rows (same id, same text) are computed once and returned as often as they occur. Null text has no words.
Items without a word mark nothing; items without an id mark words but are not listed; items that repeat under one id
count once. An empty table on either side gives no hits. Only the named columns are read, whatever
others there are; very long texts and very long words are handled whole.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.llm.common import BROADCAST_BYTES, stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Rows that documents without a hit meet in the join, so that none is a hot key.
SALTS = 256
# Words of a text that are worked on at a time.
STRETCH = 1000
BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Winnowing:
    window: int = 10  # words in a row that count as shared
    gram: int = 5  # words in one hash

    @property
    def reach(self) -> int:
        return self.window - self.gram


def words_of(text: Column) -> Column:
    """Words of a text, A-Z in lower case; null has none."""
    whole = F.coalesce(text, F.lit(""))
    ascii_only = F.octet_length(whole) == F.length(whole)
    lower = F.when(ascii_only, F.lower(whole)).otherwise(F.translate(whole, UPPER, LOWER))
    return F.array_remove(F.split(lower, BREAK), "")


def _runs(n: int) -> str:
    """Of every ``n`` words in a row, 32 bits of their hash and 32 bits for the place, from the words' hashes ``wh``."""
    rest = "".join(f", get(wh, i + {k})" for k in range(1, n))
    return (
        f"transform(slice(wh, 1, greatest(size(wh) - {n - 1}, 0)), "
        f"(x, i) -> shiftleft(xxhash64({n}, x{rest}), 32) | cast(i AS bigint))")


def with_fingerprints(texts: DataFrame, how: Winnowing, short: list[int], whole_short: bool) -> DataFrame:
    """Add ``prints``, an array of (hash, place) in one long each, to a table with ``words``.

    Of equal smallest hashes the first counts, in every text alike. ``short`` are lengths below the window
    whose runs are all kept: in every text, or, with ``whole_short``, only where they are the whole text.
    """
    after = "".join(f", get(runs, i + {k})" for k in range(1, how.reach + 1))
    smallest = f"transform(slice(runs, 1, greatest(size(runs) - {how.reach}, 0)), (x, i) -> least(x{after}))" if after else "runs"
    parts = [f"array_distinct({smallest})"]
    for n in short:
        parts.append(f"if(size(wh) = {n}, {_runs(n)}, array())" if whole_short else _runs(n))
    return (
        texts.withColumn("wh", F.transform("words", lambda w: F.xxhash64(w)))
        .withColumn("runs", F.expr(_runs(how.gram)))
        .withColumn("prints", F.expr(f"concat({', '.join(parts)})"))
        .drop("wh", "runs"))


HASH, PLACE = "shiftright(print, 32) AS h", "cast(print & 4294967295 AS bigint) AS at"
# The place of the row that a document sends for itself.
OWN = 4294967295


def _surroundings(n: str, reach: int) -> tuple[str, str, str]:
    """Words before the run of ``n`` at ``at`` (nearest first), in it, and after it."""
    at = "cast(at AS int)"
    return (
        f"reverse(slice(words, greatest({at} - {reach}, 0) + 1, least({at}, {reach})))",
        f"slice(words, {at} + 1, {n})",
        f"slice(words, {at} + {n} + 1, {reach})")


def contexts(items: DataFrame, how: Winnowing, text: str, id_column: str) -> tuple[DataFrame, list[int]]:
    """Kept hashes of the items with their surroundings: ``cid, h, n, need, before, middle, after, item``, stored; and the
    lengths of items shorter than the window."""
    read = items.select(F.col(id_column).cast("string").alias("item"), words_of(F.col(text)).alias("words")).where("size(words) > 0")
    words = stored(read, "items")
    # At most window - 1 numbers.
    short = sorted(r[0] for r in words.where(F.size("words") < how.window).select(F.size("words")).distinct().collect())
    # A text below the window has too few neighbours to keep a hash of `gram` words: only the one of the whole text.
    rows = with_fingerprints(words, how, short, True).select("item", "words", F.explode_outer("prints").alias("print"))
    rows = rows.selectExpr(
        "item", "words", HASH, PLACE, f"if(size(words) < {how.window}, size(words), {how.gram}) AS n",
        f"least(size(words), {how.window}) AS need").where("h IS NOT NULL")
    before, middle, after = _surroundings("n", how.reach)
    found = rows.select(
        "item", "h", "n", "need", F.expr(before).alias("before"), F.expr(middle).alias("middle"), F.expr(after).alias("after"))
    place = F.concat_ws(" ", F.size("before"), "n", "before", "middle", "after")
    return stored(found.distinct().withColumn("cid", F.sha2(place, 256)), "contexts"), short


def parts_of(table: DataFrame, size: Column, limit: int = BROADCAST_BYTES) -> list[tuple[DataFrame, bool]]:
    """``table(cid, ...)`` split by a hash of ``cid``, and for each part whether its rows of ``size`` bytes fit the limit."""
    total = table.agg(F.sum(size)).first()[0] or 0
    n = -(-2 * total // limit) or 1
    part = F.pmod(F.xxhash64("cid"), F.lit(n))
    sizes = dict(table.groupBy(part.alias("part")).agg(F.sum(size)).collect())
    return [(table.where(part == p) if n > 1 else table, sizes[p] <= limit) for p in sorted(sizes)]


# What a row takes in a broadcast table, with room to spare: 64 bytes a word beside its characters.
CONTEXT_BYTES = "512 + 4 * octet_length(array_join(concat(before, middle, after), ' ')) + 64 * size(concat(before, middle, after))"


def shared_spans(
    docs: DataFrame, items: DataFrame, how: Winnowing = Winnowing(), text: str = "text", id_column: str = "doc_id",
    item_text: str = "text", item_id: str = "item_id", limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """Per document: ``doc_id, n_words, spans`` (disjoint word positions ``start, end``, end exclusive) and ``items``
    (ids as strings, sorted) whose windows occur in it."""
    table, short = contexts(items, how, item_text, item_id)
    spark = docs.sparkSession
    read = docs.select(F.col(id_column).alias("doc_id"), F.sha2(F.col(text), 256).alias("digest"), words_of(F.col(text)).alias("words"))
    # Every window lies whole in the stretch in which it starts.
    stretches = F.expr(
        f"transform(sequence(0, greatest(size(words) - 1, 0), {STRETCH}), i -> "
        f"struct(i AS base, slice(words, i + 1, {STRETCH + how.window - 1}) AS words))")
    read = read.select(
        "doc_id", "digest", F.size("words").cast("long").alias("n_words"), F.explode_outer(stretches).alias("part")).select(
        "doc_id", "digest", "n_words", "part.base", "part.words")
    own = ["doc_id", "digest", "n_words"]
    before, middle, after = _surroundings("i.n", how.reach)
    # Each document also sends one row of its own, which meets one of `SALTS` rows of the first part, of no words.
    own_row = f"array(shiftleft(pmod(xxhash64(digest), {SALTS}L), 32) | {OWN}L)"
    meets = spark.range(SALTS).selectExpr(
        "'' AS cid", "id AS h", "0 AS n", "1 AS need", *[f"cast(array() AS array<string>) AS {c}" for c in ("before", "middle", "after")])

    def hits(side: DataFrame, first: bool) -> DataFrame:
        printed = with_fingerprints(read, how, short, False)
        if first:
            printed = printed.withColumn("prints", F.expr(f"if(base = 0, concat(prints, {own_row}), prints)"))
        # Outer, as the filter that Spark derives from an inner one would compute the hashes once more for each use.
        d = printed.select(*own, "base", "words", F.explode_outer("prints").alias("print")).selectExpr(*own, "base", "words", HASH, PLACE)
        # Only the surroundings leave the join, never all words of a text.
        near = d.join(side.withColumnRenamed("h", "ih").alias("i"), F.expr("h = ih")).select(
            *own, "base", "at", "cid", "need", "n", F.expr(f"at = {OWN} AND n = 0").alias("itself"), F.col("i.before").alias("ib"),
            F.col("i.middle").alias("im"), F.col("i.after").alias("ia"),
            *[F.expr(f"if(at = {OWN}, NULL, {x})").alias(c) for x, c in ((before, "b"), (middle, "m"), (after, "a"))])
        same = "transform(zip_with({0}, {1}, (x, y) -> x = y), e -> coalesce(e, false))"
        for mine, theirs, c in (("b", "ib", "lead"), ("a", "ia", "trail")):
            near = near.withColumn(c, F.expr(f"array_position({same.format(mine, theirs)}, false)"))
            near = near.withColumn(c, F.expr(f"if({c} = 0, size({theirs}), {c} - 1)"))
        hit = near.withColumn("hit", F.expr(f"coalesce(at < {OWN} AND m = im AND lead + n + trail >= need, false)"))
        # Misses stay as nulls: a filter here would move below the columns it reads and compute them again.
        return hit.select(
            *own, "itself", F.expr("if(hit, cid, NULL)").alias("cid"),
            F.expr("if(hit, struct(base + at - lead AS start, base + at + n + trail AS end), NULL)").alias("run"))

    first, *others = parts_of(table.drop("item").distinct(), F.expr(CONTEXT_BYTES), limit) or [(table.drop("item"), True)]
    sides = [(first[0].unionByName(meets), first[1]), *others]
    found = reduce(DataFrame.unionByName, [hits(F.broadcast(t) if fits else t, k == 0) for k, (t, fits) in enumerate(sides)])
    merged = stored(
        found.groupBy(*own).agg(
            F.count_if("itself").alias("copies"), F.collect_set("run").alias("runs"), F.collect_set("cid").alias("cids"),
        ).withColumn("hit", F.expr("sort_array(array_distinct(flatten(transform(runs, r -> sequence(r.start, r.end - 1)))))"))
        .withColumn("starts", F.expr("filter(hit, (x, i) -> coalesce(get(hit, i - 1) < x - 1, true))"))
        .withColumn("ends", F.expr("filter(hit, (x, i) -> coalesce(get(hit, i + 1) > x + 1, true))"))
        .select(*own, "copies", F.expr("zip_with(starts, ends, (a, b) -> struct(a AS start, b + 1 AS end))").alias("spans"), "cids"),
        "spans")
    clean = merged.where("size(cids) = 0").withColumn("items", F.array().cast("array<string>"))
    listed = table.select("cid", "item").distinct()
    exploded = merged.where("size(cids) > 0").select(*own, "copies", "spans", F.explode("cids").alias("cid"))
    named = [
        exploded.join(F.broadcast(t) if fits else t, "cid")
        for t, fits in parts_of(listed, F.expr("256 + coalesce(octet_length(item), 0)"), limit)]
    # Equal rows agree in spans, so these may be part of the key.
    whole = [clean.drop("cids")]
    if named:
        whole.append(reduce(DataFrame.unionByName, named).groupBy(*own, "copies", "spans").agg(
            F.array_sort(F.collect_set("item")).alias("items")))
    every = reduce(DataFrame.unionByName, whole)
    return every.select("doc_id", "n_words", "spans", "items", F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("copy")).drop("copy")


def contamination(docs: DataFrame, items: DataFrame, how: Winnowing = Winnowing(), **columns) -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, items_sha256, contaminated`` and the ``spans`` of every document."""
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return shared_spans(docs, items, how, **columns).select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


def sql(window: int = 10) -> str:
    """The contract in SQL, by an explicit join of all windows."""
    words = lambda t: f"regexp_extract_all(translate({t}, '{UPPER}', '{LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
    return f"""
WITH d AS (SELECT doc_id, row_number() OVER () AS k, coalesce({words('text')}, []) AS words FROM documents),
i AS (SELECT cast(item_id AS varchar) AS item, coalesce({words('text')}, []) AS words FROM benchmark),
lengths AS (SELECT DISTINCT least(len(words), {window}) AS n FROM i WHERE len(words) > 0),
own AS (SELECT item, words, least(len(words), {window}) AS n FROM i WHERE len(words) > 0),
asked AS (SELECT DISTINCT item, n, array_to_string(words[p:p + n - 1], ' ') AS shared
  FROM (SELECT item, words, n, unnest(range(1, len(words) - n + 2)) AS p FROM own)),
given AS (SELECT k, n, p, array_to_string(words[p:p + n - 1], ' ') AS shared
  FROM (SELECT k, words, n, unnest(range(1, len(words) - n + 2)) AS p FROM d, lengths WHERE len(words) >= n)),
hit AS (SELECT g.k, g.p, g.n, a.item FROM given g JOIN asked a ON g.n = a.n AND g.shared = a.shared),
places AS (SELECT k, count(DISTINCT q) AS n_hit FROM (SELECT k, unnest(range(p, p + n)) AS q FROM hit) GROUP BY k),
named AS (SELECT k, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT k, item FROM hit WHERE item IS NOT NULL) GROUP BY k)
SELECT d.doc_id, cast(len(words) AS bigint) AS n_words, cast(coalesce(n_hit, 0) AS bigint) AS n_hit,
  cast(coalesce(n_items, 0) AS bigint) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN places USING (k) LEFT JOIN named USING (k)"""
