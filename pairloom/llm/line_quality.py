"""Quality rules from a document's own counts and from lines its host repeats.

Base rules: a document fails with fewer than 50 words, or if more than half of
its words lie in three-word windows that occur twice or more in it.

Line frequency: lines are normalised (trimmed, lower case, runs of white space
as one space, digit runs as 0) and hashed. Per host and line the distinct
documents are counted; documents with the same set of lines are copies and count
as one. A line is boilerplate if its count is above ``min_documents`` and above
``share`` of the host's distinct documents. Lines above the limits are removed; a
document is depleted, and rejected, if fewer than ``left`` of its words remain.

Two settings, off by default, spare groups of copies where deduplication follows.
With ``ends``, documents whose ``ends`` smallest and largest line hashes agree count
as one. With ``copies``, a line stays if one such set makes up more than this share
of its occurrences; pages with hardly a line of their own then count as copies too.

All of it is DataFrame expressions. A row's windows are packed as (hash, position)
in one long each and sorted inside the row, so no word is shuffled. Line counts
are pre-aggregated per host and line, so neither a hot host nor a hot line is a
hot task. A host has at most (mean distinct lines) / ``share`` boilerplate lines, so
they fit one array per host.

Null text has no words, no lines and fails. A null host is a host of its own.
Each input row gives one output row, also for repeated rows and null ids; columns
other than id, text and host aren't read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.llm.common import small, stored, words_of

BLANKS = " \t\n\x0b\f\r"
SYMBOLS = "[#*$%&|<>]+"


@dataclass(frozen=True)
class LineLimits:
    min_documents: int = 20
    share: float = 0.01
    left: float = 0.5
    ends: int | None = None
    copies: float | None = None


def normal(line: Column) -> Column:
    """Trimmed, in lower case, runs of white space as one space."""
    return F.regexp_replace(F.lower(F.btrim(line, F.lit(BLANKS))), "[ \\t-\\r]+", " ")


def line_hash(normal_line: Column) -> Column:
    """60 bits of the md5 of a normalised line, digit runs as 0."""
    return F.conv(F.substring(F.md5(F.regexp_replace(normal_line, "[0-9]+", "0")), 1, 15), 16, 10).cast("long")


def hashed_lines(lines: Column) -> Column:
    """Hash and number of words of every line."""
    n = lambda x: F.length(x) - F.length(F.replace(x, F.lit(" "), F.lit(""))) + 1
    return F.transform(F.transform(lines, normal), lambda x: F.struct(line_hash(x).alias("h"), n(x).alias("n")))


def lines_of(text: Column) -> Column:
    """Lines with a word."""
    return F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(BLANKS)) != "")


def boilerplate(docs: DataFrame, limits: LineLimits) -> DataFrame:
    """``host, frequent`` (array of line hashes) of a table with ``host, lines`` (array of structs with hash ``h``)."""
    lines = docs.where("size(lines) > 0").select("host", F.array_sort(F.array_distinct("lines.h")).alias("lines"))
    told_by = ("lines",) if limits.ends is None else (
        F.slice("lines", 1, limits.ends), F.slice(F.reverse("lines"), 1, limits.ends))
    sketched = lines.withColumn("sketch", F.xxhash64(*told_by))
    documents = sketched.groupBy("host", "sketch").count().groupBy("host").agg(F.count("*").alias("documents"))
    counted = (
        sketched.select("host", "sketch", F.explode("lines").alias("line"))
        .groupBy("host", "line", "sketch").count()
        .groupBy("host", "line").agg(F.count("*").alias("n"), F.max("count").alias("most"), F.sum("count").alias("all")))
    # Cheap limit first: the join sees few lines.
    often = counted.where(F.col("n") > limits.min_documents)
    if limits.copies is not None:
        often = often.where(F.col("most") <= limits.copies * F.col("all"))
    return often.join(documents, "host").where(F.col("n") > limits.share * F.col("documents")).groupBy("host").agg(
        F.sort_array(F.collect_list("line")).alias("frequent"))


def base_counts(docs: DataFrame) -> DataFrame:
    """Add ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, lines`` to a table with ``text`` (not null)."""
    text = F.col("text")
    split = docs.withColumn("words", words_of(text)).withColumn("lines", lines_of(text))
    n = F.size("words")
    # Windows as (hash << bits | position), positions needing `bits` bits.
    bits = F.greatest(F.lit(1), F.ceil(F.log2(n + 1))).cast("int")
    window = F.expr(
        "transform(sequence(0, n_words - 3), i -> shiftleft(xxhash64(words[i], words[i + 1], words[i + 2]), bits) | i)")
    counted = split.select(
        *docs.columns, "words", "lines", n.alias("n_words"), bits.alias("bits"),
        F.length(F.regexp_replace(text, "[ \\t-\\r]+", "")).alias("word_chars"),
        (F.length(text) - F.length(F.regexp_replace(text, SYMBOLS, ""))).alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).alias("n_dup_lines"))
    windows = counted.select(
        *[c for c in counted.columns if c != "words"],
        F.sort_array(F.when(F.col("n_words") < 3, F.array().cast("array<bigint>")).otherwise(window)).alias("sorted"))
    # Windows next to an equal hash, as positions; a covered stretch counts its words once.
    repeated = F.expr(
        "filter(sorted, (x, k) -> shiftright(x, bits) <=> shiftright(get(sorted, k - 1), bits)"
        " or shiftright(x, bits) <=> shiftright(get(sorted, k + 1), bits))")
    places = windows.withColumn("repeated", repeated).withColumn(
        "places", F.expr("sort_array(transform(repeated, x -> x & (shiftleft(1L, bits) - 1)))"))
    covered = F.expr(
        "aggregate(places, named_struct('n', 0L, 'last', -3L), (a, p) -> named_struct('n', a.n + least(3L, p - a.last), 'last', p), a -> a.n)")
    return places.withColumn("n_repeat_words", covered).drop("sorted", "bits", "repeated", "places")


def frequent_of(docs: DataFrame, limits: LineLimits) -> DataFrame:
    """Boilerplate per host, stored, with a broadcast hint if it is small."""
    frequent = stored(boilerplate(docs, limits), "boilerplate")
    size = frequent.agg(F.count("*"), F.max(F.size("frequent")), F.max(F.octet_length("host"))).first()
    return small(frequent, size[0], 64 + 8 * (size[1] or 0) + (size[2] or 0))


def quality(
    docs: DataFrame, limits: LineLimits = LineLimits(), text: str = "text", id_column: str = "doc_id", host: str = "source",
) -> DataFrame:
    """``doc_id``, base counts, ``base_failed``, ``kept``, ``n_removed_lines``, ``n_left_words`` of every row."""
    source = docs.select(
        F.col(id_column).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"),
        F.coalesce(F.concat(F.lit("="), F.col(host).cast("string")), F.lit("")).alias("host"))
    # Read once: counts and line hashes are stored, and a later filter can't copy the window expressions.
    counted = stored(base_counts(source).select(
        "doc_id", "host", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        hashed_lines(F.col("lines")).alias("lines")), "lines")
    joined = counted.join(frequent_of(counted, limits), "host", "left").withColumn(
        "removed", F.expr("filter(lines, x -> array_contains(coalesce(frequent, array()), x.h))"))
    left = F.col("n_words") - F.expr("aggregate(removed, 0L, (a, x) -> a + x.n)")
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return joined.select(
        "doc_id", *[F.col(c).cast("long").alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
        failed.alias("base_failed"),
        (~failed & (left >= limits.left * F.col("n_words"))).alias("kept"),
        F.size("removed").cast("long").alias("n_removed_lines"), left.cast("long").alias("n_left_words"))


def clean_text(
    docs: DataFrame, limits: LineLimits = LineLimits(), text: str = "text", host: str = "source",
) -> DataFrame:
    """``docs`` with lines above the limits removed from the text; null text stays null."""
    keyed = docs.withColumn("_host", F.coalesce(F.concat(F.lit("="), F.col(host).cast("string")), F.lit("")))
    hashed = stored(keyed.select(F.col("_host").alias("host"), hashed_lines(
        lines_of(F.coalesce(F.col(text), F.lit("")))).alias("lines")), "lines")
    frequent = frequent_of(hashed, limits).select(F.col("host").alias("_host"), F.col("frequent").alias("_frequent"))
    joined = keyed.join(frequent, "_host", "left")
    none = F.array().cast("array<bigint>")
    kept = F.filter(F.split(F.col(text), "\n"), lambda x: ~F.array_contains(F.coalesce("_frequent", none), line_hash(normal(x))))
    return joined.withColumn(text, F.array_join(kept, "\n")).select(*docs.columns)


SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text, coalesce('=' || source, '') AS host FROM documents),
lines AS (
  SELECT rid, host, line, ('0x' || substr(md5(regexp_replace(regexp_replace(lower(trim(line, E' \t\n\x0B\f\r')),
    '[ \t-\r]+', ' ', 'g'), '[0-9]+', '0', 'g')), 1, 15))::BIGINT AS h,
    len(regexp_extract_all(line, '[^ \t-\r]+')) AS n
  FROM (SELECT rid, host, unnest(string_split(text, E'\n')) AS line FROM docs)
  WHERE regexp_matches(line, '[^ \t-\r]')),
pairs AS (SELECT DISTINCT rid, host, h FROM lines),
sketches AS (SELECT rid, host, {sketch} AS sketch FROM pairs GROUP BY ALL),
hosts AS (SELECT host, count(DISTINCT sketch) AS documents FROM sketches GROUP BY host),
counted AS (
  SELECT host, h, count(*) AS n, max(c) AS most, sum(c) AS occurrences FROM (
    SELECT p.host, h, sketch, count(*) AS c FROM pairs p JOIN sketches USING (rid) GROUP BY ALL) GROUP BY ALL),
frequent AS (
  SELECT host, h FROM counted JOIN hosts USING (host)
  WHERE n > {min_documents} AND {spared} AND n > {share} * documents),
removed AS (SELECT rid, count(*) AS lines, sum(n) AS words FROM lines JOIN frequent USING (host, h) GROUP BY rid),
dup AS (SELECT rid, count(*) - count(DISTINCT line) AS n FROM lines GROUP BY rid),
words AS (SELECT rid, regexp_extract_all(text, '[^ \t-\r]+') AS w FROM docs),
windows AS (
  SELECT rid, i, [w[i], w[i + 1], w[i + 2]] AS win FROM (SELECT rid, w, unnest(range(1, len(w) - 1)) AS i FROM words)),
twice AS (SELECT rid, i FROM windows QUALIFY count(*) OVER (PARTITION BY rid, win) > 1),
covered AS (
  SELECT rid, count(DISTINCT i + k) AS n FROM twice, (VALUES (0), (1), (2)) AS t(k) GROUP BY rid),
counts AS (
  SELECT d.rid, doc_id, len(w)::BIGINT AS n_words, length(regexp_replace(text, '[ \t-\r]', '', 'g'))::BIGINT AS word_chars,
    len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols, coalesce(dup.n, 0)::BIGINT AS n_dup_lines,
    coalesce(covered.n, 0)::BIGINT AS n_repeat_words, coalesce(removed.lines, 0)::BIGINT AS n_removed_lines,
    (len(w) - coalesce(removed.words, 0))::BIGINT AS n_left_words
  FROM docs d JOIN words USING (rid) LEFT JOIN dup USING (rid) LEFT JOIN covered USING (rid) LEFT JOIN removed USING (rid))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND n_left_words >= {left} * n_words AS kept,
  n_removed_lines, n_left_words
FROM counts
"""


def sql(limits: LineLimits = LineLimits()) -> str:
    ends = f"[1:{limits.ends}]"
    sketch = "list_sort(list(h))" if limits.ends is None else f"[list_sort(list(h)){ends}, list_reverse_sort(list(h)){ends}]"
    spared = "true" if limits.copies is None else f"most <= {limits.copies} * occurrences"
    return SQL.format(
        min_documents=limits.min_documents, sketch=sketch, spared=spared, share=limits.share, left=limits.left)
