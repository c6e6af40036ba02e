"""libsvm text: ``label index:value index:value ...``, 1-based ascending indices.

The format has no ids, so an example is known by its position. Files are read in splits, whose number
depends on file sizes, settings and cores; positions must not, since they decide an example's shard and its turn in it. Each row
therefore carries its file, the start of its split and its place in the split; the counts of all splits, summed up in the
order of file and start, turn the place into the position among all examples.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pairloom.functions.text import libsvm_line
from pairloom.plans.scratch import new_run_dir, write_table

# Columns that say where a row was read; ``place`` ascends within a split.
ORIGIN = ("file", "block", "place")
BROADCAST_LIMIT_BYTES = 16 << 20


def has_example() -> Column:
    """Whether a line is neither blank nor a comment."""
    return F.col("value").rlike(r"^\s*[^\s#]")


def parse_libsvm(lines: DataFrame) -> DataFrame:
    """Wide examples from ``lines(example_id, value)``; other columns of ``lines`` stay.

    Blank lines and ``#`` lines are skipped. Zero values are dropped: they add
    nothing to a score and the one-hot check would reject them. A row whose
    items are not ``index:value`` with indices ascending from 1 raises an
    error when it is read, with ANSI mode on or off. The items of a line are split and cast as whole
    arrays, not one by one.
    """
    kept_columns = [c for c in lines.columns if c != "value"]
    read = (
        lines.where(has_example())
        .withColumn("line", F.trim(F.regexp_replace("value", r"\s+", " ")))
        .withColumn("first", F.substring_index("line", " ", 1))
        .withColumn("items", F.expr("substr(line, length(first) + 2)"))
        .selectExpr(
            *kept_columns, "line", "items", "try_cast(first AS double) AS label",
            "if(items = '', array(), split(regexp_replace(items, ':[^ ]*', ''), ' ')) AS index_text",
            "if(items = '', array(), split(regexp_replace(items, '[^ ]*:', ''), ' ')) AS value_text",
        )
        .selectExpr(
            *kept_columns, "line", "items", "label",
            "try_cast(index_text AS array<int>) AS given", "try_cast(value_text AS array<double>) AS numbers",
        )
    )
    ascending = F.expr(
        "coalesce(given = sort_array(array_distinct(given)) AND coalesce(get(given, 0), 1) >= 1"
        " AND size(given) = length(items) - length(replace(items, ':', ''))"
        " AND NOT exists(given, i -> i IS NULL) AND NOT exists(numbers, x -> x IS NULL) AND label IS NOT NULL, false)"
    )
    message = F.concat(F.lit("not index:value with indices ascending from 1: "), F.col("line"))
    has_zero = F.expr("array_contains(numbers, 0D)")
    kept = F.filter(F.arrays_zip("given", "numbers"), lambda p: p.numbers != F.lit(0.0))
    return read.select(
        *kept_columns,
        F.when(F.col("label").isNull(), F.raise_error(message).cast("double")).otherwise(F.col("label")).alias("label"),
        F.when(~ascending, F.raise_error(message).cast("array<int>"))
        .when(has_zero, kept["given"])
        .otherwise(F.col("given"))
        .alias("indices"),
        F.when(has_zero, kept["numbers"]).otherwise(F.col("numbers")).alias("values"),
    )


def split_starts(placed: DataFrame) -> DataFrame:
    """``file, block, shift``: what turns a row's ``place`` into its position among all rows.

    One row per split is aggregated. Splits are summed up within their file and files among each other, so only
    one row per file is ever in one task.
    """
    splits = placed.groupBy("file", "block").agg(F.count("*").alias("n"), F.min("place").alias("first"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    in_file = splits.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    files_before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    files = splits.groupBy("file").agg(F.sum("n").alias("n")).select(
        "file", F.coalesce(F.sum("n").over(files_before), F.lit(0)).alias("skipped"))
    shift = (F.col("skipped") + F.col("before") - F.col("first")).alias("shift")
    return in_file.join(files, "file").select("file", "block", shift)


def number_rows(placed: DataFrame, limit_bytes: int = BROADCAST_LIMIT_BYTES) -> DataFrame:
    """Replace the ``ORIGIN`` columns of a stored table by ``example_id``, the row's position in order of file and line.

    The table must be stored, as a second read could be split otherwise.
    """
    starts = write_table(split_starts(placed), new_run_dir(placed.sparkSession, "splits"))
    n, longest = starts.agg(F.count("*"), F.max(F.octet_length("file"))).first()
    if n * ((longest or 0) + 64) <= limit_bytes:
        starts = F.broadcast(starts)
    rest = [c for c in placed.columns if c not in ORIGIN]
    return placed.join(starts, ["file", "block"]).select((F.col("place") + F.col("shift")).alias("example_id"), *rest)


def read_libsvm(spark: SparkSession, path: str) -> DataFrame:
    """Read libsvm text as wide examples; labels pass through unchanged.

    ``example_id`` is the position of the example, from 0, in the order of file names and lines; blank lines and
    comments don't count. It is the same however the files are split. The text is parsed once, into a table.
    """
    lines = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))
    placed = lines.where(has_example()).withColumn("place", F.monotonically_increasing_id())
    return number_rows(write_table(parse_libsvm(placed), new_run_dir(spark, "libsvm-rows")))


def libsvm_lines(examples: DataFrame) -> DataFrame:
    return examples.select("example_id", libsvm_line(F.col("label"), F.col("indices"), F.col("values")).alias("value"))


def write_libsvm(examples: DataFrame, path: str) -> None:
    libsvm_lines(examples).select("value").write.mode("overwrite").text(path)
