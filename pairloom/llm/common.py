"""What the operators share: reading tables, scratch tables, checked broadcasts."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.plans.scratch import new_run_dir, write_table
from pairloom.plans.session import settings

# A side is broadcast only if it was counted and is below this many bytes.
BROADCAST_BYTES = 16 << 20
# Whole texts that go to a Python worker at once. Spark's own number, 10,000, makes batches of tens of megabytes, which
# each task holds in the JVM (twice, while a buffer grows) and in its worker.
TEXTS_AT_ONCE = 500
ROWS_AT_ONCE = "spark.sql.execution.arrow.maxRecordsPerBatch"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` in the shared scratch folder and return it as read back."""
    return write_table(df, new_run_dir(df.sparkSession, f"llm-{purpose}"))


def stored_by_texts(df: DataFrame, purpose: str) -> DataFrame:
    """``stored``, with few rows in an Arrow batch while it is written: for operators over whole texts."""
    spark = df.sparkSession
    now = int(spark.conf.get(ROWS_AT_ONCE))
    with settings(spark, {ROWS_AT_ONCE: str(min(now, TEXTS_AT_ONCE) if now > 0 else TEXTS_AT_ONCE)}):
        return stored(df, purpose)


def small(df: DataFrame, rows: int, row_bytes: int, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast if ``rows`` rows of at most ``row_bytes`` fit the limit; else leave the join to Spark."""
    return F.broadcast(df) if rows * row_bytes <= limit else df


def words_of(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` as an array; null or blank text has none."""
    bare = F.btrim(text, F.lit(" \t\n\x0b\f\r"))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, "[ \\t-\\r]+"))


def texts(column: pa.Array) -> list[str]:
    """Python strings of an Arrow column, null as the empty string."""
    return ["" if t is None else t for t in column.to_pylist()]


def unsigned(x: Column) -> Column:
    """A long taken as one of 63 bits."""
    return x.bitwiseAND(F.lit((1 << 63) - 1))


def learning_row(doc_id: Column) -> Column:
    """True for documents that models may learn from: crc32 of the id's text mod 5 is not 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 != 0, F.lit(False))
