"""Indexed examples from the given tables, prepared once per session and folder."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.plans.scratch import new_run_dir, write_table
from pairloom.plans.session import settings
from pairloom.sources.vocabulary import (
    Vocabulary, build_vocabulary, chunk_words, field_rows, indexed_chunks, indexed_rows, text_chunks,
)

# Priorities that count as a positive order.
HIGH_PRIORITIES = ("1-URGENT", "2-HIGH")
# Labelled documents whose words one task counts.
SLOT_DOCUMENTS = 16384


@dataclass(frozen=True)
class Dataset:
    """Wide examples and the number of features."""

    examples: DataFrame
    n_features: int


_prepared: dict[tuple, Dataset] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def order_rows(spark: SparkSession, sf_dir: str, regression: bool = False) -> DataFrame:
    """Orders with their customer: four one-hot fields; label = high priority or price / 1e5."""
    orders, customer = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    joined = orders.join(customer, orders.o_custkey == customer.c_custkey)
    if regression:
        label = F.col("o_totalprice") / F.lit(100000.0)
    else:
        label = F.when(F.col("o_orderpriority").isin(*HIGH_PRIORITIES), 1.0).otherwise(0.0)
    fields = {
        "cust": F.col("c_custkey"),
        "nation": F.col("c_nationkey"),
        "seg": F.col("c_mktsegment"),
        "status": F.col("o_orderstatus"),
    }
    return field_rows(joined, F.col("o_orderkey"), label, fields)


def document_slots(spark: SparkSession, sf_dir: str) -> int:
    return max(spark.sparkContext.defaultParallelism, -(-table(spark, sf_dir, "labels").count() // SLOT_DOCUMENTS))


def document_rows(spark: SparkSession, sf_dir: str, slots: int) -> DataFrame:
    """Labelled documents: their words with counts, in slots; label = quality."""
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    joined = documents.join(labels, "doc_id")
    return text_chunks(joined, F.col("doc_id"), F.col("quality"), F.col("text"), slots)


def _prepare(
    key: tuple, spark: SparkSession, rows: Callable[[], DataFrame], tokens: Callable[[DataFrame], DataFrame],
    indexed: Callable[[DataFrame, Vocabulary], DataFrame],
) -> Dataset:
    if key not in _prepared:
        # The rows of tokens are stored, since numbering and indexing both need them.
        run = new_run_dir(spark, "examples")
        with settings(spark):
            stored = write_table(rows(), f"{run}/tokens")
            vocabulary = build_vocabulary(tokens(stored))
            examples = write_table(indexed(stored, vocabulary), f"{run}/examples")
        _prepared[key] = Dataset(examples, vocabulary.size)
    return _prepared[key]


def _field_tokens(stored: DataFrame) -> DataFrame:
    tokens = stored.select(F.explode("tokens.token").alias("token"))
    return tokens.where(F.col("token").isNotNull())


def _key(spark: SparkSession, sf_dir: str, name: str) -> tuple:
    return (spark.sparkContext.applicationId, sf_dir, name)


def order_examples(spark: SparkSession, sf_dir: str, regression: bool = False) -> Dataset:
    name = "order-prices" if regression else "orders"
    return _prepare(
        _key(spark, sf_dir, name), spark, lambda: order_rows(spark, sf_dir, regression), _field_tokens, indexed_rows)


def document_counts(spark: SparkSession, sf_dir: str) -> Dataset:
    """Documents with the number of occurrences as value."""
    key = _key(spark, sf_dir, "documents")
    if key in _prepared:
        return _prepared[key]
    slots = document_slots(spark, sf_dir)
    return _prepare(
        key, spark, lambda: document_rows(spark, sf_dir, slots), chunk_words,
        lambda stored, vocabulary: indexed_chunks(stored, vocabulary, slots))


def document_examples(spark: SparkSession, sf_dir: str) -> Dataset:
    """Documents one-hot: every word that occurs has the value 1."""
    counted = document_counts(spark, sf_dir)
    ones = F.array_repeat(F.lit(1.0), F.size("values"))
    return Dataset(counted.examples.withColumn("values", ones), counted.n_features)

