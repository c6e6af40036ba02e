"""Registered queries: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.llm import (
    batch_bpe, block_search, displacement_fim, grouping_pack, hash_forest, hd_language, kd_shards, line_quality, oph_dedup,
    pii_labelers, token_counts, toxic_segments, winnowing,
)
from pairloom.llm.common import read_table


def tokenizer_file(name: str) -> str:
    """Where a public vocabulary file lies."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_words, n_tokens, n_unknown."""
    return token_counts.count_tokens(read_table(spark, sf_dir, "documents"), tokenizer_file("piece_bpe_32k.model"))


def op2_hash_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hash_forest.nearest(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op3_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_quality.quality(read_table(spark, sf_dir, "documents"))


def op4_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = kd_shards.kd_shards(read_table(spark, sf_dir, "documents"), shards=16)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def op5_hd_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hd_language.identify(read_table(spark, sf_dir, "documents"))


def op6_toxic_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = toxic_segments.fit(docs, read_table(spark, sf_dir, "labels"))
    return toxic_segments.score(docs, model)


def op7_pii_labelers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_labelers.personal_data(read_table(spark, sf_dir, "documents"))


def op8_oph_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    how = oph_dedup.NearDuplicates(width=3, percent=85, bands=40, rows=8)
    return oph_dedup.near_duplicates(read_table(spark, sf_dir, "documents"), how)


def op9_grouping_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grouping_pack.pack_documents(read_table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"))


def op10_batch_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batch_bpe.encode_digests(read_table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"))


def op11_block_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return block_search.search(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op12_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnowing.contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op13_displacement_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return displacement_fim.digests(read_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_counts": op1_token_counts,
    "op2_hash_forest": op2_hash_forest,
    "op3_line_quality": op3_line_quality,
    "op4_kd_shards": op4_kd_shards,
    "op5_hd_language": op5_hd_language,
    "op6_toxic_segments": op6_toxic_segments,
    "op7_pii_labelers": op7_pii_labelers,
    "op8_oph_dedup": op8_oph_dedup,
    "op9_grouping_pack": op9_grouping_pack,
    "op10_batch_bpe": op10_batch_bpe,
    "op11_block_search": op11_block_search,
    "op12_winnowing": op12_winnowing,
    "op13_displacement_fim": op13_displacement_fim,
}
ORACLE_SQL: dict[str, str] = {
    "op3_line_quality": line_quality.sql(),
    "op11_block_search": block_search.sql(),
    "op12_winnowing": winnowing.sql(),
    "op13_displacement_fim": displacement_fim.sql(),
}
