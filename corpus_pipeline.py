"""From raw documents to packed training sequences, in five stages.

Every stage takes ``(spark, docs, sf_dir)`` with the columns of ``documents`` and works on
all rows it gets; all but the last return those columns.

1. language: documents without a letter, or near no learned language, go.
2. quality: documents that fail the base rules or are depleted of own lines go.
3. near_duplicates: one document of each group (five words, similarity 0.8) stays.
4. personal_data: spans are replaced by their kind; ``n_chars`` follows the text.
5. packing: documents become pieces placed in sequences of 4096 tokens.

Rows with null text go with the first stage. Repeated rows with one id count as copies, one stays;
rows without id can't be grouped and stay. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.llm import grouping_pack, hd_language, line_quality, oph_dedup, pii_labelers
from pairloom.llm.common import learning_row, read_table, small, stored
from pairloom.llm.queries import tokenizer_file

# A document whose best cosine is below this resembles no learned language.
LEAST_LANGUAGE_SCORE = 0.02
# Groups of copies are the next stage's work: it keeps one of each, so none may be rejected here.
SPARING_COPIES = line_quality.LineLimits(ends=2, copies=0.5)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = hd_language.fit(docs, learning_row(F.col("doc_id")))
    marked = hd_language.annotate(docs, model)
    good = marked.where((F.col("lang_pred") != hd_language.UNDETERMINED) & (F.col("score") >= LEAST_LANGUAGE_SCORE))
    return good.select(*[F.col("row")[c].alias(c) for c in docs.columns])


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # The whole row travels as the id, so no join brings the text back.
    rows = docs.select(F.struct(*docs.columns).alias("row"), "text", "source")
    good = line_quality.quality(rows, SPARING_COPIES, id_column="row").where("kept")
    return good.select(*[F.col("doc_id")[c].alias(c) for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = stored(oph_dedup.near_duplicates(docs).select("doc_id", "kept"), "groups")
    gone = found.where(~F.col("kept")).select("doc_id")
    left = docs.join(small(gone, gone.count(), 16), "doc_id", "left_anti")
    # Repeated rows of one id: rare, so only these are gathered by id.
    again = stored(found.where("kept and doc_id is not null").groupBy("doc_id").count().where("count > 1").select("doc_id"), "repeated")
    n = again.count()
    if not n:
        return left
    single = left.join(small(again, n, 16), "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return left.join(small(again, n, 16), "doc_id", "left_anti").unionByName(single)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    masked = pii_labelers.mask(docs)
    if "n_chars" not in docs.columns:
        return masked
    kind = docs.schema["n_chars"].dataType
    return masked.withColumn("n_chars", F.length("text").cast(kind)).select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return grouping_pack.pack_documents(docs, tokenizer_file("word_bpe_49k.json"))


STAGES = [
    ("language", language),
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("packing", packing),
]

# No SQL: language prototypes and tokenization can't be expressed in it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is stored before the next stage reads it."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
