"""Labelled sparse examples: labels, shards, long and wide form, preview.

Wide form: ``example_id long, label double, indices array<int>, values
array<double>`` with 1-based, ascending indices. Long form has one row per
non-zero: ``example_id, label, j, x``.
"""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def positive(label: Column) -> Column:
    return label > F.lit(0.0)


def binarise_label(examples: DataFrame) -> DataFrame:
    """Labels above zero become 1.0, all others 0.0."""
    label = F.when(positive(F.col("label")), F.lit(1.0)).otherwise(F.lit(0.0))
    return examples.withColumn("label", label)


def shard_column(num_shards: int, method: str = "modulo") -> Column:
    """Shard number of an example: by id, or by a hash for ids with a pattern."""
    key = F.col("example_id")
    if method == "hash":
        key = F.xxhash64(key)
    elif method != "modulo":
        raise ValueError(f"unknown shard method {method!r}")
    return F.pmod(key, F.lit(num_shards).cast("long")).cast("int")


def default_slots(spark: SparkSession, num_shards: int) -> int:
    """Number of slots: enough for all cores, at most one per shard."""
    cores = spark.sparkContext.defaultParallelism
    sized = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(1, min(num_shards, max(cores, sized)))


def slot_labels(spark: SparkSession, slots: int) -> list[int]:
    """One label per slot, chosen so that hash partitioning spreads them evenly.

    Plain numbers 0..n-1 would collide in some partitions and leave others
    empty. Only balance depends on this, never a result.
    """
    label = F.col("id").cast("int")
    part = F.pmod(F.hash(label), F.lit(slots)).alias("part")
    found = spark.range(64 * slots).groupBy(part).agg(F.min(label).alias("label")).collect()
    labels = [row["label"] for row in found]
    return labels if len(labels) == slots else list(range(slots))


def shard_weights(examples: DataFrame, num_shards: int, method: str = "modulo") -> list[int]:
    """Non-zeros (and one for the bias) per shard: ``num_shards`` numbers."""
    sizes = examples.groupBy(shard_column(num_shards, method).alias("shard")).agg(F.sum(F.size("indices") + F.lit(1)))
    weights = [0] * num_shards
    for shard, n in sizes.collect():
        weights[shard] = n
    return weights


def fill_slots(weights: list[int], slots: int) -> list[int]:
    """The slot of each shard: the heaviest shard first, each to the slot with the least so far."""
    heap = [(0, s) for s in range(slots)]
    placed = [0] * len(weights)
    for shard in sorted(range(len(weights)), key=lambda i: (-weights[i], i)):
        load, slot = heapq.heappop(heap)
        placed[shard] = slot
        heapq.heappush(heap, (load + weights[shard], slot))
    return placed


def assign_shard(
    examples: DataFrame, num_shards: int, slots: int | None = None, method: str = "modulo",
    weights: list[int] | None = None,
) -> DataFrame:
    """Add ``shard`` and ``slot`` and place every slot whole in one partition.

    The shard is the unit of local training and part of the model. A slot is
    a set of whole shards that one task handles; it says where rows are, and
    its number changes no result. With ``weights`` (see ``shard_weights``) the slots are filled evenly by
    weight, otherwise by shard numbers in turn.
    """
    spark = examples.sparkSession
    n = slots or default_slots(spark, num_shards)
    labels = sorted(slot_labels(spark, n))
    of_shard = fill_slots(weights, n) if weights is not None else [shard % n for shard in range(num_shards)]
    label_of = F.split(F.lit(",".join(str(labels[slot]) for slot in of_shard)), ",").cast("array<int>")
    placed = examples.withColumn("shard", shard_column(num_shards, method))
    return placed.withColumn("slot", F.get(label_of, F.col("shard"))).repartition(n, "slot")


def spread_for_scoring(examples: DataFrame, tasks: int, drop: tuple[str, ...] = ("shard", "step", "shard_rows")) -> DataFrame:
    """Place rows by a hash of id and split over ``tasks`` slots of their own, whatever their shards."""
    labels = ",".join(map(str, sorted(slot_labels(examples.sparkSession, tasks))))
    key = [c for c in ("split", "example_id") if c in examples.columns]
    slot = F.get(F.split(F.lit(labels), ",").cast("array<int>"), F.pmod(F.xxhash64(*key), F.lit(tasks)).cast("int"))
    return examples.drop(*drop).withColumn("slot", slot).repartition(tasks, "slot")


def number_steps(sharded: DataFrame) -> DataFrame:
    """Add ``step``, the position of a row in its shard (and split) in the order of ids."""
    within = [c for c in ("slot", "shard", "split") if c in sharded.columns]
    in_shard = Window.partitionBy(*within).orderBy("example_id")
    return sharded.withColumn("step", F.row_number().over(in_shard)).sortWithinPartitions("slot", "step", "shard")


def with_shard_rows(stepped: DataFrame) -> DataFrame:
    """Add ``shard_rows``, the rows of a shard (and split): its highest step."""
    within = [c for c in ("slot", "shard", "split") if c in stepped.columns]
    rows = stepped.groupBy(*within).agg(F.max("step").alias("shard_rows"))
    # One row per shard.
    return stepped.join(F.broadcast(rows), within)


def to_long(examples: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """One row per non-zero: the kept columns, ``j`` and ``x``."""
    keep = keep if keep is not None else ["example_id", "label"]
    return examples.select(*keep, F.inline(F.arrays_zip("indices", "values"))).withColumnsRenamed(
        {"indices": "j", "values": "x"}
    )


def to_wide(long: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Long form back to one row per example; an example without rows is lost."""
    keep = keep if keep is not None else ["example_id", "label"]
    pairs = F.sort_array(F.collect_list(F.struct("j", "x")))
    return (
        long.groupBy(*keep)
        .agg(pairs.alias("pairs"))
        .select(
            *keep,
            F.col("pairs.j").cast("array<int>").alias("indices"),
            F.col("pairs.x").cast("array<double>").alias("values"),
        )
    )


def from_vectors(rows: DataFrame, features: str = "features") -> DataFrame:
    """Replace a column of vectors, sparse or dense, by ``indices`` (from 1) and ``values``; zeros are dropped.

    The vectors' own storage is read as a struct, without a Python worker.
    """
    rest = [c for c in rows.columns if c != features]
    stored = rows.select(*rest, F.unwrap_udt(features).alias("vector"))
    # Dense vectors have no index array.
    numbered = stored.select(*rest, F.expr(
        "CASE WHEN vector.type = 0 THEN transform(vector.indices, i -> i + 1) "
        "WHEN size(vector.values) = 0 THEN array() ELSE sequence(1, size(vector.values)) END").alias("j"),
        F.col("vector.values").alias("x"))
    pairs = numbered.select(*rest, F.filter(F.arrays_zip("j", "x"), lambda p: p.x != F.lit(0.0)).alias("pairs"))
    return pairs.select(*rest, F.col("pairs.j").alias("indices"), F.col("pairs.x").alias("values"))


def wide_form(rows: DataFrame) -> DataFrame:
    """Wide examples as they are; rows with a vector column ``features`` instead of ``indices`` are converted."""
    return from_vectors(rows) if "features" in rows.columns and "indices" not in rows.columns else rows


def split_examples(examples: DataFrame, every: int = 5) -> DataFrame:
    """Add ``split``: each ``every``-th id is ``valid``, the rest ``train``."""
    is_valid = F.pmod(F.col("example_id"), F.lit(every)) == 0
    return examples.withColumn("split", F.when(is_valid, F.lit("valid")).otherwise(F.lit("train")))


def preview(df: DataFrame, n: int = 3) -> DataFrame:
    """The first ``n`` rows by id."""
    return df.orderBy("example_id").limit(n)
