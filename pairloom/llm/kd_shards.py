"""Shards from a k-d tree over metadata.

The tree splits a node along its widest dimension (range divided by the whole
range) at a weighted median, so that both sides get bytes in proportion to the
leaves they will hold, until every leaf holds about the target bytes. All nodes
of a level are split at once. A weighted median is found in passes: weights
are summed into bins per node, the bin with the median is opened into finer bins,
until it holds one value; documents of one value, such as a hot source, are
divided by a hash of the id in the same way. A pass shuffles at most nodes * BINS
sums. The tree, at most one cut per shard, is all that the driver holds.

Slots number a shard's documents without gaps: each shard is numbered in
blocks by a hash of the id, offset by the sizes of earlier blocks.

Null metadata is the smallest value; null text has no bytes and weighs 1. Equal
rows, and rows without id, tie in every coordinate and share a side; each keeps
its row. An empty table gives no rows. Columns other than id, text and the
dimensions aren't read.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import ceil

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pairloom.llm.common import stored

BINS = 1024
BLOCKS = 64
# Exact integers of a double.
TIE_RANGE = 1 << 52


def coordinate(kind: str, x: Column) -> Column:
    """A metadata column as a double: numbers as they are, text by its first six bytes."""
    if kind == "string":
        return F.coalesce(F.conv(F.rpad(F.hex(F.substring(x.cast("binary"), 1, 6)), 12, "0"), 16, 10).cast("double"), F.lit(-1.0))
    return F.coalesce(x.cast("double"), F.lit(-1.0))


@dataclass(frozen=True)
class Cut:
    """The value in which a node's wanted weight is reached, the weight before it, and what it holds."""

    value: float
    start: float
    weight: float
    documents: int


def weighted_cuts(rows: DataFrame, bounds: dict[int, tuple[float, float, float]]) -> dict[int, Cut]:
    """Exact weighted quantiles of many nodes at once.

    ``rows``: ``node, x, weight``. ``bounds``: per node its smallest and largest ``x`` and
    the wanted weight. One job per pass; a node ends when its bin holds one value.
    """
    spark = rows.sparkSession
    cuts: dict[int, Cut] = {}
    # node -> (low, high, weight below low, wanted weight)
    open_ = {n: (low, high, 0.0, wanted) for n, (low, high, wanted) in bounds.items()}
    while open_:
        ranges = F.broadcast(spark.createDataFrame(
            [(n, a, b, w - below) for n, (a, b, below, w) in open_.items()],
            "node long, low double, high double, wanted double"))
        width = F.greatest((F.col("high") - F.col("low")) / BINS, F.lit(1e-300))
        bin_ = F.least(F.floor((F.col("x") - F.col("low")) / width), F.lit(BINS - 1))
        sums = (
            rows.join(ranges, "node").where((F.col("x") >= F.col("low")) & (F.col("x") <= F.col("high")))
            .groupBy("node", "wanted", bin_.alias("bin"))
            .agg(F.sum("weight").alias("w"), F.count("*").alias("n"), F.min("x").alias("low"), F.max("x").alias("high")))
        upto = F.sum("w").over(Window.partitionBy("node").orderBy("bin"))
        reached = sums.withColumn("upto", upto).where(F.col("upto") - F.col("w") < F.col("wanted"))
        hit = reached.groupBy("node").agg(F.max(F.struct("bin", "low", "high", "w", "n", "upto")).alias("b"))
        for node, b in hit.collect():
            _, _, below, wanted = open_[node]
            start = below + b["upto"] - b["w"]
            if b["low"] == b["high"]:
                cuts[node] = Cut(b["low"], start, b["w"], b["n"])
                del open_[node]
            else:
                open_[node] = (b["low"], b["high"], start, wanted)
    return cuts


def nearest(cut: Cut, wanted: float) -> float:
    """The cut's value if its end is the nearer side of the wanted weight, else just before it."""
    ahead = cut.start + cut.weight - wanted <= wanted - cut.start
    return cut.value if ahead else float(np.nextafter(cut.value, -np.inf))


def kd_shards(
    docs: DataFrame, dimensions: tuple[str, ...] = ("source", "lang", "doc_id"), shards: int | None = None,
    target_bytes: int = 256 << 20, text: str = "text", id_column: str = "doc_id",
) -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot``; ``shards`` leaves, or as many as ``target_bytes`` needs."""
    kinds = dict(docs.dtypes)
    raw = F.coalesce(F.col(text), F.lit(""))
    rows = stored(docs.select(
        F.col(id_column).cast("long").alias("doc_id"), (F.octet_length(raw) + 1).cast("long").alias("size"),
        F.crc32(raw.cast("binary")).alias("text_crc32"),
        # Equal texts follow each other where all coordinates tie.
        *[coordinate(kinds[c], F.col(c)).alias(f"x{i}") for i, c in enumerate(dimensions)],
        ((F.xxhash64(raw).bitwiseAND(F.lit((1 << 26) - 1)) * F.lit(1 << 26)) + F.xxhash64(id_column).bitwiseAND(F.lit((1 << 26) - 1))).cast("double").alias("tie"),
        F.lit(0).cast("long").alias("node")), "shards")
    axes = range(len(dimensions))
    spread = [F.struct(F.min(f"x{i}").alias("a"), F.max(f"x{i}").alias("b")).alias(f"r{i}") for i in axes]
    spark = docs.sparkSession
    whole = rows.agg(F.sum("size").alias("total"), *spread).first()
    if shards is None:
        shards = max(1, ceil((whole["total"] or 0) / target_bytes))
    if whole["total"] is None:
        return rows.selectExpr("doc_id", "size", "text_crc32", "0 as shard", "0L as slot")
    scale = [(whole[f"r{i}"]["b"] - whole[f"r{i}"]["a"]) or 1.0 for i in axes]
    # node -> (first shard, number of shards)
    leaves, next_node = {0: (0, shards)}, 1
    while any(k > 1 for _, k in leaves.values()):
        found = {r["node"]: r for r in rows.groupBy("node").agg(F.sum("size").alias("total"), *spread).collect()}
        splitting = {n: v for n, v in leaves.items() if v[1] > 1 and n in found}
        widest = {
            n: max(axes, key=lambda i: (found[n][f"r{i}"]["b"] - found[n][f"r{i}"]["a"]) / scale[i]) for n in splitting}
        wanted = {n: found[n]["total"] * (k // 2) / k for n, (_, k) in splitting.items()}
        axis = spark.createDataFrame([(n, widest[n]) for n in splitting], "node long, axis int")
        x = F.coalesce(*[F.when(F.col("axis") == i, F.col(f"x{i}")) for i in axes])
        active = rows.join(F.broadcast(axis), "node").withColumn("x", x)
        cuts = weighted_cuts(
            active.select("node", "x", F.col("size").alias("weight")),
            {n: (found[n][f"r{i}"]["a"], found[n][f"r{i}"]["b"], wanted[n]) for n, i in widest.items()})
        # Documents of the cut's value are divided by the tie hash; one document goes to the nearer side.
        at = spark.createDataFrame([(n, c.value) for n, c in cuts.items() if c.documents > 1], "node long, cut double")
        tie_cuts = {n: float(TIE_RANGE) if nearest(c, wanted[n]) == c.value else -1.0 for n, c in cuts.items() if c.documents == 1}
        if len(tie_cuts) < len(cuts):
            tied = active.join(F.broadcast(at), "node").where("x = cut").select("node", F.col("tie").alias("x"), F.col("size").alias("weight"))
            inner = weighted_cuts(tied, {
                n: (0.0, float(TIE_RANGE), wanted[n] - c.start) for n, c in cuts.items() if c.documents > 1})
            tie_cuts |= {n: nearest(c, wanted[n] - cuts[n].start) for n, c in inner.items()}
        made, moves = {}, []
        for n, (first, k) in splitting.items():
            made[next_node], made[next_node + 1] = (first, k // 2), (first + k // 2, k - k // 2)
            moves.append((n, widest[n], cuts[n].value, tie_cuts[n], next_node))
            next_node += 2
        joined = rows.join(F.broadcast(spark.createDataFrame(
            moves, "node long, axis int, cut double, tie_cut double, child long")), "node", "left")
        left = (x < F.col("cut")) | ((x == F.col("cut")) & (F.col("tie") <= F.col("tie_cut")))
        moved = F.when(F.col("child").isNull(), F.col("node")).otherwise(F.col("child") + F.when(left, 0).otherwise(1))
        rows = stored(joined.withColumn("node", moved).select(*rows.columns), "shards")
        # A node without documents keeps its shards empty.
        leaves = {n: v for n, v in leaves.items() if v[1] == 1 and n in found} | made
    place = spark.createDataFrame([(n, first) for n, (first, _) in leaves.items()], "node long, shard int")
    placed = rows.join(F.broadcast(place), "node").withColumn("block", F.pmod(F.xxhash64("doc_id"), F.lit(BLOCKS)))
    before = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = placed.groupBy("shard", "block").count().select(
        "shard", "block", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("first"))
    within = Window.partitionBy("shard", "block").orderBy("doc_id", "text_crc32")
    return placed.withColumn("at", F.row_number().over(within) - 1).join(offsets, ["shard", "block"]).select(
        "doc_id", "size", "text_crc32", "shard", (F.col("first") + F.col("at")).cast("long").alias("slot"))
