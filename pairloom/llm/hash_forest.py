"""Nearest neighbours by inner product with a forest of sorted hash strings.

Each tree hashes a vector to a long string of bits (signs of random projections,
62 bits as a sortable long). A tree is the sorted array of these strings, cut
into blocks of about ``block_rows`` consecutive entries. A query descends
in every tree to its longest-prefix matches: in a sorted array entries that share
a prefix are one interval. Then it ascends in all trees at once: the prefix
length x is lowered until the intervals of all trees hold ``candidates`` entries
together, and all of these are scored.

So that the inner product ranks like the angle, vectors are scaled by the largest
norm and get one more component that makes all norms 1 (queries get 0 there).

Equal vectors are one entry with their smallest ids: equal scores go to
smaller ids, so of equal vectors only the ``k + 1`` smallest ids can be in an answer
(one more than k, as a query leaves itself out). This is exact and keeps a very
frequent vector from filling a block. Equal queries are searched once.

Blocks hold the vectors, so scores are matrix products inside a block and only
each block's ``k`` best entries per query travel. A query visits the blocks that its
interval touches. Block borders (``blocks`` per tree) come from a bounded sample of
the strings; every vector is indexed.

On data without structure (random directions in 64 dimensions) a near neighbour
shares few bits, so ``candidates`` must be a share of the table for a given recall;
it is ``share`` of the distinct vectors, ``least`` at the least.

Vectors that are null, empty, zero, or hold null or non-finite components take
no part. Vectors of another length than the first id's are refused. Rows without
id take no part; repeated rows with one id and vector count once. Other columns aren't read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pairloom.llm.common import stored

BITS = 62


@dataclass(frozen=True)
class Forest:
    trees: int = 16
    share: float = 0.9
    least: int = 2000
    block_rows: int = 4096
    sample: int = 50_000
    seed: int = 7


def planes(tree: int, size: int, seed: int) -> np.ndarray:
    return np.random.default_rng([seed, tree]).standard_normal((size, BITS))


def strings(vectors: np.ndarray, tree: int, seed: int) -> np.ndarray:
    bits = vectors @ planes(tree, vectors.shape[1], seed) > 0
    return bits @ (np.int64(1) << np.arange(BITS - 1, -1, -1, dtype=np.int64))


def matrix(column: pa.Array) -> np.ndarray:
    flat = np.asarray(column.flatten().to_numpy(zero_copy_only=False), dtype=np.float64)
    return flat.reshape(len(column), -1) if len(column) else np.empty((0, 1))


def hashed(vectors: DataFrame, forest: Forest, largest: float, query: bool) -> DataFrame:
    """``tree, string, id, vector`` per tree of ``id, vector``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = matrix(batch["vector"])
            if not len(v):
                continue
            last = np.zeros(len(v)) if query else np.sqrt(np.maximum(0, largest**2 - (v * v).sum(axis=1)))
            wide = np.column_stack([v, last])
            for tree in range(forest.trees):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(v), tree, np.int32)), pa.array(strings(wide, tree, forest.seed)), batch["id"], batch["vector"]],
                    ["tree", "string", "id", "vector"])

    return vectors.select("id", "vector").mapInArrow(run, "tree int, string long, id long, vector array<double>")


def interval(strings_: np.ndarray, query: np.ndarray, depth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and end position of entries that share ``depth`` bits with ``query``."""
    span = np.int64(1) << (BITS - depth).astype(np.int64)
    low = query // span * span
    return np.searchsorted(strings_, low), np.searchsorted(strings_, low + span)


def profiles(key: tuple, entries: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
    """Per query the number of the block's entries that share at least 0, 1, .. BITS bits."""
    if not len(queries) or not len(entries):
        return pd.DataFrame({"id": pd.Series(dtype="int64"), "counts": pd.Series(dtype=object)})
    s, q = np.sort(entries["string"].to_numpy()), queries["string"].to_numpy()
    counts = np.empty((len(q), BITS + 1), np.int64)
    for depth in range(BITS + 1):
        low, high = interval(s, q, np.full(len(q), depth))
        counts[:, depth] = high - low
    return pd.DataFrame({"id": queries["id"].to_numpy(), "counts": list(counts)})


def best_in_block(k: int):
    def search(key: tuple, entries: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out: list[list] = [[], [], []]
        if len(queries) and len(entries):
            entries = entries.sort_values(["string", "id"], kind="stable")
            s, ids = entries["string"].to_numpy(), entries["id"].to_numpy()
            v = np.stack(entries["vector"].to_numpy()).astype(np.float64)
            low, high = interval(s, queries["string"].to_numpy(), queries["depth"].to_numpy())
            # Queries of one interval are one matrix product.
            order = np.lexsort((high, low))
            groups = np.flatnonzero(np.diff(low[order], prepend=-1) | np.diff(high[order], prepend=-1))
            wanted = np.stack(queries["vector"].to_numpy()).astype(np.float64)
            names = queries["id"].to_numpy()
            for a, b in zip(groups, [*groups[1:], len(order)]):
                at, lo, hi = order[a:b], low[order[a]], high[order[a]]
                if lo == hi:
                    continue
                for part in np.array_split(at, -(-len(at) // 256)):
                    scores = wanted[part] @ v[lo:hi].T
                    take = min(k, hi - lo)
                    top = np.argpartition(-scores, take - 1, axis=1)[:, :take]
                    # Entries that tie with the last one compete by id: keep all of them.
                    border = np.take_along_axis(scores, top, 1).min(axis=1)
                    rows, cols = np.nonzero(scores >= border[:, None] - 1e-12)
                    out[0].append(names[part][rows])
                    out[1].append(ids[lo:hi][cols])
                    out[2].append(scores[rows, cols])
        if not out[0]:
            return pd.DataFrame({"query": pd.Series(dtype="int64"), "id": pd.Series(dtype="int64"), "near": pd.Series(dtype="float64")})
        return pd.DataFrame({"query": np.concatenate(out[0]), "id": np.concatenate(out[1]), "near": np.concatenate(out[2])})

    return search


def nearest(
    table: DataFrame, is_query: F.Column, k: int = 20, forest: Forest = Forest(),
    vector: str = "embedding", id_column: str = "vec_id",
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest found of every row for which ``is_query`` holds."""
    spark = table.sparkSession
    good = (
        table.select(F.col(id_column).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vector"), is_query.alias("asks"))
        .where("id is not null and vector is not null and size(vector) > 0")
        .where(F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
        .where(F.exists("vector", lambda x: x != 0)))
    # -0.0 and 0.0 are one value.
    good = good.withColumn("vector", F.transform("vector", lambda x: x + 0.0)).withColumn("key", F.xxhash64("vector"))
    # Distinct vectors with their k + 1 smallest ids, pre-aggregated by blocks of ids.
    smallest = lambda c: F.slice(F.sort_array(F.array_distinct(F.flatten(F.collect_list(c)))), 1, k + 1)
    part = good.groupBy("key", "vector", F.pmod(F.xxhash64("id"), F.lit(256)).alias("part")).agg(
        F.slice(F.sort_array(F.collect_set("id")), 1, k + 1).alias("ids"), F.max("asks").alias("asks"))
    entries = stored(
        part.groupBy("key", "vector").agg(smallest("ids").alias("ids"), F.max("asks").alias("asks"))
        .withColumn("id", F.col("ids")[0]).select("id", "vector", "ids", F.coalesce("asks", F.lit(False)).alias("asks")),
        "vectors")
    members = stored(good.where("asks").join(
        entries.select(F.xxhash64("vector").alias("key"), F.col("vector").alias("own"), F.col("id").alias("entry")), "key"
    ).where("vector = own").select("id", "entry", "vector").distinct(), "queries")
    facts = entries.agg(F.count("*"), F.max(F.sqrt(F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x))), F.min(F.size("vector")), F.max(F.size("vector"))).first()
    rows, largest = facts[0], facts[1] or 1.0
    if facts[2] != facts[3]:
        raise ValueError("vectors differ in length")
    need = max(forest.least, int(forest.share * rows))
    index = stored(hashed(entries.select("id", "vector"), forest, largest, False), "forest")
    asked = hashed(entries.where("asks").select("id", "vector"), forest, largest, True)
    # Block borders per tree from a bounded sample of strings.
    blocks = max(1, rows // forest.block_rows)
    fraction = min(1.0, forest.sample / max(1, rows))
    cuts = index.where(F.pmod(F.xxhash64("id"), F.lit(1 << 20)) < int(fraction * (1 << 20)) + 1).groupBy("tree").agg(
        F.percentile_approx("string", [i / blocks for i in range(1, blocks)] or [0.5], 10_000).alias("cuts"))
    borders = {r["tree"]: sorted(set(r["cuts"]))[: blocks - 1] for r in cuts.collect()}
    border = F.broadcast(spark.createDataFrame(
        [(t, [int(x) for x in b]) for t, b in borders.items()], "tree int, borders array<long>"))

    def block_of(x: str) -> str:
        return f"size(filter(borders, b -> b <= {x}))"

    index = index.join(border, "tree").withColumn("block", F.expr(block_of("string"))).drop("borders")
    asked = stored(asked.join(border, "tree"), "asked")
    home = asked.withColumn("block", F.expr(block_of("string")))
    counts = (
        index.select("tree", "block", "string").groupBy("tree", "block")
        .cogroup(home.select("tree", "block", "string", "id").groupBy("tree", "block"))
        .applyInPandas(profiles, "id long, counts array<long>"))
    # Synchronous ascent: the longest prefix at which all trees together hold enough.
    each = counts.select("id", F.posexplode("counts").alias("depth", "n")).groupBy("id", "depth").agg(F.sum("n").alias("n"))
    depth = each.groupBy("id").agg(F.coalesce(F.max(F.when(F.col("n") >= need, F.col("depth"))), F.lit(0)).alias("depth"))
    span = "shiftleft(1L, 62 - depth)"
    low = f"(string div {span}) * {span}"
    visits = asked.join(depth, "id").withColumn(
        "block", F.explode(F.expr(f"sequence({block_of(low)}, {block_of(f'({low} + {span} - 1)')})"))).drop("borders")
    found = (
        index.select("tree", "block", "string", "id", "vector").groupBy("tree", "block")
        .cogroup(visits.select("tree", "block", "string", "id", "vector", "depth").groupBy("tree", "block"))
        .applyInPandas(best_in_block(k + 1), "query long, id long, near double"))
    pairs = found.groupBy("query", "id").agg(F.max("near").alias("near"))
    # Of each query's distinct vectors only the nearest k + 1 matter; equal scores by smaller id.
    top = Window.partitionBy("query").orderBy(F.desc("near"), "id")
    kept = pairs.withColumn("r", F.row_number().over(top)).where(F.col("r") <= 2 * k + 2).select("query", "id")
    answers = kept.join(entries.select("id", F.col("vector").alias("other"), "ids"), "id")
    # Each query row: ids of the found vectors, exact scores in double precision, its own id left out.
    scored = answers.join(entries.select(F.col("id").alias("query"), F.col("vector").alias("own")), "query").select(
        "query", "ids", F.aggregate(F.zip_with("own", "other", lambda a, b: a * b), F.lit(0.0), lambda a, x: a + x).alias("score"))
    best = scored.groupBy("query").agg(F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("s"), "ids"))).alias("found"))
    lists = best.select("query", F.slice(F.sort_array(F.flatten(F.transform(
        "found", lambda f: F.transform(f["ids"], lambda i: F.struct(f["s"].alias("s"), i.alias("i")))))), 1, k + 1).alias("found"))
    own = members.select("id", "entry").join(lists, F.col("entry") == F.col("query"), "left").select(
        F.col("id").alias("query_id"),
        F.slice(F.filter("found", lambda f: f["i"] != F.col("id")), 1, k).alias("found"))
    return own.select("query_id", F.posexplode("found").alias("at", "f")).select(
        "query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("f.i").alias("vec_id"), (-F.col("f.s")).alias("score"))
