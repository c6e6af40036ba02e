"""Connected components over an edge table, by rounds of Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.llm.common import stored


def component_labels(edges: DataFrame) -> DataFrame:
    """``id, label``: the smallest id reachable over ``a, b`` edges, for ids that have an edge.

    A round takes the smallest label among neighbours, then the label of the
    label. Minima are pre-aggregated before they are shuffled, so a hub is no hot
    task. Each round is cut off by a stored table.
    """
    both = stored(edges.select("a", "b").union(edges.select("b", "a")).where("a != b").distinct(), "edges")
    labels = stored(
        both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("m")).select("id", F.least("id", "m").alias("label")),
        "labels")
    while True:
        near = both.join(labels.select(F.col("id").alias("b"), "label"), "b").groupBy(F.col("a").alias("id")).agg(
            F.min("label").alias("m"))
        hooked = labels.join(near, "id").select("id", F.least("label", "m").alias("new"), F.col("label").alias("old"))
        hooked = stored(hooked, "labels")
        up = hooked.select(F.col("id").alias("new"), F.col("new").alias("above"))
        labels = stored(hooked.join(up, "new").select("id", F.least("new", "above").alias("label"), "old"), "labels")
        if labels.where("label != old").isEmpty():
            return labels.select("id", "label")
        labels = labels.select("id", "label")
