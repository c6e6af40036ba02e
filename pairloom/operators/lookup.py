"""Joining many feature occurrences with a table that has one row per feature."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lookup(
    rows: DataFrame,
    table: DataFrame,
    key: str,
    *,
    table_rows: int,
    row_bytes: int,
    limit_bytes: int,
    wanted: DataFrame | None = None,
) -> DataFrame:
    """Left-join ``rows(slot, key, ...)`` with ``table(key, ...)``.

    Up to ``limit_bytes`` (a bound known from the row count) the table is
    broadcast and ``rows`` keep their partitioning. Beyond it, every slot
    first asks for the distinct keys it uses and receives one copy of each of
    their rows; the join then runs on ``(slot, key)``. A key that occurs in a
    third of all rows is thereby spread over all slots, and what travels is
    one row per slot and key rather than one per occurrence. Rows that are
    hash-partitioned by ``slot`` are not shuffled for it (see
    ``plans.session``), nor sorted: what a slot asked for is its hash table. ``wanted`` gives the distinct ``(slot, key)`` if the
    caller has them already.
    """
    if table_rows * row_bytes <= limit_bytes:
        return rows.join(F.broadcast(table), key, "left")
    if wanted is None:
        wanted = rows.where(F.col(key).isNotNull()).select("slot", key).distinct()
    return rows.join(wanted.join(table, key).hint("shuffle_hash"), ["slot", key], "left")
