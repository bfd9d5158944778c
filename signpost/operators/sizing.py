"""Decisions that depend on the size of the input."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS = 100_000
# Ids alone, or with a number or two.
KNOWN_IDS = 5 * BROADCAST_ROWS
BROADCAST_BYTES = 64 * 1024 * 1024


def is_bounded(
    side: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES
) -> bool:
    """Is `side` small enough to broadcast? Looks at no more than `max_rows` + 1 rows."""
    width = F.octet_length(F.to_json(F.struct(*side.columns)))
    seen = side.limit(max_rows + 1).agg(
        F.count("*").alias("rows"), F.coalesce(F.sum(width), F.lit(0)).alias("bytes")
    )
    size = seen.first()
    return size["rows"] <= max_rows and size["bytes"] <= max_bytes


def broadcast_if_bounded(side: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast when `side` is measured to be small; else leave the join to Spark."""
    return F.broadcast(side) if is_bounded(side, max_rows) else side
