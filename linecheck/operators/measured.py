"""Decisions that rest on measured sizes, not on estimates.

A join side is broadcast only after its rows were counted. Tables that are counted
and then used again are written to the shared folder first, so they are computed
once and survive the loss of an executor.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linecheck.session import fresh_path

# At some hundred bytes a row this keeps a broadcast table near 100 MB.
BROADCAST_ROWS = 500_000


def written(table: DataFrame, name: str) -> DataFrame:
    """The table as stored in the shared folder."""
    path = fresh_path(table.sparkSession, name)
    table.write.parquet(path)
    return table.sparkSession.read.schema(table.schema).parquet(path)


def is_small(table: DataFrame, most: int = BROADCAST_ROWS) -> bool:
    """Whether the table has at most ``most`` rows."""
    return table.count() <= most


def small_side(table: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """The table, marked for broadcast if it is small.

    Otherwise it is left as it is: Spark then shuffles both sides and splits skewed keys.
    """
    return F.broadcast(table) if is_small(table, most) else table
