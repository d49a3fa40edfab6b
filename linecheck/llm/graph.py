"""Connected components by star contraction, as joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linecheck.llm.common import stored


def _mark(edges: DataFrame) -> tuple:
    """What tells whether a round changed the edges."""
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root``, the smallest node of its component, for every node but the roots.

    ``edges`` has columns ``a`` and ``b`` of ids; loops, repeats and missing ends play no
    part, no edges give no rows. A round ties every node to the smallest node it sees; all
    rows of a node meet in aggregations that combine before the shuffle and in joins that
    Spark can split, so a node may have any number of neighbours. The number of rounds
    grows with the logarithm of the length of chains.
    """
    pairs = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    now = stored(pairs, "edges")
    mark = _mark(now)
    while mark[0]:
        both = now.union(now.select(F.col("b"), F.col("a")))
        least = both.groupBy(F.col("a").alias("at")).agg(F.min("b").alias("least"))
        least = least.select("at", F.least("at", "least").alias("least"))
        wide = both.join(least, F.col("a") == F.col("at")).where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
        wide = wide.union(least.where("least < at")).distinct()
        low = wide.groupBy(F.col("a").alias("at")).agg(F.min("b").alias("least"))
        near = wide.join(low, F.col("a") == F.col("at")).select(F.col("b").alias("a"), F.col("least").alias("b"))
        now = stored(near.where("a <> b").union(low).distinct(), "edges")
        before, mark = mark, _mark(now)
        if mark == before:
            break
    return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
