"""How well scores tell two classes apart: counts at every threshold, and the area under their curve.

Equal scores are one row, so ties count half, as they should. The distinct scores are dealt to
tasks in order; running totals are taken within each task and carried on by one row per task, so
no task sees them all.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from linecheck.operators.measured import small_side, written


def threshold_counts(rows: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """Per distinct score: ``hits`` and ``misses`` of that score, and of it and all above.

    A row is a hit if its label is above 0, a miss otherwise; rows without score or label are
    left out. Columns: ``score``, ``hits``, ``misses``, ``hits_above``, ``misses_above`` (both of
    this score or a greater one).
    """
    good = rows.select(F.col(score).alias("score"), (F.col(label) > 0).alias("hit")).where("score is not null and hit is not null")
    counts = good.groupBy("score").agg(F.count_if("hit").alias("hits"), F.count_if(~F.col("hit")).alias("misses"))
    dealt = written(counts.repartitionByRange(F.desc("score")).withColumn("lane", F.spark_partition_id()), "scores")
    lanes = dealt.groupBy("lane").agg(F.sum("hits").alias("lane_hits"), F.sum("misses").alias("lane_misses"))
    earlier = Window.orderBy("lane").rowsBetween(Window.unboundedPreceding, -1)
    carried = lanes.select("lane", *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"{c}_before") for c in ("lane_hits", "lane_misses")])
    so_far = Window.partitionBy("lane").orderBy(F.desc("score"))
    joined = dealt.join(small_side(carried), "lane")
    return joined.select(
        "score",
        "hits",
        "misses",
        (F.sum("hits").over(so_far) + F.col("lane_hits_before")).alias("hits_above"),
        (F.sum("misses").over(so_far) + F.col("lane_misses_before")).alias("misses_above"),
    )


def area_under_curve(counts: DataFrame) -> DataFrame:
    """One row ``hits``, ``misses``, ``area``: how likely a hit scores above a miss, ties counting half.

    ``counts`` are those of ``threshold_counts``. Without hits or misses the area is missing.
    """
    # Of each miss, the hits above it and half of those at its score, in halves to stay whole.
    halves = F.sum(((2 * F.col("hits_above") - F.col("hits")) * F.col("misses")).cast("decimal(38,0)"))
    totals = counts.agg(F.sum("hits").alias("hits"), F.sum("misses").alias("misses"), halves.alias("halves"))
    pairs = F.col("hits").cast("double") * F.col("misses")
    return totals.select("hits", "misses", F.when(pairs > 0, F.col("halves").cast("double") / (2 * pairs)).alias("area"))
