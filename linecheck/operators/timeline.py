"""Marker segmentation of long, possibly very uneven histories.

Every row belongs to the sample that the latest marker row at or before its time
has started. Within one history (a machine and a model, say) that is a running
maximum of the marker times, one window and one shuffle. That is the plan as long as
a task can sort the largest history (``limit`` rows, measured).

Beyond that, histories are cut into time slots. The rows are stored first, so that their source is
read twice at most: for the size of the largest history, and for the rows themselves.

1. ``slot_table`` counts rows and marker times per history and slot. A slot is a
   day, say; one with more than ``limit`` rows is cut into hours, those into minutes, then
   seconds, and at last at every distinct time. A window over the slots of a history, and
   one over the parts of each cut slot, carry the last marker on.
2. ``place`` joins that table to the rows and tells every row its *home*: the slot in
   which its sample started. All rows of one sample share one home.
3. ``segment`` takes the running maximum within (history, home), again one shuffle.

Rows of a slot that holds a single sample know their sample from step 2. Where such
rows of one sample exceed ``limit`` they are *settled*: they skip the window. So no
group of a window over rows has more than about three times ``limit`` rows, however uneven
machines, days, times or samples are. A window over slots is as large as the number of slots
of a history, or of parts of one slot: 60 at most, but for the distinct times of one second,
or of one slot that is given as a column.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import WindowSpec

from linecheck.operators.lookup import lookup, on
from linecheck.operators.measured import is_small, small_side, written

DEFAULT_LIMIT = 2_000_000


@dataclass(frozen=True)
class Placed:
    """Rows with ``home``, ``settled``, ``own`` and ``known_start``; settled samples and their homes, if any.

    ``own`` rows follow a marker of their own slot and take their start from the window over
    (history, home). All other rows have it in ``known_start``.
    """

    rows: DataFrame
    settled_samples: DataFrame | None


# Length of the text of a time up to each width.
WIDTHS = {"year": 4, "month": 7, "day": 10, "hour": 13, "minute": 16, "second": 19}


def slot_of(rows: DataFrame, time: str, width: str | Column = "day") -> Column:
    """The slot of a time, in the type of the time column, so that slots sort like times.

    Times of any other type, or slots of another width, need a column that never falls
    as the time grows.
    """
    if isinstance(width, Column):
        return width
    kind = rows.schema[time].dataType
    if isinstance(kind, T.StringType):
        return F.substring(time, 1, WIDTHS[width])
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.date_trunc(width, time).cast(kind)
    raise ValueError(f"name a slot for a time column of type {kind.simpleString()}")


def levels_of(rows: DataFrame, time: str, width: str | Column = "day") -> list[Column]:
    """Slots of the width, of all smaller widths, and at last the times themselves.

    A slot that is given as a column is cut at the times at once.
    """
    smaller = [width] if isinstance(width, Column) else [*WIDTHS][[*WIDTHS].index(width) :]
    return [*(slot_of(rows, time, each) for each in smaller), F.col(time)]


def running_start(keys: Sequence[str], time: str, marker: Column) -> Column:
    """The latest marker time so far; rows at the marker's own time belong to it too."""
    so_far = Window.partitionBy(*keys).orderBy(time)
    return F.max(F.when(marker, F.col(time))).over(so_far)


def _facts(rows: DataFrame, keys: Sequence[str], slot: Column, time: str, marker: Column) -> DataFrame:
    mark = F.when(marker, F.col(time))
    return rows.groupBy(*keys, slot.alias("slot")).agg(
        F.count("*").alias("slot_rows"),
        F.min(mark).alias("first_mark"),
        F.max(mark).alias("last_mark"),
    )


def _before(keys: Sequence[str]) -> WindowSpec:
    return Window.partitionBy(*keys).orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)


def _carried(
    rows: DataFrame, keys: Sequence[str], time: str, marker: Column, levels: Sequence[Column], limit: int
) -> tuple[DataFrame, list[DataFrame]]:
    """Slots with the last marker before them and its home; per level the slots that are cut further."""
    slots: DataFrame | None = None
    cuts: list[DataFrame] = []
    inside, owner = rows, list(keys)
    for depth, level in enumerate(levels):
        facts = written(_facts(inside, owner, level, time, marker), "slots")
        facts = facts.withColumn("carried", F.max("last_mark").over(_before(owner)))
        if depth:
            outer = cuts[-1].withColumnRenamed("carried", "outer")
            facts = lookup(facts, outer, on(owner), "inner", ["outer"])
            facts = facts.withColumn("carried", F.coalesce("carried", "outer"))
        at_times = depth == len(levels) - 1
        crowded = F.lit(False) if at_times else F.col("slot_rows") > limit
        ready = facts.where(~crowded).select(
            *keys, "slot", "slot_rows", "first_mark", "last_mark", "carried", F.lit(at_times).alias("single_time")
        )
        slots = ready if slots is None else slots.unionByName(ready)
        cut = facts.where(crowded).select(*keys, F.col("slot").alias("wide_slot"), "carried")
        if at_times or cut.isEmpty():
            break
        cuts.append(small_side(written(cut, "cut")))
        owner = [*keys, "wide_slot"]
        inside = lookup(inside.withColumn("wide_slot", level), cuts[-1], on(owner), "left_semi")

    # A marker that is carried on is the last one of the slot that is its home.
    slots = written(slots, "cut-slots")
    homes = small_side(slots.where(F.col("last_mark").isNotNull()).select(*keys, "last_mark", F.col("slot").alias("carried_home")))
    slots = lookup(slots, homes, [*on(keys), ("carried", "last_mark")], "left", ["carried_home"])
    return slots.drop("last_mark"), cuts


def slot_table(
    rows: DataFrame, keys: Sequence[str], time: str, marker: Column, levels: Sequence[Column], limit: int
) -> tuple[DataFrame, list[DataFrame], DataFrame | None]:
    """The slots of every history, those that are cut, level by level, and the settled samples.

    Of a slot the rows from ``own_from`` on
    have their home in it; all others start at ``known_start`` and have ``known_home``.
    """
    slots, cuts = _carried(rows, keys, time, marker, levels, limit)
    marked = F.col("first_mark").isNotNull()
    slots = written(slots.withColumn("one_sample", F.col("single_time") | ~marked), "carried").withColumn(
        "slot_sample", F.when(F.col("one_sample"), F.coalesce("first_mark", "carried"))
    )
    marked_home = F.when(marked, F.col("slot")).otherwise(F.col("carried_home"))
    loads = slots.where("one_sample").groupBy(*keys, F.col("slot_sample").alias("known_start"))
    loads = loads.agg(F.sum("slot_rows").alias("load"), F.max(marked_home).alias("home"))
    settled = loads.where(F.col("load") > limit).select(*keys, "known_start", "home")
    if settled.isEmpty():
        settled = None
        slots = slots.withColumn("settled", F.lit(False))
    else:
        settled = small_side(written(settled, "settled"))
        pairs = [*on(keys), ("slot_sample", "known_start")]
        slots = lookup(slots, settled.withColumn("found", F.lit(True)), pairs, "left", ["found"])
        slots = slots.withColumn("settled", F.col("one_sample") & F.coalesce("found", F.lit(False)))
    is_settled = F.col("settled")
    slots = slots.select(
        *keys,
        "slot",
        F.when(~is_settled, F.col("first_mark")).alias("own_from"),
        F.when(is_settled, F.col("slot_sample")).otherwise(F.col("carried")).alias("known_start"),
        F.when(is_settled, marked_home).otherwise(F.col("carried_home")).alias("known_home"),
        "settled",
    )
    return written(slots, "homes"), cuts, settled


def place(
    rows: DataFrame, keys: Sequence[str], time: str, marker: Column, width: str | Column, limit: int | None
) -> Placed | None:
    """Tell every row the slot in which its sample started.

    None if there is no need to, because a task can sort the largest history. With no limit
    the caller vouches for that, and nothing is measured.
    """
    if limit is None:
        return None
    # Whether the times can be cut must not depend on how many there are.
    levels_of(rows, time, width)
    histories = rows.groupBy(*keys).agg(F.count("*").alias("history_rows"))
    if is_small(histories.where(F.col("history_rows") > limit), 0):
        return None
    # What follows reads the rows several times; their source is read this once more.
    rows = written(rows, "cut-rows")
    levels = levels_of(rows, time, width)
    slots, cuts, settled = slot_table(rows, keys, time, marker, levels, limit)
    cut = rows.withColumn("row_slot", levels[0])
    for crowded, finer in zip(cuts, levels[1:], strict=False):
        crowded = crowded.withColumn("crowded", F.lit(True))
        cut = lookup(cut, crowded, [*on(keys), ("row_slot", "wide_slot")], "left", ["crowded"])
        cut = cut.withColumn("row_slot", F.when(F.col("crowded"), finer).otherwise(F.col("row_slot"))).drop("crowded")
    facts = ["slot", "own_from", "known_start", "known_home", "settled"]
    placed = lookup(cut, small_side(slots), [*on(keys), ("row_slot", "slot")], "inner", facts)
    own = F.coalesce(F.col(time) >= F.col("own_from"), F.lit(False))
    placed = placed.withColumn("own", own).select(
        *rows.columns,
        F.when(F.col("own"), F.col("slot")).otherwise(F.col("known_home")).alias("home"),
        "known_start",
        "own",
        "settled",
    )
    return Placed(placed if settled is None else written(placed, "placed"), settled)


def calm_rows(
    placed: Placed, keys: Sequence[str], time: str, marker: Column, start: str, homes: DataFrame | None = None
) -> DataFrame:
    """The rows that are not settled, with their start, partitioned by (history, home).

    With ``homes`` only the rows of these homes.
    """
    rows = placed.rows.where(~F.col("settled"))
    if homes is not None:
        rows = lookup(rows, homes, on([*keys, "home"]), "left_semi")
    window = running_start([*keys, "home"], time, marker)
    rows = rows.withColumn(start, F.when(F.col("own"), window).otherwise(F.col("known_start")))
    return rows.drop("own", "known_start", "settled")


def settled_rows(placed: Placed, start: str) -> DataFrame:
    return placed.rows.where("settled").withColumnRenamed("known_start", start).drop("own", "settled", "home")


def segment(
    rows: DataFrame,
    keys: Sequence[str],
    time: str,
    marker: Column,
    *,
    start: str = "sample_ts",
    slot: str | Column = "day",
    limit: int | None = DEFAULT_LIMIT,
) -> DataFrame:
    """All rows, each with the start time of its sample (null before the first marker)."""
    placed = place(rows, keys, time, marker, slot, limit)
    if placed is None:
        return rows.withColumn(start, running_start(keys, time, marker))
    columns = [*rows.columns, start]
    calm = calm_rows(placed, keys, time, marker, start).select(*columns)
    if placed.settled_samples is None:
        return calm
    return calm.unionByName(settled_rows(placed, start).select(*columns))
