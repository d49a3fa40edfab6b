"""Insert, upsert and update of tables with a primary key.

Each takes the table and the rows to write and returns the new table, to be written
to a new place (``sources.tables.rewrite`` does so under the table's name). Rows to write
must have unique keys, none of them missing, and only columns of the table. The joins
shuffle by the key, which is unique in the table and so never skewed; a table bucketed by
its key (see ``create_table``) is not shuffled at all.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linecheck.operators.lookup import unused


class KeyConflict(ValueError):
    """Rows to write that do not fit the table, or a table that does not fit its keys."""


def demand_keys(rows: DataFrame, keys: Sequence[str], what: str) -> None:
    """Refuse rows without a value for some key."""
    missing = reduce(lambda a, b: a | b, [F.col(key).isNull() for key in keys])
    if not rows.where(missing).isEmpty():
        raise KeyConflict(f"{what} have no value for a key of {', '.join(keys)}")


def _demand_fit(table: DataFrame, rows: DataFrame, keys: Sequence[str]) -> None:
    unknown = [c for c in rows.columns if c not in table.columns]
    if unknown:
        raise KeyConflict(f"the table has no column {', '.join(unknown)}")
    absent = [key for key in keys if key not in rows.columns]
    if absent:
        raise KeyConflict(f"rows to write lack the key {', '.join(absent)}")
    demand_keys(rows, keys, "rows to write")
    demand_keys(table, keys, "rows of the table")
    counts = rows.groupBy(*keys).agg(F.count("*").alias("n_rows"))
    if not counts.where(F.col("n_rows") > 1).isEmpty():
        raise KeyConflict(f"rows to write repeat a key in {', '.join(keys)}")


def insert(table: DataFrame, rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add rows; a key that is already there is an error."""
    keys = list(keys)
    _demand_fit(table, rows, keys)
    if not rows.join(table.select(*keys), keys, "left_semi").isEmpty():
        raise KeyConflict("a key to insert exists already")
    return table.unionByName(rows)


def upsert(table: DataFrame, rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add rows, replacing those with the same key."""
    keys = list(keys)
    _demand_fit(table, rows, keys)
    return table.join(rows.select(*keys), keys, "left_anti").unionByName(rows)


def update(table: DataFrame, rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Take over the columns that ``rows`` has; a key that is not there is an error."""
    keys = list(keys)
    _demand_fit(table, rows, keys)
    if not rows.join(table.select(*keys), keys, "left_anti").isEmpty():
        raise KeyConflict("a key to update does not exist")
    changed = [c for c in rows.columns if c not in keys]
    if not changed:
        return table
    new = unused(table.columns, "new")
    values = rows.select(*keys, F.struct(*changed).alias(new))
    return table.join(values, keys, "left").select(
        *[
            F.when(F.col(new).isNotNull(), F.col(f"{new}.`{c}`")).otherwise(F.col(c)).alias(c) if c in changed else F.col(c)
            for c in table.columns
        ]
    )
