"""Joins in which a missing key value equals a missing key value."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def unused(columns: Sequence[str], wish: str) -> str:
    """A name that no column starts with, whatever the case."""
    while any(c.lower().startswith(wish.lower()) for c in columns):
        wish = f"_{wish}"
    return wish


def lookup(
    rows: DataFrame, table: DataFrame, pairs: Sequence[tuple[str, str]], how: str, take: Sequence[str] = ()
) -> DataFrame:
    """Join ``table`` to ``rows`` on pairs of columns and add the columns in ``take``."""
    found = unused(rows.columns, "found_")
    right = table.toDF(*[f"{found}{c}" for c in table.columns])
    same = reduce(lambda a, b: a & b, [F.col(a).eqNullSafe(F.col(f"{found}{b}")) for a, b in pairs])
    joined = rows.join(right, same, how)
    return joined.select(*rows.columns, *[F.col(f"{found}{c}").alias(c) for c in take])


def on(keys: Sequence[str]) -> list[tuple[str, str]]:
    """Pairs of equally named columns."""
    return [(key, key) for key in keys]
