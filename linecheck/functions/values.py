"""Casts and dates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def number_or_zero(value: Column) -> Column:
    """The value as a double; text that is no number, and null, count as 0."""
    return F.coalesce(value.try_cast("double"), F.lit(0.0))


def later(first: Column, second: Column) -> Column:
    return F.greatest(first, second)


def midnight(day: Column | None = None, pattern: str = "yyyy-MM-dd") -> Column:
    """The start of a day (today if none is given) as text."""
    day = F.current_date() if day is None else day
    return F.concat(F.date_format(day, pattern), F.lit(" 00:00:00"))
