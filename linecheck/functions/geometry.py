"""Distances and tolerances."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def distance(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    """Euclidean distance in the plane."""
    dx, dy = x1 - x2, y1 - y2
    return F.sqrt(dx * dx + dy * dy)


def deviation(measured: Column, wanted: Column) -> Column:
    return F.abs(wanted - measured)


def out_of_tolerance(offset: Column, limit: Column) -> Column:
    """Strictly above the limit.

    Spark sorts NaN above every number, but an offset that is not a number must pass,
    and nothing exceeds a limit that is not a number either.
    """
    return ~F.isnan(offset) & (offset > limit)
