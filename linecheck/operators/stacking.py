"""Putting frames on top of each other."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def stack(frames: Sequence[DataFrame]) -> DataFrame:
    """All rows of all frames, columns matched by position."""
    if not frames:
        raise ValueError("nothing to stack")
    return reduce(DataFrame.union, frames)


def stack_tagged(frames: Mapping[str, DataFrame], tag: str = "part") -> DataFrame:
    """All rows of named frames, columns matched by name, with the frame's name in ``tag``."""
    return stack_by_name([frame.withColumn(tag, F.lit(name)) for name, frame in frames.items()])


def stack_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    if not frames:
        raise ValueError("nothing to stack")
    return reduce(DataFrame.unionByName, frames)
