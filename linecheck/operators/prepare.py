"""From raw readings to typed lines, and the model list."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linecheck import functions as fn
from linecheck import schemas as S
from linecheck.operators.timeline import DEFAULT_LIMIT, segment


def starts_sample() -> Column:
    """Line number 1 opens a new sample."""
    return F.col("linenmb") == 1


def typed_lines(raw: DataFrame) -> DataFrame:
    """Eight columns of a reading with numeric coordinates, and the model key."""
    return raw.select(
        "linenmb",
        "equipmentid",
        "mcid",
        "datetime",
        *[fn.number_or_zero(F.col(name)).alias(name) for name in S.COORDINATES],
        fn.model_key(F.col("mcid")).alias("model_key"),
    )


def prepare(raw: DataFrame, *, slot: str | Column = "day", limit: int | None = DEFAULT_LIMIT) -> DataFrame:
    """Typed lines with the start time of their sample in ``sample_ts``.

    A sample is known by (equipmentid, mcid, sample_ts), not by one packed text. Rows
    before the first marker of their machine and model form a sample whose start is
    null; they do not take over the start of another machine.
    """
    return segment(typed_lines(raw), S.HISTORY, "datetime", starts_sample(), slot=slot, limit=limit)


def listed_models(model_list: DataFrame) -> DataFrame:
    """Distinct names of a model list. Only spaces are removed, a ``#`` part stays."""
    return model_list.select(fn.without_spaces(F.col("mcID")).alias("model_key")).distinct()
