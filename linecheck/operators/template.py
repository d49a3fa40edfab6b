"""Golden templates: what every line of a model should measure."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

MEASURES = ("lead_diff", "pad_diff", "lead_limit", "pad_limit")


def template_table(raw: DataFrame) -> DataFrame:
    """Template rows in our own names, every number cast; ``raw`` has a ``model_key``."""

    def number(name: str, kind: str):
        return F.coalesce(F.col(name).cast(kind), F.lit(0).cast(kind))

    return raw.select(
        "model_key",
        number("lineNmb", "int").alias("line"),
        number("leadDiff", "double").alias("lead_diff"),
        number("padDiff", "double").alias("pad_diff"),
        number("leadThreshold", "double").alias("lead_limit"),
        number("padThreshold", "double").alias("pad_limit"),
    )


def template_positions(templates: DataFrame) -> DataFrame:
    """Position of every template line in its model, and the model's number of lines."""
    model = Window.partitionBy("model_key")
    in_order = model.orderBy("line", *MEASURES)
    return templates.select(
        "model_key",
        F.row_number().over(in_order).alias("pos"),
        "line",
        *MEASURES,
        F.count("*").over(model).cast("int").alias("n_std"),
    )


def template_sizes(templates: DataFrame) -> DataFrame:
    return templates.groupBy("model_key").agg(F.count("*").cast("int").alias("n_std"))


def missing_templates(model_keys: DataFrame, templates: DataFrame) -> DataFrame:
    """Models that are asked for but have no template line."""
    return model_keys.distinct().join(templates.select("model_key").distinct(), "model_key", "left_anti")
