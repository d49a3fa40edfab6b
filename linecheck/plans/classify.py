"""Boosted-tree classification of feature vectors."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, OneVsRest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linecheck.session import shared_folder

# Names of the modes.
MODES = ("train", "loadAndPredict", "trainAndPredict")


@dataclass(frozen=True)
class Scored:
    model: PipelineModel
    rows: DataFrame


def features_from_array(rows: DataFrame, column: str) -> DataFrame:
    """An array of numbers as the ``features`` vector."""
    return rows.withColumn("features", array_to_vector(F.col(column).cast("array<double>")))


def features_from_columns(columns: list[str]) -> VectorAssembler:
    """A pipeline stage that makes numeric columns the ``features`` vector."""
    return VectorAssembler(inputCols=columns, outputCol="features")


def hold_out(rows: DataFrame, key: str, rate: float, seed: int = 0) -> tuple[DataFrame, DataFrame]:
    """Split rows into (kept, held out) by a hash of their key.

    The same row falls on the same side in every run and for any partitioning, also when
    a lost task is repeated. ``rate`` is the expected share of the second part.
    """
    if not 0.0 <= rate <= 1.0:
        raise ValueError("rate lies between 0 and 1")
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")))
    share = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") / F.lit(2.0**32)
    return rows.where(share >= rate), rows.where(share < rate)


def classifier(params: Mapping[str, object] | None = None, classes: int = 2):
    """Gradient-boosted trees on ``features`` and ``label``; one model per class beyond two."""
    booster = GBTClassifier(featuresCol="features", labelCol="label", **{"seed": 0, **(params or {})})
    if classes <= 2:
        return booster
    return OneVsRest(classifier=booster, featuresCol="features", labelCol="label")


def fit(train: DataFrame, params: Mapping[str, object] | None = None, classes: int = 2, stages=()) -> PipelineModel:
    shared_folder(train.sparkSession)
    return Pipeline(stages=[*stages, classifier(params, classes)]).fit(train)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def run_classifier(
    mode: str,
    frames: Mapping[str, DataFrame],
    *,
    params: Mapping[str, object] | None = None,
    classes: int = 2,
    stages=(),
    model_path: str | None = None,
) -> Scored:
    """Train, or load and score, or train and score.

    ``train`` scores the training rows, the other two the ``test`` rows. With a
    ``model_path`` a trained model is saved there; ``loadAndPredict`` reads it from there.
    """
    if mode not in MODES:
        raise ValueError(f"mode is one of {', '.join(MODES)}")
    needed = {"train": ["train"], "loadAndPredict": ["test"], "trainAndPredict": ["train", "test"]}[mode]
    missing = [name for name in needed if name not in frames]
    if missing:
        raise ValueError(f"{mode} needs the frame {missing[0]}")

    if mode == "loadAndPredict":
        if model_path is None:
            raise ValueError("loadAndPredict needs model_path")
        model = load_model(model_path)
    else:
        model = fit(frames["train"], params, classes, stages)
        if model_path is not None:
            save_model(model, model_path)
    return Scored(model, model.transform(frames[needed[-1]]))
