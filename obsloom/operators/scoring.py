"""Batch scoring with fitted pipelines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.feature import IndexToString
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from obsloom.functions.labels import contains_any

# Texts that name the class without an event.
NORMAL_WORDS = ("normal", "bình", "binh thuong")


def is_normal(name: Column, words: Sequence[str] = NORMAL_WORDS) -> Column:
    return contains_any(name, words)


def class_names(model: PipelineModel) -> list[str]:
    for stage in reversed(model.stages):
        if isinstance(stage, IndexToString):
            return list(stage.getLabels())
    raise ValueError("the pipeline does not name its classes")


def probabilities(scored: DataFrame) -> Column:
    """Class probabilities as an array; raw scores pass through softmax where a model has nothing else."""
    if "probability" in scored.columns:
        return vector_to_array("probability")
    raw = vector_to_array("rawPrediction")
    top = F.array_max(raw)
    weights = F.transform(raw, lambda v: F.exp(v - top))
    total = F.aggregate(weights, F.lit(0.0), lambda a, b: a + b)
    return F.transform(weights, lambda v: v / total)


def score(df: DataFrame, model: PipelineModel, prefix: str, per_class: bool = True) -> DataFrame:
    """Add ``<prefix>_class``, ``<prefix>_confidence`` (percent) and one probability per class."""
    names = class_names(model)
    scored = model.transform(df)
    scored = scored.withColumn("__p", probabilities(scored))
    out = {
        f"{prefix}_class": F.col("predicted"),
        f"{prefix}_confidence": F.col("__p")[F.col("prediction").cast("int")] * 100,
    }
    if per_class:
        out.update({f"{prefix}_p_{name}": F.col("__p")[i] for i, name in enumerate(names)})
    return scored.select(*df.columns, *[value.alias(name) for name, value in out.items()])
