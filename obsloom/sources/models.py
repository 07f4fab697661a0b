"""Saved pipelines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def _exists(spark: SparkSession, path: str) -> list[str]:
    """The folders that match a path pattern, in name order."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    found = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(hadoop)
    return sorted(status.getPath().toString() for status in found or [])


def best_available(spark: SparkSession, folders: Sequence[str], patterns: Sequence[str]) -> str:
    """The first match, trying each name pattern in every folder before the next pattern."""
    for pattern in patterns:
        for folder in folders:
            found = _exists(spark, f"{folder}/{pattern}")
            if found:
                return found[0]
    raise FileNotFoundError(f"no model matches {', '.join(patterns)}")
