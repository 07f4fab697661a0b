"""Classifier quality from predictions, as aggregates over (label, prediction) and over scores."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.param.shared import HasLabelCol, HasPredictionCol
from pyspark.sql import DataFrame, functions as F

from obsloom.operators.ranks import running_totals


def confusion(df: DataFrame, label: str, prediction: str, classes: Sequence[object] | None = None) -> DataFrame:
    """``label, prediction, n`` for every pair of classes, 0 where a pair does not occur."""
    pairs = df.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(
        F.count("*").alias("n")
    )
    if classes is None:
        return pairs
    counted = [F.sum(F.when(F.col("prediction") == c, F.col("n"))).alias(f"__{i}") for i, c in enumerate(classes)]
    entries = [
        F.struct(F.lit(c).alias("prediction"), F.coalesce(F.col(f"__{i}"), F.lit(0)).alias("n"))
        for i, c in enumerate(classes)
    ]
    present = df.sparkSession.createDataFrame([(c,) for c in classes], ["label"])
    rows = present.join(pairs.groupBy("label").agg(*counted), "label", "left")
    return rows.select("label", F.inline(F.array(*entries)))


def class_metrics(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """``class, support, predicted, hits, precision, recall, f1``; a division by zero counts as 0."""
    pairs = confusion(df, label, prediction)
    sides = F.array(
        F.struct(F.col("label").alias("class"), F.col("n").alias("support"), F.lit(0).cast("bigint").alias("predicted")),
        F.struct(F.col("prediction").alias("class"), F.lit(0).cast("bigint").alias("support"), F.col("n").alias("predicted")),
    )
    hit = F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(F.lit(0))
    counts = (
        pairs.withColumn("__hits", hit)
        .select("__hits", F.inline(sides))
        .groupBy("class")
        .agg(
            F.sum("support").alias("support"),
            F.sum("predicted").alias("predicted"),
            F.sum(F.when(F.col("support") > 0, F.col("__hits")).otherwise(F.lit(0))).alias("hits"),
        )
    )
    precision = F.coalesce(F.try_divide("hits", "predicted"), F.lit(0.0))
    recall = F.coalesce(F.try_divide("hits", "support"), F.lit(0.0))
    scored = counts.withColumn("precision", precision).withColumn("recall", recall)
    f1 = F.try_divide(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall"))
    return scored.withColumn("f1", F.coalesce(f1, F.lit(0.0)))


def macro_metrics(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """``accuracy, precision, recall, f1``, the last three as plain means over the classes."""
    return class_metrics(df, label, prediction).agg(
        (F.sum("hits") / F.sum("support")).alias("accuracy"),
        F.avg("precision").alias("precision"),
        F.avg("recall").alias("recall"),
        F.avg("f1").alias("f1"),
    )


def roc_auc(df: DataFrame, positive: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """``auc`` per group: the chance that a positive outranks a negative, ties counting half.

    ``positive`` is a truth value. Rows are counted per distinct score first, and running totals over
    the scores are taken bucket by bucket. NULL when a group has only one class.
    """
    keys = [F.lit("__all__").alias("__all")] if not by else [F.col(b) for b in by]
    names = list(by) or ["__all"]
    counts = (
        df.where(F.col(score).isNotNull() & F.col(positive).isNotNull())
        .groupBy(*keys, F.col(score).cast("double").alias("__score"))
        .agg(
            F.count_if(F.col(positive)).alias("pos"),
            F.count_if(~F.col(positive)).alias("neg"),
        )
    )
    ordered = running_totals(counts, names, "__score", ["pos", "neg"])
    won = F.sum(F.col("pos").cast("double") * (F.col("neg_before") + F.col("neg") / 2.0))
    pairs = F.first("pos_total").cast("double") * F.first("neg_total").cast("double")
    return ordered.groupBy(*names).agg(F.try_divide(won, pairs).alias("auc")).drop("__all")


def macro_auc(df: DataFrame, label: str, scores: dict[str, str]) -> DataFrame:
    """Mean one-against-rest ``auc`` over the classes; ``scores`` maps a class to its score column.

    NULL as soon as one class does not occur.
    """
    entries = [
        F.struct(F.lit(c).alias("class"), (F.col(label) == F.lit(c)).alias("positive"), F.col(s).alias("score"))
        for c, s in scores.items()
    ]
    per_class = roc_auc(df.select(F.inline(F.array(*entries))), "positive", "score", ["class"])
    return per_class.agg(F.when(F.count("auc") == len(scores), F.avg("auc")).alias("auc"))


class MacroF1(Evaluator, HasLabelCol, HasPredictionCol):
    """Macro-averaged F1 for grid searches (Spark's own ``f1`` is weighted by class size)."""

    @keyword_only
    def __init__(self, labelCol: str = "label", predictionCol: str = "prediction"):
        super().__init__()
        self._set(**self._input_kwargs)

    def _evaluate(self, dataset: DataFrame) -> float:
        return float(macro_metrics(dataset, self.getLabelCol(), self.getPredictionCol()).first()["f1"])

    def isLargerBetter(self) -> bool:
        return True


class ClassF1(Evaluator, HasLabelCol, HasPredictionCol):
    """F1 of class 1 of a two-class label."""

    @keyword_only
    def __init__(self, labelCol: str = "label", predictionCol: str = "prediction"):
        super().__init__()
        self._set(**self._input_kwargs)

    def _evaluate(self, dataset: DataFrame) -> float:
        found = class_metrics(dataset, self.getLabelCol(), self.getPredictionCol()).where("class = 1").first()
        return float(found["f1"]) if found else 0.0

    def isLargerBetter(self) -> bool:
        return True
