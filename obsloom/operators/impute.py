"""Values for gaps, learned on one frame and usable on any other."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from obsloom.operators.profile import value_counts
from obsloom.operators.quantiles import quantiles


def modes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``column, mode``: the most frequent value, the smallest one on ties.

    Values are counted across the cluster; only the counts of distinct values meet.
    """
    texts = df.select(*[F.col(c).cast("string").alias(c) for c in columns])
    counted = value_counts(texts, columns).where(F.col("value").isNotNull())
    return counted.groupBy("column").agg(F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("mode"))


def medians(df: DataFrame, columns: Sequence[str], accuracy: int | None = None, **exact: int) -> DataFrame:
    """``column, median``."""
    found = quantiles(df, columns, [0.5], accuracy=accuracy, **exact)
    return found.select("column", F.element_at("q", 1).alias("median"))


def learn_fills(
    df: DataFrame,
    numeric: Sequence[str] = (),
    categorical: Sequence[str] = (),
    strategy: str = "median",
    constant: float = 0.0,
    accuracy: int | None = None,
) -> dict[str, object]:
    """One fill value per column: ``median``, ``mean`` or ``constant`` for numbers, the mode for text.

    A column without any value gets none.
    """
    fills: dict[str, object] = {}
    if numeric and strategy == "median":
        fills.update({r["column"]: r["median"] for r in medians(df, numeric, accuracy).collect()})
    elif numeric and strategy == "mean":
        fills.update(df.agg(*[F.avg(c).alias(c) for c in numeric]).first().asDict())
    elif numeric and strategy == "constant":
        fills.update({c: constant for c in numeric})
    elif numeric:
        raise ValueError(f"unknown strategy {strategy}")
    if categorical:
        fills.update({r["column"]: r["mode"] for r in modes(df, categorical).collect()})
    return {name: value for name, value in fills.items() if value is not None}


def apply_fills(df: DataFrame, fills: dict[str, object]) -> DataFrame:
    known = {name: value for name, value in fills.items() if name in df.columns}
    return df.withColumns(
        {name: F.coalesce(F.col(name), F.lit(value)) for name, value in known.items()}
    ) if known else df
