"""Scores and linear scales."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, functions as F


def weighted_score(weights: Mapping[str, float]) -> Column:
    """Sum of ``weight * column``; NULL as soon as one column is NULL."""
    terms = [F.col(name) * F.lit(float(weight)) for name, weight in weights.items()]
    total = terms[0]
    for term in terms[1:]:
        total = total + term
    return total


def to_percent_scale(value: Column, low: float, high: float) -> Column:
    """Map ``low..high`` to 0..100 and clamp what lies outside."""
    scaled = (value - F.lit(float(low))) / F.lit(float(high - low)) * F.lit(100.0)
    clamped = F.least(F.lit(100.0), F.greatest(F.lit(0.0), scaled))
    return F.when(value.isNotNull(), clamped)
