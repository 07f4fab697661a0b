"""Direction in degrees as a point on the unit circle."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def angle_parts(degrees: Column, digits: int = 4) -> tuple[Column, Column]:
    """(sine, cosine), rounded the same way for batch features and for scoring."""
    radians = F.radians(degrees)
    return F.round(F.sin(radians), digits), F.round(F.cos(radians), digits)
