"""Rounding that does not depend on the order in which a sum was taken."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def half_up(value: Column, digits: int) -> Column:
    """Round half up to ``digits``.

    Distributed sums differ in their last bits from run to run, so a mean that is exactly x.xx5 may
    arrive as x.xx4999. Rounding six digits further out first takes that noise away.
    """
    return F.round(F.round(value, digits + 6), digits)
