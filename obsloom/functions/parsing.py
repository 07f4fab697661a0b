"""Tolerant reading of text: what cannot be read becomes NULL."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The spellings that count as a truth value.
TRUE_WORDS = ("1", "true", "t", "yes")
FALSE_WORDS = ("0", "false", "f", "no")


def to_double(value: Column, digits: int | None = None) -> Column:
    number = value.try_cast("double")
    return number if digits is None else F.round(number, digits)


def to_int(value: Column, kind: str = "int") -> Column:
    """Whole numbers, also from text such as ``12.0``; a fraction is cut off."""
    return F.coalesce(value.try_cast(kind), value.try_cast("double").try_cast(kind))


def to_boolean(value: Column) -> Column:
    """Read the usual spellings whatever their case and padding, else try a plain cast."""
    word = F.lower(F.trim(value.cast("string")))
    return (
        F.when(word.isin(*TRUE_WORDS), F.lit(True))
        .when(word.isin(*FALSE_WORDS), F.lit(False))
        .otherwise(value.cast("string").try_cast("boolean"))
    )
