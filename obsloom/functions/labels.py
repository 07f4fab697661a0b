"""First-match rule labels and flags."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

Rule = tuple[str, Column]


def label(rules: Sequence[Rule], default: str) -> Column:
    """The name of the first rule that holds; a NULL condition does not hold."""
    if not rules:
        return F.lit(default)
    (name, condition), *rest = rules
    chain = F.when(condition, F.lit(name))
    for name, condition in rest:
        chain = chain.when(condition, F.lit(name))
    return chain.otherwise(F.lit(default))


def positive_flag(value: Column) -> Column:
    """1 when the value is above zero, else 0 (also for NULL)."""
    return F.when(value > 0, F.lit(1)).otherwise(F.lit(0))


def positive_name(value: Column, yes: str, no: str) -> Column:
    return F.when(value > 0, F.lit(yes)).otherwise(F.lit(no))


def contains_any(text: Column, parts: Sequence[str]) -> Column:
    """Does the trimmed, lower-cased text contain any of ``parts``?"""
    cleaned = F.lower(F.trim(text))
    found = F.lit(False)
    for part in parts:
        found = found | cleaned.contains(part)
    return found
