"""Baskets of items and labels made from them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F


def basket(items: Sequence[Column]) -> Column:
    """A sorted array of the distinct items that are not NULL."""
    return F.sort_array(F.array_compact(F.array_distinct(F.array(*items))))


def prefixed(prefix: str, value: Column) -> Column:
    """``prefix`` + value; NULL stays NULL."""
    return F.concat(F.lit(prefix), value.cast("string"))


def any_in(items: Column, wanted: Sequence[str]) -> Column:
    return F.exists(items, lambda item: item.isin(list(wanted)))


def short_label(items: Column, keep: int = 3, sep: str = "+") -> Column:
    """The first ``keep`` items in order, and how many more there are."""
    ordered = F.sort_array(items)
    more = F.size(items) - F.lit(keep)
    head = F.array_join(F.slice(ordered, 1, keep), sep)
    return F.when(more > 0, F.concat(head, F.lit(sep), more.cast("string"), F.lit("more"))).otherwise(head)


def name_category(name: Column, groups: Sequence[tuple[str, Sequence[str]]], default: str) -> Column:
    """The first group of which one part occurs in ``name``."""
    chain = None
    for category, parts in groups:
        hit = F.lit(False)
        for part in parts:
            hit = hit | name.contains(part)
        chain = F.when(hit, F.lit(category)) if chain is None else chain.when(hit, F.lit(category))
    return chain.otherwise(F.lit(default)) if chain is not None else F.lit(default)
