"""Named bins over a number line."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F


def bin_right_closed(value: Column, edges: Sequence[float], names: Sequence[str]) -> Column:
    """Bins ``(edge, next edge]``; a value outside all of them, or NULL, has no bin."""
    if len(edges) != len(names) + 1:
        raise ValueError("one more edge than names is needed")
    chain = F.when(value <= F.lit(float(edges[0])), F.lit(None).cast("string"))
    for name, upper in zip(names, edges[1:]):
        chain = chain.when(value <= F.lit(float(upper)), F.lit(name))
    return chain


def bin_left_closed(
    value: Column, cuts: Sequence[float], names: Sequence[str], null_to_top: bool = False
) -> Column:
    """Bins ``[cut, next cut)`` without outer limits.

    NULL has no bin, unless ``null_to_top`` asks for the top one.
    """
    if len(cuts) != len(names) - 1:
        raise ValueError("one cut fewer than names is needed")
    chain = F.when(value < F.lit(float(cuts[0])), F.lit(names[0]))
    for name, upper in zip(names[1:], cuts[1:]):
        chain = chain.when(value < F.lit(float(upper)), F.lit(name))
    top = F.lit(names[-1])
    return chain.otherwise(top) if null_to_top else chain.when(value.isNotNull(), top)
