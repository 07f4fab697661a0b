"""Quantiles: approximate in one pass, or exact without holding a column in one task."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window as W

from obsloom.operators.sizes import measured

#: Rank accuracy of the pass that narrows a quantile down; about 4 rows in so many are then looked at.
ACCURACY = 1000
#: Bytes of brackets that are sent to every executor, at most, and bytes that a bracket may take.
SENT, BRACKET = 32 << 20, 256


def quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: Sequence[float],
    by: Sequence[str] = (),
    accuracy: int | None = None,
    narrow: int = ACCURACY,
) -> DataFrame:
    """Long table ``by, column, q`` with ``q`` the values at ``probabilities``.

    With ``accuracy`` one pass of ``percentile_approx``. Otherwise exact, with linear interpolation between
    neighbours: approximate quantiles a little below and above each wanted rank enclose it for certain, so it
    is enough to count what lies below and to order the few values between.
    """
    probabilities = [float(p) for p in probabilities]
    if accuracy is None:
        return _exact(df, columns, probabilities, by, narrow)
    found = [
        F.percentile_approx(F.col(c).cast("double"), probabilities, accuracy).alias(f"__{i}") for i, c in enumerate(columns)
    ]
    entries = [F.struct(F.lit(c).alias("column"), F.col(f"__{i}").alias("q")) for i, c in enumerate(columns)]
    return df.groupBy(*by).agg(*found).select(*by, F.inline(F.array(*entries)))


def _exact(df: DataFrame, columns: Sequence[str], probabilities: list[float], by: Sequence[str], narrow: int) -> DataFrame:
    keys = [f"__by_{i}" for i in range(len(by))]
    values = [f"__v_{i}" for i in range(len(columns))]
    rows = df.select(
        F.struct(*[F.col(b).alias(k) for b, k in zip(by, keys)], F.lit(0).alias("__all")).alias("__group"),
        *[F.col(c).cast("double").alias(v) for c, v in zip(columns, values)],
    )
    margin = 2.0 / narrow
    ends = [max(0.0, p - margin) for p in probabilities] + [min(1.0, p + margin) for p in probabilities] + [0.0, 1.0]
    brackets = rows.groupBy("__group").agg(
        *[F.percentile_approx(v, ends, narrow).alias(f"{v}_ends") for v in values],
        *[F.count(v).alias(f"{v}_n") for v in values],
    )
    met, end, size = _bracketed(rows, brackets, values, bool(by))
    wanted = range(len(probabilities))

    # NaN is the largest number for Spark; it stays where an order puts it.
    def span(v: str, j: int) -> tuple[Column, Column]:
        # with few values a neighbour's rank may lie outside the margin, so they are all looked at
        few = size(v) <= 2 * narrow
        return (
            F.when(few, end(v, len(ends) - 2)).otherwise(end(v, j)),
            F.when(few, end(v, len(ends) - 1)).otherwise(end(v, j + len(probabilities))),
        )

    below = [F.count_if(F.col(v) < span(v, j)[0]).alias(f"{v}_{j}") for v in values for j in wanted]
    sizes = [F.count(v).alias(f"{v}_n") for v in values]
    counts = met.groupBy("__group").agg(*below, *sizes).select(
        "__group",
        F.inline(F.array(*[
            F.struct(F.lit(i).alias("c"), F.lit(j).alias("j"), F.col(f"{v}_{j}").alias("below"), F.col(f"{v}_n").alias("n"))
            for i, v in enumerate(values) for j in wanted
        ])),
    )
    near = F.array(*[
        F.when(
            (F.col(v) >= span(v, j)[0]) & (F.col(v) <= span(v, j)[1]),
            F.struct(F.lit(i).alias("c"), F.lit(j).alias("j"), F.col(v).alias("v")),
        )
        for i, v in enumerate(values) for j in wanted
    ])
    between = (
        met.select("__group", F.explode(F.filter(near, lambda x: x.isNotNull())).alias("x"))
        .groupBy("__group", "x.c", "x.j", "x.v").agg(F.count("*").alias("copies"))
    )
    running = W.partitionBy("__group", "c", "j").orderBy("v").rowsBetween(W.unboundedPreceding, 0)
    placed = between.withColumn("upto", F.sum("copies").over(running)).join(counts.filter("n > 0"), ["__group", "c", "j"])
    p = F.array(*map(F.lit, probabilities))[F.col("j")]
    place = p * (F.col("n") - 1)
    low, high = F.floor(place) + 1, F.ceil(place) + 1
    last, first = F.col("below") + F.col("upto"), F.col("below") + F.col("upto") - F.col("copies")

    def at(rank: Column) -> Column:
        return F.max(F.when((rank > first) & (rank <= last), F.col("v")))

    found = placed.groupBy("__group", "c", "j").agg(at(low).alias("low"), at(high).alias("high"), F.first(place).alias("place"))
    over = F.col("place") - F.floor("place")
    value = F.when(over == 0, F.col("low")).otherwise((F.ceil("place") - F.col("place")) * F.col("low") + over * F.col("high"))
    gathered = found.groupBy("__group", "c").agg(F.sort_array(F.collect_list(F.struct("j", value.alias("q")))).alias("found"))
    names = F.array(*map(F.lit, columns))
    return gathered.select(
        *[F.col(f"__group.{k}").alias(b) for b, k in zip(by, keys)],
        F.get(names, F.col("c")).alias("column"),
        F.transform("found", lambda x: x["q"]).alias("q"),
    )


def _bracketed(
    rows: DataFrame, brackets: DataFrame, values: Sequence[str], grouped: bool
) -> tuple[DataFrame, Callable[[str, int], Column], Callable[[str], Column]]:
    """The rows, and how to name a bracket's ends and its column's size next to a row.

    Without groups the brackets are one row of numbers and stand in the plan as literals. Brackets of groups are
    written first: while their number keeps them within ``SENT`` bytes they are sent to the rows, which then stay
    where they are; with more groups than that, groups are small next to the table and rows meet them by a shuffle.
    """
    if not grouped:
        row = brackets.first()
        ends = {v: (row[f"{v}_ends"] if row else None) for v in values}
        return (
            rows,
            lambda v, i: F.lit(ends[v][i] if ends[v] else None).cast("double"),
            lambda v: F.lit(row[f"{v}_n"] if row else 0),
        )
    side = measured(brackets)
    small = side.count() * len(values) * BRACKET <= SENT
    met = rows.join(F.broadcast(side) if small else side, "__group")
    return met, lambda v, i: F.col(f"{v}_ends")[i], lambda v: F.col(f"{v}_n")
