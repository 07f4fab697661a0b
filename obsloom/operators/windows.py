"""Earlier readings of the same entity, for entities of any size.

``lag`` needs the rows of an entity in order. A window over the entity gives them, but all in one task. Here
all rows are cut into ranges of the whole order, entity first; a row takes its value from its own range or,
near the range's start, from the last rows of the ranges before, a table with a handful of rows per range.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window as W, functions as F

from obsloom.operators.ranges import cut_points, default_ranges, range_number

RANGE = "__range"


def add_lags(
    df: DataFrame,
    values: Mapping[str, str],
    key: str,
    order: Sequence[str],
    offset: int = 1,
    ranges: int | None = None,
) -> DataFrame:
    """For each ``out: column`` the value ``offset`` rows earlier in the same entity.

    ``order`` must be a total order within an entity: end it with a unique column. Its columns may have any
    type that sorts; NULL comes first. A NULL key is an entity of its own. ``ranges`` says into how many
    pieces the rows are cut and never changes a result.
    """
    whole = [key, *order]
    cuts = cut_points(df, whole, ranges or default_ranges(df))
    placed = df.withColumn(RANGE, range_number(df, whole, cuts))

    inside = W.partitionBy(RANGE).orderBy(*whole)
    backwards = W.partitionBy(RANGE).orderBy(*[F.desc(c) for c in whole])
    entity = F.struct(F.col(key).alias("key"))
    carried = F.struct(entity.alias("entity"), *[F.col(c).alias(f"v{i}") for i, c in enumerate(values.values())])

    tails = (
        placed.select(RANGE, carried.alias("__carried"), F.row_number().over(backwards).alias("__back"))
        .where(F.col("__back") <= offset)
        .groupBy(RANGE)
        .agg(F.sort_array(F.collect_list(F.struct((-F.col("__back")).alias("at"), "__carried"))).alias("__tail"))
    )
    earlier = W.orderBy(RANGE).rowsBetween(-offset, -1)
    tails = tails.select(
        F.col(RANGE).alias("__tail_range"),
        F.transform(F.flatten(F.collect_list("__tail").over(earlier)), lambda x: x["__carried"]).alias("__earlier"),
    )
    numbered = placed.withColumn("__row", F.row_number().over(inside)).withColumn("__own", F.lag(carried, offset).over(inside))
    joined = numbered.join(tails, F.col(RANGE) == F.col("__tail_range"))
    back = F.lit(offset) - F.col("__row") + 1
    outside = F.when(F.size("__earlier") >= back, F.get("__earlier", F.size("__earlier") - back))
    found = joined.withColumn("__found", F.when(F.col("__row") > offset, F.col("__own")).otherwise(outside))
    same = F.col("__found.entity") == entity
    lagged = {out: F.when(same, F.col("__found")[f"v{i}"]) for i, out in enumerate(values)}
    kept = [c for c in df.columns if c not in lagged]
    return found.select(*kept, *[value.alias(out) for out, value in lagged.items()])
