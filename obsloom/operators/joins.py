"""Joins of rows to their group or to a dimension.

Group values reach the rows by aggregate-then-join, not by a window: the aggregate combines before
its shuffle, and a hot key in the join is split by adaptive execution, where a window would put
all rows of the key into one task. Only groups with a natural bound, such as an entity's day, use one.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F


def with_group_values(df: DataFrame, keys: Sequence[str], aggregates: Sequence[Column]) -> DataFrame:
    """Every row with the aggregates of its group. NULL keys form a group of their own."""
    marks = [f"__key_{i}" for i in range(len(keys))]
    groups = df.groupBy(*[F.col(k).alias(m) for k, m in zip(keys, marks)]).agg(*aggregates)
    condition = F.lit(True)
    for key, mark in zip(keys, marks):
        condition = condition & F.col(key).eqNullSafe(F.col(mark))
    return df.join(groups, condition, "left").drop(*marks)


def with_group_count(df: DataFrame, keys: Sequence[str], out: str = "group_count") -> DataFrame:
    return with_group_values(df, keys, [F.count("*").alias(out)])


def with_daily_range(
    df: DataFrame, entity: str, time: str, high: str, low: str, out: str = "daily_range"
) -> DataFrame:
    """Highest ``high`` minus lowest ``low`` of the entity's day, on every row of that day.

    A day bounds the readings of an entity, so one window does it with one shuffle.
    """
    day = W.partitionBy(F.col(entity), F.to_date(F.col(time)))
    return df.withColumn(out, F.max(high).over(day) - F.min(low).over(day))


def latest_per_key(df: DataFrame, key: str, time: str) -> DataFrame:
    """The rows at each key's latest time; ties all stay."""
    latest = df.where(F.col(time).isNotNull()).groupBy(key).agg(F.max(time).alias(time))
    return df.join(latest, [key, time], "left_semi")


def one_latest_per_key(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """One row per key, the last by ``order``; combined before the shuffle."""
    whole = F.struct(*[F.col(c) for c in df.columns])
    picked = df.groupBy(key).agg(F.max_by(whole, F.struct(*order)).alias("__row"))
    return picked.select("__row.*")


def lookup(
    df: DataFrame,
    key: str,
    mapping: Mapping[str, str] | DataFrame,
    out: str,
    default: str | None = None,
    value: str | None = None,
) -> DataFrame:
    """Add ``out`` from a dimension: a dict, or a frame with ``key`` and ``value`` columns.

    Keys that are not in the dimension get ``default``. A frame must have one row per key; Spark chooses
    the join by its size.
    """
    if isinstance(mapping, DataFrame):
        side = mapping.select(F.col(key).alias("__key"), F.col(value or out).alias("__value"))
    else:
        side = F.broadcast(
            df.sparkSession.createDataFrame(list(mapping.items()), "__key string, __value string")
        )
    found = F.col("__value") if default is None else F.coalesce(F.col("__value"), F.lit(default))
    joined = df.drop(out).join(side, F.col(key) == F.col("__key"), "left")
    return joined.withColumn(out, found).drop("__key", "__value")
