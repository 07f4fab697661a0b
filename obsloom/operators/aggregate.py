"""Group reports. Every one is a partial and a final aggregate around one shuffle of the partials."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from obsloom.functions.rounding import half_up
from obsloom.operators.joins import with_group_count


def group_count(df: DataFrame, keys: Sequence[str], out: str = "n") -> DataFrame:
    """Rows per group, largest first, ties by key."""
    return df.groupBy(*keys).agg(F.count("*").alias(out)).orderBy(F.desc(out), *keys)


def group_mean(
    df: DataFrame, keys: Sequence[str], columns: Sequence[str], digits: int | None = 2, prefix: str = "avg_"
) -> DataFrame:
    """Mean of several columns per group, rounded when ``digits`` is given."""
    means = []
    for name in columns:
        mean = F.avg(name)
        means.append((mean if digits is None else half_up(mean, digits)).alias(f"{prefix}{name}"))
    return df.groupBy(*keys).agg(*means)


def agg_topn(
    df: DataFrame, keys: Sequence[str], aggregates: Sequence[Column], order: Sequence[Column | str], n: int, place: str | None = None
) -> DataFrame:
    """Rollup, order, first ``n``: a top-k per partition, then of those. Ties go by key.

    With ``place`` the rows are numbered in their order, so that it outlives a later shuffle.
    """
    top = df.groupBy(*keys).agg(*aggregates).orderBy(*order, *keys).limit(n)
    if place is None:
        return top
    return top.withColumn(place, F.row_number().over(W.orderBy(*order, *keys)).cast("bigint")).orderBy(place)


def with_share(
    counts: DataFrame, count: str, within: Sequence[str] = (), digits: int = 2, out: str = "pct"
) -> DataFrame:
    """Percent of the total, or of the total within a group; for frames of counts, one row per class."""
    total = F.sum(count).over(W.partitionBy(*within))
    return counts.withColumn(out, half_up(F.col(count) / total * 100, digits))


def class_balance(df: DataFrame, column: str, flag_above: float = 70.0) -> DataFrame:
    """``column, n, pct, majority_pct, imbalanced``."""
    counts = df.groupBy(column).agg(F.count("*").alias("n"))
    totals = counts.agg(F.sum("n").alias("__all"), F.max("n").alias("__most"))
    share = lambda n: half_up(F.col(n) / F.col("__all") * 100, 2)
    rows = counts.join(totals, how="cross").withColumn("pct", share("n")).withColumn("majority_pct", share("__most"))
    return rows.drop("__all", "__most").withColumn("imbalanced", F.col("majority_pct") > F.lit(flag_above))


def filled_counts(
    df: DataFrame, period: str, category: str, categories: Sequence[str] | None = None, out: str = "n"
) -> DataFrame:
    """Counts per period and category in long form, 0 where a pair does not occur.

    One pass when the categories are given; else all pairs come from the distinct periods and categories.
    """
    if categories is None:
        counts = df.groupBy(period, category).agg(F.count("*").alias(out))
        domain = counts.agg(F.array_compact(F.collect_set(category)).alias("__domain"))
        pairs = counts.select(period).distinct().join(domain, how="cross")
        pairs = pairs.select(F.col(period).alias("__period"), F.explode("__domain").alias("__category"))
        met = F.col(period).eqNullSafe(F.col("__period")) & (F.col(category) == F.col("__category"))
        return pairs.join(counts, met, "left").select(
            F.col("__period").alias(period), F.col("__category").alias(category), F.coalesce(out, F.lit(0).cast("bigint")).alias(out)
        )
    counted = [F.count_if(F.col(category) == c).alias(f"__{i}") for i, c in enumerate(categories)]
    entries = [
        F.struct(F.lit(c).alias(category), F.col(f"__{i}").alias(out)) for i, c in enumerate(categories)
    ]
    return df.groupBy(period).agg(*counted).select(period, F.inline(F.array(*entries)))


def matrix(
    df: DataFrame,
    row: str,
    column: str,
    values: Sequence[object],
    aggregate: Column,
    prefix: str = "",
) -> DataFrame:
    """One row per ``row`` value and one column per listed ``column`` value; NULL where nothing falls.

    The column values are given, so Spark need not look for them first.
    """
    pivoted = df.groupBy(row).pivot(column, list(values)).agg(aggregate)
    return pivoted.withColumnsRenamed({str(v): f"{prefix}{v}" for v in values})


def profile_by(
    df: DataFrame, key: Column, key_name: str, columns: Sequence[str], digits: int = 2, prefix: str = "avg_"
) -> DataFrame:
    """Means of several columns by a derived key such as the hour of day or the month."""
    return group_mean(df.withColumn(key_name, key), [key_name], columns, digits, prefix)


def time_span(df: DataFrame, time: str) -> DataFrame:
    return df.agg(
        F.min(time).alias("first_time"),
        F.max(time).alias("last_time"),
        F.countDistinct(time).alias("distinct_times"),
    )


def distinct_values(df: DataFrame, key: str) -> DataFrame:
    return df.select(key).distinct().orderBy(key)


def members(df: DataFrame, group: str, member: str) -> DataFrame:
    """``group, member, n_members``, one row per member: a group's members never meet in one cell."""
    return with_group_count(df.select(group, member).distinct(), [group], "n_members")


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by column name; a column that a frame lacks is NULL in its rows."""
    if not frames:
        raise ValueError("nothing to unite")
    united = frames[0]
    for frame in frames[1:]:
        united = united.unionByName(frame, allowMissingColumns=True)
    return united


def distinct_rows(df: DataFrame) -> DataFrame:
    return df.distinct()

