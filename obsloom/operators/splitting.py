"""Samples, splits and folds that come out the same on any number of machines.

The order is a hash of the row's key and a seed, not ``rand()``. A split needs only the position of its
cut in that order, so the rows themselves are not shuffled. ``key`` must name a row uniquely.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from obsloom.operators.ranks import cuts_passed, seeded_hash

STRATUM = "__stratum"


def stratum(columns: Sequence[str]) -> Column:
    """The columns' values side by side: a struct groups and joins with NULL as a value like any other."""
    return F.struct(*[F.col(c).alias(f"s{i}") for i, c in enumerate(columns)]) if columns else F.struct(F.lit(0).alias("s0"))


def tested_rows(group_n: Column, train_ratio: float) -> Column:
    """Rows of a stratum that the training leaves over; of two rows or more each side gets one."""
    left_over = group_n - F.floor(group_n * F.lit(float(train_ratio)))
    clamped = F.least(F.greatest(left_over, F.lit(1)), group_n - 1)
    return F.greatest(clamped, F.lit(0)).cast("bigint")


def mark_split(
    df: DataFrame,
    strata: Sequence[str],
    key: Sequence[str],
    train_ratio: float = 0.8,
    seed: int = 42,
    out: str = "split",
) -> DataFrame:
    """Every row with ``train`` or ``test``, in exact proportion within each stratum."""
    marked = cuts_passed(
        df.withColumn(STRATUM, stratum(strata)),
        [STRATUM],
        key,
        seed,
        F.array(F.col("group_n") - tested_rows(F.col("group_n"), train_ratio)),
        "__passed",
    )
    return marked.withColumn(out, F.when(F.col("__passed") == 0, "train").otherwise("test")).drop(
        STRATUM, "__passed"
    )


def split(
    df: DataFrame, strata: Sequence[str], key: Sequence[str], train_ratio: float = 0.8, seed: int = 42
) -> tuple[DataFrame, DataFrame]:
    marked = mark_split(df, strata, key, train_ratio, seed, "__split")
    return tuple(marked.where(F.col("__split") == side).drop("__split") for side in ("train", "test"))


def mark_folds(
    df: DataFrame, strata: Sequence[str], key: Sequence[str], k: int = 3, seed: int = 42, out: str = "fold"
) -> DataFrame:
    """Fold 0..k-1 per row; within a stratum the folds differ by at most one row."""
    wanted = F.array(*[F.ceil(F.col("group_n") * F.lit(f) / F.lit(k)).cast("bigint") for f in range(1, k)])
    marked = cuts_passed(df.withColumn(STRATUM, stratum(strata)), [STRATUM], key, seed, wanted, out)
    return marked.withColumn(out, F.col(out).cast("int")).drop(STRATUM)


def bernoulli_sample(df: DataFrame, fraction: float, seed: int = 42) -> DataFrame:
    """Spark's own sample; depends on how the input is partitioned."""
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)


def hash_sample(df: DataFrame, key: Sequence[str], fraction: float, seed: int = 42) -> DataFrame:
    """The rows whose hash lies below ``fraction`` of the hash range: narrow and reproducible."""
    if fraction >= 1.0:
        return df
    bound = format(int(fraction * 2**32), "08x")
    return df.where(F.substring(seeded_hash(key, seed), 1, 8) < F.lit(bound))


def cap_rows(df: DataFrame, key: Sequence[str], max_rows: int, seed: int = 42) -> DataFrame:
    """Exactly ``max_rows`` rows by seeded order when there are more, else all.

    Meant for one use, a bound on the rows that a classifier is fitted on; evaluation takes all rows.
    """
    whole = df.withColumn(STRATUM, stratum([]))
    wanted = F.array(F.least(F.col("group_n"), F.lit(max_rows).cast("bigint")))
    marked = cuts_passed(whole, [STRATUM], key, seed, wanted, "__passed")
    return marked.where(F.col("__passed") == 0).drop(STRATUM, "__passed")
