"""Ranges of an order, cut at sampled points, for work that needs rows in order but not in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from obsloom.operators.sizes import measured

#: Sampled rows for each range, and ranges for each shuffle partition.
SAMPLE, SPREAD = 16, 4
#: Different hashes by which rows are sampled.
HASHES = 1 << 62


def default_ranges(df: DataFrame) -> int:
    return SPREAD * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def cut_points(df: DataFrame, order: Sequence[str], ranges: int) -> list[list]:
    """Values of ``order`` at which ranges end, in order: about every ``SAMPLE``-th row of a sample by hash.

    Every row is as likely as any other to be sampled, whatever the size of the table and the order in which
    it is read; the share follows from the number of rows, so about ``ranges * SAMPLE`` rows reach the driver.
    Equal rows share a hash, so the hash also takes in where a row was read. The cuts balance the work; nothing
    that is computed in the ranges may depend on them.
    """
    rows = df.select(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order)])
    share = min(1.0, ranges * SAMPLE / max(1, rows.count()))
    hashed = F.xxhash64(*rows.columns, F.monotonically_increasing_id()).bitwiseAND(F.lit(HASHES - 1))
    sample = rows.where(hashed < F.lit(int(share * HASHES))).orderBy(*rows.columns).collect()
    step = max(1, len(sample) // ranges)
    return [list(row) for row in sample[step::step]]


def range_number(df: DataFrame, order: Sequence[str], cuts: list[list]) -> Column:
    """How many cut points are not above the row's ``order``, found by bisection; NULL is lowest."""
    if not cuts:
        return F.lit(0)
    kinds = [df.schema[c].dataType for c in order]
    table = F.array(*[F.struct(*[F.lit(v).cast(kind).alias(f"o{i}") for i, (v, kind) in enumerate(zip(cut, kinds))]) for cut in cuts])
    place = F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order)])

    def halve(span: Column, _: Column) -> Column:
        middle = F.shiftright(span["low"] + span["high"], 1)
        is_open, above = span["low"] < span["high"], F.get(table, middle) <= place
        return F.struct(
            F.when(is_open & above, middle + 1).otherwise(span["low"]).alias("low"),
            F.when(is_open & ~above, middle).otherwise(span["high"]).alias("high"),
        )

    steps = F.sequence(F.lit(1), F.lit(len(cuts).bit_length()))
    start = F.struct(F.lit(0).alias("low"), F.lit(len(cuts)).alias("high"))
    # never null, and said to be so: a join on the number would else filter the rows by a second bisection
    return F.coalesce(F.aggregate(steps, start, halve, lambda span: span["low"]), F.lit(0))


def with_place(df: DataFrame, order: Sequence[str], out: str = "place") -> DataFrame:
    """``df`` with the place, from 1, of each row in ``order``, which must be a total order; NULL comes first.

    Rows are numbered in ranges of the order; what lies before a range is a sum over one row per range.
    """
    cuts = cut_points(df, order, default_ranges(df))
    ranged = df.withColumn("__range", range_number(df, order, cuts))
    ahead = W.orderBy("__range").rowsBetween(W.unboundedPreceding, -1)
    sizes = ranged.groupBy("__range").agg(F.count("*").alias("__n"))
    before = sizes.select("__range", F.coalesce(F.sum("__n").over(ahead), F.lit(0)).alias("__before"))
    inside = F.row_number().over(W.partitionBy("__range").orderBy(*order))
    return ranged.withColumn("__at", inside).join(measured(before), "__range").select(*df.columns, (F.col("__before") + F.col("__at")).alias(out))
