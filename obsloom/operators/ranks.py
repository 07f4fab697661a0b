"""Exact positions in an order, without sorting a group in one task.

A window over a label or a column puts all rows of the group into one task, and one group may hold a
third of the data. Here rows fall into ordered buckets first. Bucket sizes are counted with map-side
combining, running sums over the few bucket rows tell in which bucket a wanted rank lies, and only the
rows of those buckets are ordered. Copies are counted, not carried.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from obsloom.operators.sizes import measured

HASH_DIGITS = 4  # 65,536 buckets


def seeded_hash(key: Sequence[str], seed: int) -> Column:
    """A reproducible random order: md5 of the key and the seed, the same in any engine."""
    return F.md5(F.concat_ws("|", *[F.col(c).cast("string") for c in key], F.lit(str(seed))))


def rank_cuts(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[str],
    bucket: str,
    wanted: Column,
) -> DataFrame:
    """The order values found at wanted ranks of each group.

    ``bucket`` must not decrease along ``order``. ``wanted`` is an array<bigint> of 1-based ranks, an
    expression over ``group_n``, the size of the group. Returns ``by, group_n, rank, cut`` with ``cut``
    a struct of the order columns. ``by`` columns must not be NULL.
    """
    rows = df.select(*by, bucket, *order)
    whole = W.partitionBy(*by)
    before = whole.orderBy(bucket).rowsBetween(W.unboundedPreceding, -1)
    sizes = rows.groupBy(*by, bucket).agg(F.count("*").alias("bucket_n"))
    targets = (
        sizes.withColumn("bucket_before", F.coalesce(F.sum("bucket_n").over(before), F.lit(0)))
        .withColumn("group_n", F.sum("bucket_n").over(whole))
        .withColumn("ranks", F.array_distinct(wanted))
        .withColumn(
            "ranks",
            F.filter(
                "ranks",
                lambda r: (r > F.col("bucket_before")) & (r <= F.col("bucket_before") + F.col("bucket_n")),
            ),
        )
        .where(F.size("ranks") > 0)
        .drop("bucket_n")
    )
    running = W.partitionBy(*by, bucket).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    return (
        rows.join(measured(targets), [*by, bucket])
        .groupBy(*by, bucket, *order)
        .agg(
            F.count("*").alias("copies"),
            F.first("bucket_before").alias("bucket_before"),
            F.first("group_n").alias("group_n"),
            F.first("ranks").alias("ranks"),
        )
        .withColumn("upto", F.col("bucket_before") + F.sum("copies").over(running))
        .select(
            *by,
            "group_n",
            F.explode(
                F.filter("ranks", lambda r: (r <= F.col("upto")) & (r > F.col("upto") - F.col("copies")))
            ).alias("rank"),
            F.struct(*order).alias("cut"),
        )
    )


def seeded_cuts(df: DataFrame, by: Sequence[str], key: Sequence[str], seed: int, wanted: Column) -> DataFrame:
    """:func:`rank_cuts` in the order of :func:`seeded_hash`, ties by ``key``."""
    hashed = df.select(*by, *key, seeded_hash(key, seed).alias("__hash"))
    hashed = hashed.withColumn("__bucket", F.substring("__hash", 1, HASH_DIGITS))
    return rank_cuts(hashed, by, ["__hash", *key], "__bucket", wanted)


def cuts_passed(
    df: DataFrame, by: Sequence[str], key: Sequence[str], seed: int, wanted: Column, out: str
) -> DataFrame:
    """How many of the group's cuts lie before a row: 0 up to the first cut, and so on.

    Each group has one short array of cuts; as long as Spark broadcasts them the rows are not shuffled.
    """
    cuts = (
        seeded_cuts(df, by, key, seed, wanted)
        .groupBy(*by)
        .agg(F.sort_array(F.collect_list("cut")).alias("__cuts"))
    )
    position = F.struct(seeded_hash(key, seed).alias("__hash"), *[F.col(c) for c in key])
    passed = F.size(F.filter("__cuts", lambda cut: cut < position))
    return (
        df.join(measured(cuts), list(by), "left")
        .withColumn(out, F.when(F.col("__cuts").isNull(), F.lit(0)).otherwise(passed))
        .drop("__cuts")
    )


def value_edges(df: DataFrame, columns: Sequence[str], resolution: int) -> dict[str, list[float]]:
    """Roughly even split points per column; they balance work and never change a result."""
    steps = [i / resolution for i in range(1, max(resolution, 2))]
    row = df.agg(*[F.percentile_approx(c, steps, 10 * resolution).alias(c) for c in columns]).first()
    edges = {}
    for name in columns:
        points = sorted({float(p) for p in row[name] or []})
        edges[name] = [float("-inf"), *points, float("inf")]
    return edges


def in_bucket(df: DataFrame, column: str, edges: Sequence[float], out: str) -> DataFrame:
    """The number of the interval between ``edges`` that holds the value; binary search in the JVM."""
    if len(edges) < 3:
        return df.withColumn(out, F.lit(0.0))
    return Bucketizer(splits=list(edges), inputCol=column, outputCol=out, handleInvalid="keep").transform(df)


def running_totals(
    df: DataFrame, by: Sequence[str], order: str, values: Sequence[str], resolution: int = 1000
) -> DataFrame:
    """Add ``<value>_before`` and ``<value>_total`` for each value column.

    ``_before`` is the sum over smaller ``order`` values of the group. ``order`` must be a double
    without NULLs and unique in its group, so aggregate first.
    """
    bucketed = in_bucket(df, order, value_edges(df, [order], resolution)[order], "__bucket")
    whole = W.partitionBy(*by)
    before = whole.orderBy("__bucket").rowsBetween(W.unboundedPreceding, -1)
    parts = bucketed.groupBy(*by, "__bucket").agg(*[F.sum(v).alias(v) for v in values])
    offsets = parts.select(
        *by,
        "__bucket",
        *[F.coalesce(F.sum(v).over(before), F.lit(0)).alias(f"__{v}_offset") for v in values],
        *[F.sum(v).over(whole).alias(f"{v}_total") for v in values],
    )
    inside = W.partitionBy(*by, "__bucket").orderBy(order).rowsBetween(W.unboundedPreceding, -1)
    joined = bucketed.join(offsets, [*by, "__bucket"])
    for v in values:
        joined = joined.withColumn(
            f"{v}_before", F.col(f"__{v}_offset") + F.coalesce(F.sum(v).over(inside), F.lit(0))
        )
    return joined.drop("__bucket", *[f"__{v}_offset" for v in values])

