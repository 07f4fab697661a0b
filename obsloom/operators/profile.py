"""Data quality profiles: a fixed number of passes however many columns there are."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from obsloom.functions.rounding import half_up
from obsloom.operators.conform import family
from obsloom.operators.quantiles import quantiles

SEP = "__of__"
#: Registers of a sketch of different values, as a power of two.
SKETCH_BITS = 12


def _long(row: DataFrame, columns: Sequence[str], parts: Sequence[str]) -> DataFrame:
    """Turn one wide row of ``part__of__column`` into a row per column."""
    entries = [
        F.struct(F.lit(c).alias("column"), *[F.col(f"`{p}{SEP}{c}`").alias(p) for p in parts]) for c in columns
    ]
    return row.select(F.inline(F.array(*entries)))


def _named(column: Column, part: str, of: str) -> Column:
    return column.alias(f"{part}{SEP}{of}")


def shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n_rows")).withColumn("n_columns", F.lit(len(df.columns)))


def null_audit(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``column, nulls, pct`` for every column, most NULLs first."""
    columns = list(columns or df.columns)
    counts = [_named(F.count_if(F.col(c).isNull()), "nulls", c) for c in columns]
    wide = df.agg(F.count("*").alias("__rows"), *counts)
    entries = [F.struct(F.lit(c).alias("column"), F.col(f"nulls{SEP}{c}").alias("nulls")) for c in columns]
    long = wide.select("__rows", F.inline(F.array(*entries)))
    share = half_up(F.col("nulls") / F.when(F.col("__rows") > 0, F.col("__rows")) * 100, 2)
    return long.select("column", "nulls", share.alias("pct")).orderBy(F.desc("nulls"), "column")


def duplicate_audit(df: DataFrame) -> DataFrame:
    """``total_rows, distinct_rows, duplicate_rows, duplicate_pct``; copies are combined before the shuffle."""
    copies = df.groupBy(*df.columns).agg(F.count("*").alias("__copies"))
    totals = copies.agg(
        F.coalesce(F.sum("__copies"), F.lit(0)).alias("total_rows"), F.count("*").alias("distinct_rows")
    )
    extra = F.col("total_rows") - F.col("distinct_rows")
    share = extra / F.when(F.col("total_rows") > 0, F.col("total_rows")) * 100
    return totals.withColumn("duplicate_rows", extra).withColumn("duplicate_pct", half_up(share, 2))


def as_text(df: DataFrame, name: str) -> Column:
    """The column's values as text, different ones as different texts."""
    kind, value = df.schema[name].dataType, F.col(name)
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        value = value + F.lit(0.0)  # minus zero is zero
    elif isinstance(kind, T.TimestampType):
        value = F.unix_micros(value)  # as text, the two instants of a repeated hour would be one
    elif isinstance(kind, (T.ArrayType, T.StructType, T.MapType)):
        value = F.when(value.isNotNull(), F.to_json(F.struct(value)))
    return value.cast("string")


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``column, value, n``: every column's values as text, counted across the cluster.

    Each column is one scan of itself alone whose values are combined before they are shuffled; no row is made
    for a cell. NULL has a row with ``n`` 0.
    """
    counted = [
        df.select(as_text(df, c).alias("value")).groupBy("value").agg(F.count("value").alias("n")).select(F.lit(c).alias("column"), "value", "n")
        for c in columns
    ]
    return reduce(DataFrame.unionAll, counted)


def distinct_sketches(df: DataFrame, columns: Sequence[str], by: Sequence[str]) -> DataFrame:
    """One row per group, by day for instance, with a sketch of each column's different values.

    Kept as a table, sketches of new groups are added as data come in, and :func:`merged_distincts` answers for any
    set of groups without the rows.
    """
    return df.groupBy(*by).agg(*[F.hll_sketch_agg(as_text(df, c), F.lit(SKETCH_BITS)).alias(c) for c in columns])


def merged_distincts(sketches: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """``by, column, distinct_n`` over all groups of :func:`distinct_sketches`, or by some of its columns.

    An estimate: with 4,096 registers the standard error is about 1.3 %, and a few hundred values are counted exactly.
    """
    merged = sketches.groupBy(*by).agg(*[F.hll_sketch_estimate(F.hll_union_agg(c)).alias(f"__{c}") for c in columns])
    entries = [F.struct(F.lit(c).alias("column"), F.col(f"__{c}").alias("distinct_n")) for c in columns]
    return merged.select(*by, F.inline(F.array(*entries)))


def _per_column(df: DataFrame, columns: Sequence[str], found: DataFrame, counts: Sequence[str]) -> DataFrame:
    """One row per column even when there are no rows."""
    names = df.sparkSession.createDataFrame([(c,) for c in columns], "column string")
    return names.join(found, "column", "left").fillna(0, list(counts))


def distinct_counts(df: DataFrame, columns: Sequence[str], rsd: float | None = None) -> DataFrame:
    """``column, distinct_n``; approximate with relative error ``rsd`` when given.

    Exact counts go column by column, where Spark's several distinct aggregates at once would repeat every row as wide
    as it is.
    """
    if rsd is not None:
        counts = [_named(F.approx_count_distinct(c, rsd), "distinct_n", c) for c in columns]
        return _long(df.agg(*counts), columns, ["distinct_n"])
    found = value_counts(df, columns).groupBy("column").agg(F.count("value").alias("distinct_n"))
    return _per_column(df, columns, found, ["distinct_n"])


def column_profile(df: DataFrame) -> DataFrame:
    """``column, family, non_null, distinct_n`` for every column."""
    counts = value_counts(df, df.columns).groupBy("column")
    found = counts.agg(F.sum("n").alias("non_null"), F.count("value").alias("distinct_n"))
    kind = F.lit(None).cast("string")
    for field in df.schema.fields:
        kind = F.when(F.col("column") == field.name, F.lit(family(field.dataType))).otherwise(kind)
    return _per_column(df, df.columns, found, ["non_null", "distinct_n"]).withColumn("family", kind)


def describe_long(df: DataFrame, columns: Sequence[str], digits: int = 6) -> DataFrame:
    """``column, n, mean, sd, min, max`` as doubles."""
    parts = []
    for name in columns:
        value = F.col(name).cast("double")
        parts += [
            _named(F.count(value), "n", name),
            _named(half_up(F.avg(value), digits), "mean", name),
            _named(half_up(F.stddev_samp(value), digits), "sd", name),
            _named(F.min(value), "min", name),
            _named(F.max(value), "max", name),
        ]
    return _long(df.agg(*parts), columns, ["n", "mean", "sd", "min", "max"])


def skewness_long(df: DataFrame, columns: Sequence[str], digits: int = 6) -> DataFrame:
    """Population skewness per column."""
    parts = [_named(half_up(F.skewness(F.col(c).cast("double")), digits), "skewness", c) for c in columns]
    return _long(df.agg(*parts), columns, ["skewness"])


def correlation(df: DataFrame, one: str, other: str, digits: int = 6) -> DataFrame:
    """Pearson correlation over rows that have both values."""
    both = df.select(one, other).dropna()
    return both.agg(half_up(F.corr(one, other), digits).alias("corr"), F.count("*").alias("n"))


def correlation_long(df: DataFrame, columns: Sequence[str], digits: int = 6) -> DataFrame:
    """``x, y, corr`` for every pair of columns, over complete rows, in one aggregate."""
    pairs = list(combinations(columns, 2))
    found = df.select(*columns).dropna().agg(
        *[half_up(F.corr(x, y), digits).alias(f"__{i}") for i, (x, y) in enumerate(pairs)]
    )
    entries = [
        F.struct(F.lit(x).alias("x"), F.lit(y).alias("y"), F.col(f"__{i}").alias("corr"))
        for i, (x, y) in enumerate(pairs)
    ]
    return found.select(F.inline(F.array(*entries)))


def correlation_matrix(df: DataFrame, columns: Sequence[str]):
    """The whole matrix from ``pyspark.ml`` (n columns squared numbers on the driver)."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.stat import Correlation

    assembler = VectorAssembler(inputCols=list(columns), outputCol="__v", handleInvalid="skip")
    vectors = assembler.transform(df.select(*columns).dropna()).select("__v")
    return Correlation.corr(vectors, "__v").first()[0].toArray()


def box_stats(
    df: DataFrame, columns: Sequence[str], accuracy: int | None = None, fence: float = 1.5, **exact: int
) -> DataFrame:
    """``column, min, q1, median, q3, max`` and whiskers clamped to the data."""
    found = quantiles(df, columns, [0.0, 0.25, 0.5, 0.75, 1.0], accuracy=accuracy, **exact)
    named = found.select(
        "column",
        *[F.element_at("q", i + 1).alias(n) for i, n in enumerate(["min", "q1", "median", "q3", "max"])],
    )
    reach = F.lit(fence) * (F.col("q3") - F.col("q1"))
    return named.withColumn("whisker_low", F.greatest("min", F.col("q1") - reach)).withColumn(
        "whisker_high", F.least("max", F.col("q3") + reach)
    )


def iqr_outliers(
    df: DataFrame,
    columns: Sequence[str],
    accuracy: int | None = None,
    fence: float = 1.5,
    flag_above: float = 5.0,
    **exact: int,
) -> DataFrame:
    """``column, q1, q3, outliers, pct, flagged``: quartiles first, then one count for all columns.

    The fences, two numbers per column, are put into the second pass as literals. A column without
    values is left out.
    """
    found = {r["column"]: r["q"] for r in quantiles(df, columns, [0.25, 0.75], accuracy=accuracy, **exact).collect()}
    present = [c for c in columns if found.get(c) and found[c][0] is not None]
    if not present:
        raise ValueError("no column has a value")
    counts, entries = [], []
    for name in present:
        q1, q3 = found[name]
        reach = fence * (q3 - q1)
        beyond = (F.col(name) < F.lit(q1 - reach)) | (F.col(name) > F.lit(q3 + reach))
        counts.append(_named(F.count_if(beyond), "outliers", name))
        entries.append(
            F.struct(
                F.lit(name).alias("column"),
                F.lit(q1).alias("q1"),
                F.lit(q3).alias("q3"),
                F.col(f"outliers{SEP}{name}").alias("outliers"),
            )
        )
    long = df.agg(F.count("*").alias("__rows"), *counts).select("__rows", F.inline(F.array(*entries)))
    pct = half_up(F.col("outliers") / F.col("__rows") * 100, 2)
    return (
        long.withColumn("pct", pct)
        .withColumn("flagged", F.col("pct") > F.lit(flag_above))
        .drop("__rows")
        .orderBy(F.desc("outliers"), "column")
    )


def histogram(df: DataFrame, columns: Sequence[str], bins: int = 40) -> DataFrame:
    """``column, bin, low, high, n`` with equal widths from minimum to maximum; empty bins stay.

    The last bin holds the maximum. A constant or empty column has no histogram. Two passes for any
    number of columns; the counts per bin are combined before the shuffle.
    """
    ends = df.agg(
        *[F.struct(F.min(c).cast("double").alias("lo"), F.max(c).cast("double").alias("hi")).alias(c) for c in columns]
    ).first()
    kept = [c for c in columns if ends[c]["lo"] is not None and ends[c]["lo"] < ends[c]["hi"]]
    if not kept:
        raise ValueError("every column is constant or empty")
    binned = []
    for name in kept:
        low, high = ends[name]["lo"], ends[name]["hi"]
        step = (high - low) / bins
        slot = F.least(F.floor((F.col(name).cast("double") - F.lit(low)) / F.lit(step)), F.lit(bins - 1))
        binned.append(F.struct(F.lit(name).alias("column"), slot.cast("int").alias("bin")))
    counted = (
        df.select(F.inline(F.array(*binned)))
        .where(F.col("bin").isNotNull())
        .groupBy("column", "bin")
        .agg(F.count("*").alias("n"))
    )
    frame = df.sparkSession.createDataFrame(
        [
            (c, i, ends[c]["lo"] + i * ((ends[c]["hi"] - ends[c]["lo"]) / bins),
             ends[c]["lo"] + (i + 1) * ((ends[c]["hi"] - ends[c]["lo"]) / bins))
            for c in kept
            for i in range(bins)
        ],
        "column string, bin int, low double, high double",
    )
    return frame.join(counted, ["column", "bin"], "left").fillna(0, ["n"])
