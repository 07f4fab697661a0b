"""Row filters. All of them are narrow and reach the scan as pushed filters where the source can."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def outside(value: Column, low: Column | float, high: Column | float) -> Column:
    """Below ``low`` or above ``high``; false for NULL."""
    return F.coalesce((value < low) | (value > high), F.lit(False))


def complete_rows(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Rows without a NULL in ``subset``."""
    return df.dropna(subset=list(subset) if subset else None)


def failed_casts(df: DataFrame, column: str, data_type: str = "double") -> DataFrame:
    """Rows whose text is there but cannot be read as ``data_type``."""
    return df.where(F.col(column).isNotNull() & F.col(column).try_cast(data_type).isNull())


def split_by(df: DataFrame, key: str, values: Sequence[str]) -> dict[str, DataFrame]:
    """One lazy frame per listed value; rows with other values are in none."""
    return {value: df.where(F.col(key) == value) for value in values}


def in_time_range(df: DataFrame, time: str, start: str, end: str, date_partition: str | None = None) -> DataFrame:
    """Rows from ``start`` to ``end``, both included.

    With ``date_partition`` the day range is added as well, so that only those folders are read.
    """
    kind = df.schema[time].dataType
    first, last = F.lit(start).cast(kind), F.lit(end).cast(kind)
    kept = df.where(F.col(time).between(first, last))
    if date_partition:
        kept = kept.where(F.col(date_partition).between(F.lit(start).cast("date"), F.lit(end).cast("date")))
    return kept


def informative_columns(df: DataFrame, columns: Sequence[str]) -> list[str]:
    """Columns with more than one distinct value, found from one min/max aggregate."""
    ends = df.agg(*[F.struct(F.min(c).alias("lo"), F.max(c).alias("hi")).alias(c) for c in columns]).first()
    return [c for c in columns if ends[c]["lo"] is not None and ends[c]["lo"] != ends[c]["hi"]]
