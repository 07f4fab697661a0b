"""Calendar parts of an observation time."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def calendar_parts(time: Column) -> dict[str, Column]:
    """Hour, day of month, month and weekday (Monday = 0)."""
    return {
        "hour": F.hour(time),
        "day": F.dayofmonth(time),
        "month": F.month(time),
        "weekday": F.weekday(time),
    }


def month_start(time: Column) -> Column:
    return F.trunc(F.to_date(time), "month")


def parse_time(text: Column, fmt: str | None = None) -> Column:
    """Text to timestamp; unreadable text becomes NULL and does not stop the job."""
    return F.try_to_timestamp(text, F.lit(fmt)) if fmt else F.try_to_timestamp(text)
