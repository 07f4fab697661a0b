"""Hourly observations seen through the ``events`` table.

The expressions are plain SQL that Spark and DuckDB read alike; only the access to the JSON text
differs. Each stage lists (name, expression) and is one projection without a shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from obsloom.plans.registry import table

BASE = [
    ("event_id", "event_id"),
    ("ts", "ts"),
    ("user_id", "user_id"),
    ("event_type", "event_type"),
    ("c", "cast(round(value * 100) as bigint)"),
    ("k", "cast({json_k} as bigint)"),
]
PEAK = "12 + cast(c % 3000 as double) / cast(100 as double)"
OBSERVATION = [
    ("obs_id", "event_id"),
    ("time", "ts"),
    ("city", "concat('city_', cast(user_id as varchar(20)))"),
    ("province", "concat('prov_', cast(user_id % 10 as varchar(20)))"),
    ("region", "case user_id % 4 when 0 then 'north' when 1 then 'central' when 2 then 'south' else 'unknown' end"),
    ("temp_max", "tmax"),
    ("temp_min", "tmax - (2 + k % 9)"),
    ("temperature", "tmax - cast((2 + k % 9) as double) / cast(2 as double)"),
    ("humidity", "case when k % 10 = 0 then null else cast(k as double) end"),
    ("pressure", "cast(990 + event_id % 40 as double)"),
    ("wind_speed", "cast((c * 7) % 4500 as double) / cast(100 as double)"),
    ("wind_gust", "cast((c * 11) % 6000 as double) / cast(100 as double)"),
    ("wind_direction", "cast((event_id * 37) % 360 as double)"),
    (
        "precipitation",
        "case when event_type in ('error', 'purchase') "
        "then cast((c * 3) % 800 as double) / cast(10 as double) else cast(0 as double) end",
    ),
    ("cloudcover", "cast((k * 7) % 101 as double)"),
    ("visibility", "cast(1 + c % 10 as double)"),
    ("weather_main", "case when k % 17 = 0 then null else event_type end"),
    (
        "is_day_raw",
        "case k % 6 when 0 then 'TRUE' when 1 then ' 1 ' when 2 then 'f' when 3 then 'No' when 4 then null "
        "else 'maybe' end",
    ),
    ("reading_raw", "case when event_id % 23 = 0 then 'n/a' else cast(c as varchar(20)) end"),
]
COLUMNS = [name for name, _ in OBSERVATION]


def _select(stage: list[tuple[str, str]], **parts: str) -> list[str]:
    return [f"{expression.format(**parts) if parts else expression} as {name}" for name, expression in stage]


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per observation, with the irregularities of real feeds."""
    return (
        table(spark, sf_dir, "events")
        .selectExpr(*_select(BASE, json_k="get_json_object(props, '$.k')"))
        .selectExpr("*", f"{PEAK} as tmax")
        .selectExpr(*_select(OBSERVATION))
    )


def over_observations(body: str, *named: str) -> str:
    """DuckDB text: the observations as ``obs``, further named parts, then ``body``."""
    base = ", ".join(_select(BASE, json_k="json_extract(props, '$.k')"))
    parts = [
        f"b as (select {base} from events)",
        f"t as (select *, {PEAK} as tmax from b)",
        f"obs as (select {', '.join(_select(OBSERVATION))} from t)",
        *named,
    ]
    return "with " + ",\n".join(parts) + "\n" + body
