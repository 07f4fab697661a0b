"""Raw files to bronze, bronze to silver, silver to gold.

Each transform is one narrow projection over its input, so it works on a stream as well. A batch load
reads only what was ingested under its id, can be repeated, and replaces readings of earlier loads.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from obsloom.functions import parsing
from obsloom.functions.angles import angle_parts
from obsloom.functions.calendar import calendar_parts
from obsloom.functions.labels import positive_flag
from obsloom.functions.scaling import weighted_score
from obsloom.operators.conform import cast_columns, conform, fill_with, mirror_column
from obsloom.plans import weather
from obsloom.sources.files import read_raw_csv, with_lineage
from obsloom.sources.tables import LOAD, load_newest, read_loads

KEY = ["city", "time"]


def bronze_from_csv(spark: SparkSession, source: str, bronze: str, load_id: str) -> None:
    """Raw files, as text with lineage, to the load's own partition of the bronze folder."""
    rows = with_lineage(read_raw_csv(spark, source)).withColumn(LOAD, F.lit(load_id))
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(LOAD).parquet(bronze)


def to_silver(bronze: DataFrame, variant: str = "v2", null_to_top: bool = False) -> DataFrame:
    """Typed and derived columns in the silver layout.

    A derived column that the input brings is kept where it has a value. ``variant`` chooses the label
    and level rules.
    """
    df = mirror_column(bronze, "region", "province")
    if isinstance(df.schema["time"].dataType, T.StringType):
        df = df.withColumn("time", F.try_to_timestamp("time"))
    df = cast_columns(df, weather.MEASURED, "double", 2)
    df = cast_columns(df, weather.DERIVED, "double", 4)
    df = cast_columns(df, ["weather_code", "hour", "day", "month", "weekday", "rain"], "int")
    if "is_day" in df.columns and not isinstance(df.schema["is_day"].dataType, T.BooleanType):
        df = df.withColumn("is_day", parsing.to_boolean(F.col("is_day")))
    derived = dict(calendar_parts(F.col("time")))
    if {"temp_max", "temp_min"} <= set(df.columns):
        derived["temp_range"] = F.col("temp_max") - F.col("temp_min")
    if "wind_direction" in df.columns:
        derived["wind_dir_sin"], derived["wind_dir_cos"] = angle_parts(F.col("wind_direction"))
    if "precipitation" in df.columns:
        derived["rain"] = positive_flag(F.col("precipitation"))
    else:
        derived["rain"] = F.lit(0)
    df = fill_with(df, derived)
    known = set(df.columns)
    labels = {}
    if "extreme" not in known and {"temp_max", "wind_speed"} <= known:
        labels["extreme"] = weather.extreme(variant, "rain" if variant == "v2" else "precipitation")
    for name, column in weather.levels(variant, null_to_top).items():
        if name not in known and weather.LEVELS[name][0] in known:
            labels[name] = column
    df = df.withColumns(labels) if labels else df
    return conform(df.withColumn("update_at", F.current_timestamp()), weather.SILVER_SCHEMA)


def to_gold(silver: DataFrame) -> DataFrame:
    """The risk score per reading in the gold layout."""
    scored = silver.withColumn("risk_score", weighted_score(weather.RISK_WEIGHTS))
    return conform(scored.withColumn("update_at", F.current_timestamp()), weather.GOLD_SCHEMA)


def load_silver(spark: SparkSession, bronze: str, silver: str, load_id: str, variant: str = "v2") -> None:
    rows = to_silver(read_loads(spark, bronze, load_id), variant)
    load_newest(rows, silver, KEY, "time", _order(rows), load_id)


def load_gold(spark: SparkSession, silver: str, gold: str, load_id: str) -> None:
    rows = to_gold(read_loads(spark, silver, load_id))
    load_newest(rows, gold, KEY, "time", _order(rows), load_id)


def _order(df: DataFrame) -> list[str]:
    """All columns but the load stamp: which of several rows with one key stays is not left to chance."""
    return [c for c in df.columns if c not in ("update_at", *KEY)]
