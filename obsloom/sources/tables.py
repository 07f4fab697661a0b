"""Catalog tables by day, and loads that can be repeated."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F, types as T

from obsloom.operators.sizes import measured
from obsloom.session import checkpointed

EVENT_DATE = "event_date"
LOAD = "load_id"


def create_namespace(spark: SparkSession, name: str, location: str | None = None) -> None:
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {name}{place}")


def create_table(
    spark: SparkSession, name: str, schema: T.StructType, provider: str = "parquet", location: str | None = None
) -> None:
    """Create a table with the given columns, partitioned by the day of its rows.

    The day is a column of its own, since the session catalog has no partition transforms.
    """
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}, {EVENT_DATE} date) USING {provider} "
        f"PARTITIONED BY ({EVENT_DATE}){place}"
    )


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.read.table(name)


def with_event_date(df: DataFrame, time: str) -> DataFrame:
    return df.withColumn(EVENT_DATE, F.to_date(F.col(time)))


def by_day(df: DataFrame) -> DataFrame:
    """Bring the rows of a day together before a write, so that a task writes few files.

    Adaptive execution sizes the pieces: days that are small share a task, a large day is split.
    """
    return df.hint("rebalance", F.col(EVENT_DATE))


def append_table(df: DataFrame, name: str, time: str) -> None:
    """Append by column order of the table."""
    target = df.sparkSession.read.table(name).columns
    by_day(with_event_date(df, time).select(*target)).write.mode("append").insertInto(name)


def newest_by_key(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key, the last by ``order``; cut down before the shuffle as well, so copies do not travel."""
    newest = W.partitionBy(*key).orderBy(*[F.desc(c) for c in order])
    return df.withColumn("__place", F.row_number().over(newest)).where("__place = 1").drop("__place")


def load_newest(df: DataFrame, path: str, key: Sequence[str], time: str, order: Sequence[str], load_id: str) -> None:
    """Merge rows into a folder by day; for each key the newest load's reading stays.

    Loads are as old as their ids sort, so a correction in a later load replaces the reading, and a load
    that is run again, at once or late, changes nothing. Only the days that the load touches are read, and
    only their partitions are written. Within a load the last row by ``order`` stays.
    """
    spark = df.sparkSession
    new = with_event_date(df, time).withColumn(LOAD, F.lit(load_id))
    days = measured(new.select(EVENT_DATE).distinct())
    ends = days.agg(F.min(EVENT_DATE).alias("first"), F.max(EVENT_DATE).alias("last")).first()
    try:
        held = spark.read.parquet(path)
    except AnalysisException:
        held = None
    if held is not None:
        # two literals prune the folders; which days between them are at hand says the table of days
        near = F.col(EVENT_DATE).isNull()
        if ends["first"] is not None:
            near = near | F.col(EVENT_DATE).between(F.lit(ends["first"]), F.lit(ends["last"]))
        same = held[EVENT_DATE].eqNullSafe(days[EVENT_DATE])
        new = new.unionByName(held.where(near).join(days, same, "left_semi").select(*new.columns))
    # the table is read and written: the merged days are cut off from it first
    merged = checkpointed(newest_by_key(new, [*key, EVENT_DATE], [LOAD, *order]))
    (
        by_day(merged)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(EVENT_DATE)
        .parquet(path)
    )


def read_loads(spark: SparkSession, path: str, load_id: str | None = None) -> DataFrame:
    """The rows of a folder that loads are merged into, or what is left there of one load."""
    rows = spark.read.parquet(path)
    return (rows if load_id is None else rows.where(F.col(LOAD) == load_id)).drop(LOAD)

