"""Queries that go through files, tables and streams below the shared work folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from obsloom.operators.conform import columns
from obsloom.plans import medallion, weather
from obsloom.plans.observations import observations, over_observations
from obsloom.plans.registry import query, table
from obsloom.plans.sqltext import half_up_sql, label_v2_sql, levels_sql
from obsloom.session import work_path
from obsloom.sources import files, tables
from obsloom.streaming import ingest
from obsloom.streaming.lag import lag_stream

RAW = [
    "obs_id", "time", "city", "province", "temperature", "temp_min", "temp_max", "humidity", "precipitation",
    "cloudcover", "wind_speed", "wind_direction", "pressure", "is_day",
]


def raw_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings as a feed delivers them: time as text, truth values in any spelling."""
    return (
        observations(spark, sf_dir)
        .withColumnRenamed("is_day_raw", "is_day")
        .select(*RAW)
        .withColumn("time", F.date_format("time", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    )


@query(
    "csv_round_trip",
    over_observations(
        "select cast(obs_id as varchar) as obs_id, strftime(time, '%Y-%m-%d %H:%M:%S.%f') as time, city, "
        "cast(cast(pressure as bigint) as varchar) || '.0' as pressure from obs"
    ),
)
def csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Export, then scan as text."""
    path = work_path(spark, "csv")
    files.export_csv(raw_readings(spark, sf_dir).select("obs_id", "time", "city", "pressure"), path)
    return files.read_raw_csv(spark, path)


@query(
    "csv_mixed_headers",
    over_observations(
        "select cast(obs_id as varchar) as obs_id, case when region = 'north' then city end as city, "
        "case when region <> 'north' then province end as province from obs"
    ),
)
def csv_mixed_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    north, other = work_path(spark, "csv-north"), work_path(spark, "csv-other")
    df = observations(spark, sf_dir)
    files.export_csv(df.where("region = 'north'").select("obs_id", "city"), north)
    files.export_csv(df.where("region <> 'north'").select("province", "obs_id"), other)
    return files.read_mixed_csv(spark, [north, other])


@query("parquet_scan", "select l_orderkey, l_quantity from lineitem where l_quantity > 45")
def parquet_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = files.read_parquet(spark, f"{sf_dir}/lineitem.parquet")
    return lines.where(F.col("l_quantity") > 45).select("l_orderkey", "l_quantity")


@query(
    "parquet_append_overwrite",
    "select o_orderstatus, 2 * count(*) as n from orders group by all",
)
def parquet_append_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_path(spark, "orders")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    for write in (files.append_parquet, files.overwrite_parquet, files.append_parquet):
        write(orders, path)
    return spark.read.parquet(path).groupBy("o_orderstatus").agg(F.count("*").alias("n"))


@query("wide_read", "select cast(o_orderkey as double) as o_orderkey, o_totalprice, o_orderdate, "
       "(select count(*) from orders) as n_rows from orders")
def wide_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_path(spark, "orders-text")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", F.col("o_orderdate").cast("string"))
    files.overwrite_parquet(orders, path)
    df, n, _ = files.read_wide(spark, path, "o_orderdate")
    return df.withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp_ntz")).withColumn(
        "n_rows", F.lit(n).cast("bigint")
    )


@query("fallback_read", "select s_suppkey, s_name from supplier")
def fallback_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    missing = work_path(spark, "missing")
    sources = [("parquet", missing), ("csv", f"{missing}.csv"), ("parquet", f"{sf_dir}/supplier.parquet")]
    return files.read_first(spark, sources).select("s_suppkey", "s_name")


@query(
    "typed_rows_join",
    "select n_name, t.zone from nation join (values (0, 'a'), (1, 'b'), (2, 'a')) t(r, zone) on n_regionkey = t.r",
)
def typed_rows_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    zones = files.rows_with_schema(spark, [(0, "a"), (1, "b"), (2, "a")], columns("n_regionkey int, zone string"))
    return table(spark, sf_dir, "nation").join(F.broadcast(zones), "n_regionkey").select("n_name", "zone")


@query("lineage_columns", "select count(*) as n, true as has_file, true as has_time, 'orders.parquet' as file from orders")
def lineage_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = files.stamped(files.with_lineage(table(spark, sf_dir, "orders")))
    return df.agg(
        F.count("*").alias("n"),
        F.bool_and(F.col("source_file").isNotNull()).alias("has_file"),
        F.bool_and(F.col("update_at").isNotNull() & F.col("bronze_ingested_at").isNotNull()).alias("has_time"),
        F.max(F.element_at(F.split("source_file", "/"), -1)).alias("file"),
    )


@query(
    "catalog_table_by_day",
    over_observations(
        "select cast(time as date) as event_date, count(*) as n, sum(pressure) as pressure from obs "
        "where cast(time as date) >= date '2024-01-10' group by all"
    ),
)
def catalog_table_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Create a namespace and a table by day, append, read a range of days."""
    space, place = f"obs_{uuid.uuid4().hex}", work_path(spark, "catalog")
    tables.create_namespace(spark, space, place)
    schema = columns("obs_id bigint, time timestamp, city string, pressure double")
    tables.create_table(spark, f"{space}.readings", schema, location=f"{place}/readings")
    df = observations(spark, sf_dir).select("obs_id", F.col("time").cast("timestamp"), "city", "pressure")
    tables.append_table(df, f"{space}.readings", "time")
    rows = tables.read_table(spark, f"{space}.readings").where(F.col("event_date") >= "2024-01-10")
    return rows.groupBy("event_date").agg(F.count("*").alias("n"), F.sum("pressure").alias("pressure"))


ROUNDED_SQL = (
    "s as (select obs_id, time, city, province, province as region, "
    + ", ".join(
        f"{half_up_sql(c, 2)} as {c}"
        for c in ["temperature", "temp_min", "temp_max", "humidity", "precipitation", "cloudcover", "wind_speed",
                  "wind_direction", "pressure"]
    )
    + ", case when lower(trim(is_day_raw)) in ('1', 'true') then true "
    "when lower(trim(is_day_raw)) in ('f', 'no') then false end as is_day from obs)"
)
SILVER_CHECKED = [
    "time", "city", "province", "region", "temperature", "humidity", "is_day", "hour", "weekday", "temp_range",
    "wind_dir_sin", "wind_dir_cos", "rain", "extreme", "temp_level", "humidity_level", "pressure_level", "wind_level",
]
SILVER_SQL = (
    "select time, city, province, region, temperature, humidity, is_day, cast(extract(hour from time) as integer) as hour, "
    "cast(extract(isodow from time) - 1 as integer) as weekday, "
    f"{half_up_sql('temp_max - temp_min', 6)} as temp_range, {half_up_sql('sin(radians(wind_direction))', 4)} as wind_dir_sin, "
    f"{half_up_sql('cos(radians(wind_direction))', 4)} as wind_dir_cos, "
    f"cast(case when precipitation > 0 then 1 else 0 end as integer) as rain, {label_v2_sql()} as extreme, "
    f"{levels_sql('v2')} from s"
)


def _checked_silver(df: DataFrame) -> DataFrame:
    shown = df.select(*SILVER_CHECKED)
    return shown.withColumn("time", F.col("time").cast("timestamp_ntz")).withColumn(
        "temp_range", F.round("temp_range", 6)
    )


@query("bronze_to_silver", over_observations(SILVER_SQL, ROUNDED_SQL))
def bronze_to_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw files to bronze to silver; the raw files come twice and silver is loaded three times."""
    raw, bronze, silver = (work_path(spark, n) for n in ("raw", "bronze", "silver"))
    files.export_csv(raw_readings(spark, sf_dir), raw)
    for load in ("load-1", "load-1", "load-2"):
        medallion.bronze_from_csv(spark, raw, bronze, load)
        medallion.load_silver(spark, bronze, silver, load)
    return _checked_silver(tables.read_loads(spark, silver))


@query(
    "silver_correction",
    over_observations(
        "select time, city, case when obs_id % 7 = 0 then " + half_up_sql("temperature + 1", 2) + " else "
        + half_up_sql("temperature", 2) + " end as temperature from obs"
    ),
)
def silver_correction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second load corrects every seventh reading; the first one is then run again without effect."""
    first, second, bronze, silver = (work_path(spark, n) for n in ("raw", "fixes", "bronze", "silver"))
    raw = raw_readings(spark, sf_dir)
    files.export_csv(raw, first)
    files.export_csv(raw.where("obs_id % 7 = 0").withColumn("temperature", F.col("temperature") + 1), second)
    for source, load in ((first, "load-1"), (second, "load-2"), (first, "load-1")):
        medallion.bronze_from_csv(spark, source, bronze, load)
        medallion.load_silver(spark, bronze, silver, load)
    return tables.read_loads(spark, silver).select(F.col("time").cast("timestamp_ntz").alias("time"), "city", "temperature")


@query(
    "silver_to_gold",
    over_observations(
        "select time, province, city, temperature, humidity, pressure, wind_speed, precipitation, cloudcover, "
        + half_up_sql(
            "precipitation * cast(0.4 as double) + wind_speed * cast(0.3 as double) + cloudcover * cast(0.2 as double) "
            "+ humidity * cast(0.1 as double)", 6,
        )
        + " as risk_score from s",
        ROUNDED_SQL,
    ),
)
def silver_to_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw, bronze, silver, gold = (work_path(spark, n) for n in ("raw", "bronze", "silver", "gold"))
    files.export_csv(raw_readings(spark, sf_dir), raw)
    medallion.bronze_from_csv(spark, raw, bronze, "load-1")
    medallion.load_silver(spark, bronze, silver, "load-1")
    for _ in range(2):
        medallion.load_gold(spark, silver, gold, "load-1")
    df = tables.read_loads(spark, gold).select(*[f.name for f in weather.GOLD_SCHEMA.fields if f.name != "update_at"])
    return df.withColumn("time", F.col("time").cast("timestamp_ntz")).withColumn("risk_score", F.round("risk_score", 6))


MESSAGE = T.StructType(
    [T.StructField(c, T.StringType() if c in ("time", "city", "province", "is_day") else T.DoubleType()) for c in RAW]
)


def send_messages(df: DataFrame, folder: str) -> None:
    """One JSON message per line, as a broker would hand them over."""
    df.select(F.to_json(F.struct(*df.columns)).alias("value")).write.mode("append").text(folder)


@query(
    "stream_bronze",
    over_observations(
        "select cast(obs_id as double) as obs_id, strftime(time, '%Y-%m-%d %H:%M:%S.%f') as time, city, temp_max, "
        "is_day_raw as is_day, true as has_origin from obs"
    ),
)
def stream_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder, bronze, checkpoint = (work_path(spark, n) for n in ("messages", "bronze", "checkpoint"))
    send_messages(raw_readings(spark, sf_dir), folder)
    stream = ingest.read_messages(spark, folder, MESSAGE)
    for _ in range(2):
        ingest.append_stream(stream, bronze, checkpoint).awaitTermination()
    return spark.read.parquet(bronze).select(
        "obs_id", "time", "city", "temp_max", "is_day",
        (F.col("source_file").isNotNull() & F.col("bronze_ingested_at").isNotNull()).alias("has_origin"),
    )


@query("stream_silver", over_observations(SILVER_SQL, ROUNDED_SQL))
def stream_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages to silver; every message is sent again in a later batch."""
    folder, silver, checkpoint = (work_path(spark, n) for n in ("messages", "silver", "checkpoint"))
    for _ in range(2):
        send_messages(raw_readings(spark, sf_dir), folder)
        stream = ingest.read_messages(spark, folder, MESSAGE).drop("raw_message", "source_file", "bronze_ingested_at")
        ingest.silver_stream(stream, silver, checkpoint).awaitTermination()
    return _checked_silver(tables.read_loads(spark, silver))


@query(
    "stream_dedupe",
    over_observations("select cast(obs_id as double) as obs_id, city, time from obs"),
)
def stream_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder, out, checkpoint = (work_path(spark, n) for n in ("messages", "unique", "checkpoint"))
    for _ in range(2):
        send_messages(raw_readings(spark, sf_dir), folder)
        stream = ingest.read_messages(spark, folder, MESSAGE).select("obs_id", "city", F.to_timestamp("time").alias("time"))
        unique = ingest.dedupe_stream(stream, ["obs_id"], "time", "60 days")
        ingest.append_stream(unique, out, checkpoint).awaitTermination()
    return spark.read.parquet(out).withColumn("time", F.col("time").cast("timestamp_ntz"))


@query(
    "stream_lag",
    over_observations(
        "select cast(obs_id as double) as obs_id, city, lag(temp_max) over (partition by city order by time, obs_id) "
        "as temp_lag_1, false as late from obs"
    ),
)
def stream_lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third of the readings at a time, by time; each run picks up where the last one stopped."""
    folder, out, checkpoint = (work_path(spark, n) for n in ("messages", "lagged", "checkpoint"))
    raw = raw_readings(spark, sf_dir).select("obs_id", "time", "city", "temp_max")
    seconds = F.unix_timestamp(F.to_timestamp("time"))
    one, two = raw.agg(F.percentile_approx(seconds, [1 / 3, 2 / 3])).first()[0]
    for part in (seconds < one, (seconds >= one) & (seconds < two), seconds >= two):
        send_messages(raw.where(part), folder)
        stream = ingest.read_messages(spark, folder, MESSAGE).select(
            "obs_id", "city", "temp_max", F.to_timestamp("time").alias("time")
        )
        lag_stream(stream, {"temp_lag_1": "temp_max"}, "city", ["time", "obs_id"], out, checkpoint).awaitTermination()
    return spark.read.parquet(out).select("obs_id", "city", "temp_lag_1", "late")
