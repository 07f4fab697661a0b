"""Queries over conformance, predicates and derived features."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from obsloom.functions import parsing
from obsloom.functions.angles import angle_parts
from obsloom.functions.arrays import any_in, basket, prefixed
from obsloom.functions.calendar import calendar_parts, month_start, parse_time
from obsloom.functions.labels import positive_flag, positive_name
from obsloom.functions.scaling import to_percent_scale, weighted_score
from obsloom.operators import conform as C
from obsloom.operators import filters
from obsloom.operators.aggregate import group_count
from obsloom.operators.impute import apply_fills, learn_fills
from obsloom.operators.joins import latest_per_key, lookup, one_latest_per_key, with_daily_range, with_group_count
from obsloom.operators.scoring import is_normal
from obsloom.operators.windows import add_lags
from obsloom.plans import weather
from obsloom.plans.observations import observations, over_observations
from obsloom.plans.registry import query, table
from obsloom.plans.sqltext import half_up_sql, label_v1_sql, label_v2_sql, levels_sql

RISK_SQL = (
    "precipitation * cast(0.4 as double) + wind_speed * cast(0.3 as double) "
    "+ cloudcover * cast(0.2 as double) + humidity * cast(0.1 as double)"
)


@query(
    "label_v1_counts",
    over_observations(f"select region, {label_v1_sql()} as extreme, count(*) as n from obs group by all"),
)
def label_v1_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled = observations(spark, sf_dir).withColumn("extreme", weather.extreme("v1"))
    return group_count(labelled, ["region", "extreme"])


@query(
    "label_v2_counts",
    over_observations(f"select region, {label_v2_sql()} as extreme, count(*) as n from obs group by all"),
)
def label_v2_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled = observations(spark, sf_dir).withColumn("extreme", weather.extreme("v2", "precipitation"))
    return group_count(labelled, ["region", "extreme"])


@query("levels_right_closed", over_observations(f"select obs_id, {levels_sql('v1')} from obs"))
def levels_right_closed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return observations(spark, sf_dir).select("obs_id", *[c.alias(n) for n, c in weather.levels("v1").items()])


@query("levels_left_closed", over_observations(f"select obs_id, {levels_sql('v2')} from obs"))
def levels_left_closed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return observations(spark, sf_dir).select("obs_id", *[c.alias(n) for n, c in weather.levels("v2").items()])


@query("levels_null_to_top", over_observations(f"select obs_id, {levels_sql('v2', True)} from obs"))
def levels_null_to_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    return observations(spark, sf_dir).select("obs_id", *[c.alias(n) for n, c in weather.levels("v2", True).items()])


@query(
    "conform_types",
    over_observations(
        "select obs_id, cast(time as varchar) as time_text, "
        "try_cast(reading_raw as double) as reading, round(try_cast(wind_speed as double), 1) as wind_speed, "
        "cast(humidity as bigint) as humidity, cast(null as varchar) as station from obs"
    ),
)
def conform_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = C.columns(
        "obs_id bigint, time_text string, reading double, wind_speed double, humidity bigint, station string"
    )
    raw = observations(spark, sf_dir).withColumn("time_text", F.col("time").cast("string"))
    return C.conform(raw.withColumnRenamed("reading_raw", "reading"), schema, {"wind_speed": 1})


@query(
    "cast_round",
    over_observations(
        "select obs_id, round(try_cast(reading_raw as double), 2) as reading_raw, "
        f"{half_up_sql('temp_min', 2)} as temp_min from obs"
    ),
)
def cast_round(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = observations(spark, sf_dir).select("obs_id", "reading_raw", "temp_min")
    return C.cast_columns(raw, ["reading_raw", "temp_min", "no_such_column"], "double", 2)


@query(
    "cast_int",
    over_observations("select obs_id, cast(try_cast(reading_raw as integer) as bigint) as reading from obs"),
)
def cast_int(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = parsing.to_int(F.col("reading_raw")).cast("bigint")
    return observations(spark, sf_dir).select("obs_id", number.alias("reading"))


@query(
    "bool_parse",
    over_observations(
        "select is_day_raw, case when lower(trim(is_day_raw)) in ('1','true','t','yes') then true "
        "when lower(trim(is_day_raw)) in ('0','false','f','no') then false end as is_day, count(*) as n "
        "from obs group by all"
    ),
)
def bool_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = observations(spark, sf_dir).withColumn("is_day", parsing.to_boolean(F.col("is_day_raw")))
    return group_count(parsed, ["is_day_raw", "is_day"])


@query(
    "parse_time",
    over_observations(
        "select obs_id, try_cast(case when obs_id % 23 = 0 then reading_raw "
        "else strftime(time, '%Y-%m-%d %H:%M:%S') end as timestamp) as parsed from obs"
    ),
)
def parse_time_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.when(F.col("obs_id") % 23 == 0, F.col("reading_raw")).otherwise(
        F.date_format("time", "yyyy-MM-dd HH:mm:ss")
    )
    raw = observations(spark, sf_dir).select("obs_id", text.alias("text"))
    return raw.select("obs_id", parse_time(F.col("text")).cast("timestamp_ntz").alias("parsed"))


@query(
    "mirror_and_fill",
    over_observations(
        "select obs_id, region as province, region, coalesce(humidity, cloudcover) as humidity, "
        "temp_max - temp_min as temp_range from obs"
    ),
)
def mirror_and_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = C.mirror_column(observations(spark, sf_dir).drop("province"), "region", "province")
    df = C.fill_with(df, {"humidity": F.col("cloudcover"), "temp_range": F.col("temp_max") - F.col("temp_min")})
    return df.select("obs_id", "province", "region", "humidity", "temp_range")


@query(
    "missing_columns",
    over_observations("select obs_id, cast(null as double) as feels_like, humidity from obs"),
)
def missing_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = observations(spark, sf_dir).select("obs_id", "humidity")
    return C.with_missing(df, {"feels_like": "double", "humidity": "double"})


@query(
    "first_available",
    over_observations("select obs_id, coalesce(humidity, cloudcover) as moisture from obs"),
)
def first_available(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = C.coalesce_columns(observations(spark, sf_dir), ["dew_point", "humidity", "cloudcover"], "moisture")
    return df.select("obs_id", "moisture")


@query(
    "drop_rename",
    over_observations("select obs_id, time as observed_at, city as place, humidity from obs"),
)
def drop_rename(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = observations(spark, sf_dir).select("obs_id", "time", "city", "humidity", "temp_max", "wind_speed")
    return C.drop_and_rename(df, weather.LEAKING[3:], {"time": "observed_at", "city": "place"})


@query(
    "numeric_and_target",
    over_observations(
        "select obs_id, temp_max, temp_min, temperature, humidity, pressure, wind_speed, wind_gust, "
        f"wind_direction, precipitation, cloudcover, visibility, {label_v1_sql()} as extreme from obs"
    ),
)
def numeric_and_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled = observations(spark, sf_dir).withColumn("extreme", weather.extreme("v1"))
    return C.numeric_and(labelled, ["extreme", "rain"])


@query(
    "serving_defaults",
    over_observations(
        "select obs_id, coalesce(humidity, 80.0) as humidity, pressure, "
        "cast(12 as bigint) as hour, cast(28.0 as double) as temp_lag_1 from obs"
    ),
)
def serving_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    filled = C.fill_defaults(observations(spark, sf_dir), weather.SCORING_DEFAULTS)
    return filled.select("obs_id", "humidity", "pressure", F.col("hour").cast("bigint").alias("hour"), "temp_lag_1")


@query(
    "widen_numeric",
    "select cast(l_orderkey as double) as l_orderkey, cast(l_linenumber as double) as l_linenumber, l_quantity, "
    "l_returnflag, count(*) as n from lineitem group by all",
)
def widen_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag")
    return group_count(C.widen_numeric(df), df.columns)


@query(
    "infer_numeric",
    over_observations(
        " union all ".join(
            f"select '{c}' as \"column\", count({c}) as non_null, "
            f"count({c}) - count(try_cast({c} as double)) as failed, "
            f"coalesce((count({c}) - count(try_cast({c} as double)))::double / nullif(count({c}), 0) < 0.2, false) "
            "as is_numeric from obs"
            for c in ["city", "province", "region", "weather_main", "is_day_raw", "reading_raw"]
        )
    ),
)
def infer_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.numeric_text_columns(observations(spark, sf_dir))


@query(
    "failed_casts",
    over_observations(
        "select obs_id, reading_raw from obs where reading_raw is not null and try_cast(reading_raw as double) is null"
    ),
)
def failed_casts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.failed_casts(observations(spark, sf_dir), "reading_raw").select("obs_id", "reading_raw")


@query(
    "outside_range",
    over_observations("select obs_id, temp_max from obs where temp_max < 15 or temp_max > 39"),
)
def outside_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = observations(spark, sf_dir).select("obs_id", "temp_max")
    return df.where(filters.outside(F.col("temp_max"), 15, 39))


@query(
    "complete_rows",
    over_observations(
        "select obs_id, humidity, weather_main from obs where humidity is not null and weather_main is not null"
    ),
)
def complete_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = observations(spark, sf_dir).select("obs_id", "humidity", "weather_main")
    return filters.complete_rows(df, ["humidity", "weather_main"])


@query(
    "split_by_key",
    over_observations("select region as part, obs_id from obs where region in ('north', 'central', 'south')"),
)
def split_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = filters.split_by(observations(spark, sf_dir).select("obs_id", "region"), "region", list(weather.MIN_SUPPORT))
    united = None
    for name, part in parts.items():
        named = part.select(F.lit(name).alias("part"), "obs_id")
        united = named if united is None else united.unionByName(named)
    return united


@query(
    "any_item_in_set",
    over_observations(
        f"select obs_id from obs where {label_v1_sql()} in ('heatwave', 'storm') or region in ('heatwave', 'storm')"
    ),
)
def any_item_in_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = basket([weather.extreme("v1"), F.col("region")])
    return observations(spark, sf_dir).withColumn("items", items).where(any_in(F.col("items"), ["heatwave", "storm"])).select("obs_id")


@query(
    "time_range",
    over_observations(
        "select obs_id, time, city from obs where time between timestamp '2024-01-05 06:00:00' "
        "and timestamp '2024-01-07 18:00:00'"
    ),
)
def time_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = observations(spark, sf_dir).select("obs_id", "time", "city")
    return filters.in_time_range(df, "time", "2024-01-05 06:00:00", "2024-01-07 18:00:00")


@query(
    "informative_columns",
    over_observations(
        "select c as \"column\" from (select 'humidity' as c, count(distinct humidity) as n from obs union all "
        "select 'pressure', count(distinct pressure) from obs union all "
        "select 'altitude', count(distinct 5) from obs) where n > 1"
    ),
)
def informative(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = observations(spark, sf_dir).withColumn("altitude", F.lit(5.0))
    kept = filters.informative_columns(df, ["humidity", "pressure", "altitude"])
    return spark.createDataFrame([(c,) for c in kept], "column string")


@query(
    "calendar_parts",
    over_observations(
        "select obs_id, extract(hour from time) as hour, extract(day from time) as day, "
        "extract(month from time) as month, extract(isodow from time) - 1 as weekday, "
        "cast(time as date) as date from obs"
    ),
)
def calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = {n: c.cast("bigint") for n, c in calendar_parts(F.col("time")).items()}
    return observations(spark, sf_dir).select(
        "obs_id", *[c.alias(n) for n, c in parts.items()], F.to_date("time").alias("date")
    )


@query(
    "month_truncation",
    "select o_orderkey, cast(date_trunc('month', o_orderdate) as date) as month from orders",
)
def month_truncation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderkey", month_start(F.col("o_orderdate")).alias("month"))


@query(
    "wind_encoding",
    over_observations(
        f"select obs_id, {half_up_sql('sin(radians(wind_direction))', 4)} as wind_dir_sin, "
        f"{half_up_sql('cos(radians(wind_direction))', 4)} as wind_dir_cos from obs"
    ),
)
def wind_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    sine, cosine = angle_parts(F.col("wind_direction"))
    return observations(spark, sf_dir).select("obs_id", sine.alias("wind_dir_sin"), cosine.alias("wind_dir_cos"))


@query(
    "rain_flag",
    over_observations(
        "select region, cast(case when precipitation > 0 then 1 else 0 end as bigint) as rain, "
        "case when precipitation > 0 then 'rain_yes' else 'rain_no' end as rain_label, count(*) as n "
        "from obs group by all"
    ),
)
def rain_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    flagged = observations(spark, sf_dir).select(
        "region",
        positive_flag(F.col("precipitation")).cast("bigint").alias("rain"),
        positive_name(F.col("precipitation"), "rain_yes", "rain_no").alias("rain_label"),
    )
    return group_count(flagged, ["region", "rain", "rain_label"])


@query("risk_score", over_observations(f"select obs_id, {half_up_sql(RISK_SQL, 6)} as risk_score from obs"))
def risk_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return observations(spark, sf_dir).select(
        "obs_id", F.round(weighted_score(weather.RISK_WEIGHTS), 6).alias("risk_score")
    )


@query(
    "percent_scale",
    over_observations(
        "select obs_id, " + half_up_sql("least(100, greatest(0, (temp_min + 10) / 60 * 100))", 6)
        + " as temp_pct, " + half_up_sql("case when humidity is null then null else "
        "least(100, greatest(0, (humidity - 20) / 60 * 100)) end", 6) + " as humidity_pct from obs"
    ),
)
def percent_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    return observations(spark, sf_dir).select(
        "obs_id",
        F.round(to_percent_scale(F.col("temp_min"), -10, 50), 6).alias("temp_pct"),
        F.round(to_percent_scale(F.col("humidity"), 20, 80), 6).alias("humidity_pct"),
    )


@query(
    "normal_class",
    over_observations(
        f"select extreme, lower(trim(extreme)) like '%normal%' as is_normal, count(*) as n "
        f"from (select ' ' || upper({label_v1_sql()}) as extreme from obs) group by all"
    ),
)
def normal_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = observations(spark, sf_dir).select(F.concat(F.lit(" "), F.upper(weather.extreme("v1"))).alias("extreme"))
    return group_count(named.withColumn("is_normal", is_normal(F.col("extreme"))), ["extreme", "is_normal"])


@query(
    "lag_features",
    over_observations(
        "select obs_id, lag(temp_max) over w as temp_lag_1, lag(humidity) over w as humidity_lag_1, "
        "lag(pressure) over w as pressure_lag_1 from obs window w as (partition by city order by time, obs_id)"
    ),
)
def lag_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    lagged = add_lags(
        observations(spark, sf_dir).select("obs_id", "city", "time", "temp_max", "humidity", "pressure"),
        {"temp_lag_1": "temp_max", "humidity_lag_1": "humidity", "pressure_lag_1": "pressure"},
        "city",
        ["time", "obs_id"],
    )
    return lagged.select("obs_id", "temp_lag_1", "humidity_lag_1", "pressure_lag_1")


@query(
    "lag_features_sliced",
    over_observations(
        "select obs_id, lag(temp_max, 3) over (partition by region order by time, obs_id) as temp_lag_3 from obs"
    ),
)
def lag_features_sliced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regions are large entities and lie in many ranges."""
    df = observations(spark, sf_dir).select("obs_id", "region", "time", "temp_max")
    lagged = add_lags(df, {"temp_lag_3": "temp_max"}, "region", ["time", "obs_id"], offset=3, ranges=40)
    return lagged.select("obs_id", "temp_lag_3")


@query(
    "lag_with_gaps",
    over_observations(
        "select obs_id, lag(temp_max, 2) over (partition by region order by t nulls first, obs_id) as temp_lag_2 from "
        "(select *, case when obs_id % 50 <> 0 then strftime(time, '%Y-%m-%d %H:%M:%S') end as t from obs)"
    ),
)
def lag_with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Times as text, some of them missing, and regions as entities."""
    text = F.when(F.col("obs_id") % 50 != 0, F.date_format("time", "yyyy-MM-dd HH:mm:ss"))
    df = observations(spark, sf_dir).select("obs_id", "region", "temp_max", text.alias("t"))
    return add_lags(df, {"temp_lag_2": "temp_max"}, "region", ["t", "obs_id"], offset=2).select("obs_id", "temp_lag_2")


@query(
    "city_region",
    "select s_suppkey, city, case city when 'Ha Noi' then 'north' when 'Vinh' then 'central' when 'Can Tho' then 'south' "
    "else 'unknown' end as region from (select s_suppkey, case s_suppkey % 5 when 0 then 'Ha Noi' when 1 then 'Vinh' "
    "when 2 then 'Can Tho' when 3 then 'Atlantis' end as city from supplier)",
)
def city_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regions of cities by the dictionary of cities."""
    names = F.array(*map(F.lit, ["Ha Noi", "Vinh", "Can Tho", "Atlantis", None]))
    cities = table(spark, sf_dir, "supplier").select("s_suppkey", F.get(names, (F.col("s_suppkey") % 5).cast("int")).alias("city"))
    return lookup(cities, "city", weather.CITY_REGION, "region", weather.UNKNOWN_REGION)


@query(
    "infer_numeric_cast",
    over_observations("select obs_id, city, is_day_raw, try_cast(reading_raw as double) as reading_raw from obs"),
)
def infer_numeric_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text columns that mostly hold numbers become numbers; what cannot be read becomes NULL."""
    return C.infer_numeric(observations(spark, sf_dir).select("obs_id", "city", "is_day_raw", "reading_raw"))


@query(
    "daily_range",
    over_observations(
        f"select obs_id, {half_up_sql('max(temp_max) over w - min(temp_min) over w', 6)} as temp_range from obs "
        "window w as (partition by city, cast(time as date))"
    ),
)
def daily_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = observations(spark, sf_dir).select("obs_id", "city", "time", "temp_max", "temp_min")
    ranged = with_daily_range(df, "city", "time", "temp_max", "temp_min", "temp_range")
    return ranged.select("obs_id", F.round("temp_range", 6).alias("temp_range"))


@query(
    "group_size_on_rows",
    over_observations("select obs_id, weather_main, count(*) over (partition by weather_main) as group_count from obs"),
)
def group_size_on_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_group_count(observations(spark, sf_dir).select("obs_id", "weather_main"), ["weather_main"])


@query(
    "region_lookup",
    "select c_custkey, coalesce(n_name, 'unknown') as nation, coalesce(r_name, 'unknown') as region, "
    "case c_mktsegment when 'BUILDING' then 'works' when 'MACHINERY' then 'works' when 'HOUSEHOLD' then 'home' "
    "else 'unknown' end as segment_group from customer left join nation on c_nationkey = n_nationkey "
    "left join region on n_regionkey = r_regionkey",
)
def region_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations = table(spark, sf_dir, "nation").withColumnRenamed("n_nationkey", "c_nationkey")
    regions = table(spark, sf_dir, "region").withColumnRenamed("r_regionkey", "region_key")
    df = table(spark, sf_dir, "customer")
    df = lookup(df, "c_nationkey", nations, "nation", "unknown", "n_name")
    df = lookup(df, "c_nationkey", nations, "region_key", None, "n_regionkey")
    df = lookup(df, "region_key", regions, "region", "unknown", "r_name")
    groups = {"BUILDING": "works", "MACHINERY": "works", "HOUSEHOLD": "home"}
    df = lookup(df, "c_mktsegment", groups, "segment_group", "unknown")
    return df.select("c_custkey", "nation", "region", "segment_group")


@query(
    "latest_per_city",
    over_observations(
        "select o.obs_id, o.city, o.time, o.temp_max from obs o join "
        "(select city, max(time) as latest from obs group by city) m on o.city = m.city and o.time = m.latest"
    ),
)
def latest_per_city(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_per_key(observations(spark, sf_dir).select("obs_id", "city", "time", "temp_max"), "city", "time")


@query(
    "latest_day_with_ties",
    "select o.o_orderkey, o.o_orderstatus, o.o_orderdate from orders o join (select o_orderstatus, max(o_orderdate) as d "
    "from orders group by all) m on o.o_orderstatus = m.o_orderstatus and o.o_orderdate = m.d",
)
def latest_day_with_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderdate")
    return latest_per_key(orders, "o_orderstatus", "o_orderdate")


@query(
    "one_latest_per_customer",
    "select o_custkey, o_orderkey, o_totalprice from (select *, row_number() over (partition by o_custkey "
    "order by o_orderdate desc, o_orderkey desc) as rn from orders) where rn = 1",
)
def one_latest_per_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_totalprice", "o_orderdate")
    return one_latest_per_key(orders, "o_custkey", ["o_orderdate", "o_orderkey"]).drop("o_orderdate")


@query(
    "impute_median",
    over_observations("select obs_id, coalesce(humidity, (select median(humidity) from obs)) as humidity from obs"),
)
def impute_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = observations(spark, sf_dir).select("obs_id", "humidity")
    return apply_fills(df, learn_fills(df, numeric=["humidity"]))


@query(
    "impute_mode",
    over_observations(
        "select obs_id, coalesce(weather_main, (select weather_main from obs where weather_main is not null "
        "group by weather_main order by count(*) desc, weather_main limit 1)) as weather_main from obs"
    ),
)
def impute_mode(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = observations(spark, sf_dir).select("obs_id", "weather_main")
    return apply_fills(df, learn_fills(df, categorical=["weather_main"]))


@query(
    "impute_mean",
    over_observations(
        "select obs_id, " + half_up_sql("coalesce(humidity, (select avg(humidity) from obs))", 6) + " as humidity, "
        "coalesce(case when cloudcover > 50 then cloudcover end, 0) as cloudcover from obs"
    ),
)
def impute_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = observations(spark, sf_dir).select(
        "obs_id", "humidity", F.when(F.col("cloudcover") > 50, F.col("cloudcover")).alias("cloudcover")
    )
    fills = learn_fills(df, ["humidity"], strategy="mean") | learn_fills(df, ["cloudcover"], strategy="constant")
    return apply_fills(df, fills).withColumn("humidity", F.round("humidity", 6))


@query(
    "basket_items",
    over_observations(
        "select obs_id, array_to_string(list_sort(list_distinct(list_filter("
        f"[weather_main, region, {label_v1_sql()}, 'prov_' || province], lambda x: x is not null))), ',') as items, "
        f"len(list_distinct(list_filter([weather_main, region, {label_v1_sql()}, 'prov_' || province], "
        "lambda x: x is not null))) as n_items from obs"
    ),
)
def basket_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = basket(
        [F.col("weather_main"), F.col("region"), weather.extreme("v1"), prefixed("prov_", F.col("province"))]
    )
    return observations(spark, sf_dir).select(
        "obs_id", F.array_join(items, ",").alias("items"), F.size(items).cast("bigint").alias("n_items")
    )
