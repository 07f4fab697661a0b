"""Queries over group reports, data quality profiles and set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from obsloom.functions.calendar import month_start
from obsloom.functions.rounding import half_up
from obsloom.operators import aggregate as A
from obsloom.operators import profile as P
from obsloom.operators.impute import medians, modes
from obsloom.operators.quantiles import quantiles
from obsloom.plans import weather
from obsloom.operators.ranges import with_place
from obsloom.plans.observations import COLUMNS, observations, over_observations
from obsloom.plans.registry import query, table
from obsloom.plans.sqltext import half_up_sql, label_v1_sql, levels_sql, unpivot_sql

LINE_NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
READINGS = ["temp_max", "temp_min", "humidity", "pressure", "wind_speed", "precipitation"]
LABELS = ["heatwave", "heavy_rain", "normal", "rain", "storm"]
LABELLED = f"l as (select *, {label_v1_sql()} as extreme from obs)"


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return observations(spark, sf_dir).withColumn("extreme", weather.extreme("v1"))


@query("table_shape", "select count(*) as n_rows, cast(11 as bigint) as n_columns from lineitem")
def table_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.shape(table(spark, sf_dir, "lineitem")).withColumn("n_columns", F.col("n_columns").cast("bigint"))


@query("city_counts", over_observations("select city, count(*) as n from obs group by city"))
def city_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.group_count(observations(spark, sf_dir), ["city"])


@query(
    "region_extreme_counts",
    over_observations("select region, extreme, count(*) as n from l group by all", LABELLED),
)
def region_extreme_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.group_count(labelled(spark, sf_dir), ["region", "extreme"])


@query(
    "three_key_counts",
    over_observations("select region, province, extreme, count(*) as n from l group by all", LABELLED),
)
def three_key_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.group_count(labelled(spark, sf_dir), ["region", "province", "extreme"])


@query(
    "level_counts",
    over_observations(
        "select wind_level, count(*) as n from v group by all", f"v as (select {levels_sql('v1')} from obs)"
    ),
)
def level_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.group_count(observations(spark, sf_dir).withColumns(weather.levels("v1")), ["wind_level"])


@query(
    "city_summary",
    over_observations(
        f"select province, city, {half_up_sql('avg(temperature)', 4)} as avg_temperature, "
        "max(temp_max) as max_temperature, min(temp_min) as min_temperature, "
        f"{half_up_sql('avg(humidity)', 4)} as avg_humidity, {half_up_sql('avg(wind_speed)', 4)} as avg_wind_speed "
        "from obs group by all"
    ),
)
def city_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return observations(spark, sf_dir).groupBy("province", "city").agg(
        half_up(F.avg("temperature"), 4).alias("avg_temperature"),
        F.max("temp_max").alias("max_temperature"),
        F.min("temp_min").alias("min_temperature"),
        half_up(F.avg("humidity"), 4).alias("avg_humidity"),
        half_up(F.avg("wind_speed"), 4).alias("avg_wind_speed"),
    )


@query(
    "city_means",
    over_observations(
        "select city, " + ", ".join(f"{half_up_sql(f'avg({c})', 2)} as avg_{c}" for c in READINGS)
        + " from obs group by city"
    ),
)
def city_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.group_mean(observations(spark, sf_dir), ["city"], READINGS)


@query(
    "top_cities",
    over_observations(
        "select *, row_number() over (order by avg_temp desc, city) as place from "
        f"(select city, {half_up_sql('avg(temp_max)', 2)} as avg_temp from obs group by city) "
        "order by place limit 20"
    ),
)
def top_cities(spark: SparkSession, sf_dir: str) -> DataFrame:
    means = half_up(F.avg("temp_max"), 2).alias("avg_temp")
    return A.agg_topn(observations(spark, sf_dir), ["city"], [means], [F.desc("avg_temp")], 20, place="place")


@query(
    "rollup_report",
    "select l_returnflag, l_linestatus, count(*) as n, sum(l_quantity) as quantity, "
    f"{half_up_sql('avg(l_extendedprice)', 4)} as avg_price from lineitem group by all "
    "order by quantity desc, l_returnflag, l_linestatus limit 500",
)
def rollup_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = [
        F.count("*").alias("n"),
        F.sum("l_quantity").alias("quantity"),
        half_up(F.avg("l_extendedprice"), 4).alias("avg_price"),
    ]
    return A.agg_topn(
        table(spark, sf_dir, "lineitem"), ["l_returnflag", "l_linestatus"], parts, [F.desc("quantity")], 500
    )


@query(
    "region_rain_share",
    over_observations(
        "select region, rain_label, count(*) as n, "
        + half_up_sql("count(*)::double / sum(count(*)) over (partition by region) * 100", 2)
        + " as pct from r group by region, rain_label",
        "r as (select region, case when precipitation > 0 then 'rain_yes' else 'rain_no' end as rain_label from obs)",
    ),
)
def region_rain_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    rain = F.when(F.col("precipitation") > 0, "rain_yes").otherwise("rain_no")
    counts = observations(spark, sf_dir).groupBy("region", rain.alias("rain_label")).agg(F.count("*").alias("n"))
    return A.with_share(counts, "n", ["region"])


@query(
    "class_balance",
    over_observations(
        "select *, max(pct) over () as majority_pct, max(pct) over () > 70 as imbalanced from "
        "(select extreme, count(*) as n, " + half_up_sql("count(*)::double / sum(count(*)) over () * 100", 2)
        + " as pct from l group by extreme)",
        LABELLED,
    ),
)
def class_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.class_balance(labelled(spark, sf_dir), "extreme")


@query(
    "time_span",
    over_observations(
        "select min(time) as first_time, max(time) as last_time, count(distinct time) as distinct_times from obs"
    ),
)
def time_span(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.time_span(observations(spark, sf_dir), "time")


@query(
    "distinct_counts",
    over_observations(
        " union all ".join(
            f"select '{c}' as \"column\", count(distinct {c}) as distinct_n from obs"
            for c in ["city", "region", "weather_main", "humidity", "precipitation"]
        )
    ),
)
def distinct_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.distinct_counts(
        observations(spark, sf_dir), ["city", "region", "weather_main", "humidity", "precipitation"]
    )


@query("distinct_counts_approx")
def distinct_counts_approx(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.distinct_counts(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_partkey", "l_extendedprice"], 0.02)


FAMILY_OF = {c: "numeric" for c in ["obs_id", *weather.MEASURED]} | {"time": "time"}


@query(
    "column_profile",
    over_observations(
        " union all ".join(
            f"select '{c}' as \"column\", count({c}) as non_null, count(distinct {c}) as distinct_n, "
            f"'{FAMILY_OF.get(c, 'categorical')}' as family from obs"
            for c in COLUMNS
        )
    ),
)
def column_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.column_profile(observations(spark, sf_dir))


@query(
    "null_audit",
    over_observations(
        " union all ".join(
            f"select '{c}' as \"column\", count(*) - count({c}) as nulls, "
            + half_up_sql(f"(count(*) - count({c}))::double / count(*) * 100", 2)
            + " as pct from obs"
            for c in COLUMNS
        )
    ),
)
def null_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.null_audit(observations(spark, sf_dir))


@query(
    "duplicate_audit",
    "select total_rows, distinct_rows, total_rows - distinct_rows as duplicate_rows, "
    + half_up_sql("(total_rows - distinct_rows)::double / total_rows * 100", 2)
    + " as duplicate_pct from (select count(*) as total_rows from lineitem), "
    "(select count(*) as distinct_rows from (select distinct l_orderkey, l_linenumber from lineitem))",
)
def duplicate_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.duplicate_audit(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber"))


@query(
    "describe_numeric",
    " union all ".join(
        f"select '{c}' as \"column\", count({c}) as n, {half_up_sql(f'avg({c})', 6)} as mean, "
        f"{half_up_sql(f'stddev_samp({c})', 6)} as sd, min({c}) as min, max({c}) as max from lineitem"
        for c in LINE_NUMBERS
    ),
)
def describe_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.describe_long(table(spark, sf_dir, "lineitem"), LINE_NUMBERS)


@query(
    "skewness",
    'select "column", '
    + half_up_sql("avg(power(value - m, 3)) / power(avg(power(value - m, 2)), 1.5)", 6)
    + f" as skewness from (select *, avg(value) over (partition by \"column\") as m from "
    f"({unpivot_sql('lineitem', LINE_NUMBERS)})) group by \"column\"",
)
def skewness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.skewness_long(table(spark, sf_dir, "lineitem"), LINE_NUMBERS)


@query(
    "iqr_outliers",
    over_observations(
        "select q.\"column\", q1, q3, count_if(value < q1 - 1.5 * (q3 - q1) or value > q3 + 1.5 * (q3 - q1)) as outliers, "
        + half_up_sql("outliers::double / n * 100", 2)
        + " as pct, pct > 5 as flagged from q join u on q.\"column\" = u.\"column\", (select count(*) as n from obs) "
        "group by q.\"column\", q1, q3, n",
        f"u as ({unpivot_sql('obs', READINGS)})",
        "q as (select \"column\", quantile_cont(value, 0.25) as q1, quantile_cont(value, 0.75) as q3 from u "
        "where value is not null group by \"column\")",
    ),
)
def iqr_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.iqr_outliers(observations(spark, sf_dir), READINGS)


BOX_SQL = (
    "select \"column\", min(value) as min, quantile_cont(value, 0.25) as q1, quantile_cont(value, 0.5) as median, "
    "quantile_cont(value, 0.75) as q3, max(value) as max from u group by \"column\""
)
BOX_COLUMNS = ["min", "q1", "median", "q3", "max", "whisker_low", "whisker_high"]


def _rounded_box(df: DataFrame) -> DataFrame:
    return df.select("column", *[half_up(F.col(c), 6).alias(c) for c in BOX_COLUMNS])


def _box_oracle(columns: list[str]) -> str:
    rounded = ", ".join(f"{half_up_sql(c, 6)} as {c}" for c in BOX_COLUMNS)
    return (
        f"with u as ({unpivot_sql('lineitem', columns)}), b as ({BOX_SQL}), w as (select *, "
        "greatest(min, q1 - 1.5 * (q3 - q1)) as whisker_low, least(max, q3 + 1.5 * (q3 - q1)) as whisker_high from b) "
        f"select \"column\", {rounded} from w"
    )


@query("box_stats", _box_oracle(LINE_NUMBERS))
def box_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded_box(P.box_stats(table(spark, sf_dir, "lineitem"), LINE_NUMBERS))


@query("box_stats_by_rank", _box_oracle(LINE_NUMBERS))
def box_stats_by_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same numbers from a coarse first pass."""
    return _rounded_box(P.box_stats(table(spark, sf_dir, "lineitem"), LINE_NUMBERS, narrow=100))


@query("box_stats_approx")
def box_stats_approx(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.box_stats(table(spark, sf_dir, "lineitem"), LINE_NUMBERS, accuracy=10_000)


@query(
    "histogram40",
    f"with u as ({unpivot_sql('lineitem', LINE_NUMBERS)}), e as (select \"column\", min(value) as lo, max(value) as hi, "
    "(max(value) - min(value)) / 40 as step from u group by \"column\" having min(value) < max(value)), "
    "g as (select e.*, cast(b as bigint) as bin from e, range(40) t(b)), "
    "c as (select u.\"column\", cast(least(floor((value - lo) / step), 39) as bigint) as bin, count(*) as n "
    "from u join e on u.\"column\" = e.\"column\" where value is not null group by all) "
    f"select g.\"column\", g.bin, {half_up_sql('lo + g.bin * step', 6)} as low, "
    f"{half_up_sql('lo + (g.bin + 1) * step', 6)} as high, coalesce(n, 0) as n "
    "from g left join c on g.\"column\" = c.\"column\" and g.bin = c.bin",
)
def histogram40(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = P.histogram(table(spark, sf_dir, "lineitem"), LINE_NUMBERS, 40)
    return found.select(
        "column",
        F.col("bin").cast("bigint").alias("bin"),
        half_up(F.col("low"), 6).alias("low"),
        half_up(F.col("high"), 6).alias("high"),
        "n",
    )


@query(
    "corr_pair",
    over_observations(
        f"select {half_up_sql('corr(temp_max, lagged)', 6)} as corr, count(*) as n from g where lagged is not null",
        "g as (select temp_max, lag(temp_max) over (partition by city order by time, obs_id) as lagged from obs)",
    ),
)
def corr_pair(spark: SparkSession, sf_dir: str) -> DataFrame:
    from obsloom.operators.windows import add_lags

    df = observations(spark, sf_dir).select("obs_id", "city", "time", "temp_max")
    lagged = add_lags(df, {"lagged": "temp_max"}, "city", ["time", "obs_id"])
    return P.correlation(lagged, "temp_max", "lagged")


@query(
    "corr_matrix",
    over_observations(
        " union all ".join(
            f"select '{x}' as x, '{y}' as y, {half_up_sql(f'corr({x}, {y})', 6)} as corr from k"
            for i, x in enumerate(READINGS)
            for y in READINGS[i + 1 :]
        ),
        "k as (select * from obs where " + " and ".join(f"{c} is not null" for c in READINGS) + ")",
    ),
)
def corr_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.correlation_long(observations(spark, sf_dir), READINGS)


@query(
    "monthly_trend",
    "select cast(date_trunc('month', o_orderdate) as date) as month, "
    f"{half_up_sql('avg(o_totalprice)', 2)} as avg_o_totalprice from orders group by all",
)
def monthly_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return A.profile_by(orders, month_start(F.col("o_orderdate")), "month", ["o_totalprice"]).orderBy("month")


@query(
    "seasonality",
    "select extract(month from l_shipdate) as month, '_c' as \"column\", 0.0 as mean, 0.0 as q1, 0.0 as q3 "
    "from lineitem where false union all "
    + " union all ".join(
        f"select extract(month from l_shipdate), '{c}', {half_up_sql(f'avg({c})', 2)}, "
        f"{half_up_sql(f'quantile_cont({c}, 0.25)', 2)}, {half_up_sql(f'quantile_cont({c}, 0.75)', 2)} "
        "from lineitem group by 1"
        for c in LINE_NUMBERS[:2]
    ),
)
def seasonality(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = LINE_NUMBERS[:2]
    df = table(spark, sf_dir, "lineitem").select(F.month("l_shipdate").cast("bigint").alias("month"), *columns)
    means = A.group_mean(df, ["month"], columns, 2, "")
    long = means.select(
        "month", F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("mean")) for c in columns]))
    )
    spread = quantiles(df, columns, [0.25, 0.75], by=["month"])
    quartiles = spread.select(
        "month", "column", half_up(F.col("q")[0], 2).alias("q1"), half_up(F.col("q")[1], 2).alias("q3")
    )
    return long.join(quartiles, ["month", "column"]).select("month", "column", "mean", "q1", "q3")


@query(
    "seasonality_by_rank",
    "select extract(month from l_shipdate) as month, "
    f"{half_up_sql('quantile_cont(l_extendedprice, 0.25)', 2)} as q1, "
    f"{half_up_sql('quantile_cont(l_extendedprice, 0.75)', 2)} as q3 from lineitem group by 1",
)
def seasonality_by_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "lineitem").select(F.month("l_shipdate").cast("bigint").alias("month"), "l_extendedprice")
    spread = quantiles(df, ["l_extendedprice"], [0.25, 0.75], by=["month"], narrow=100)
    return spread.select("month", half_up(F.col("q")[0], 2).alias("q1"), half_up(F.col("q")[1], 2).alias("q3"))


@query(
    "hourly_profile",
    over_observations(
        "select extract(hour from time) as hour, "
        + ", ".join(f"{half_up_sql(f'avg({c})', 2)} as avg_{c}" for c in READINGS)
        + " from obs group by 1"
    ),
)
def hourly_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.profile_by(observations(spark, sf_dir), F.hour("time").cast("bigint"), "hour", READINGS)


@query(
    "month_hour_matrix",
    "select extract(day from l_shipdate) as day, "
    + ", ".join(
        half_up_sql(f"avg(case when extract(month from l_shipdate) = {m} then l_quantity end)", 1) + f" as month_{m}"
        for m in range(1, 13)
    )
    + " from lineitem group by 1",
)
def month_hour_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "lineitem").select(
        F.dayofmonth("l_shipdate").cast("bigint").alias("day"), F.month("l_shipdate").alias("month"), "l_quantity"
    )
    return A.matrix(df, "day", "month", range(1, 13), half_up(F.avg("l_quantity"), 1), "month_")


@query(
    "time_of_day_matrix",
    over_observations(
        "select extract(hour from time) as hour, "
        + ", ".join(
            half_up_sql(f"avg(case when extract(isodow from time) = {d + 1} then temp_max end)", 1) + f" as weekday_{d}"
            for d in range(7)
        )
        + " from obs group by 1"
    ),
)
def time_of_day_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = observations(spark, sf_dir).select(
        F.hour("time").cast("bigint").alias("hour"), F.weekday("time").alias("weekday"), "temp_max"
    )
    return A.matrix(df, "hour", "weekday", range(7), half_up(F.avg("temp_max"), 1), "weekday_")


@query(
    "extreme_by_day_filled",
    over_observations(
        "select p.day, c.extreme, count(l.obs_id) as n from (select distinct cast(time as date) as day from l) p "
        "cross join (select distinct extreme from l) c left join l on cast(l.time as date) = p.day "
        "and l.extreme = c.extreme group by all",
        LABELLED,
    ),
)
def extreme_by_day_filled(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = labelled(spark, sf_dir).withColumn("day", F.to_date("time"))
    return A.filled_counts(df, "day", "extreme", LABELS)


@query(
    "priority_by_month_filled",
    "select p.month, c.o_orderpriority, count(o.o_orderkey) as n from "
    "(select distinct cast(date_trunc('month', o_orderdate) as date) as month from orders) p "
    "cross join (select distinct o_orderpriority from orders) c left join orders o "
    "on cast(date_trunc('month', o.o_orderdate) as date) = p.month and o.o_orderpriority = c.o_orderpriority group by all",
)
def priority_by_month_filled(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").withColumn("month", month_start(F.col("o_orderdate")))
    return A.filled_counts(orders, "month", "o_orderpriority")


@query(
    "group_members",
    over_observations(
        "select region, city, count(*) over (partition by region) as n_members from (select distinct region, city from obs)"
    ),
)
def group_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.members(observations(spark, sf_dir), "region", "city")


@query(
    "column_medians",
    f"select \"column\", {half_up_sql('median(value)', 6)} as median from ({unpivot_sql('lineitem', LINE_NUMBERS)}) "
    "group by \"column\"",
)
def column_medians(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = medians(table(spark, sf_dir, "lineitem"), LINE_NUMBERS)
    return found.withColumn("median", half_up(F.col("median"), 6))


@query(
    "column_modes",
    " union all ".join(
        f"(select '{c}' as \"column\", {c} as mode from part where {c} is not null group by {c} "
        f"order by count(*) desc, {c} limit 1)"
        for c in ["p_brand", "p_type"]
    ),
)
def column_modes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return modes(table(spark, sf_dir, "part"), ["p_brand", "p_type"])


@query(
    "union_by_name",
    "select c_custkey as key, c_name as name, c_acctbal as balance, c_mktsegment as segment from customer union all "
    "select s_suppkey, s_name, s_acctbal, null from supplier",
)
def union_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"),
        F.col("c_mktsegment").alias("segment"),
    )
    suppliers = table(spark, sf_dir, "supplier").select(
        F.col("s_acctbal").alias("balance"), F.col("s_suppkey").alias("key"), F.col("s_name").alias("name")
    )
    return A.union_all([customers, suppliers])


@query("distinct_rows", "select distinct l_orderkey, l_linenumber from lineitem")
def distinct_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.distinct_rows(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber"))


@query("distinct_values", "select distinct p_type from part order by 1")
def distinct_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.distinct_values(table(spark, sf_dir, "part"), "p_type")


@query(
    "sorted_by_time",
    over_observations("select obs_id, time, city, row_number() over (order by time, city, obs_id) as place from obs order by place"),
)
def sorted_by_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order as a column, which tables keep and comparisons see."""
    placed = with_place(observations(spark, sf_dir).select("obs_id", "time", "city"), ["time", "city", "obs_id"])
    return placed.orderBy("place")
