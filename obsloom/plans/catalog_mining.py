"""Queries over itemsets and rules per region."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from obsloom.functions.arrays import basket, name_category, prefixed
from obsloom.functions.labels import positive_name
from obsloom.operators import mining as M
from obsloom.plans import weather
from obsloom.plans.observations import observations, over_observations
from obsloom.plans.registry import query
from obsloom.plans.sqltext import half_up_sql, label_v1_sql, levels_sql

CONTEXT = ["temp_level", "humidity_level", "wind_level", "pressure_level", "main_item"]
TARGET = ["rain_label", "extreme"]


def transactions(spark: SparkSession, sf_dir: str, scope: str = "full") -> DataFrame:
    """``obs_id, region, items``; scope ``context`` leaves the targets out of the baskets."""
    df = observations(spark, sf_dir).withColumns(
        {
            **weather.levels("v1"),
            "extreme": weather.extreme("v1"),
            "rain_label": positive_name(F.col("precipitation"), "rain_yes", "rain_no"),
            "main_item": prefixed("main_", F.col("weather_main")),
        }
    )
    chosen = CONTEXT if scope == "context" else CONTEXT + TARGET
    return df.select("obs_id", "region", basket([F.col(c) for c in chosen]).alias("items"))


def _transactions_sql(scope: str = "full") -> str:
    listed = ", ".join(CONTEXT if scope == "context" else CONTEXT + TARGET)
    return (
        f"tx as (select obs_id, region, list_sort(list_distinct(list_filter([{listed}], lambda x: x is not null))) "
        f"as items from (select *, {levels_sql('v1')}, {label_v1_sql()} as extreme, "
        "case when precipitation > 0 then 'rain_yes' else 'rain_no' end as rain_label, "
        "'main_' || weather_main as main_item from obs))"
    )


# The mining limits, written once more for the checks.
LIMITS_SQL = (
    "lim as (select * from (values ('north', 0.005::double, 0.1::double), ('central', 0.005::double, 0.1::double), "
    "('south', 0.001::double, 0.05::double), ('unknown', 0.005::double, 0.1::double)) "
    "t(region, min_support, min_confidence))"
)
SIZES_SQL = "nb as (select region, count(*) as n_baskets from tx group by region)"
SUBSETS_SQL = (
    "fi as (select c.region, c.s, c.freq, nb.n_baskets from (select region, "
    "list_filter(items, lambda x, i: ((m >> (i - 1)) & 1) = 1) as s, count(*) as freq from "
    "(select region, items, unnest(range(1, cast(power(2, len(items)) as bigint))) as m from tx) group by all) c "
    "join nb on nb.region = c.region join lim on lim.region = c.region "
    "where c.freq >= ceil(lim.min_support * nb.n_baskets))"
)
RULES_SQL = (
    "ru as (select * from (select w.region, w.a as antecedent, [w.r] as consequent, w.freq::double / w.n_baskets as support, "
    "w.freq::double / l.freq as confidence, "
    "(w.freq::double / l.freq) / (r.freq::double / w.n_baskets) as lift from "
    "(select region, freq, n_baskets, r, list_filter(s, lambda x: x <> r) as a from "
    "(select region, s, freq, n_baskets, unnest(s) as r from fi where len(s) > 1)) w "
    "join fi l on l.region = w.region and l.s = w.a join fi r on r.region = w.region and r.s = [w.r]) "
    "join lim using (region) where confidence >= min_confidence)"
)
MINED = (_transactions_sql(), LIMITS_SQL, SIZES_SQL, SUBSETS_SQL, RULES_SQL)
TARGETS_SQL = "consequent[1] in ('rain_yes', 'heatwave', 'heavy_rain', 'storm')"
PLACE_SQL = (
    "row_number() over (partition by region order by round(lift, 9) desc, round(confidence, 9) desc, "
    "antecedent, consequent)"
)
TOP_SQL = f"top as (select * from (select *, {PLACE_SQL} as place from ru where {TARGETS_SQL}) where place <= 200)"
RULE_COLUMNS_SQL = (
    "region, array_to_string(antecedent, '+') as antecedent, array_to_string(consequent, '+') as consequent, "
    + ", ".join(f"{half_up_sql(c, 6)} as {c}" for c in ["support", "confidence", "lift"])
)


def _flat(found: DataFrame) -> DataFrame:
    """Rules with their items as text and their numbers rounded."""
    flat = {c: F.array_join(c, "+") for c in ("antecedent", "consequent")}
    flat |= {c: F.round(F.round(c, 12), 6) for c in ("support", "confidence", "lift")}
    return found.withColumns(flat)


def mined(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.itemsets(transactions(spark, sf_dir), "items", "region", weather.MIN_SUPPORT, weather.DEFAULT_SUPPORT)


def mined_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.rules(mined(spark, sf_dir), "region", weather.MIN_CONFIDENCE, weather.DEFAULT_CONFIDENCE)


def top_target_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = M.rules_for(mined_rules(spark, sf_dir), weather.RULE_TARGETS)
    return M.top_rules(found, "region", weather.MAX_RULES)


@query(
    "freq_itemsets",
    over_observations("select region, array_to_string(s, '+') as items, freq, n_baskets from fi", *MINED[:4]),
)
def freq_itemsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mined(spark, sf_dir).withColumn("items", F.array_join("items", "+"))


PAIRS_SQL = (
    "ex as (select obs_id, region, unnest(items) as item from tx)",
    "one as (select region, item as items, count(*) as freq from ex group by all)",
    "two as (select a.region, a.item || '+' || b.item as items, count(*) as freq from ex a join ex b "
    "on a.obs_id = b.obs_id and a.item < b.item group by all)",
)


@query(
    "freq_itemsets_2",
    over_observations(
        "select u.region, items, freq, n_baskets from (select * from one union all select * from two) u "
        "join nb on nb.region = u.region join lim on lim.region = u.region where freq >= ceil(min_support * n_baskets)",
        *MINED[:3],
        *PAIRS_SQL,
    ),
)
def freq_itemsets_2(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = M.itemsets(transactions(spark, sf_dir), "items", "region", weather.MIN_SUPPORT, weather.DEFAULT_SUPPORT, max_size=2)
    return found.withColumn("items", F.array_join("items", "+"))


@query(
    "freq_itemsets_context",
    over_observations(
        "select region, array_to_string(s, '+') as items, freq, n_baskets from fi",
        _transactions_sql("context"),
        *MINED[1:4],
    ),
)
def freq_itemsets_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = M.itemsets(
        transactions(spark, sf_dir, "context"), "items", "region", weather.MIN_SUPPORT, weather.DEFAULT_SUPPORT
    )
    return found.withColumn("items", F.array_join("items", "+"))


@query(
    "top_itemsets",
    over_observations(
        "select region, array_to_string(s, '+') as items, freq, place from (select *, row_number() over "
        "(partition by region order by freq desc, s) as place from fi) where place <= 10",
        *MINED[:4],
    ),
)
def top_itemsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    top = M.top_itemsets(mined(spark, sf_dir), "region", 10)
    return top.select(
        "region", F.array_join("items", "+").alias("items"), "freq", F.col("place").cast("bigint").alias("place")
    )


@query(
    "rules_1to1",
    over_observations(f"select {RULE_COLUMNS_SQL} from ru where len(antecedent) = 1", *MINED),
)
def rules_1to1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(mined_rules(spark, sf_dir).where(F.size("antecedent") == 1))


@query("rules_all", over_observations(f"select {RULE_COLUMNS_SQL} from ru", *MINED))
def rules_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(mined_rules(spark, sf_dir))


@query("rules_fp_growth", over_observations(f"select {RULE_COLUMNS_SQL} from ru", *MINED))
def rules_fp_growth(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = M.fp_growth_rules(
        transactions(spark, sf_dir), "items", "region", weather.MIN_SUPPORT, weather.MIN_CONFIDENCE,
        weather.DEFAULT_SUPPORT, weather.DEFAULT_CONFIDENCE,
    )
    return _flat(found)


@query(
    "rules_top_per_region",
    over_observations(f"select {RULE_COLUMNS_SQL}, place from top", *MINED, TOP_SQL),
)
def rules_top_per_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(top_target_rules(spark, sf_dir)).withColumn("place", F.col("place").cast("bigint"))


@query(
    "item_confidence",
    over_observations(
        "select i.item, g.region, coalesce(" + half_up_sql("avg(confidence)", 6) + ", 0) as confidence from "
        "(select distinct item from x) i cross join (select distinct region from lim) g "
        "left join x on x.item = i.item and x.region = g.region group by all",
        *MINED,
        f"x as (select region, confidence, unnest(antecedent) as item from ru where {TARGETS_SQL})",
    ),
)
def item_confidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = M.rules_for(mined_rules(spark, sf_dir), weather.RULE_TARGETS)
    found = M.item_confidence(found, "region", [*weather.MIN_SUPPORT, weather.UNKNOWN_REGION])
    return found.withColumn("confidence", F.round(F.round("confidence", 12), 6))


@query(
    "rule_edges",
    over_observations(
        "select region, case when len(antecedent) > 3 then array_to_string(antecedent[1:3], '+') || '+' || "
        "(len(antecedent) - 3) || 'more' else array_to_string(antecedent, '+') end as source, consequent[1] as target, "
        f"{half_up_sql('lift', 6)} as weight, {half_up_sql('confidence', 6)} as confidence, "
        "case when consequent[1] in ('heatwave', 'heavy_rain', 'storm') then 'extreme' "
        "when contains(consequent[1], 'rain') then 'rain' else 'other' end as category "
        f"from (select *, {PLACE_SQL} as p2 from ru where {TARGETS_SQL} and lift >= 1.5) where p2 <= 15",
        *MINED,
    ),
)
def rule_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    strong = M.top_rules(M.rules_for(mined_rules(spark, sf_dir), weather.RULE_TARGETS, weather.MIN_LIFT), "region", 15)
    groups = [("extreme", weather.EXTREME_TARGETS), ("rain", ["rain"])]
    edges = M.rule_edges(strong, "region").withColumn("category", name_category(F.col("target"), groups, "other"))
    return edges.withColumns({c: F.round(F.round(c, 12), 6) for c in ("weight", "confidence")})
