"""Queries over samples, splits, folds, scaling and encoding."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from obsloom.operators import splitting as S
from obsloom.operators.cluster import silhouette, standard_scale
from obsloom.operators.evaluate import class_metrics, confusion, macro_auc, macro_metrics, roc_auc
from obsloom.operators.oversample import class_weights
from obsloom.operators.ranks import seeded_hash
from obsloom.operators.training import label_index, rank_candidates
from obsloom.plans import weather
from obsloom.plans.observations import observations, over_observations
from obsloom.plans.registry import query, table
from obsloom.plans.sqltext import half_up_sql, label_v1_sql

RAIN_SQL = "cast(case when precipitation > 0 then 1 else 0 end as bigint)"
STRATA = (
    f"s as (select obs_id, {label_v1_sql()} as extreme, {RAIN_SQL} as rain, weather_main, "
    "md5(concat(obs_id, '|42')) as h from obs)"
)


def stratified(spark: SparkSession, sf_dir: str) -> DataFrame:
    rain = F.when(F.col("precipitation") > 0, 1).otherwise(0).cast("bigint")
    return observations(spark, sf_dir).select(
        "obs_id", weather.extreme("v1").alias("extreme"), rain.alias("rain"), "weather_main"
    )


def _split_sql(part: str) -> str:
    return (
        f"select obs_id, case when row_number() over (partition by {part} order by h, obs_id) <= "
        f"case when count(*) over (partition by {part}) <= 1 then 1 else "
        f"greatest(1, least(count(*) over (partition by {part}) - 1, "
        f"floor(count(*) over (partition by {part}) * cast(0.8 as double)))) end then 'train' else 'test' end as split from s"
    )


@query("stratified_split", over_observations(_split_sql("extreme, rain"), STRATA))
def stratified_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.mark_split(stratified(spark, sf_dir), ["extreme", "rain"], ["obs_id"]).select("obs_id", "split")


@query("stratified_split_nulls", over_observations(_split_sql("weather_main"), STRATA))
def stratified_split_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.mark_split(stratified(spark, sf_dir), ["weather_main"], ["obs_id"]).select("obs_id", "split")


AWKWARD_SQL = (
    "s as (select obs_id, case when obs_id % 3 = 0 then 'a||b' when obs_id % 3 = 1 then 'a' end as one, "
    "case when obs_id % 4 = 0 then 'c' when obs_id % 4 = 1 then 'b||c' when obs_id % 4 = 2 then '__NULL__' end as other, "
    "md5(concat(obs_id, '|42')) as h from obs)"
)


@query("split_awkward_strata", over_observations(_split_sql("one, other"), AWKWARD_SQL))
def split_awkward_strata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Strata whose values hold separators, NULL, and text that looks like it."""
    third, fourth = F.col("obs_id") % 3, F.col("obs_id") % 4
    df = observations(spark, sf_dir).select(
        "obs_id",
        F.when(third == 0, "a||b").when(third == 1, "a").alias("one"),
        F.when(fourth == 0, "c").when(fourth == 1, "b||c").when(fourth == 2, "__NULL__").alias("other"),
    )
    return S.mark_split(df, ["one", "other"], ["obs_id"]).select("obs_id", "split")


@query("plain_split", over_observations(_split_sql("1"), STRATA))
def plain_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test = S.split(stratified(spark, sf_dir), [], ["obs_id"])
    return train.select("obs_id", F.lit("train").alias("split")).unionByName(
        test.select("obs_id", F.lit("test").alias("split"))
    )


@query(
    "kfold_assignment",
    over_observations(
        "select obs_id, cast(floor((row_number() over (partition by extreme order by h, obs_id) - 1) * 3 / "
        "count(*) over (partition by extreme)) as integer) as fold from s",
        STRATA,
    ),
)
def kfold_assignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.mark_folds(stratified(spark, sf_dir), ["extreme"], ["obs_id"], 3).select("obs_id", "fold")


@query(
    "hash_sample",
    over_observations("select obs_id from s where substr(h, 1, 8) < '33333333'", STRATA),
)
def hash_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.hash_sample(observations(spark, sf_dir).select("obs_id"), ["obs_id"], 0.2)


@query("bernoulli_sample")
def bernoulli_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.bernoulli_sample(observations(spark, sf_dir).select("obs_id"), 0.2)


@query(
    "capped_rows",
    over_observations("select obs_id, extreme from s order by h, obs_id limit 2000", STRATA),
)
def capped_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.cap_rows(stratified(spark, sf_dir).select("obs_id", "extreme"), ["obs_id"], 2000)


@query(
    "class_weights",
    over_observations(
        "select extreme, count(*) as n, "
        + half_up_sql("sum(count(*)) over ()::double / (count(*) over () * count(*))", 6)
        + " as weight from s group by extreme",
        STRATA,
    ),
)
def weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return class_weights(stratified(spark, sf_dir), "extreme").withColumn("weight", F.round("weight", 6))


@query(
    "standard_scale",
    "select l_orderkey, l_linenumber, l_partkey, "
    + ", ".join(
        half_up_sql(f"({c} - avg({c}) over ()) / stddev_samp({c}) over ()", 6) + f" as z_{c}"
        for c in ["l_quantity", "l_extendedprice"]
    )
    + " from lineitem",
)
def scaled(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["l_quantity", "l_extendedprice"]
    df = standard_scale(table(spark, sf_dir, "lineitem"), columns)
    return df.select(
        "l_orderkey", "l_linenumber", "l_partkey",
        *[F.round(F.round(f"z_{c}", 12), 6).alias(f"z_{c}") for c in columns],
    )


@query(
    "label_encode",
    over_observations("select obs_id, extreme, cast(dense_rank() over (order by extreme) - 1 as double) as label from s", STRATA),
)
def label_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = stratified(spark, sf_dir).select("obs_id", "extreme")
    return label_index(df, "extreme").transform(df)


PREDICTED_SQL = (
    "p as (select obs_id, extreme as label, case when substr(h, 1, 1) < 'b' then extreme "
    "when substr(h, 2, 1) < '8' then 'normal' else 'rain' end as prediction, "
    "cast(round(temp_like, 1) as double) as score from (select s.*, obs.temp_max as temp_like from s "
    "join obs on s.obs_id = obs.obs_id))"
)


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A prediction for every observation that is wrong in a reproducible quarter of them."""
    digest = seeded_hash(["obs_id"], 42)
    guess = (
        F.when(F.substring(digest, 1, 1) < "b", F.col("label"))
        .when(F.substring(digest, 2, 1) < "8", F.lit("normal"))
        .otherwise(F.lit("rain"))
    )
    return observations(spark, sf_dir).select(
        "obs_id", weather.extreme("v1").alias("label"), F.round("temp_max", 1).alias("score")
    ).withColumn("prediction", guess)


CLASSES = ["heatwave", "heavy_rain", "normal", "rain", "storm"]


@query(
    "confusion_matrix",
    over_observations(
        "select a.c as label, b.c as prediction, count(p.obs_id) as n from k a cross join k b left join p "
        "on p.label = a.c and p.prediction = b.c group by all",
        STRATA,
        PREDICTED_SQL,
        "k as (select unnest(['heatwave', 'heavy_rain', 'normal', 'rain', 'storm']) as c)",
    ),
)
def confusion_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return confusion(predictions(spark, sf_dir), "label", "prediction", CLASSES)


METRIC_PARTS = (
    "m as (select c, count_if(label = c) as support, count_if(prediction = c) as predicted, "
    "count_if(label = c and prediction = c) as hits from p, (select unnest(['heatwave', 'heavy_rain', 'normal', "
    "'rain', 'storm']) as c) group by c)",
    "f as (select *, case when predicted = 0 then 0 else hits::double / predicted end as precision, "
    "case when support = 0 then 0 else hits::double / support end as recall from m)",
    "g as (select *, case when precision + recall = 0 then 0 else 2 * precision * recall / (precision + recall) end "
    "as f1 from f)",
)


@query(
    "class_metrics",
    over_observations(
        "select c as class, support, predicted, hits, "
        + ", ".join(f"{half_up_sql(c, 6)} as {c}" for c in ["precision", "recall", "f1"])
        + " from g",
        STRATA,
        PREDICTED_SQL,
        *METRIC_PARTS,
    ),
)
def per_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = class_metrics(predictions(spark, sf_dir), "label", "prediction")
    return found.withColumns({c: F.round(c, 6) for c in ["precision", "recall", "f1"]})


@query(
    "macro_metrics",
    over_observations(
        f"select {half_up_sql('sum(hits)::double / sum(support)', 6)} as accuracy, "
        + ", ".join(f"{half_up_sql(f'avg({c})', 6)} as {c}" for c in ["precision", "recall", "f1"])
        + " from g",
        STRATA,
        PREDICTED_SQL,
        *METRIC_PARTS,
    ),
)
def macro(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = macro_metrics(predictions(spark, sf_dir), "label", "prediction")
    return found.select(*[F.round(c, 6).alias(c) for c in ["accuracy", "precision", "recall", "f1"]])


def _auc_sql(positive: str) -> str:
    """Rank-sum form: mean ranks of the positives."""
    return (
        f"(select (sum(case when y then r end) - count_if(y)::double * (count_if(y) + 1) / 2) / "
        f"(count_if(y)::double * count_if(not y)) from (select {positive} as y, rank() over (order by score) "
        f"+ (count(*) over (partition by score) - 1) / 2.0 as r from p))"
    )


@query(
    "roc_auc_rank",
    over_observations("select " + half_up_sql(_auc_sql("label = 'heatwave'"), 6) + " as auc", STRATA, PREDICTED_SQL),
)
def auc_two_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = predictions(spark, sf_dir).withColumn("positive", F.col("label") == "heatwave")
    return roc_auc(df, "positive", "score").select(F.round("auc", 6).alias("auc"))


@query(
    "macro_auc",
    over_observations(
        "select " + half_up_sql("(" + " + ".join(_auc_sql(f"label = '{c}'") for c in CLASSES) + ") / 5", 6) + " as auc",
        STRATA,
        PREDICTED_SQL,
    ),
)
def auc_many_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = macro_auc(predictions(spark, sf_dir), "label", {c: "score" for c in CLASSES})
    return found.select(F.round("auc", 6).alias("auc"))


@query(
    "candidate_ranking",
    "select *, row_number() over (order by score desc, accuracy desc, recall desc, candidate, point) as place from ("
    "select p_type as candidate, p_brand as point, round(avg(p_size) / 50, 3) as score, "
    "round(avg(p_retailprice) / 2000, 6) as accuracy, cast(count(*) as double) as recall from part group by all)",
)
def candidate_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order of a leaderboard, with part groups standing in for candidates."""
    board = table(spark, sf_dir, "part").groupBy(F.col("p_type").alias("candidate"), F.col("p_brand").alias("point")).agg(
        F.round(F.avg("p_size") / 50, 3).alias("score"),
        F.round(F.avg("p_retailprice") / 2000, 6).alias("accuracy"),
        F.count("*").cast("double").alias("recall"),
    )
    return rank_candidates(board)


@query(
    "silhouette_of_cities",
    over_observations(
        "select " + half_up_sql("avg(case when n = 1 then 0 else (b - a) / greatest(a, b) end)", 6)
        + " as silhouette, count(*) as n from (select x.city, any_value(x.n) as n, "
        "max(case when z.region = x.region then z.d * z.m / (z.m - 1) end) as a, "
        "min(case when z.region <> x.region then z.d end) as b from c x join "
        "(select p.city, q.region, avg(power(p.t - q.t, 2) + power(p.w - q.w, 2)) as d, count(*) as m "
        "from c p cross join c q group by all) z on z.city = x.city group by x.city)",
        "c as (select city, region, avg(temp_max) as t, avg(wind_speed) as w, count(*) over (partition by region) as n "
        "from obs group by city, region)",
    ),
)
def silhouette_of_cities(spark: SparkSession, sf_dir: str) -> DataFrame:
    means = observations(spark, sf_dir).groupBy("city", "region").agg(
        F.avg("temp_max").alias("t"), F.avg("wind_speed").alias("w")
    )
    found = silhouette(means, ["t", "w"], "region")
    return found.select(F.round("silhouette", 6).alias("silhouette"), "n")
