"""Queries over clusters, projections, neighbours and classifiers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from obsloom.functions.angles import angle_parts
from obsloom.functions.calendar import calendar_parts
from obsloom.functions.labels import positive_flag
from obsloom.functions.parsing import to_boolean
from obsloom.operators import cluster as K
from obsloom.operators import training as TR
from obsloom.operators.aggregate import group_count, members
from obsloom.operators.conform import fill_defaults, fill_with
from obsloom.operators.evaluate import ClassF1, confusion, macro_auc, macro_metrics
from obsloom.operators.neighbours import nearest_neighbours
from obsloom.operators.oversample import oversample
from obsloom.operators.scoring import class_names, is_normal, score
from obsloom.operators.sizes import measured
from obsloom.operators.splitting import mark_folds, split
from obsloom.operators.windows import add_lags
from obsloom.plans import weather
from obsloom.plans.observations import observations, over_observations
from obsloom.plans.registry import query, table
from obsloom.plans.sqltext import half_up_sql, label_v1_sql
from obsloom.session import work_path
from obsloom.sources.models import best_available, load_model, save_model

LINE_FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
READINGS = ["temperature", "temp_min", "temp_max", "humidity", "pressure", "wind_speed", "precipitation", "cloudcover"]


def model_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Observations with the classifier features and both targets.

    They are made once and kept in the work folder: splitting, weighing, fitting and scoring pass over them a dozen times.
    """
    df = observations(spark, sf_dir)
    sine, cosine = angle_parts(F.col("wind_direction"))
    df = df.withColumns(
        {
            **calendar_parts(F.col("time")),
            "wind_dir_sin": sine,
            "wind_dir_cos": cosine,
            "is_day": to_boolean(F.col("is_day_raw")).cast("double"),
            "extreme": weather.extreme("v1"),
            "rain": positive_flag(F.col("precipitation")),
        }
    )
    df = add_lags(
        df,
        {"temp_lag_1": "temp_max", "humidity_lag_1": "humidity", "pressure_lag_1": "pressure"},
        "city",
        ["time", "obs_id"],
    )
    return measured(TR.model_frame(df, weather.FEATURES, ["obs_id", "extreme", "rain"]))


def train_and_test(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return split(model_rows(spark, sf_dir), ["extreme", "rain"], ["obs_id"])


@query("kmeans_sweep")
def kmeans_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = observations(spark, sf_dir)
    return K.kmeans_sweep(df, READINGS, range(2, 9))


@query("kmeans_assign")
def kmeans_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, clustered = K.cluster_rows(observations(spark, sf_dir), READINGS, 3)
    return clustered.select("obs_id", "region", "cluster")


@query("kmeans_line_items")
def kmeans_line_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, clustered = K.cluster_rows(table(spark, sf_dir, "lineitem"), LINE_FEATURES, 4, max_iter=20)
    return K.cluster_means(clustered, LINE_FEATURES).orderBy("cluster")


@query("cluster_by_region")
def cluster_by_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = observations(spark, sf_dir).withColumn("extreme", weather.extreme("v1"))
    _, clustered = K.cluster_rows(df, READINGS, 3)
    return group_count(clustered, ["region", "cluster", "extreme"])


@query("city_clusters")
def city_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, clustered = K.cluster_entities(observations(spark, sf_dir), "city", weather.CITY_FEATURES)
    return members(clustered, "cluster", "city")


@query("city_cluster_profile")
def city_cluster_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, clustered = K.cluster_entities(observations(spark, sf_dir), "city", weather.CITY_FEATURES)
    return K.cluster_means(clustered, weather.CITY_FEATURES).orderBy("cluster")


@query("pca2")
def pca2(spark: SparkSession, sf_dir: str) -> DataFrame:
    shares, points = K.project(observations(spark, sf_dir), READINGS, 2)
    return points.select("obs_id", "pc1", "pc2", F.lit(shares[0]).alias("share_1"), F.lit(shares[1]).alias("share_2"))


@query("embedding_pca")
def embedding_pca(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = table(spark, sf_dir, "embeddings").select(
        "vec_id", "label", *[F.col("embedding")[i].cast("double").alias(f"e{i}") for i in range(64)]
    )
    _, points = K.project(wide, [f"e{i}" for i in range(64)], 2)
    return points.select("vec_id", "label", "pc1", "pc2")


NEAR_FEATURES = ["temp_max", "wind_speed", "pressure"]


@query(
    "nearest_in_class",
    over_observations(
        "select extreme, temp_max, wind_speed, pressure, any_value(copies) as copies, "
        + ", ".join(f"{half_up_sql(f'max(case when rn = {i + 1} then d end)', 6)} as d{i}" for i in range(1, 4))
        + " from (select p.*, row_number() over (partition by p.extreme, p.temp_max, p.wind_speed, p.pressure "
        "order by d) as rn from (select a.*, sqrt(power(a.temp_max - b.temp_max, 2) + "
        "power(a.wind_speed - b.wind_speed, 2) + power(a.pressure - b.pressure, 2)) as d "
        "from (select extreme, temp_max, wind_speed, pressure, count(*) as copies from l group by all) a "
        "join l b on a.extreme = b.extreme) p) where rn <= 4 group by all",
        f"l as (select {label_v1_sql()} as extreme, temp_max, wind_speed, pressure from obs)",
    ),
)
def nearest_in_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distances of every point to its three nearest of the same class."""
    df = observations(spark, sf_dir).withColumn("extreme", weather.extreme("v1"))
    near = nearest_neighbours(df, "extreme", NEAR_FEATURES, 3)

    def distance(i: int):
        squares = F.zip_with("x", F.get("neighbours", F.lit(i)), lambda a, b: (a - b) * (a - b))
        return F.sqrt(F.aggregate(squares, F.lit(0.0), lambda a, b: a + b))

    return near.select(
        "extreme",
        *[F.col("x")[i].alias(c) for i, c in enumerate(NEAR_FEATURES)],
        "copies",
        *[F.round(F.round(distance(i), 12), 6).alias(f"d{i + 1}") for i in range(3)],
    )


def _fraction_sql(*parts: str) -> str:
    return f"(('0x' || substr(md5(concat_ws('|', {', '.join(parts)})), 1, 8))::bigint::double / 4294967296::double)"


NEIGHBOUR, STEP = "'neighbour'", "'step'"
#: Points a and b, in SQL: other points by distance and values, the point's own copies before them.
_APART = "sqrt((a.x0 - b.x0) * (a.x0 - b.x0) + (a.x1 - b.x1) * (a.x1 - b.x1) + (a.x2 - b.x2) * (a.x2 - b.x2))"


@query(
    "smote_balanced",
    over_observations(
        "select extreme, x0 as temp_max, x1 as wind_speed, x2 as pressure, false as synthetic from l union all "
        "select c.extreme, c.x0 + c.step * (n.b0 - c.x0), c.x1 + c.step * (n.b1 - c.x1), c.x2 + c.step * (n.b2 - c.x2), true "
        "from child c join near n on n.extreme = c.extreme and n.x0 = c.x0 and n.x1 = c.x1 and n.x2 = c.x2 "
        "and n.upto > c.choice and n.upto - n.times <= c.choice",
        f"l as (select * from (select {label_v1_sql()} as extreme, obs_id, temp_max as x0, wind_speed as x1, pressure as x2 from obs) "
        "where extreme is not null and x0 is not null and x1 is not null and x2 is not null)",
        "size as (select extreme, count(*) as n, max(count(*)) over () - count(*) as missing from l group by extreme)",
        "p as (select extreme, x0, x1, x2, count(*) as copies from l semi join (select * from size where missing > 0) using (extreme) group by all)",
        f"other as (select a.extreme, a.x0, a.x1, a.x2, b.x0 as b0, b.x1 as b1, b.x2 as b2, b.copies, {_APART} as d "
        "from p a join p b on a.extreme = b.extreme and not (a.x0 = b.x0 and a.x1 = b.x1 and a.x2 = b.x2) "
        "qualify row_number() over (partition by a.extreme, a.x0, a.x1, a.x2 order by d, b0, b1, b2) <= 3)",
        "entry as (select extreme, x0, x1, x2, x0 as b0, x1 as b1, x2 as b2, least(copies - 1, 3) as times, -1::double as d from p "
        "union all select extreme, x0, x1, x2, b0, b1, b2, least(copies, 3), d from other)",
        "near as (select *, sum(times) over (partition by extreme, x0, x1, x2 order by d, b0, b1, b2) as upto from entry)",
        "ordered as (select l.*, s.n, s.missing, md5(concat_ws('|', obs_id, '42')) as h from l join size s using (extreme) where s.missing > 0)",
        "placed as (select *, missing // n + case when row_number() over (partition by extreme order by h, obs_id) <= missing % n "
        "then 1 else 0 end as times from ordered)",
        "each as (select *, unnest(range(0, times)) as i from placed)",
        f"child as (select *, floor({_fraction_sql('h', 'i', NEIGHBOUR)} * least(3, n - 1)) as choice, "
        f"{_fraction_sql('h', 'i', STEP)} as step from each)",
    ),
)
def smote_balanced(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = observations(spark, sf_dir).withColumn("extreme", weather.extreme("v1"))
    return oversample(df, "extreme", NEAR_FEATURES, ["obs_id"])


@query(
    "smote_class_sizes",
    over_observations(
        "select extreme, synthetic, case when synthetic then (select max(n) from c) - n else n end as n from c, "
        "(select unnest([true, false]) as synthetic) where not synthetic or n < (select max(n) from c)",
        f"c as (select {label_v1_sql()} as extreme, count(*) as n from obs group by all)",
    ),
)
def smote_class_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = observations(spark, sf_dir).withColumn("extreme", weather.extreme("v1"))
    made = oversample(df, "extreme", NEAR_FEATURES, ["obs_id"])
    return made.groupBy("extreme", "synthetic").agg(F.count("*").alias("n"))


def _scored(spark: SparkSession, sf_dir: str, target: str, estimator, prefix: str) -> DataFrame:
    train, test = train_and_test(spark, sf_dir)
    model = TR.fit_classifier(train, weather.FEATURES, target, estimator)
    return score(test, model, prefix)


@query("rf_scores")
def rf_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = _scored(spark, sf_dir, "extreme", TR.random_forest(), "extreme")
    return scored.withColumn("is_normal", is_normal(F.col("extreme_class"))).drop(*weather.FEATURES)


@query("gbt_scores")
def gbt_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = _scored(spark, sf_dir, "extreme", TR.boosted_trees(classes=5), "extreme")
    return scored.drop(*weather.FEATURES)


@query("rain_scores")
def rain_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scored(spark, sf_dir, "rain", TR.boosted_trees(), "rain").drop(*weather.FEATURES)


@query("saved_model_scores")
def saved_model_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Train, save, find the best saved model, load it, and score rows that lack inputs."""
    train, test = train_and_test(spark, sf_dir)
    folder = work_path(spark, "models")
    save_model(TR.fit_classifier(train, weather.FEATURES, "extreme", TR.random_forest()), f"{folder}/best_extreme_rf")
    model = load_model(best_available(spark, [folder], ["best_extreme_gb", "best_extreme_*"]))
    asked = fill_defaults(
        fill_with(test.drop("visibility"), {"humidity_lag_1": F.col("humidity"), "pressure_lag_1": F.col("pressure")}),
        {c: weather.SCORING_DEFAULTS[c] for c in weather.FEATURES if c in weather.SCORING_DEFAULTS},
    )
    return score(asked, model, "extreme").select("obs_id", "extreme_class", "extreme_confidence")


@query("model_quality")
def model_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test = train_and_test(spark, sf_dir)
    model = TR.fit_classifier(train, weather.FEATURES, "extreme", TR.random_forest())
    scored = score(test, model, "extreme")
    classes = class_names(model)
    quality = macro_metrics(scored, "extreme", "extreme_class")
    auc = macro_auc(scored, "extreme", {c: f"extreme_p_{c}" for c in classes}).first()["auc"]
    return quality.withColumn("auc", F.lit(auc))


@query("model_confusion")
def model_confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test = train_and_test(spark, sf_dir)
    model = TR.fit_classifier(train, weather.FEATURES, "extreme", TR.random_forest())
    return confusion(score(test, model, "extreme"), "extreme", "extreme_class", class_names(model))


#: How the leaderboards search their grids: every point with all of its trees and all rows on all three folds.
RACE = TR.Race(rungs=((1.0, 3),), rows=None)


def extreme_candidates() -> list[TR.Candidate]:
    grid = [{**point, "classes": 5} for point in TR.BOOST_GRID + TR.WIDE_BOOST_GRID]
    return [TR.Candidate("forest", TR.random_forest, TR.FOREST_GRID, "trees"), TR.Candidate("boosted", TR.boosted_trees, grid, "rounds")]


def extreme_board(df: DataFrame) -> DataFrame:
    """Two families by macro F1 over three stratified folds, the training parts oversampled."""
    indexed = TR.label_index(df, "extreme").transform(mark_folds(df, ["extreme"], ["obs_id"], 3))

    def balanced(train: DataFrame) -> DataFrame:
        return oversample(train, "label", weather.FEATURES, ["obs_id"])

    return TR.cross_validate(indexed, extreme_candidates(), weather.FEATURES, "fold", 3, resample=balanced, key=["obs_id"], race=RACE)


@query("cv_leaderboard")
def cv_leaderboard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All points of the three grids, by how far they come and then by macro F1."""
    return TR.rank_candidates(extreme_board(model_rows(spark, sf_dir)))


@query("rain_candidates")
def rain_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rain or not, by F1 of the rainy class."""
    df = mark_folds(model_rows(spark, sf_dir), ["rain"], ["obs_id"], 3).withColumn("label", F.col("rain").cast("double"))
    candidates = [
        TR.Candidate("forest", TR.random_forest, TR.FOREST_GRID, "trees"),
        TR.Candidate("boosted", TR.boosted_trees, TR.BOOST_GRID + TR.WIDE_BOOST_GRID, "rounds"),
    ]
    board = TR.cross_validate(
        df, candidates, weather.FEATURES, "fold", 3, evaluator=ClassF1(), missing="zero", key=["obs_id"], race=RACE
    )
    return TR.rank_candidates(board)
