"""Sources, models and streams end to end."""

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from obsloom.operators import centres
from obsloom.operators import training as TR
from obsloom.operators.cluster import best_k, cluster_entities, kmeans_sweep, project, silhouette, standard_scale
from obsloom.operators.oversample import class_weights, oversample
from obsloom.operators.scoring import score
from obsloom.operators.splitting import mark_folds
from obsloom.plans import weather
from obsloom.session import work_path
from obsloom.sources import files, models
from obsloom.sources.tables import newest_by_key
from obsloom.streaming import ingest, lag
from obsloom.streaming.lag import in_order, lag_stream

# Two readings and what their report must say.
READINGS = [
    ("2026-02-11 14:00:00", "HCM", "Ho Chi Minh", 32.5, 30.0, 34.0, 65, 35.0, 10000, 0.0, 40, 3.5, 5.0, 180, 1012, True,
     800, "Clear", "clear sky", "01d"),
    ("2026-02-11 14:00:00", "HN", "Ha Noi", 18.2, 17.0, 19.0, 80, 18.0, 8000, 0.5, 75, 2.0, 3.0, 90, 1018, True,
     500, "Rain", "light rain", "10d"),
]


def test_typed_rows_report(spark):
    df = files.rows_with_schema(spark, READINGS, weather.READING_SCHEMA)
    report = df.groupBy("province", "city").agg(
        F.avg("temperature"), F.max("temp_max"), F.min("temp_min"), F.avg("humidity"), F.avg("wind_speed")
    )
    assert {r["province"]: tuple(r[2:]) for r in report.collect()} == {
        "HCM": (32.5, 34.0, 30.0, 65.0, 3.5), "HN": (18.2, 19.0, 17.0, 80.0, 2.0),
    }


def test_city_regions():
    assert weather.CITY_REGION["Ha Noi"] == "north" and weather.CITY_REGION["Vinh"] == "central"
    assert weather.CITY_REGION["Vinh Long"] == "south" and len(weather.CITY_REGION) == 31 + 22 + 25


def test_no_source_left(spark):
    with pytest.raises(FileNotFoundError):
        files.read_first(spark, [("parquet", work_path(spark, "no")), ("table", "no_such_table")])


@pytest.fixture(scope="module")
def labelled(spark):
    rows = [(i, float(i % 7), float(i % 5) + (3.0 if i % 4 == 0 else 0.0), "a" if i % 4 == 0 else "b" if i % 6 else "c") for i in range(240)]
    return spark.createDataFrame(rows, "id long, u double, v double, kind string").cache()


def test_saved_model_scores_alike(spark, labelled):
    model = TR.fit_classifier(labelled, ["u", "v"], "kind", TR.random_forest(5, 4))
    folder = work_path(spark, "models")
    models.save_model(model, f"{folder}/best_extreme_rf")
    found = models.best_available(spark, [f"{folder}/none", folder], ["best_extreme_gb", "best_extreme_*"])
    again = models.load_model(found)
    one, two = (score(labelled, m, "k").orderBy("id").collect() for m in (model, again))
    assert one == two
    assert all(abs(r["k_p_a"] + r["k_p_b"] + r["k_p_c"] - 1) < 1e-9 and r["k_confidence"] <= 100 for r in one)
    with pytest.raises(FileNotFoundError):
        models.best_available(spark, [folder], ["best_rain_*"])


def test_boosted_trees_for_many_classes_and_gaps(labelled):
    gaps = labelled.withColumn("u", F.when(F.col("id") % 9 > 0, F.col("u")))
    for missing in ("zero", "median"):
        model = TR.fit_classifier(gaps, ["u", "v"], "kind", TR.boosted_trees(2, 0.1, 2, classes=3), missing)
        scored = score(gaps, model, "k")
        assert scored.count() == 240 and scored.where("k_confidence is null or k_class is null").count() == 0


def test_cross_validation_resamples_training_rows_only(labelled):
    df = TR.label_index(labelled, "kind").transform(mark_folds(labelled, ["kind"], ["id"], 2))
    seen = []

    def balanced(train):
        even = oversample(train, "label", ["u", "v"], ["id"])
        seen.append({r["label"]: r["count"] for r in even.groupBy("label").count().collect()})
        return even

    candidates = [TR.Candidate("forest", TR.random_forest, [{"trees": 2, "depth": 2}, {"trees": 3, "depth": 3}])]
    board = TR.rank_candidates(TR.cross_validate(df, candidates, ["u", "v"], "fold", 2, resample=balanced))
    assert board.count() == 2 and all(len(set(s.values())) == 1 for s in seen) and len(seen) == 2
    name, estimator = TR.choose(board, candidates)
    assert name == "forest" and estimator.getNumTrees() in (2, 3)


def scored_by_hand(df, estimator, fold):
    """Macro F1 of a plain fit on the other folds."""
    prepared = Pipeline(stages=TR.preparation(["u", "v"])).fit(df.where(F.col("fold") != fold))
    train = prepared.transform(TR.with_class_weights(df.where(F.col("fold") != fold), "label", TR.WEIGHT))
    model = estimator.setLabelCol("label").fit(train.repartition(1))
    rows = model.transform(prepared.transform(df.where(F.col("fold") == fold)))
    return TR.macro_metrics(rows, "label", "prediction").first()["f1"]


@pytest.fixture(scope="module")
def folded(labelled):
    return TR.label_index(labelled, "kind").transform(mark_folds(labelled, ["kind"], ["id"], 3)).cache()


@pytest.mark.parametrize("make,grid", [
    (TR.random_forest, [{"trees": t, "depth": 3} for t in (2, 6)]),
    (TR.boosted_trees, [{"rounds": n, "depth": 2, "classes": 3} for n in (2, 5)]),
])
def test_first_trees_are_those_of_a_smaller_fit(folded, make, grid):
    """The first rounds of a boosted fit predict like a fit of so many rounds; a forest keeps its first trees."""
    grown = "trees" if make is TR.random_forest else "rounds"
    prepared = Pipeline(stages=TR.preparation(["u", "v"])).fit(folded)
    train = prepared.transform(TR.with_class_weights(folded, "label", TR.WEIGHT)).repartition(1).cache()
    small, large = (make(**point).setLabelCol("label").fit(train) for point in grid)
    cut = TR.first_trees(large, grid[0][grown])
    rows = [sorted((r["id"], r["prediction"]) for r in m.transform(train).select("id", "prediction").collect()) for m in (small, cut)]
    if make is TR.boosted_trees:
        assert rows[0] == rows[1]
    else:
        assert len(cut.trees) == 2 and [t.toDebugString for t in cut.trees] == [t.toDebugString for t in large.trees[:2]]


def test_a_search_without_a_race_fits_every_point_on_every_fold(folded):
    candidates = [TR.Candidate("boosted", TR.boosted_trees, [{"rounds": n, "depth": 2, "classes": 3} for n in (2, 4)], "rounds")]
    board = {r["point"]: r for r in TR.cross_validate(folded, candidates, ["u", "v"], "fold", 3).collect()}
    for point in candidates[0].grid:
        row = board[str(point)]
        by_hand = sum(scored_by_hand(folded, TR.boosted_trees(**point), fold) for fold in range(3)) / 3
        assert abs(row["score"] - by_hand) < 1e-9 and row["folds"] == 3 and row["trees_share"] == 1.0


def test_a_race_looks_at_all_points_and_finishes_with_the_best(folded, labelled):
    candidates = [
        TR.Candidate("forest", TR.random_forest, [{"trees": t, "depth": d} for t in (4, 8) for d in (1, 4)], "trees"),
        TR.Candidate("boosted", TR.boosted_trees, [{"rounds": n, "rate": r, "classes": 3} for n in (4, 8) for r in (0.01, 0.5)], "rounds"),
    ]
    race = TR.Race(rungs=((0.5, 1), (1.0, 3)), cut=4, rows=100)
    board = TR.rank_candidates(TR.cross_validate(folded, candidates, ["u", "v"], "fold", 3, key=["id"], race=race))
    rows = board.collect()
    assert len(rows) == 8 and [r["place"] for r in rows] == list(range(1, 9))
    assert [r["rung"] for r in rows] == [1, 1] + [0] * 6 and {r["candidate"] for r in rows[:2]} == {"forest", "boosted"}
    assert all((r["folds"], r["trees_share"]) == ((3, 1.0) if r["rung"] else (1, 0.5)) for r in rows)
    assert rows[0]["score"] >= rows[1]["score"]
    name, model = TR.fit_best(labelled, board, candidates, ["u", "v"], "kind", key=["id"], max_rows=150)
    assert name == rows[0]["candidate"] and model.rows_left_out == 90 and score(labelled, model, "k").count() == 240


def test_weights_even_out_classes(labelled):
    rows = class_weights(labelled, "kind").collect()
    assert all(abs(r["n"] * r["weight"] - 240 / 3) < 1e-9 for r in rows)


def test_clustering_properties(labelled):
    sweep = kmeans_sweep(labelled, ["u", "v"], range(2, 5))
    costs = [r["cost"] for r in sweep.orderBy("k").collect()]
    assert costs == sorted(costs, reverse=True) and best_k(sweep) in (2, 3, 4)
    shares, points = project(labelled, ["u", "v"], 2)
    assert abs(sum(shares) - 1) < 1e-9 and points.count() == 240
    with pytest.raises(ValueError):
        cluster_entities(labelled.where("kind <> 'c'"), "kind", ["u", "v"])


def test_all_fits_of_a_sweep_are_those_of_plain_lloyd_steps(spark):
    """From the same starting centres, all k and restarts together end where one fit at a time ends."""
    chance = np.random.default_rng(4)
    rows = np.concatenate([chance.normal(c, 0.4, size=(60, 2)) for c in ((0, 0), (4, 0), (0, 5), (6, 6))])
    points = spark.createDataFrame([(r.tolist(),) for r in rows], "x array<double>").repartition(5).cache()
    starts = centres.starting_rows(points, 42)
    fits = centres.fit_all(points, [2, 3, 4, 7], restarts=3)
    worths = centres.silhouettes(points, fits)
    for fit, worth in zip(fits, worths):
        best = None
        for i in range(3):
            c = centres.spread_out(starts, fit.k, 42 + i)
            for _ in range(20):
                own = centres.distances(rows, c).argmin(axis=1)
                c = np.array([rows[own == j].mean(axis=0) if (own == j).any() else c[j] for j in range(fit.k)])
            cost = centres.distances(rows, c).min(axis=1).sum()
            best = cost if best is None else min(best, cost)
        assert abs(fit.cost - best) < 1e-6 * best
        own = centres.distances(rows, fit.centres).argmin(axis=1)
        apart = ((rows[:, None, :] - rows[None, :, :]) ** 2).sum(axis=2)
        plain = []
        for i in range(len(rows)):
            inside = apart[i, own == own[i]].sum() / max((own == own[i]).sum() - 1, 1)
            outside = min(apart[i, own == j].mean() for j in set(own) - {own[i]})
            plain.append(0.0 if (own == own[i]).sum() == 1 else (outside - inside) / max(inside, outside))
        assert abs(worth - np.mean(plain)) < 1e-9
    assert best_k(spark.createDataFrame([(f.k, w) for f, w in zip(fits, worths)], "k int, silhouette double")) == 4


def test_entities_get_the_nearest_centre(spark):
    chance = np.random.default_rng(5)
    rows = [(f"c{i % 12}", *map(float, chance.normal(10 * (i % 3), 1, size=2))) for i in range(600)]
    sweep, clustered = cluster_entities(spark.createDataFrame(rows, "city string, u double, v double"), "city", ["u", "v"])
    found = {r["city"]: r["cluster"] for r in clustered.collect()}
    assert best_k(sweep) == 3 and len(found) == 12 and clustered.columns == ["city", "u", "v", "cluster"]
    assert all((found[f"c{i}"] == found[f"c{j}"]) == (i % 3 == j % 3) for i in range(12) for j in range(12))


def test_silhouette_of_thousands_of_clusters(spark):
    chance = np.random.default_rng(6)
    own = np.concatenate([np.arange(5000), chance.integers(0, 5000, size=1000)])
    rows = chance.normal(size=(6000, 2)) + chance.normal(size=(5000, 2))[own] * 30
    df = spark.createDataFrame([(f"k{c}", *map(float, r)) for c, r in zip(own, rows)], "c string, u double, v double")
    got = silhouette(df, ["u", "v"], "c").first()
    sizes = np.bincount(own)
    total = 0.0
    for i in range(6000):
        apart = ((rows - rows[i]) ** 2).sum(axis=1)
        mean = np.bincount(own, weights=apart) / sizes
        if sizes[own[i]] > 1:
            inside = mean[own[i]] * sizes[own[i]] / (sizes[own[i]] - 1)
            mean[own[i]] = np.inf
            total += (mean.min() - inside) / max(mean.min(), inside)
    assert got["n"] == 6000 and abs(got["silhouette"] - total / 6000) < 1e-6


def test_scaling_a_constant(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "v double, same double")
    scaled = standard_scale(df, ["v", "same"]).orderBy("v").collect()
    assert [r["z_same"] for r in scaled] == [0.0, 0.0] and abs(scaled[1]["z_v"] - 0.5**0.5) < 1e-12


def readings(spark, rows):
    return spark.createDataFrame(rows, "city string, t string, id long, v double").withColumn("t", F.col("t").cast("timestamp"))


def sent(spark, batches, **read):
    """What the lag stream writes when the batches arrive one run after the other: id -> (before, late)."""
    source, out, check = (work_path(spark, n) for n in ("in", "out", "check"))
    schema = readings(spark, [("a", "2024-01-01 10:00:00", 1, 1.0)]).schema
    for batch in batches:
        readings(spark, batch).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).options(**read).parquet(source)
        lag_stream(stream, {"before": "v"}, "city", ["t", "id"], out, check).awaitTermination()
    return {r["id"]: (r["before"], r["late"]) for r in spark.read.parquet(out).collect()}


def test_stream_lag_marks_late_rows_over_several_runs(spark):
    found = sent(spark, [
        [("a", "2024-01-01 10:00:00", 1, 1.0), ("a", "2024-01-01 11:00:00", 2, 2.0), ("b", "2024-01-01 10:00:00", 3, 3.0)],
        [("a", "2024-01-01 12:00:00", 4, 4.0), ("a", "2024-01-01 10:30:00", 5, 5.0), ("c", "2024-01-01 09:00:00", 6, 6.0)],
        [("b", "2024-01-01 13:00:00", 7, 7.0), ("a", "2024-01-01 13:00:00", 8, 8.0), ("a", "2024-01-01 12:00:00", 4, 4.5)],
    ])
    assert found == {
        1: (None, False), 2: (1.0, False), 3: (None, False), 4: (None, True), 5: (None, True), 6: (None, False),
        7: (3.0, False), 8: (4.0, False),
    }


def test_stream_lag_of_a_hot_entity_and_of_nulls(spark):
    """Two thirds of all readings are of one entity, some entities and values are NULL, times tie."""
    rows = [(None if i % 11 == 0 else "hot" if i % 3 else f"c{i % 7}", f"2024-01-0{1 + i // 200} {i % 200 // 10:02}:00:00", i, None if i % 5 == 0 else float(i))
            for i in range(600)]
    found, last = sent(spark, [rows[:200], rows[200:400], rows[400:]]), {}
    for city, _, number, value in rows:
        assert found[number] == (last.get(city), False)
        last[city] = value


def test_places_sort_like_spark(spark):
    places = [(None, 2), (1.5, None), (1.5, 1), (None, None), (-2.0, 9)]
    rows = spark.createDataFrame(places, "a double, b long").orderBy("a", "b").collect()
    assert [tuple(r) for r in rows] == sorted(places, key=in_order)


def test_broken_messages_keep_their_text(spark):
    source, out, check = (work_path(spark, n) for n in ("in", "out", "check"))
    spark.createDataFrame([('{"city": "a", "v": 1.5}',), ("no json",)], "value string").write.text(source)
    schema = readings(spark, [("a", "2024-01-01 10:00:00", 1, 1.0)]).schema
    ingest.append_stream(ingest.read_messages(spark, source, schema), out, check).awaitTermination()
    rows = {r["raw_message"]: (r["city"], r["v"]) for r in spark.read.parquet(out).collect()}
    assert rows == {'{"city": "a", "v": 1.5}': ("a", 1.5), "no json": (None, None)}


def test_stream_lag_sends_every_column_once(spark, monkeypatch):
    """Every value that goes to Python and back costs; instants go as numbers and come back as they were."""
    seen = []
    plain = lag.LastReading.__init__
    monkeypatch.setattr(lag.LastReading, "__init__", lambda self, *given: (seen.append(given), plain(self, *given))[1])
    rate = spark.readStream.format("rate").load()
    stream = rate.selectExpr("cast(value as string) as city", "timestamp as t", "value as id", "cast(value as double) as v")
    found = lag.lagged_stream(stream, {"before": "v"}, "city", ["t", "id"])
    assert found.schema.simpleString() == "struct<city:string,t:timestamp,id:bigint,v:double,before:double,late:boolean>"
    assert seen[0][1:] == (4, ["r1", "r2"], ["r3"], "r0")


def test_newest_of_a_key_carries_each_row_once(spark):
    """Rows went through the shuffle twice, as the row and as its order, and through an aggregate that sorts."""
    rows = [("a", 1, 5.0, None), ("a", 1, None, "y"), ("a", 1, 5.0, "z"), (None, 2, None, None), ("b", None, 1.0, "p"), ("b", None, 1.0, "p")]
    df = spark.createDataFrame(rows, "city string, t int, v double, w string")
    newest = newest_by_key(df, ["city", "t"], ["v", "w"])
    plan = newest._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and plan.count("WindowGroupLimit") == 2
    assert sorted(map(tuple, newest.collect()), key=str) == sorted([("a", 1, 5.0, "z"), (None, 2, None, None), ("b", None, 1.0, "p")], key=str)
