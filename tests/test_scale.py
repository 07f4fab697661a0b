"""The ways that serve large groups, forced on small data and compared with brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from obsloom.operators.evaluate import roc_auc
from obsloom.operators.joins import latest_per_key, with_group_count
from obsloom.operators.mining import itemsets, rules
from obsloom.operators import neighbours
from obsloom.operators.neighbours import nearest_neighbours
from obsloom.operators.oversample import oversample
from obsloom.operators.profile import column_profile, distinct_counts, distinct_sketches, histogram, merged_distincts, null_audit
from obsloom.operators.quantiles import quantiles
from obsloom.operators.splitting import cap_rows, mark_folds, mark_split
from obsloom.operators.ranges import cut_points, range_number, with_place
from obsloom.operators.windows import add_lags
from obsloom.sources.files import read_mixed_csv
from obsloom.sources.tables import load_newest, read_loads
from obsloom.session import work_path


@pytest.fixture(scope="module")
def hot(spark):
    """One key with most rows, one instant with many of them, cold keys, NULL keys and NULL values."""
    chance = random.Random(7)
    rows = []
    for i in range(600):
        key = "hot" if i < 450 else None if i < 470 else f"cold{i % 9}"
        time = 1000.0 if 100 <= i < 300 else float(chance.randrange(5000))
        rows.append((i, key, time, None if i % 11 == 0 else float(chance.randrange(100))))
    return spark.createDataFrame(rows, "id long, key string, t double, v double").repartition(5).cache()


@pytest.mark.parametrize("offset", [1, 3, 40])
@pytest.mark.parametrize("ranges", [1, 4, 60])
def test_lag_over_ranges(hot, offset, ranges):
    groups, want = {}, {}
    for r in sorted(hot.collect(), key=lambda r: (r["t"], r["id"])):
        past = groups.setdefault(r["key"], [])
        want[r["id"]] = past[-offset] if len(past) >= offset else None
        past.append(r["v"])
    lagged = add_lags(hot, {"before": "v"}, "key", ["t", "id"], offset, ranges)
    assert lagged.columns == ["id", "key", "t", "v", "before"]
    assert {r["id"]: r["before"] for r in lagged.collect()} == want


@pytest.mark.parametrize("kind", ["string", "timestamp", "date", "decimal(20,3)", "boolean"])
def test_lag_with_missing_times_of_any_type(hot, kind):
    gaps = hot.withColumn("t", F.when(F.col("id") % 7 > 0, F.col("t").cast("long").cast("timestamp")))
    gaps = gaps.withColumn("t", F.col("t").cast("long").cast(kind) if kind in ("string", "decimal(20,3)", "boolean") else F.col("t").cast(kind))
    ordered = W.partitionBy("key").orderBy("t", "id")
    want = gaps.select("id", F.lag("v", 2).over(ordered).alias("before")).collect()
    got = add_lags(gaps, {"before": "v"}, "key", ["t", "id"], 2, 30).select("id", "before").collect()
    assert sorted(got) == sorted(want)


def test_ranges_follow_the_order_and_stay_small(hot):
    order = ["key", "t", "id"]
    cuts = cut_points(hot, order, 20)
    numbered = hot.withColumn("r", range_number(hot, order, cuts))
    in_order = [r["r"] for r in numbered.orderBy(*order).collect()]
    assert in_order == sorted(in_order) and len(set(in_order)) >= 15 and max(in_order.count(r) for r in set(in_order)) <= 120


def test_cut_points_follow_all_rows_of_a_large_sorted_table(spark):
    """Two million rows in order, sampled at a small share: ranges within twice the mean."""
    rows = spark.range(2_000_000, numPartitions=8)
    for ranges in (1, 4, 16):
        cuts = cut_points(rows, ["id"], ranges)
        sizes = [r["count"] for r in rows.groupBy(range_number(rows, ["id"], cuts).alias("r")).count().collect()]
        assert len(sizes) == len(cuts) + 1 and max(sizes) <= 2 * 2_000_000 / ranges and sum(sizes) == 2_000_000
    same = spark.range(1000).select(F.lit(7).alias("id"))
    assert all(cut == [7] for cut in cut_points(same, ["id"], 8))


def test_places_are_those_of_one_sort(hot):
    placed = with_place(hot.where("id % 7 > 0"), ["key", "t", "id"])
    rows = placed.orderBy("place").collect()
    assert [r["place"] for r in rows] == list(range(1, len(rows) + 1))
    order = [(r["key"] is not None, r["key"], r["t"], r["id"]) for r in rows]
    assert order == sorted(order) and placed.columns == ["id", "key", "t", "v", "place"]


def scans_in_exchanges(physical, name):
    """Scans of the table whose rows reach an exchange by key without an aggregate in between."""
    found, above = [], [(-1, False, False)]  # depth, below an exchange, and below an aggregate of that exchange
    for line in physical.split("\n"):
        depth = len(line) - len(line.lstrip(" :+-*"))
        while above[-1][0] >= depth:
            above.pop()
        _, moved, combined = above[-1]
        if "Exchange hashpartitioning" in line:
            moved, combined = True, False
        combined = combined or "Aggregate(" in line
        if "FileScan" in line and name in line and moved and not combined:
            found.append(line)
        above.append((depth, moved, combined))
    return found


@pytest.mark.parametrize("threshold", ["-1", "1", "10485760"])
@pytest.mark.parametrize("by", [[], ["key"]])
def test_quantiles_neither_cross_nor_shuffle_the_rows(spark, sf_dir, by, threshold):
    """At any broadcast threshold: no cartesian product, and no row of the table in an exchange."""
    default = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        df = spark.read.parquet(f"{sf_dir}/lineitem.parquet").withColumnRenamed("l_returnflag", "key")
        found = quantiles(df, ["l_quantity", "l_extendedprice"], [0.25, 0.5, 0.75], by=by)
        physical = found._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in physical and "NestedLoop" not in physical
        assert "Exchange hashpartitioning" in physical and not scans_in_exchanges(physical, "lineitem")
        assert found.count() == (6 if by else 2)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", default)


@pytest.mark.parametrize("narrow", [4, 1000])
@pytest.mark.parametrize("by", [[], ["key"]])
def test_exact_quantiles(hot, by, narrow):
    wanted = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    found = quantiles(hot, ["t", "v"], wanted, by=by, narrow=narrow).collect()
    groups = {}
    for r in hot.collect():
        for c in ("t", "v"):
            if r[c] is not None:
                groups.setdefault((tuple(r[b] for b in by), c), []).append(r[c])
    assert len(found) == len(groups)
    for r in found:
        values = groups[(tuple(r[b] for b in by), r["column"])]
        assert np.allclose(r["q"], np.quantile(values, wanted))


def test_auc_with_ties(spark):
    chance = random.Random(3)
    rows = [(i % 3 == 0, float(chance.randrange(20)) + (i % 3 == 0)) for i in range(300)]
    df = spark.createDataFrame(rows, "y boolean, s double")
    pos, neg = [s for y, s in rows if y], [s for y, s in rows if not y]
    want = np.mean([(p > n) + 0.5 * (p == n) for p in pos for n in neg])
    assert abs(roc_auc(df, "y", "s").first()["auc"] - want) < 1e-12
    assert roc_auc(df.where("y"), "y", "s").first()["auc"] is None


@pytest.mark.parametrize("rows,train", [(1, 1), (2, 1), (5, 4), (10, 8)])
def test_split_sizes(spark, rows, train):
    df = spark.range(rows).withColumn("g", F.lit(None).cast("string"))
    marked = mark_split(df, ["g"], ["id"])
    assert marked.where("split = 'train'").count() == train and marked.count() == rows


def test_split_does_not_depend_on_partitions(hot):
    def trained(df):
        return {r["id"] for r in mark_split(df, ["key"], ["id"]).where("split = 'train'").collect()}

    assert trained(hot) == trained(hot.repartition(2, "v")) and 0 < len(trained(hot)) < 600


def test_folds_are_even(hot):
    sizes = mark_folds(hot, ["key"], ["id"], 3).groupBy("key", "fold").count().collect()
    for key in {r["key"] for r in sizes}:
        counts = [r["count"] for r in sizes if r["key"] == key]
        assert max(counts) - min(counts) <= 1


def test_cap(hot):
    assert cap_rows(hot, ["id"], 50).count() == 50
    assert cap_rows(hot, ["id"], 5000).count() == 600


@pytest.fixture(scope="module")
def points(spark):
    chance = random.Random(5)
    rows = []
    for i in range(400):
        spot = (3.0, 3.0, 3.0) if i % 3 == 0 else tuple(round(chance.gauss(0, 5), 1) for _ in range(3))
        rows.append((i, "big" if i < 260 else "small" if i < 398 else "tiny", *spot))
    rows += [(400, "one", 1.0, 2.0, 3.0)]
    return spark.createDataFrame(rows, "id long, c string, x double, y double, z double").cache()


@pytest.mark.parametrize("cell_rows,query_rows", [(20, 15), (64, 1000), (5000, 5000)])
def test_neighbours_are_exact(points, cell_rows, query_rows):
    found = nearest_neighbours(points, "c", ["x", "y", "z"], 3, cell_rows=cell_rows, query_rows=query_rows).collect()
    rows = {}
    for r in points.collect():
        rows.setdefault(r["c"], []).append((r["x"], r["y"], r["z"]))
    assert len(found) == sum(len(set(v)) for v in rows.values())
    for r in found:
        here = np.array(r["x"])
        others = sorted(np.linalg.norm(np.array(rows[r["c"]]) - here, axis=1))[1:4]
        got = [np.linalg.norm(np.array(n) - here) for n in r["neighbours"]]
        assert np.allclose(got, others)


@pytest.mark.parametrize("width,following", [(1, 2), (15, 1), (15, 6)])
def test_neighbours_in_many_dimensions(spark, width, following):
    """Clustered points, grids with very many ties, and copies; the neighbours are the nearest, ties by their values."""
    chance = np.random.default_rng(width)
    rows = np.round(chance.normal(size=(900, width)) + 8 * chance.integers(0, 4, size=(900, 1)), 1)
    grid = chance.integers(0, 3, size=(300, width)).astype(float)
    names = ["cloud"] * 900 + ["grid"] * 300
    df = spark.createDataFrame([(n, r.tolist()) for n, r in zip(names, [*rows, *grid])], "c string, x array<double>").repartition(3)
    found = nearest_neighbours(df, "c", "x", 3, cell_rows=40, query_rows=25, following=following).collect()
    for name, group in (("cloud", rows), ("grid", grid)):
        mine = [r for r in found if r["c"] == name]
        assert len(mine) == len(np.unique(group, axis=0)) and sum(r["copies"] for r in mine) == len(group)
        for r in mine[::5]:
            here = np.array(r["x"])
            apart = np.sqrt(((group - here) ** 2).sum(axis=1))
            order = sorted(zip(apart, map(tuple, group)))
            order.remove((0.0, tuple(here)))
            assert [tuple(n) for n in r["neighbours"]] == [p for _, p in order[:3]]


def test_clustered_points_touch_few_cells(spark):
    """In 15 dimensions with structure, a point looks into a handful of the cells, whatever their number."""
    chance = np.random.default_rng(8)
    base = chance.normal(size=(2, 15))
    spots = chance.normal(size=(6000, 2)) * 20
    rows = spots @ base + chance.normal(size=(6000, 15)) * 0.05
    df = spark.createDataFrame([("a", r.tolist()) for r in rows], "g string, x array<double>").withColumn("copies", F.lit(1).cast("long"))
    points = df.withColumn("point", F.monotonically_increasing_id()).cache()
    cuts = neighbours.group_cuts(points, 100)
    placed = neighbours.in_cells(points, cuts).cache()
    found = neighbours.search(placed, placed, 3, 4000)
    boxes = neighbours.boxes_of(placed, cuts, 15)
    asked = neighbours.touched(placed.join(found.select("point", "reach"), "point"), boxes, 0, None)
    cells = len(boxes["a"][0])
    assert cells >= 50 and asked.count() / 6000 < 6


def test_oversampled_rows_lie_between_neighbours(points):
    made = oversample(points, "c", ["x", "y", "z"], ["id"], cell_rows=50)
    sizes = {r["c"]: r["count"] for r in made.groupBy("c").count().collect()}
    assert set(sizes.values()) == {260}
    assert made.where("not synthetic").count() == 401
    near = {(r["c"], tuple(r["x"])): r["neighbours"] for r in nearest_neighbours(points, "c", ["x", "y", "z"], 3).collect()}
    for r in made.where("synthetic").collect():
        p = np.array([r["x"], r["y"], r["z"]])
        assert any(
            abs(np.linalg.norm(p - a) + np.linalg.norm(p - np.array(b)) - np.linalg.norm(a - np.array(b))) < 1e-9
            for (c, spot), others in near.items() if c == r["c"]
            for a in [np.array(spot)] for b in (others or [spot])
        )
    again = oversample(points.repartition(3), "c", ["x", "y", "z"], ["id"], cell_rows=30)
    assert sorted(map(tuple, again.collect()), key=repr) == sorted(map(tuple, made.collect()), key=repr)


def test_balanced_classes_are_left_alone(points):
    same = points.where("c = 'big'")
    assert oversample(same, "c", ["x"], ["id"]).where("synthetic").count() == 0


def test_group_values_and_latest_with_null_keys(hot):
    counted = with_group_count(hot, ["key"])
    assert counted.count() == 600 and counted.where("key is null").first()["group_count"] == 20
    latest = latest_per_key(hot.where("t = 1000"), "key", "t")
    assert latest.count() == 200


def test_itemsets(spark):
    long = [("g", [f"i{j:02}" for j in range(40)])] + [("g", ["i01", "i07", "i30"])] * 9
    wide = spark.createDataFrame(long, "g string, items array<string>")
    assert itemsets(wide, "items", "g", {}, 0.5).count() == 7
    small = spark.createDataFrame([("g", ["a", "b"]), ("g", ["a"]), ("g", []), ("h", ["a"])], "g string, items array<string>")
    found = itemsets(small.where("g = 'g'"), "items", "g", {"g": 0.5}, 1.0)
    assert {(tuple(r["items"]), r["freq"], r["n_baskets"]) for r in found.collect()} == {
        (("a",), 2, 2), (("b",), 1, 2), (("a", "b"), 1, 2),
    }
    others = itemsets(small.unionByName(small.selectExpr("cast(null as string) as g", "items")), "items", "g", {"g": 0.5}, 1.0)
    assert {(r["g"], tuple(r["items"])) for r in others.collect()} == {
        ("g", ("a",)), ("g", ("b",)), ("g", ("a", "b")), ("h", ("a",)), (None, ("a",)),
    }
    assert rules(found, "g", {}, 0.9).collect()[0][:] == ("g", ["b"], ["a"], 0.5, 1.0, 1.0)


def test_loads_are_merged_and_the_newest_reading_stays(spark):
    path = work_path(spark, "loads")

    def load(name, *rows):
        df = spark.createDataFrame(rows, "k int, t string, v double").withColumn("t", F.col("t").cast("timestamp"))
        load_newest(df, path, ["k", "t"], "t", ["v"], name)

    def held():
        return sorted((r["k"], r["v"]) for r in read_loads(spark, path).collect())

    first = [(1, "2024-01-01 10:00:00", 1.0), (1, "2024-01-01 10:00:00", 1.0), (2, None, 5.0), (3, "2024-02-01 10:00:00", 7.0)]
    load("a", *first)
    load("a", *first)
    assert held() == [(1, 1.0), (2, 5.0), (3, 7.0)]
    load("b", (1, "2024-01-01 10:00:00", 0.5), (4, "2024-01-01 11:00:00", 9.0), (2, None, 6.0))
    load("a", *first)
    assert held() == [(1, 0.5), (2, 6.0), (3, 7.0), (4, 9.0)]
    assert [r["k"] for r in read_loads(spark, path, "b").orderBy("k").collect()] == [1, 2, 4]


def test_mixed_headers_in_one_folder(spark):
    folder = work_path(spark, "mixed")
    for i, names in enumerate((["a", "b"], ["b", "a"], ["a", "c"], ["a", "b"])):
        spark.createDataFrame([tuple(f"{n}{i}" for n in names)], names).write.mode("append").option("header", True).csv(folder)
    rows = {tuple(r) for r in read_mixed_csv(spark, [folder]).select("a", "b", "c").collect()}
    assert rows == {("a0", "b0", None), ("a1", "b1", None), ("a2", None, "c2"), ("a3", "b3", None)}


def test_two_instants_of_a_repeated_hour_are_two_values(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        df = spark.sql("select timestamp_seconds(1729988000) as t union all select timestamp_seconds(1729991600)")
        assert df.select(F.col("t").cast("string")).distinct().count() == 1
        assert distinct_counts(df, ["t"]).first()["distinct_n"] == 2
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_sketches_of_days_merge_to_the_whole(spark):
    """Kept per day and merged: exact for few values, within four standard errors for many."""
    df = spark.range(200_000).select((F.col("id") % 30).alias("day"), (F.col("id") % 300).alias("few"), F.col("id").alias("many"),
                                     F.when(F.col("id") % 3 > 0, F.col("id") * 7 % 60_013).alias("gaps"))
    path = work_path(spark, "sketches")
    for part in (F.col("day") < 10, F.col("day") >= 10):
        distinct_sketches(df.where(part), ["few", "many", "gaps"], ["day"]).write.mode("append").parquet(path)
    kept = spark.read.parquet(path)
    assert kept.count() == 30
    found = {r["column"]: r["distinct_n"] for r in merged_distincts(kept, ["few", "many", "gaps"]).collect()}
    exact = {r["column"]: r["distinct_n"] for r in distinct_counts(df, ["few", "many", "gaps"]).collect()}
    assert found["few"] == exact["few"] == 300 and exact["many"] == 200_000
    assert all(abs(found[c] - exact[c]) <= 4 * 0.013 * exact[c] for c in found)
    by_day = merged_distincts(kept, ["few"], ["day"]).collect()
    assert len(by_day) == 30 and {r["distinct_n"] for r in by_day} == {10}


def test_profiles_make_no_row_for_a_cell(spark, sf_dir):
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    physical = column_profile(lines)._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in physical and "Expand" not in physical


def jobs_of(spark, group, work):
    spark.sparkContext.setJobGroup(group, group)
    work()
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return len(tracker.getJobIdsForGroup(group))


def test_profiles_do_not_take_more_jobs_for_more_columns(spark, hot):
    wide = hot.select("t", "v", *[(F.col("t") + i).alias(f"t{i}") for i in range(8)])
    for i, run in enumerate([lambda d, c: null_audit(d, c), lambda d, c: histogram(d, c, 5)]):
        few = jobs_of(spark, f"few{i}", lambda: run(wide, ["t", "v"]).collect())
        many = jobs_of(spark, f"many{i}", lambda: run(wide, wide.columns).collect())
        assert many <= few


def plan(df):
    return df._jdf.queryExecution().toString()


def test_split_does_not_shuffle_the_rows(spark, sf_dir):
    lines = spark.read.parquet(f"{sf_dir}/orders.parquet")
    marked = mark_split(lines, ["o_orderstatus"], ["o_orderkey"])
    physical = marked._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in physical and "SortMergeJoin" not in physical and "Window" not in physical


def test_filters_and_columns_reach_the_scan(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/lineitem.parquet").where("l_quantity > 45").groupBy("l_returnflag").count()
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(l_quantity,45.0)" in text and "l_extendedprice" not in text


def test_a_join_on_range_numbers_does_not_bisect_twice(spark):
    from obsloom.operators.ranges import range_number

    rows = spark.range(10).select("id", F.expr("nullif(id, 3)").alias("x"))
    numbered = rows.withColumn("r", range_number(rows, ["x"], [[2], [5]]))
    assert not numbered.schema["r"].nullable
    assert [r["r"] for r in numbered.orderBy("id").collect()] == [0, 0, 1, 0, 1, 2, 2, 2, 2, 2]
