"""Edges of conformance, labels, bins and small functions."""

import pytest
from pyspark.sql import functions as F

from obsloom.functions import parsing
from obsloom.functions.arrays import basket, short_label
from obsloom.functions.bins import bin_left_closed, bin_right_closed
from obsloom.functions.rounding import half_up
from obsloom.functions.scaling import to_percent_scale
from obsloom.operators import conform as C
from obsloom.operators import filters
from obsloom.operators.impute import apply_fills, learn_fills
from obsloom.operators.profile import histogram, iqr_outliers, null_audit
from obsloom.plans import weather
from obsloom.plans.medallion import to_silver


def column(df, expression):
    return [r[0] for r in df.orderBy("i").select(expression).collect()]


def test_unreadable_text_becomes_null(spark):
    df = spark.createDataFrame([(0, "1.5"), (1, "abc"), (2, ""), (3, None), (4, " 7 ")], "i int, t string")
    assert column(df, parsing.to_double(F.col("t"))) == [1.5, None, None, None, 7.0]
    assert column(df, parsing.to_int(F.col("t"))) == [1, None, None, None, 7]
    assert column(df, F.try_to_timestamp("t")) == [None] * 5


def test_truth_values_in_any_spelling(spark):
    words = ["TRUE", " 1 ", "t", "Yes", "0", "F", "no ", "false", "maybe", None, "y"]
    df = spark.createDataFrame(list(enumerate(words)), "i int, t string")
    assert column(df, parsing.to_boolean(F.col("t"))) == [True] * 4 + [False] * 4 + [None, None, True]


def test_bins_at_their_edges(spark):
    df = spark.createDataFrame([(i, v) for i, v in enumerate([0.0, 10.0, 10.1, 25.0, 100.0, 100.5, None])], "i int, v double")
    names = ["low", "medium", "high"]
    assert column(df, bin_right_closed(F.col("v"), [0, 10, 25, 100], names)) == [
        None, "low", "medium", "medium", "high", None, None,
    ]
    assert column(df, bin_left_closed(F.col("v"), [10, 25], names)) == [
        "low", "medium", "medium", "high", "high", "high", None,
    ]
    assert column(df, bin_left_closed(F.col("v"), [10, 25], names, null_to_top=True))[-1] == "high"


def test_rule_order(spark):
    rows = [(0, 40.0, 60.0, 50.0), (1, 30.0, 60.0, 50.0), (2, 30.0, 5.0, 50.0), (3, 30.0, 0.0, 50.0), (4, 30.0, 5.0, 1.0), (5, None, None, None)]
    df = spark.createDataFrame(rows, "i int, temp_max double, precipitation double, wind_speed double")
    assert column(df, weather.extreme("v1")) == ["heatwave", "heavy_rain", "storm", "storm", "rain", "normal"]
    assert column(df, weather.extreme("v2", "precipitation")) == ["heatwave", "rain", "rain", "storm", "rain", "normal"]


def test_baskets_without_nulls_and_copies(spark):
    df = spark.createDataFrame([(0, "b", None, "a"), (1, None, None, None), (2, "a", "a", "b")], "i int, x string, y string, z string")
    assert column(df, basket([F.col("x"), F.col("y"), F.col("z")])) == [["a", "b"], [], ["a", "b"]]


def test_short_label(spark):
    df = spark.createDataFrame([(0, ["d", "a", "c", "b"]), (1, ["b", "a"])], "i int, x array<string>")
    assert column(df, short_label(F.col("x"))) == ["a+b+c+1more", "a+b"]


def test_half_up_is_not_moved_by_sum_noise(spark):
    df = spark.createDataFrame([(0, 2.6749999999999998), (1, -2.675), (2, 0.125)], "i int, v double")
    assert column(df, half_up(F.col("v"), 2)) == [2.68, -2.68, 0.13]


def test_percent_scale_clamps(spark):
    df = spark.createDataFrame([(0, -20.0), (1, 20.0), (2, 99.0), (3, None)], "i int, v double")
    assert column(df, to_percent_scale(F.col("v"), -10, 50)) == [0.0, 50.0, 100.0, None]


def test_conform_adds_and_orders_columns(spark):
    df = spark.createDataFrame([("x", "12"), ("y", "n/a")], "extra string, v string")
    out = C.conform(df, C.columns("missing double, v int, extra string"))
    assert out.columns == ["missing", "v", "extra"]
    assert sorted(out.collect(), key=lambda r: r["extra"]) == [(None, 12, "x"), (None, None, "y")]


def test_silver_from_few_columns(spark):
    rows = [("2024-05-05 10:00:00", "hue", "31.234", "25", "1.5", "yes"), ("bad", "hue", None, None, None, None)]
    df = spark.createDataFrame(rows, "time string, city string, temp_max string, temp_min string, precipitation string, is_day string")
    silver = to_silver(df)
    assert silver.schema == weather.SILVER_SCHEMA or silver.columns == [f.name for f in weather.SILVER_SCHEMA.fields]
    good = silver.where("time is not null").first()
    assert (good["temp_max"], good["temp_range"], good["rain"], good["hour"], good["weekday"]) == (31.23, 31.23 - 25, 1, 10, 6)
    assert good["is_day"] is True and good["wind_dir_sin"] is None and good["temp_level"] == "temp_high"
    assert silver.where("time is null").first()["temp_level"] is None


def test_given_derived_columns_win(spark):
    df = spark.createDataFrame([("2024-05-05 10:00:00", "7", None)], "time string, hour string, day string")
    row = to_silver(df).first()
    assert (row["hour"], row["day"]) == (7, 5)


def test_infer_numeric_casts_only_numeric_text(spark):
    df = spark.createDataFrame([("1", "x", None), ("2", "2", None), ("3", "y", None)], "a string, b string, c string")
    assert dict(C.infer_numeric(df).dtypes) == {"a": "double", "b": "string", "c": "string"}


def test_no_candidate_column(spark):
    with pytest.raises(ValueError):
        C.coalesce_columns(spark.range(1), ["city", "place"], "out")


def test_constant_and_empty_columns(spark):
    df = spark.createDataFrame([(1.0, float(i), None) for i in range(4)], "same double, v double, none double")
    found = histogram(df, ["same", "v", "none"], 2).orderBy("column", "bin").collect()
    assert [(r["column"], r["bin"], r["n"]) for r in found] == [("v", 0, 2), ("v", 1, 2)]
    assert filters.informative_columns(df, ["same", "v", "none"]) == ["v"]
    assert {r["column"] for r in iqr_outliers(df, ["same", "none"]).collect()} == {"same"}
    assert null_audit(df).first()[:] == ("none", 4, 100.0)


def test_fills_learned_once_apply_anywhere(spark):
    train = spark.createDataFrame([(1.0, "b"), (3.0, "a"), (None, "a"), (10.0, "b"), (None, None)], "v double, t string")
    fills = learn_fills(train, ["v"], ["t"])
    assert fills == {"v": 3.0, "t": "a"}
    other = spark.createDataFrame([(None, None)], "v double, t string")
    assert apply_fills(other, fills).first()[:] == (3.0, "a")
