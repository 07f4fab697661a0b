"""The model queries search what the operators offer by default."""

import pytest

from obsloom.operators import training as TR
from obsloom.plans import catalog_models as M


@pytest.mark.parametrize("name", ["city_clusters", "city_cluster_profile"])
def test_cities_are_swept_whole(monkeypatch, name):
    class Asked(Exception):
        pass

    def asked(df, entity, features, **cuts):
        raise Asked(cuts)

    monkeypatch.setattr(M, "observations", lambda spark, sf_dir: None)
    monkeypatch.setattr(M.K, "cluster_entities", asked)
    with pytest.raises(Asked) as found:
        getattr(M, name)(None, "")
    assert found.value.args == ({},)


def test_the_race_has_all_points_of_the_grids_and_all_folds():
    points = {c.name: [{k: v for k, v in p.items() if k != "classes"} for p in c.grid] for c in M.extreme_candidates()}
    assert points == {"forest": M.TR.FOREST_GRID, "boosted": M.TR.BOOST_GRID + M.TR.WIDE_BOOST_GRID}
    assert M.RACE.rungs[-1][1] == 3 and all(0 < share <= 1.0 and folds >= 1 for share, folds in M.RACE.rungs)


def small_race(monkeypatch):
    """The same queries with small models on a few rows; the search itself is as it is."""
    monkeypatch.setattr(M, "RACE", TR.Race(rungs=((0.5, 1), (1.0, 2)), cut=4, rows=80))
    monkeypatch.setattr(M.TR, "FOREST_GRID", [{"trees": t, "depth": d} for t in (2, 4) for d in (2, 3)])
    monkeypatch.setattr(M.TR, "BOOST_GRID", [{"rounds": 2, "rate": r, "depth": 1} for r in (0.05, 0.1)])
    monkeypatch.setattr(M.TR, "WIDE_BOOST_GRID", [{"rounds": n, "rate": 0.1, "depth": 2} for n in (2, 4)])


@pytest.mark.parametrize("name", ["cv_leaderboard", "rain_candidates"])
def test_leaderboards_end_with_every_point_in_its_place(spark, sf_dir, monkeypatch, name):
    small_race(monkeypatch)
    rows = getattr(M, name)(spark, sf_dir).collect()
    assert len(rows) == 8 and [r["place"] for r in rows] == list(range(1, 9))
    keys = [(-r["rung"], -round(r["score"], 6), -round(r["accuracy"], 6), -round(r["recall"], 6)) for r in rows]
    assert keys == sorted(keys) and {r["candidate"] for r in rows if r["rung"] == 1} == {"forest", "boosted"}
    assert all(0 <= r[c] <= 1 for r in rows for c in ("score", "accuracy", "recall"))


@pytest.mark.parametrize("name", ["cv_leaderboard", "rain_candidates"])
def test_leaderboards_fit_every_point_whole(monkeypatch, name):
    """All trees, rows and folds: the search is asked for without a cut."""

    class Asked(Exception):
        pass

    def asked(df, candidates, features, fold, folds, race=None, **others):
        raise Asked(race, folds, [len(c.grid) for c in candidates])

    frame = type("Frame", (), {"withColumn": lambda self, *column: self})()
    monkeypatch.setattr(M, "model_rows", lambda spark, sf_dir: frame)
    monkeypatch.setattr(M, "mark_folds", lambda df, *how: df)
    monkeypatch.setattr(M.TR, "label_index", lambda df, label: type("Index", (), {"transform": lambda self, df: df})())
    monkeypatch.setattr(M.TR, "cross_validate", asked)
    monkeypatch.setattr(M, "F", type("Functions", (), {"col": lambda name: type("Column", (), {"cast": lambda self, kind: self})()}))
    with pytest.raises(Asked) as found:
        getattr(M, name)(None, "")
    race, folds, sizes = found.value.args
    assert race.rungs == ((1.0, 3),) and race.rows is None and folds == 3 and sizes == [4, 12]
    assert TR.Race() == race


def test_model_rows_are_made_once_and_read_from_files(spark, sf_dir):
    """Fitting passes over them a dozen times; without the files every pass would make the lags again."""
    rows = M.model_rows(spark, sf_dir)
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and "Aggregate" not in plan
    assert rows.count() == M.observations(spark, sf_dir).count()
