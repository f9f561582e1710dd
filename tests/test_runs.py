from datetime import datetime, timezone

import pytest

from medallion.operators.runs import RUN_SCHEMA, best_run, leaderboard, log_run, read_runs


def at(day):
    return datetime(2024, 3, day, tzinfo=timezone.utc)


@pytest.fixture(scope="module")
def runs(spark):
    rows = [
        ("r1", "forest", "cars", at(1), {}, {"R2": 0.9, "MAE": 5.0}),
        ("r2", "forest", "cars", at(2), {}, {"R2": 0.9, "MAE": 4.0}),
        ("r3", "linear", "cars", at(3), {}, {"R2": 0.85, "MAE": 2.0}),
        ("r4", "linear", "cars", at(4), {}, {"R2": 0.8}),
        ("r5", "broken", "cars", at(5), {}, {"R2": float("nan")}),
        ("r6", "silent", "cars", at(6), {}, {}),
        ("r7", "other", "bikes", at(7), {}, {"R2": 0.99}),
        ("r8", "linear", "cars", None, {}, {"R2": 0.85}),
        ("r0", "forest", "cars", at(2), {}, {"R2": 0.9}),
    ]
    return spark.createDataFrame(rows, RUN_SCHEMA)


def test_best_of_each_name(runs):
    found = {r.run_name: (r.run_id, r.metric_value) for r in leaderboard(runs, "R2", 0.8, "greater", "cars").collect()}
    assert found == {"forest": ("r0", 0.9), "linear": ("r3", 0.85)}


def test_best_run_returns_its_own_name(runs):
    assert tuple(best_run(runs, "R2", 0.8, "greater", "cars").first()) == ("r0", 0.9, "forest")
    assert best_run(runs, "R2", 0.8).first().run_id == "r7"


def test_less_takes_the_minimum(runs):
    assert tuple(best_run(runs, "MAE", 5.0, "less", "cars").first()) == ("r3", 2.0, "linear")


def test_threshold_is_strict(runs):
    assert best_run(runs, "R2", 0.9, "greater", "cars").count() == 0
    assert best_run(runs, "R2", 0.8, "less", "cars").count() == 0
    assert best_run(runs, "R2", 0.8, "greater", "boats").count() == 0


def test_unknown_operator(runs):
    with pytest.raises(ValueError):
        best_run(runs, "R2", 0.8, "equal")


def test_logged_runs_come_back(spark, tmp_path):
    path = str(tmp_path / "runs")
    first = log_run(spark, path, "cars_", {"R2": 0.5, "none": None}, {"trees": 10}, start_time=at(9))
    second = log_run(spark, path, "cars_", {"R2": 0.7})
    rows = {r.run_id: r for r in read_runs(spark, path).collect()}
    assert set(rows) == {first, second}
    assert rows[first].run_name == "cars_09-03-24"
    assert rows[first].params == {"trees": "10"} and rows[first].metrics == {"R2": 0.5}
