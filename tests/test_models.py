"""Poisson boosting, stored models, scoring by route, guards of the shadow run and resumed backtests."""

import itertools
import math
import re
from datetime import datetime

import numpy as np
import pytest
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import functions as F
from conftest import SMALL
from test_recursion import DEMAND, SHADOW, demand, from_columns  # noqa: F401  (fixture)

from __spark_entry__ import queries
from kerbside.catalog.jobs import lag_models
from kerbside.catalog.tables import DAILY, Tables
from kerbside.functions import rules
from kerbside.operators.series import COUNT, HOUR, ZONE
from kerbside.plans import backtest, demand_models, driver_clusters, model_store, money_models, recursion
from kerbside.plans.demand_models import RoutedModel

FEATURES = ["a", "b"]


@pytest.fixture(scope="module")
def counts(spark):
    rng = np.random.default_rng(1)
    a, b = rng.integers(0, 4, 4000), rng.integers(0, 3, 4000)
    y = rng.poisson(np.exp(0.3 + 0.8 * a - 0.5 * b * (a > 1)))
    rows = [(float(i), float(j), float(k), float(1 + k % 2)) for i, j, k in zip(a, b, y)]
    return spark.createDataFrame(rows, f"a double, b double, {COUNT} double, w double").checkpoint()


def deviance(frame, column):
    y, mu = F.col(COUNT), F.col(column)
    return frame.agg(F.avg(F.when(y > 0, y * F.ln(y / mu)).otherwise(0) - (y - mu))).first()[0] * 2


def test_poisson_boosting_lowers_the_deviance(counts):
    mean = deviance(counts.withColumn("p", F.lit(counts.agg(F.avg(COUNT)).first()[0])), "p")
    found = [deviance(demand_models.fit_poisson(counts, FEATURES, n)(counts, "p"), "p") for n in (1, 5, 40)]
    assert mean > found[0] > found[1] > found[2] and found[2] < 1.15
    cells = demand_models.fit_poisson(counts, FEATURES, 60, depth=3)(counts, "p").groupBy(*FEATURES).agg(F.avg(COUNT).alias("y"), F.max("p").alias("p"))
    assert all(abs(math.log(r.p / r.y)) < 0.15 for r in cells.collect() if r.y > 0.2)


def test_one_round_by_hand(counts):
    """The best single split on working responses, for weighted rows."""
    rows = [(r.a, r.b, r[COUNT], r.w) for r in counts.collect()]
    mu = sum(y * w for *_, y, w in rows) / sum(w for *_, w in rows)
    best = None
    for f in (0, 1):
        for cut in sorted({r[f] for r in rows})[:-1]:
            sides = [[r for r in rows if (r[f] <= cut) == left] for left in (True, False)]
            steps = [sum(w * (y - mu) for *_, y, w in side) / sum(w * mu for *_, w in side) for side in sides]
            gain = sum(s * s * sum(w * mu for *_, w in side) for s, side in zip(steps, sides))
            if best is None or gain > best[0]:
                best = gain, f, cut, steps
    _, f, cut, steps = best
    fitted = demand_models.fit_poisson(counts, FEATURES, 1, "w", depth=1)
    for r in fitted(counts.select(*FEATURES).distinct(), "p").collect():
        assert r.p == pytest.approx(mu * math.exp(0.08 * steps[0 if r[f] <= cut else 1]))


def test_counts_of_zero_and_wide_margins(spark):
    none = spark.createDataFrame([(float(i % 3), 0.0, 0.0) for i in range(100)], f"a double, b double, {COUNT} double")
    assert demand_models.fit_poisson(none, FEATURES, 3)(none, "p").agg(F.max("p")).first()[0] < 1e-6
    linear = demand_models.fit_poisson_linear(none.withColumn(COUNT, F.col("a") + 1), FEATURES)
    assert linear(none, "p").filter("p <= 0 OR p IS NULL").isEmpty()


@pytest.fixture(scope="module")
def stored_model(spark, counts, tmp_path_factory):
    overall = demand_models.fit_poisson(counts, FEATURES, 3)
    airport, event = demand_models.fit_ridge(counts, FEATURES), demand_models.fit_boosted(counts, FEATURES, 2)
    model = RoutedModel(overall, airport, event, (132,), ("2024-01-01 00:00:00", "2024-04-30 23:00:00"))
    path = str(tmp_path_factory.mktemp("models") / "candidate")
    return model, path, model_store.save_model(spark, model, path, version="v1")


def routed_frame(counts):
    zone = F.when(F.col("a") == 0, 132).otherwise(F.col("a").cast("int"))
    return counts.withColumns({ZONE: zone, "is_event_window": (F.col("b") == 2).cast("int")})


def test_a_stored_model_gives_equal_rows_in_a_new_session(spark, counts, stored_model):
    model, path, digest = stored_model
    other = spark.newSession()
    loaded = model_store.load_model(other, path, digest)
    frame = routed_frame(counts)
    want = model.predict(frame).select("a", "b", "model_type", "prediction").distinct()
    got = loaded.predict(frame).select("a", "b", "model_type", "prediction").distinct()
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert {r.model_type for r in want.collect()} == {"global", "airport_specialist", "event_specialist"}
    assert loaded.trained == model.trained and loaded.airports == (132,)
    about = model_store.describe_model(spark, path)
    assert about["version"] == "v1" and about["sha256"] == digest and about["routes"]["global"]["features"] == FEATURES


def test_changed_and_unfinished_models_are_refused(spark, counts, stored_model, tmp_path):
    model, path, digest = stored_model
    with pytest.raises(model_store.ModelError, match="changed"):
        model_store.load_model(spark, path, "0" * 64)
    other = str(tmp_path / "other")
    model_store.save_model(spark, model, other)
    model.airport.model.write().save(f"{other}/global/extra")
    with pytest.raises(model_store.ModelError, match="changed"):
        model_store.load_model(spark, other)
    model.airport.model.write().save(str(tmp_path / "part" / "global"))
    with pytest.raises(model_store.ModelError, match="No complete model"):
        model_store.load_model(spark, str(tmp_path / "part"))
    with pytest.raises(model_store.ModelError, match="isn't a fitted one"):
        model_store.save_model(spark, SHADOW, str(tmp_path / "closures"))


def test_each_row_is_scored_by_its_own_model_only(counts, stored_model):
    text = stored_model[0].predict(routed_frame(counts))._jdf.queryExecution().optimizedPlan().toString()
    choice = re.search(r"CASE WHEN \(model_type#\d+ = global\).*?END", text)[0]
    branches = re.split(r"WHEN|ELSE", choice)[1:]
    assert len(branches) == 3 and all(b.count("UDF(features") == 1 for b in branches)  # each model inside its branch
    assert text.count("UDF(features") == 3  # and nowhere else


def test_training_must_end_before_the_shadow_month(demand):  # noqa: F811
    late = RoutedModel(SHADOW.overall, SHADOW.airport, None, (132,), ("2024-01-01 00:00:00", "2024-05-01 00:00:00"))
    with pytest.raises(ValueError, match="must end before the month"):
        recursion.shadow_forecast(demand, late, "2024-05-28", "2024-05-28")
    early = RoutedModel(SHADOW.overall, SHADOW.airport, None, (132,), ("2024-01-01 00:00:00", "2024-04-30 23:00:00"))
    assert recursion.shadow_forecast(demand, early, "2024-05-28", "2024-05-28").count() == 48


def test_every_shadow_day_is_validated(demand):  # noqa: F811
    gap = from_columns("CASE WHEN forecast_hour = TIMESTAMP_NTZ '2024-05-29 05:00:00' THEN NULL ELSE 1.0 END")
    broken = RoutedModel(gap, gap, None, (132,))
    with pytest.raises(ValueError, match="no_null_predictions on 2024-05-29"):
        recursion.shadow_forecast(demand, broken, "2024-05-28", "2024-05-29")
    assert recursion.shadow_forecast(demand, broken, "2024-05-28", "2024-05-28").count() == 48
    with pytest.raises(ValueError, match="airport_model_routing on 2024-05-28"):
        recursion.shadow_forecast(demand.filter(f"{ZONE} = 1"), SHADOW, "2024-05-28", "2024-05-28")


def daily_rows():
    days = [datetime.fromordinal(datetime(2024, 1, 1).toordinal() + i) for i in range(200)]
    return [(zone, day, float((i * 7 + zone) % 11 + i % 7)) for zone in (1, 132) for i, day in enumerate(days)]


def test_a_resumed_backtest_equals_an_unbroken_one(spark, tmp_path):
    series = spark.createDataFrame(daily_rows(), DEMAND)
    whole = sorted(map(tuple, backtest.rolling_backtest(series, "2024-03", None, DAILY, fit=lag_models, folder=str(tmp_path / "a")).collect()))
    fitted = []

    def breaking(train, shape, rounds):
        last = train.agg(F.max(HOUR)).first()[0]
        fitted.append(last)
        if last.month == 4:
            raise RuntimeError("lost")
        return lag_models(train, shape, rounds)

    folder = str(tmp_path / "b")
    with pytest.raises(RuntimeError, match="lost"):
        backtest.rolling_backtest(series, "2024-03", None, DAILY, fit=breaking, folder=folder)
    assert "2024-05" not in backtest.finished_folds(spark, folder) and backtest.finished_folds(spark, folder)
    before = backtest.finished_folds(spark, folder)
    again = []
    resumed = backtest.rolling_backtest(
        series, "2024-03", None, DAILY, fit=lambda *a: again.append(1) or lag_models(*a), folder=folder
    )
    assert sorted(map(tuple, resumed.collect())) == whole
    assert len(again) == 5 - len(before)


def test_a_candidate_is_stored_with_the_decision_on_its_folds(spark, tmp_path):
    series = spark.createDataFrame(daily_rows(), DEMAND)
    path = str(tmp_path / "candidate")
    folds, decision = backtest.release_candidate(series, path, "2024-05", None, DAILY, 1)
    assert {r.test_month for r in folds.select("test_month").collect()} >= {"2024-05"}
    row = decision.first()
    assert not row.passed and "minimum_four_folds" in row.failed.split(",")  # three folds at most
    assert (row.status, row.reason, row.sha256) == ("blocked", "release_gate_failed", None)
    about = model_store.describe_model(spark, path)
    assert about["release_gate"] == {"passed": False, "failed": row.failed}
    assert model_store.load_model(spark, path).trained


def test_clusters_are_fitted_by_few_tasks(spark, monkeypatch):
    """Tasks that answer the driver in every iteration follow the number of drivers, not that of files."""
    drivers = spark.range(0, 900, 1, 9).select(
        (F.col("id") % 30).cast("double").alias("average_daily_income"), (F.col("id") % 7).cast("double").alias("average_daily_hours")
    )
    assert driver_clusters.stored_points(drivers).rdd.getNumPartitions() == 1
    monkeypatch.setattr(driver_clusters, "POINTS_PER_TASK", 300)
    points = driver_clusters.stored_points(drivers)
    assert points.rdd.getNumPartitions() == 3 and points.count() == 900
    costs = [r.inertia for r in driver_clusters.elbow(drivers, 3, 2).orderBy("k").collect()]
    assert costs == sorted(costs, reverse=True) and costs[-1] > 0


def test_importance_fits_the_forest_only(spark):
    trips = Tables(spark, SMALL).legacy.na.fill({"surcharge": 0.0})
    money = money_models.MoneyModels(trips, "fare_amount", "trip_id", trees=2, depth=2)
    assert money.train.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism  # one file of trips, fits on all cores
    whole = money.fit().importance().collect()
    alone = money.fit("random_forest")
    assert list(alone.models) == ["random_forest"] and alone.importance().collect() == whole


def test_money_rows_lie_by_leaves_and_errors_are_the_evaluators(spark):
    trips = Tables(spark, SMALL).legacy.na.fill({"surcharge": 0.0})
    table, features = money_models.model_table(trips, "tip_amount", "trip_id")
    text = table._jdf.queryExecution().optimizedPlan().toString()
    boxes = [str(box.max_lat) for box in rules.BOROUGH_BOXES.values()]
    assert not any(limit in line for line in text.splitlines() if "Filter" in line for limit in boxes)  # too much code before
    rows = table.count()
    assert 0 < rows < trips.count() and rows == table.na.drop().count() and len(features) == 38
    money = money_models.MoneyModels(trips, "tip_amount", "trip_id", trees=2, depth=2).fit()
    assert money.train.count() + money.test.count() == rows
    parts = {}
    for part, leaf in money.train.select(F.spark_partition_id(), "leaf").collect():
        parts.setdefault(part, []).append(leaf)
    assert all(leaves == sorted(leaves) for leaves in parts.values()) and sum(len(set(p)) for p in parts.values()) < rows / 8
    found = {r.model: r.rmse for r in money.comparison().collect()}
    want = {name: money.rmse.evaluate(model.transform(money.test)) for name, model in money.models.items()}
    want["baseline"] = money_models.mean_baseline_rmse(money.train, money.test).first().rmse
    assert found == {name: pytest.approx(value) for name, value in want.items()} and len(found) == 5


def test_one_forest_is_scored_as_every_smaller_one(spark):
    """Its first trees, ended early, against a forest fitted to that depth and the mean over these trees."""
    trips = Tables(spark, SMALL).legacy.na.fill({"surcharge": 0.0})
    money = money_models.MoneyModels(trips, "fare_amount", "trip_id", trees=1, depth=1)
    grid = {"featureSubsetStrategy": ["all"], "numTrees": [2, 5], "maxDepth": [0, 2, 7]}
    found = {(int(r.numTrees), int(r.maxDepth)): r.rmse for r in money.grid_search(grid, folds=2).collect()}
    assert len(found) == 6
    fold = F.pmod(F.xxhash64("trip_id"), F.lit(2))
    want = {}
    for depth in (0, 2, 7):
        for left_out in (0, 1):
            learnt, judged = money.train.filter(fold != left_out), money.train.filter(fold == left_out)
            forest = RandomForestRegressor(numTrees=5, maxDepth=depth, featureSubsetStrategy="all", seed=money_models.SEED).fit(learnt)
            rows = [(r.label, r.features) for r in judged.select("label", "features").collect()]
            want.setdefault((5, depth), []).append(money.rmse.evaluate(forest.transform(judged)))
            errors = [(sum(tree.predict(x) for tree in forest.trees[:2]) / 2 - y) ** 2 for y, x in rows]
            want.setdefault((2, depth), []).append(math.sqrt(sum(errors) / len(errors)))
    assert found == {point: pytest.approx(sum(both) / 2) for point, both in want.items()}


def test_the_grid_search_tries_the_whole_grid(spark):
    rows = queries()["forest_grid_search"](spark, SMALL).collect()
    points = itertools.product(["20", "25", "all"], range(10, 51, 10), range(5, 11))
    assert sorted((r.featureSubsetStrategy, int(r.numTrees), int(r.maxDepth)) for r in rows) == sorted(points)
    assert [r.rmse for r in rows] == sorted(r.rmse for r in rows) and rows[0].rmse > 0
