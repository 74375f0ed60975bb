from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from kerbside.operators import gates, quantiles, sampling, scoring, series
from kerbside.operators.series import COUNT, HOUR, ZONE
from kerbside.sources.tables import ContractError

DEMAND = "pickup_zone_id int, pickup_hour timestamp_ntz, trip_count double"


def three_months():
    hours = pd.date_range("2024-01-01", "2024-03-31 23:00", freq="h")
    return [
        (zone, h.to_pydatetime(), float(zone + h.hour + (5 if h.dayofweek < 5 else 0))) for zone in (1, 2) for h in hours
    ]


@pytest.fixture(scope="module")
def demand(spark):
    return spark.createDataFrame(three_months(), DEMAND)


@pytest.fixture(scope="module")
def features(demand):
    return series.feature_table(demand).toPandas().sort_values([ZONE, HOUR]).reset_index(drop=True)


def test_lag_24_is_the_value_a_day_before(features):
    values = {(r.pickup_zone_id, r.pickup_hour): r.trip_count for r in features.itertuples()}
    checked = 0
    for row in features.itertuples():
        before = values.get((row.pickup_zone_id, row.pickup_hour - timedelta(days=1)))
        if before is not None:
            assert row.lag_24 == before
            checked += 1
    assert checked > 3000


def test_features_match_a_pandas_computation(features):
    frame = pd.DataFrame(three_months(), columns=[ZONE, HOUR, COUNT]).sort_values([ZONE, HOUR])
    grouped = frame.groupby(ZONE)[COUNT]
    for n in (1, 2, 24, 168):
        frame[f"lag_{n}"] = grouped.shift(n)
    for n in (3, 6, 24):
        frame[f"rolling_mean_{n}"] = grouped.transform(lambda v, n=n: v.shift(1).rolling(n, min_periods=n).mean())
    frame = frame.dropna().reset_index(drop=True)
    assert len(frame) == len(features)
    for column in [c for c in frame if c.startswith(("lag", "rolling"))]:
        np.testing.assert_allclose(features[column], frame[column])


def test_feature_table_has_the_model_columns_only(features):
    assert set(features.columns) == {*series.HOURLY.feature_columns, HOUR, COUNT}
    assert len(series.HOURLY.feature_columns) == 28
    assert not features.isna().any().any() and features.weather_missing.eq(1).all()


def test_gaps_become_zero(rows):
    sparse = rows(DEMAND, (1, datetime(2024, 1, 1, 0), 2.0), (1, datetime(2024, 1, 1, 0), 1.0), (2, datetime(2024, 1, 1, 3), 4.0))
    got = {(r[ZONE], r[HOUR].hour): r[COUNT] for r in series.dense_series(sparse).collect()}
    assert len(got) == 8 and got[1, 0] == 3.0 and got[2, 3] == 4.0 and sum(got.values()) == 7.0


def test_missing_columns(demand):
    with pytest.raises(ContractError, match="pickup_hour, trip_count"):
        series.feature_table(demand.select(ZONE))
    with pytest.raises(ContractError, match="weather columns: temperature_c"):
        series.join_weather(demand, demand.select(HOUR, F.lit(1.0).alias("precipitation_mm")))


def test_split_is_by_calendar_month(demand):
    split = series.time_split(demand)
    assert split.months == ("2024-01", "2024-02", "2024-03")
    assert split.test.agg(F.min(HOUR)).first()[0] == datetime(2024, 3, 1)
    assert split.validation.agg(F.max(HOUR)).first()[0] == datetime(2024, 2, 29, 23)
    with pytest.raises(ValueError, match="three calendar months"):
        series.time_split(split.train)


def test_lags_never_leak(demand):
    """Changing a later value leaves every earlier feature row unchanged."""
    late = datetime(2024, 3, 15)
    changed = demand.withColumn(COUNT, F.when(F.col(HOUR) >= late, F.col(COUNT) * 9).otherwise(F.col(COUNT)))
    before = series.feature_table(demand).filter(F.col(HOUR) < late)
    after = series.feature_table(changed).filter(F.col(HOUR) < late)
    assert before.exceptAll(after).isEmpty() and after.exceptAll(before).isEmpty()


def test_metric_identities(rows):
    frame = rows("y double, p double", (10.0, 8.0), (0.0, -3.0), (4.0, 6.0))
    got = {r.metric: r.value for r in scoring.metric_rows(frame, "y", {"m": "p"}, F.lit(9.0)).collect()}
    assert got["mae"] == pytest.approx(4 / 3) and got["wape"] == pytest.approx(4 / 14)
    assert got["rmse"] == pytest.approx((8 / 3) ** 0.5)
    assert got["high_demand_precision"] == 0.0 and got["high_demand_recall"] == 0.0
    zero = {r.metric: r.value for r in scoring.metric_rows(rows("y double, p double", (0.0, 2.0)), "y", {"m": "p"}, F.lit(1.0)).collect()}
    assert zero["wape"] == 2.0


FORECAST = "pickup_zone_id int, forecast_hour timestamp_ntz, predicted_trip_count double, model_type string, event_code int, is_event_window int"


def forecast(rows, **changes):
    data = []
    for hour in (0, 1):
        for zone in (1, 132):
            kind = "airport_specialist" if zone == 132 else "event_specialist" if hour == 0 else "global"
            row = dict(zone=zone, hour=datetime(2026, 5, 24, hour), value=5.0, kind=kind, code=0, window=int(hour == 0))
            data.append(row)
    for name, value in changes.items():
        data[0][name] = value
    return rows(FORECAST, *[tuple(r.values()) for r in data])


def checks(rows, frame, zones=(1, 132), horizon=2, airports=(132,)):
    known = rows("pickup_zone_id int", *[(z,) for z in zones])
    return {r.check: r.passed for r in gates.forecast_checks(frame, known, horizon, airports).collect()}


def test_complete_forecast_passes(rows):
    assert all(checks(rows, forecast(rows)).values())


@pytest.mark.parametrize(
    "changes, failed",
    [
        ({"value": -1.0}, {"no_negative_predictions"}),
        ({"value": None}, {"no_null_predictions", "no_negative_predictions"}),
        ({"kind": "global"}, {"event_model_routing"}),
        ({"window": 0}, {"global_model_routing"}),
        ({"zone": 7}, {"complete_zone_hour_grid"}),
    ],
)
def test_broken_forecasts_fail(rows, changes, failed):
    got = checks(rows, forecast(rows, **changes))
    assert {name for name, passed in got.items() if not passed} == failed


def test_incomplete_and_airportless_forecasts_fail(rows):
    full = forecast(rows)
    short = checks(rows, full.filter("pickup_zone_id = 1 OR hour(forecast_hour) = 0"))
    assert not short["expected_row_count"] and not short["complete_zone_hour_grid"] and short["unique_zone_hour"]
    twice = checks(rows, full.unionByName(full))
    assert not twice["unique_zone_hour"] and twice["complete_zone_hour_grid"]
    assert not checks(rows, full.filter("pickup_zone_id = 1"), zones=(1,))["airport_model_routing"]


def test_old_frames_route_by_event_code(rows):
    old = forecast(rows, code=5).drop("is_event_window")
    assert checks(rows, old)["event_model_routing"] and checks(rows, old)["global_model_routing"]


def test_absent_actuals_score_as_zero(rows):
    actual = rows(DEMAND, (1, datetime(2026, 5, 24, 0), 4.0), (132, datetime(2026, 5, 24, 1), 6.0))
    frame = forecast(rows)
    report = scoring.overall_report(scoring.scored_frame(frame, actual)).first()
    assert report.scored_rows == 4 and report.bias == pytest.approx((20 - 10) / 10)
    assert report.drift_passed is False
    early = actual.withColumn(HOUR, F.col(HOUR) - F.expr("INTERVAL 1 DAY"))
    assert tuple(scoring.maturity_status(frame, early).first()) == ("waiting_for_actuals", 0)


FOLD = "test_month string, scope string, metric string, value double"
SCOPES = {
    "baseline": 0.30, "candidate": 0.20, "airport_global_model": 0.30, "airport_specialist": 0.20, "ordinary_baseline": 0.30,
    "ordinary_candidate": 0.20, "event_previous_year": 0.40, "event_candidate": 0.30, "new_year_previous_week": 0.50,
    "new_year_candidate": 0.40,
}


def folds(rows, **worse):
    data = []
    for month in ("2024-07", "2024-08", "2024-09", "2024-10"):
        for scope, value in SCOPES.items():
            data.append((month, scope, "wape", worse.get(scope, value) if month == "2024-10" else value))
            data.append((month, scope, "high_demand_recall", 0.9))
    return rows(FOLD, *data)


def test_release_needs_every_fold(rows):
    assert all(r.passed for r in gates.release_checks(folds(rows)).collect())
    failed = {r.check for r in gates.release_checks(folds(rows, candidate=0.40)).collect() if not r.passed}
    assert failed == {"worst_fold_degradation_no_more_than_2pct"}
    few = {r.check for r in gates.release_checks(folds(rows).filter("test_month < '2024-10'")).collect() if not r.passed}
    assert few == {"minimum_four_folds"}
    zero = gates.release_checks(folds(rows, baseline=0.0)).collect()
    assert not {r.check: r.passed for r in zero}["worst_fold_degradation_no_more_than_2pct"]


def test_a_candidate_is_blocked_by_any_failed_check(spark):
    def decided(*rows):
        return tuple(gates.promotion(spark.createDataFrame(list(rows), "check string, passed boolean")).first())

    assert decided(("b", True), ("a", True)) == (True, "", "awaiting_human_approval", None)
    assert decided(("b", False), ("c", True), ("a", None)) == (False, "a,b", "blocked", "release_gate_failed")
    assert decided() == (False, "", "blocked", "release_gate_failed")


def test_small_segments_are_left_out(rows):
    frame = rows(
        "pickup_zone_id int, trip_count double, predicted_trip_count double, previous_week double, horizon_hour int, "
        "calendar_segment string, market string",
        (1, 200.0, 150.0, 100.0, 1, "weekend", "non_airport"),
        (2, 1.0, 9.0, 1.0, 1, "weekend", "non_airport"),
    )
    zones = [r for r in scoring.shadow_segments(frame).collect() if r.scope == "zone"]
    assert [(r.segment, r.wape, r.baseline_wape) for r in zones] == [("1", 0.25, 0.5)]


def test_quantiles_of_large_and_small_groups(spark):
    """Bracketed and whole groups, ties, NULL keys; compared with the built-in exact aggregate."""
    df = spark.range(450_000).select(
        F.when(F.col("id") % 3 == 0, "a").when(F.col("id") % 3 == 1, "b").alias("g"),
        F.when(F.col("id") % 5 == 0, F.lit(1.0)).when(F.col("id") % 1000 != 7, F.rand(7) * 100).alias("v"),
    )
    small = spark.range(7).select(F.lit("c").alias("g"), F.col("id").cast("double").alias("v"))
    df = df.unionByName(small).repartition(8)
    df = df.checkpoint()
    probabilities = (0.0, 0.25, 0.5, 0.95, 0.999, 1.0)
    want = {
        (r.g, p): q
        for r in df.groupBy("g").agg(F.percentile("v", F.array(*[F.lit(p) for p in probabilities])).alias("q")).collect()
        for p, q in zip(probabilities, r.q)
    }
    got = {(r.g, r.p): r.value for r in quantiles.exact_quantiles(df, "v", probabilities, "g").collect()}
    assert got.keys() == want.keys()
    for key, value in want.items():
        assert got[key] == pytest.approx(value, abs=1e-9), key
    overall = {r.p: r.value for r in quantiles.exact_quantiles(df, "v", (0.5,)).collect()}
    assert overall[0.5] == pytest.approx(df.agg(F.percentile("v", F.lit(0.5))).first()[0])


def test_sample_is_round_robin_over_days(spark):
    trips = spark.range(600).select(
        F.col("id").alias("trip_id"),
        (F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(
            F.when(F.col("id") < 500, 0).otherwise((F.col("id") % 4).cast("int")), F.lit(0), F.lit(0), F.col("id") % 60
        )).alias("tpep_pickup_datetime"),
        F.col("id").alias("PULocationID"),
        F.lit(1).alias("DOLocationID"),
    )
    sample = sampling.stratified_sample(trips, 40, "trip_id")
    per_day = {r[0].day: r[1] for r in sample.groupBy(F.to_date("tpep_pickup_datetime")).count().collect()}
    assert per_day == {1: 10, 2: 10, 3: 10, 4: 10}
    ranks = sampling.rank_within_day(trips, "trip_id")
    top = ranks.filter("sample_rank <= 10").select("trip_id")
    assert top.exceptAll(sample.select("trip_id")).isEmpty()
    totals = ranks.groupBy(F.to_date("tpep_pickup_datetime")).agg(F.max("sample_rank").alias("m"), F.count_distinct("sample_rank").alias("d"), F.count("*").alias("n"))
    assert all(r.m == r.d == r.n for r in totals.collect())
