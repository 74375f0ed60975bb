from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from kerbside.operators import scoring
from kerbside.operators.series import COUNT, HOUR, ZONE
from kerbside.plans import recursion
from kerbside.plans.demand_models import RoutedModel

DEMAND = "pickup_zone_id int, pickup_hour timestamp_ntz, trip_count double"


def constant(value):
    return lambda frame, output: frame.withColumn(output, F.lit(value))


def from_columns(expression):
    return lambda frame, output: frame.withColumn(output, F.expr(expression))


ROUTED = RoutedModel(constant(10.0), constant(30.0), constant(20.0), (132,))
SHADOW = RoutedModel(
    from_columns("0.5 * lag_24 + 0.3 * rolling_mean_3 + 0.2 * lag_168"), from_columns("lag_1 + 1"), None, (132,)
)


def shadow_rows():
    start = datetime(2024, 5, 20)
    return [
        (zone, start + timedelta(hours=i), float(10 + zone % 10 + i % 24 + i // 24)) for zone in (1, 132) for i in range(12 * 24)
    ]


@pytest.fixture(scope="module")
def demand(spark):
    return spark.createDataFrame(shadow_rows(), DEMAND)


def test_history_fills_absent_hours(rows):
    sparse = rows(DEMAND, (1, datetime(2024, 1, 8), 3.0), (1, datetime(2024, 1, 10), 5.0), (2, datetime(2024, 1, 9, 23), 1.0))
    got = {r[ZONE]: r.history for r in recursion.zone_histories(sparse, recursion.next_origin(sparse)).collect()}
    assert len(got[1]) == 168 and got[1][-1] == 5.0 and got[1][-49] == 3.0 and sum(got[1]) == 8.0
    assert got[2][-2] == 1.0 and sum(got[2]) == 1.0


def test_specialists_are_routed(rows):
    """The first forecast hour is in an event window: the eve of the last Monday of May."""
    history = [(zone, datetime(2026, 5, 23) + timedelta(hours=h), 1.0) for zone in (1, 132) for h in range(23)]
    forecast = recursion.recursive_forecast(rows(DEMAND, *history), ROUTED, recursion.next_origin(rows(DEMAND, *history)), 2)
    got = {(r.horizon_hour, r[ZONE]): (r.model_type, r.predicted_trip_count) for r in forecast.collect()}
    assert got == {
        (1, 1): ("global", 10.0),
        (1, 132): ("airport_specialist", 30.0),
        (2, 1): ("event_specialist", 20.0),
        (2, 132): ("airport_specialist", 30.0),
    }


def by_hand(day):
    """The same recursion in plain Python."""
    history = {zone: [v for z, h, v in shadow_rows() if z == zone and h < day][-168:] for zone in (1, 132)}
    found = {}
    for ahead in range(24):
        for zone, past in history.items():
            if zone == 132:
                value = past[-1] + 1
            else:
                value = 0.5 * past[-24] + 0.3 * sum(past[-3:]) / 3 + 0.2 * past[-168]
            past.append(value)
            found[zone, day + timedelta(hours=ahead)] = value
    return found


def test_all_days_at_once_equal_one_day_at_a_time(demand):
    scored = recursion.shadow_forecast(demand, SHADOW, "2024-05-28", "2024-05-30")
    got = {(r[ZONE], r.forecast_hour): r.predicted_trip_count for r in scored.collect()}
    want = {}
    for day in (28, 29, 30):
        want.update(by_hand(datetime(2024, 5, day)))
    assert got.keys() == want.keys()
    for key in want:
        assert got[key] == pytest.approx(want[key])


def test_later_actuals_do_not_change_a_forecast(demand):
    day = datetime(2024, 5, 29)
    changed = demand.withColumn(COUNT, F.when(F.col(HOUR) >= day, 999.0).otherwise(F.col(COUNT)))
    columns = (ZONE, "forecast_hour", "predicted_trip_count")
    before = recursion.shadow_forecast(demand, SHADOW, "2024-05-29", "2024-05-29").select(*columns).collect()
    after = recursion.shadow_forecast(changed, SHADOW, "2024-05-29", "2024-05-29").select(*columns).collect()
    assert sorted(before) == sorted(after)


def test_daily_record(demand):
    result = recursion.shadow_evaluation(demand, SHADOW, "2024-05-28", "2024-05-29")
    scored = result["scored"].toPandas()
    daily = {str(r.day): r for r in result["daily"].collect()}
    assert set(daily) == {"2024-05-28", "2024-05-29"}
    one = scored[scored.origin == "2024-05-28"]
    wape = (one.trip_count - one.predicted_trip_count).abs().sum() / one.trip_count.sum()
    base = (one.trip_count - one.previous_week).abs().sum() / one.trip_count.sum()
    row = daily["2024-05-28"]
    assert row.wape == pytest.approx(wape) and row.baseline_wape == pytest.approx(base)
    assert row.candidate_won == (wape < base)
    assert result["segments"].filter("scope = 'horizon'").count() == 24
    assert result["overall"].first().scored_rows == 96


def test_short_history_is_refused(demand):
    with pytest.raises(ValueError, match="168 hours"):
        recursion.shadow_forecast(demand, SHADOW, "2024-05-22", "2024-05-22")


def test_published_forecast_is_validated(demand):
    frame = recursion.publishable_forecast(demand, ROUTED, 3, version="v1")
    assert frame.columns == [
        "forecast_generated_at", "forecast_hour", ZONE, "predicted_trip_count", "model_type", "model_version", "event_code",
        "is_event_window",
    ]
    assert frame.count() == 6
    with pytest.raises(ValueError, match="airport_model_routing"):
        recursion.publishable_forecast(demand.filter("pickup_zone_id = 1"), ROUTED, 2)


def test_previous_year_of_leap_day(rows):
    data = rows(DEMAND, (1, datetime(2023, 2, 28, 5), 4.0), (1, datetime(2024, 2, 29, 5), 9.0))
    got = {r[HOUR]: r.previous_year for r in scoring.join_previous_year(data, data).collect()}
    assert got[datetime(2024, 2, 29, 5)] == 4.0 and got[datetime(2023, 2, 28, 5)] == 0.0


def test_hours_after_the_last_actual_are_not_scored(demand):
    known = demand.filter(F.col(HOUR) <= datetime(2024, 5, 30, 11))
    scored = recursion.shadow_forecast(known, SHADOW, "2024-05-30", "2024-05-30")
    assert scored.agg(F.max(scoring.FORECAST_HOUR)).first()[0] == datetime(2024, 5, 30, 11)
    with pytest.raises(ValueError, match="No actuals for 2024-05-31"):
        recursion.shadow_forecast(known, SHADOW, "2024-05-30", "2024-05-31")
