import pytest
from pyspark.sql import functions as F

from kerbside.operators import legacy, profile
from kerbside.sources.tables import ContractError

SCHEMA = (
    "pickup_datetime string, dropoff_datetime string, trip_distance double, pickup_longitude double, pickup_latitude double, "
    "dropoff_longitude double, dropoff_latitude double, fare_amount double, surcharge double, tip_amount double"
)
VALID = dict(
    pickup_datetime="2013-01-04 23:55:00", dropoff_datetime="2013-01-05 00:05:00", trip_distance=2.0,
    pickup_longitude=-73.99, pickup_latitude=40.75, dropoff_longitude=-73.97, dropoff_latitude=40.77,
    fare_amount=12.0, surcharge=0.5, tip_amount=2.0,
)


def record(**changes):
    return tuple({**VALID, **changes}.values())


def test_duration_crosses_midnight(rows):
    row = legacy.add_trip_features(legacy.clean_trips(rows(SCHEMA, record()))).first()
    assert row.trip_time_in_secs == 600
    assert (row.pickup_hour, row.is_weekend, row.earning) == (23, False, 14.5)
    assert row.drive_speed_mph == pytest.approx(12.0)


@pytest.mark.parametrize(
    "change",
    [
        {"trip_distance": 0.0}, {"dropoff_datetime": "2013-01-04 22:00:00"}, {"fare_amount": -1.0},
        {"pickup_longitude": 0.0}, {"pickup_datetime": "soon"}, {"trip_distance": None}, {"trip_distance": 99.0},
        {"fare_amount": 31.0}, {"dropoff_longitude": -73.99, "dropoff_latitude": 40.75},
    ],
)
def test_implausible_records_are_dropped(rows, change):
    assert legacy.clean_trips(rows(SCHEMA, record(), record(**change))).count() == 1


def test_missing_columns_are_named_in_order(rows):
    with pytest.raises(ContractError, match="fare_amount, trip_distance"):
        legacy.clean_trips(rows(SCHEMA, record()).drop("trip_distance", "fare_amount"))


def test_join_is_one_to_one(rows):
    trips = rows(SCHEMA, record()).drop("surcharge", "tip_amount").withColumns({"medallion": F.lit("m"), "hack_license": F.lit("h")})
    fares = rows(SCHEMA, record()).select("pickup_datetime", "tip_amount").withColumns({"medallion": F.lit("m"), "hack_license": F.lit("h")})
    assert legacy.join_one_to_one(trips, fares).count() == 1
    with pytest.raises(ContractError, match="fare side"):
        legacy.join_one_to_one(trips, fares.unionByName(fares))
    with pytest.raises(ContractError, match="none of"):
        legacy.join_one_to_one(trips, fares.select("tip_amount"))


def test_missing_money_counts_as_zero(rows):
    row = legacy.add_trip_features(
        legacy.coerce(rows(SCHEMA, record(surcharge=None)), ("pickup_datetime",))
    ).first()
    assert row.earning == 14.0 and row.earning_per_mile == 7.0


def test_null_profile(rows):
    got = {r.column_name: r.null_rows for r in profile.null_counts(rows("a int, b string", (1, None), (None, None))).collect()}
    assert got == {"a": 1, "b": 2}


def test_removed_rows_explain_the_kept_ones(spark):
    from conftest import SMALL

    from kerbside.catalog.tables import Tables

    trips = Tables(spark, SMALL).legacy
    removed = legacy.validity_report(trips).agg(F.sum("removed_rows")).first()[0]
    kept = legacy.apply_validity(trips).count()
    assert 0 < kept < trips.count() and kept + removed == trips.count()


def test_sketched_quantiles_are_close(spark):
    from conftest import SMALL

    from kerbside.catalog.tables import Tables
    from kerbside.operators import gold, silver

    t = Tables(spark, SMALL)
    flagged = silver.with_flags(t.trips, t.zones)
    exact, quick = (gold.fare_distribution(flagged, exact).first() for exact in (True, False))
    assert exact.fare_eligible_rows == quick.fare_eligible_rows
    assert quick.median_fare == pytest.approx(exact.median_fare, rel=0.05)
    assert quick.p95_fare == pytest.approx(exact.p95_fare, rel=0.05)
    bands = [r.distance_miles for r in gold.by_distance_band(flagged, exact=False).collect()]
    assert bands == [r.distance_miles for r in gold.by_distance_band(flagged).collect()]
