from datetime import datetime

import pytest
from pyspark.sql import Window, functions as F

from kerbside.operators import profile, gates, gold, silver
from kerbside.plans import monthly_release
from kerbside.sources import months, tables

TRIP = (
    "VendorID int, tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz, passenger_count int, "
    "trip_distance decimal(10,2), RatecodeID int, PULocationID int, DOLocationID int, payment_type int, "
    "fare_amount decimal(10,2), tip_amount decimal(10,2), tolls_amount decimal(10,2), total_amount decimal(10,2), "
    "year int, month int"
)


def trip(pickup, dropoff, distance=2, pu=1, do=2, fare=12, total=15, year=2024, month=1):
    from decimal import Decimal

    d = lambda v: None if v is None else Decimal(v)
    at = lambda v: None if v is None else datetime.fromisoformat(v)
    return (1, at(pickup), at(dropoff), 1, d(distance), 1, pu, do, 1, d(fare), d(2), d(0), d(total), year, month)


THREE = [
    trip("2024-01-05 10:00:00", "2024-01-05 10:20:00"),
    trip("2024-01-05 11:00:00", "2024-01-05 10:50:00", distance=-1, pu=999, fare=-5, total=-5),
    trip("2002-01-05 10:00:00", "2002-01-05 10:20:00"),
]


@pytest.fixture
def zones(rows):
    return rows(
        "LocationID bigint, Borough string, Zone string, service_zone string",
        (1, "Manhattan", "Alpha", "Yellow Zone"),
        (2, "Queens", "Beta", "Boro Zone"),
    )


def test_three_row_month(rows, zones):
    enriched = silver.build_silver(rows(TRIP, *THREE), zones)
    counts = silver.quality_counts(enriched).first()
    assert counts.source_rows == 3
    assert counts.pickup_outside_partition == 1
    assert counts.unknown_pickup_zone == 1
    assert counts.demand_eligible == 1
    assert counts.nonpositive_duration == counts.negative_distance == counts.negative_fare == counts.negative_total == 1
    product = gold.hourly_zone_demand(enriched).collect()
    assert [(r.pickup_borough, r.trip_count) for r in product] == [("Manhattan", 1)]


def test_flags_keep_unknown(rows, zones):
    """One NULL per input column: value flags turn NULL, absence flags are decided."""
    row = silver.build_silver(rows(TRIP, trip(None, "2024-01-05 10:00:00", None, None, None, None, None)), zones).first()
    assert row.dq_missing_pickup_datetime is True
    assert row.dq_pickup_outside_partition is None
    assert row.dq_nonpositive_duration is None and row.derived_speed_mph is None and row.dq_implausible_speed is None
    assert row.dq_negative_distance is None and row.dq_negative_fare is None and row.dq_negative_total is None
    assert row.dq_unknown_pickup_zone is True and row.dq_unknown_dropoff_zone is True
    assert row.dq_valid_for_demand is False and row.dq_valid_for_fare is False


def test_unknown_fare_makes_fare_eligibility_unknown(rows, zones):
    row = silver.build_silver(rows(TRIP, trip("2024-01-05 10:00:00", "2024-01-05 10:20:00", fare=None)), zones).first()
    assert row.dq_valid_for_demand is True and row.dq_valid_for_fare is None


def test_month_end_is_inside(rows, zones):
    last = trip("2024-01-31 23:59:59.999999", "2024-02-01 00:10:00")
    after = trip("2024-02-01 00:00:00", "2024-02-01 00:10:00")
    got = silver.with_flags(rows(TRIP, last, after), zones).orderBy("tpep_pickup_datetime")
    assert [r.dq_pickup_outside_partition for r in got.collect()] == [False, True]


def test_duplicates_equal_the_window_form(rows):
    data = [trip("2024-01-05 10:00:00", "2024-01-05 10:20:00", fare=i % 7, pu=i % 3) for i in range(40)]
    data += [trip(None, None, None, None, None, None, None)] * 2
    data += [trip(None, None, None, None, None, None, None, month=2)]
    data += [trip("2024-01-06 10:00:00", "2024-01-05 10:20:00", fare=i) for i in range(5)]
    df = rows(TRIP, *data).withColumn("id", F.monotonically_increasing_id())
    window = F.count("*").over(Window.partitionBy(*silver.DUPLICATE_KEY)) > 1
    want = {r.id: r.w for r in df.select("id", window.alias("w")).collect()}
    got = {r.id: r.dq_candidate_duplicate for r in silver.flag_duplicates(df).collect()}
    assert got == want and True in got.values() and False in got.values()


def test_repeated_zone_key_is_refused(rows, zones):
    with pytest.raises(tables.ContractError, match="unique"):
        silver.build_silver(rows(TRIP, *THREE), zones.unionByName(zones))


def test_observed_counts_match(spark, rows, zones, tmp_path):
    watched, seen = silver.observe_counts(silver.build_silver(rows(TRIP, *THREE), zones))
    watched.write.parquet(str(tmp_path / "s"))
    counts = silver.quality_counts(spark.read.parquet(str(tmp_path / "s"))).first().asDict()
    assert seen.get == counts


def test_reconciliation_sees_lost_rows(rows):
    df = rows(TRIP, *THREE)
    assert silver.reconcile(df, df).first().reconciled
    assert not silver.reconcile(df, df.filter("trip_distance > 0")).first().reconciled
    by_month = silver.reconcile(df, df.filter("month = 9"), "month").collect()
    assert [(r.month, r.reconciled) for r in by_month] == [(1, False)]


def test_contract_lists_every_violation(rows):
    assert tables.contract_violations(rows(TRIP, *THREE)) == []
    broken = rows(TRIP, *THREE).drop("VendorID").withColumn("fare_amount", F.lit("x"))
    assert {c for c, _, _ in tables.contract_violations(broken)} == {"VendorID", "fare_amount"}
    with pytest.raises(tables.ContractError, match="VendorID.*fare_amount"):
        tables.check_contract(broken)


def report(**counts):
    base = dict(
        period="2024-01", reconciled=True, source_rows=1000, pickup_outside_partition=0, unknown_pickup_zone=0,
        candidate_duplicate_rows=0, negative_fare=1, implausible_speed=0, demand_eligible=999,
    )
    return tuple({**base, **counts}.values())


REPORT = (
    "period string, reconciled boolean, source_rows bigint, pickup_outside_partition bigint, unknown_pickup_zone bigint, "
    "candidate_duplicate_rows bigint, negative_fare bigint, implausible_speed bigint, demand_eligible bigint"
)


@pytest.mark.parametrize(
    "counts, product, passed, warnings",
    [
        ({}, "demand", True, 0),
        ({"negative_fare": 100}, "demand", True, 1),
        ({"negative_fare": 100}, "fare", False, 0),
        ({"reconciled": False}, "demand", False, 0),
        ({"unknown_pickup_zone": 11}, "demand", False, 0),
        ({"demand_eligible": 940}, "demand", False, 0),
    ],
)
def test_quality_verdicts(rows, counts, product, passed, warnings):
    row = gates.quality_verdict(gates.quality_checks(rows(REPORT, report(**counts)), product)).first()
    assert (row.passed, row.warnings) == (passed, warnings)


def test_missing_report_fails_the_release(rows):
    verdicts = gates.quality_verdict(gates.quality_checks(rows(REPORT, report())))
    expected = rows("period string", ("2024-01",), ("2024-02",))
    row = gates.completeness(expected, verdicts).first()
    assert (row.expected_periods, row.missing_reports, row.passed) == (2, 1, False)


def test_monthly_release(spark, rows, zones, tmp_path):
    """Two good months are built once, skipped the second time, gated and published."""
    paths = monthly_release.ReleasePaths(*[str(tmp_path / n) for n in ("bronze", "silver", "reports", "gold")])
    data = [trip(f"2024-0{m}-05 10:{i % 60:02d}:{i // 60:02d}", f"2024-0{m}-05 12:00:00", month=m) for m in (1, 2) for i in range(120)]
    months.write_partitioned(rows(TRIP, *data), paths.bronze)
    wanted = rows("period string", ("2024-01",), ("2024-02",))
    assert monthly_release.build_silver(spark, paths, zones, wanted) == 2
    assert monthly_release.build_silver(spark, paths, zones, wanted) == 0
    assert monthly_release.build_silver(spark, paths, zones, wanted.limit(1), force=True) == 1
    totals = monthly_release.publish_gold(spark, paths, wanted).first()
    assert totals.trips == 240
    assert spark.read.parquet(paths.silver).groupBy("month").count().count() == 2


def test_failed_gate_leaves_gold_alone(spark, rows, zones, tmp_path):
    paths = monthly_release.ReleasePaths(*[str(tmp_path / n) for n in ("bronze", "silver", "reports", "gold")])
    months.write_partitioned(rows(TRIP, *THREE), paths.bronze)
    wanted = rows("period string", ("2024-01",))
    monthly_release.build_silver(spark, paths, zones, wanted)
    with pytest.raises(RuntimeError, match="gate failed"):
        monthly_release.publish_gold(spark, paths, wanted)
    assert not (tmp_path / "gold").exists()


def test_hourly_stats_of_a_bounded_month(spark, rows, tmp_path):
    data = [
        trip("2024-01-01 10:00:00", "2024-01-01 10:10:00", pu=100),
        trip("2024-01-01 10:30:00", "2024-01-01 10:50:00", pu=100),
        trip("2024-01-02 09:00:00", "2024-01-02 09:05:00", pu=200),
        trip("2002-01-02 09:00:00", "2002-01-02 09:05:00", pu=200),
    ]
    from kerbside.catalog.support import name_files_by_month

    rows(TRIP, *data).drop("year", "month").write.parquet(str(tmp_path / "m"))
    name_files_by_month(spark, str(tmp_path / "m"), "2024-01")
    bounded = months.read_month_bounded(spark, str(tmp_path / "m"))
    stats = gold.hourly_demand_stats(bounded).orderBy("pickup_hour").collect()
    assert [r.trip_count for r in stats] == [2, 1]
    assert stats[0].avg_duration_seconds == 900.0


def test_file_without_a_month_is_refused(spark, rows, tmp_path):
    rows(TRIP, *THREE).write.parquet(str(tmp_path / "m"))
    with pytest.raises(Exception, match="No year and month"):
        months.read_month_bounded(spark, str(tmp_path / "m")).count()


def test_box_stats_keep_the_group_without_a_name(rows):
    df = rows("g string, v double", ("a", 1.0), ("a", 3.0), (None, 2.0), (None, 4.0))
    got = {r.g: (r.q50, r.below, r.above) for r in profile.box_stats(df, "v", "g").collect()}
    assert got == {"a": (2.0, 0, 0), None: (3.0, 0, 0)}
