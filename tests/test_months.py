"""Months whose files differ in types and columns, and time bounds that reach the scan."""

import pytest
from pyspark.sql import functions as F, types as T

from kerbside.catalog.support import name_files_by_month
from kerbside.plans import monthly_release
from kerbside.sources import months, widening
from kerbside.sources.tables import ContractError
from kerbside.sources.widening import wider


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def month(spark, root, period, kind, values, extra=""):
    year, number = map(int, period.split("-"))
    df = spark.createDataFrame([(v, v) for v in values], "i int, passenger_count int")
    df = df.select("i", F.col("passenger_count").cast(kind), *([F.expr(extra)] if extra else []))
    df.coalesce(1).write.mode("append").parquet(f"{root}/year={year}/month={number:02d}")


@pytest.mark.parametrize(
    "left, right, want",
    [
        ("int", "bigint", "bigint"), ("smallint", "int", "int"), ("bigint", "double", "double"), ("float", "double", "double"),
        ("int", "float", "double"), ("decimal(5,2)", "decimal(9,1)", "decimal(10,2)"), ("int", "decimal(4,2)", "decimal(12,2)"),
        ("decimal(38,0)", "decimal(38,20)", "double"), ("decimal(8,2)", "float", "double"), ("timestamp", "timestamp_ntz", "timestamp_ntz"),
        ("string", "int", None), ("date", "timestamp_ntz", None), ("boolean", "int", None),
    ],
)
def test_the_wider_of_two_types(spark, left, right, want):
    kinds = [T.StructType.fromDDL(f"c {k}")["c"].dataType for k in (left, right)]
    for pair in (kinds, kinds[::-1]):
        found = wider(*pair)
        assert (found and found.simpleString()) == want


def test_months_of_three_types_and_an_absent_column(spark, tmp_path):
    root = str(tmp_path)
    month(spark, root, "2023-12", "string", [9])  # outside the window: neither its types nor its rows count
    month(spark, root, "2024-01", "int", [1, 2])
    month(spark, root, "2024-02", "bigint", [3], "CAST(1.5 AS DOUBLE) AS tolls_amount")
    month(spark, root, "2024-03", "double", [4], "CAST(2.5 AS FLOAT) AS tolls_amount")
    month(spark, root, "2024-04", "int", [5], "'x' AS note")
    got = months.read_partitioned(spark, root, "2024-01", "2024-04")
    kinds = {f.name: f.dataType.simpleString() for f in got.schema}
    assert kinds == {"i": "int", "passenger_count": "double", "tolls_amount": "double", "note": "string", "year": "int", "month": "int"}
    rows = sorted((r.i, r.passenger_count, r.tolls_amount, r.note, r.year, r.month) for r in got.collect())
    assert rows == [
        (1, 1.0, None, None, 2024, 1), (2, 2.0, None, None, 2024, 1), (3, 3.0, 1.5, None, 2024, 2), (4, 4.0, 2.5, None, 2024, 3),
        (5, 5.0, None, "x", 2024, 4),
    ]
    one = months.read_partitioned(spark, root, "2024-01", "2024-01")
    assert dict(one.dtypes)["passenger_count"] == "int"
    assert plan(got).count("Scan parquet") == 3  # both months of whole numbers, 2024-02 apart, and the one of doubles


def test_footers_outside_the_window_stay_closed(spark, tmp_path):
    root = str(tmp_path)
    month(spark, root, "2024-01", "int", [1])
    month(spark, root, "2024-02", "double", [2])
    broken = tmp_path / "year=2024" / "month=03"
    broken.mkdir()
    (broken / "broken.parquet").write_bytes(b"no footer")
    assert months.read_partitioned(spark, root, "2024-01", "2024-02").count() == 2
    assert months.read_partitioned(spark, root, end="2024-02").count() == 2
    with pytest.raises(Exception, match="broken.parquet"):
        months.read_partitioned(spark, root).count()
    with pytest.raises(ValueError, match="No months"):
        months.read_partitioned(spark, root, "2025-01")


def test_one_month_may_hold_files_of_different_types(spark, tmp_path):
    root = str(tmp_path)
    for kind, value in (("int", 1), ("double", 2), ("bigint", 3)):
        month(spark, root, "2024-01", kind, [value])
    month(spark, root, "2024-02", "int", [4])
    got = months.read_partitioned(spark, root)
    assert sorted((r.passenger_count, r.month) for r in got.collect()) == [(1.0, 1), (2.0, 1), (3.0, 1), (4.0, 2)]


def test_types_outside_the_contract_are_refused(spark, tmp_path):
    root = str(tmp_path)
    month(spark, root, "2024-01", "int", [1])
    month(spark, root, "2024-02", "string", [2])
    with pytest.raises(ContractError, match="passenger_count is string"):
        months.read_partitioned(spark, root)
    month(spark, root, "2024-03", "int", [2], "'x' AS i2")
    month(spark, root, "2024-04", "int", [2], "1 AS i2")
    with pytest.raises(ContractError, match="i2 is"):
        months.read_partitioned(spark, root, "2024-03")
    # Zone numbers may be INTEGER or BIGINT, but no allowed type holds both of them and doubles.
    with pytest.raises(ContractError, match="PULocationID is double"):
        groups = [widening.Group(("a",), T.StructType.fromDDL("PULocationID double"))]
        widening.common_types(groups, widening.TRIP_CONTRACT)


def test_a_release_over_months_of_different_types(spark, tmp_path):
    """Bronze months that never merged before go through Silver to Gold."""
    from test_silver import THREE, TRIP

    paths = monthly_release.ReleasePaths(*(str(tmp_path / n) for n in ("bronze", "silver", "reports", "gold")))
    zones = spark.createDataFrame([(100, "Queens", "A", "x"), (200, "Bronx", "B", "y")], "LocationID long, Borough string, Zone string, service_zone string")
    trips = spark.createDataFrame(list(THREE), TRIP)
    later = trips.withColumns({c: F.col(c) + F.expr("INTERVAL 31 DAY") for c in ("tpep_pickup_datetime", "tpep_dropoff_datetime")})
    later = later.withColumns({"month": F.lit(2), "passenger_count": F.col("passenger_count").cast("double"), "note": F.lit("new")})
    for frame in (trips, later):
        frame.write.mode("append").partitionBy("year", "month").parquet(paths.bronze)
    wanted = spark.createDataFrame([("2024-01",), ("2024-02",)], "period string")
    assert monthly_release.build_silver(spark, paths, zones, wanted) == 2
    enriched = months.read_partitioned(spark, paths.silver)
    assert enriched.count() == 2 * len(THREE) and enriched.filter("note = 'new' AND month = 2").count() == len(THREE)


def test_month_bounds_are_pushed_into_each_months_scan(spark, tmp_path):
    path = str(tmp_path / "deliveries")
    for period, kind in (("2024-01", "int"), ("2024-02", "bigint")):
        times = [f"{period}-01 00:00:00", f"{period}-28 23:59:59.999999", "2023-12-31 23:59:59", "2024-03-01 00:00:00"]
        df = spark.createDataFrame([(t,) for t in times], "t string")
        own = df.select(F.col("t").cast("timestamp_ntz").alias("tpep_pickup_datetime"), F.lit(2).cast(kind).alias("passenger_count"))
        own.coalesce(1).write.parquet(f"{path}/{period}")
        name_files_by_month(spark, f"{path}/{period}", period)
    bounded = months.read_month_bounded(spark, path)
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    assert sorted(str(r.tpep_pickup_datetime)[:10] for r in bounded.collect()) == ["2024-01-01", "2024-01-28", "2024-02-01", "2024-02-28"]
    text = plan(bounded)
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    for first, after in (("2024-01-01", "2024-02-01"), ("2024-02-01", "2024-03-01")):
        assert f"GreaterThanOrEqual(tpep_pickup_datetime,{first}T00:00)" in text
        assert f"LessThan(tpep_pickup_datetime,{after}T00:00)" in text
