"""Gold's lineage record: observed totals, verified files, refusals."""

import pytest
from pyspark.sql import functions as F
from test_silver import TRIP, trip

from kerbside.operators import silver
from kerbside.plans import monthly_release
from kerbside.sources import digests, months, widening


@pytest.fixture
def release(spark, tmp_path):
    zones = spark.createDataFrame(
        [(100, "Queens", "A", "x"), (200, "Bronx", "B", "y")], "LocationID long, Borough string, Zone string, service_zone string"
    )
    paths = [str(tmp_path / n) for n in ("silver", "gold", "gold_lineage")]
    times = [("2024-01-01 10:00:00", "2024-01-01 10:10:00"), ("2024-01-01 10:30:00", "2024-01-01 10:50:00"), ("2024-01-02 09:00:00", "2024-01-02 09:05:00")]
    trips = spark.createDataFrame([trip(*at, pu=zone) for at, zone in zip(times, (100, 100, 200))], TRIP)
    months.write_partitioned(silver.with_flags(trips, zones), paths[0])
    return (*paths, monthly_release.write_gold(spark, *paths))


def test_totals_are_those_that_were_written(spark, release):
    source, product, _, record = release
    gold = spark.read.parquet(product)
    totals = {(r.product, r.rows, r.trips) for r in record.collect()}
    assert totals == {("hourly_zone_demand", 2, 3)} and gold.count() == 2
    files = {kind: {r.path for r in record.filter(F.col("kind") == kind).collect()} for kind in ("source", "output")}
    assert files["source"] == set(widening.data_files(spark, source)) and files["output"] == set(widening.data_files(spark, product))
    read = digests.read_product(spark, record)
    assert sorted(map(str, read.collect())) == sorted(map(str, gold.collect()))


def test_observed_totals_count_each_row_once(spark, tmp_path):
    """Range partitioning samples its input in a job of its own, which must not add to the totals."""
    df = spark.range(0, 50_000, 1, 8).withColumn("k", F.xxhash64("id"))
    measures = {"rows": F.count(F.lit(1)), "total": F.sum("id")}
    assert months.write_sorted(df, str(tmp_path / "t"), "k", measures=measures) == {"rows": 50_000, "total": 50_000 * 49_999 // 2}


@pytest.mark.parametrize("kind", ["source", "output"])
def test_changed_and_missing_files_are_refused(spark, release, kind):
    source, product, _, record = release
    system, path = widening.file_system(spark, record.filter(F.col("kind") == kind).first().path)
    from pathlib import Path

    local = Path(path.toUri().getPath())
    content = local.read_bytes()
    local.write_bytes(content[:-8] + b"\0\0\0\0PAR1")
    (local.parent / f".{local.name}.crc").unlink(missing_ok=True)
    assert {(r.kind, r.status) for r in digests.broken_lineage(spark, record).collect()} == {(kind, "changed")}
    local.unlink()
    assert {(r.kind, r.status) for r in digests.broken_lineage(spark, record).collect()} == {(kind, "missing")}
    with pytest.raises(ValueError, match="Lineage check failed"):
        digests.read_product(spark, record)
