"""Snapshots of the streamed demand: few files for readers, equal sums, and nothing lost or doubled by a crash."""

from datetime import datetime, timedelta

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from kerbside.operators import gold
from kerbside.streaming import hourly

START = datetime(2024, 1, 1)


def batch(out, number, rows, mark=True):
    """A batch folder as the stream writes it; rows are (zone, hours after the start, trips)."""
    folder = out / f"batch={number}"
    folder.mkdir(parents=True)
    zones, hours, trips = zip(*rows)
    columns = {
        "pickup_zone_id": pa.array(zones, pa.int32()), "pickup_borough": pa.array(["b"] * len(rows)),
        "pickup_zone": pa.array([None if z is None else f"z{z}" for z in zones]),
        "pickup_hour": pa.array([START + timedelta(hours=h) for h in hours], pa.timestamp("us")), "trip_count": pa.array(trips, pa.int64()),
    }
    pq.write_table(pa.table(columns), folder / "part.parquet")
    if mark:
        (folder / "_SUCCESS").touch()


def sums(spark, out):
    found = hourly.demand_so_far(spark, str(out)).collect()
    assert len({(r.pickup_zone_id, r.pickup_hour) for r in found}) == len(found)
    return {(r.pickup_zone_id, (r.pickup_hour - START) // timedelta(hours=1)): r.trip_count for r in found}


def files(spark, out):
    return len(hourly.demand_so_far(spark, str(out)).inputFiles())


def expected(batches):
    total = {}
    for rows in batches:
        for zone, hour, trips in rows:
            total[zone, hour] = total.get((zone, hour), 0) + trips
    return total


def test_hundred_batches_become_few_files(spark, tmp_path):
    """Batch n is late by n hours for one zone and always adds to the same hour of another and of a missing one."""
    rows = [[(1, 200 - n, n + 1), (2, 5, 1), (None, 5, 2)] for n in range(100)]
    for n, part in enumerate(rows):
        batch(tmp_path, n, part)
    want = expected(rows)
    assert sums(spark, tmp_path) == want and files(spark, tmp_path) == 100
    assert hourly.compact(spark, str(tmp_path)) == 98
    assert sums(spark, tmp_path) == want and files(spark, tmp_path) <= 5
    assert (tmp_path / "batch=0").exists()  # for readers who began before the switch

    batch(tmp_path, 100, late := [(1, 200, 7), (9, 0, 1)])  # corrects an hour of the snapshot
    assert sums(spark, tmp_path) == expected(rows + [late])
    assert hourly.compact(spark, str(tmp_path)) == 99
    assert sums(spark, tmp_path) == expected(rows + [late])
    assert sorted(p.name for p in tmp_path.glob("batch=*")) == ["batch=100", "batch=99"]
    assert hourly.compact(spark, str(tmp_path)) == 99  # nothing has settled since


def test_hours_of_a_snapshot_are_sorted(spark, tmp_path):
    for n in range(3):
        batch(tmp_path, n, [(z, (7 * z + n) % 24, 1) for z in range(50)])
    hourly.compact(spark, str(tmp_path))
    for path in (tmp_path / "_snapshots" / "upto=1").glob("*.parquet"):
        held = pq.read_table(path)["pickup_hour"].to_pylist()
        assert held == sorted(held)


@pytest.mark.parametrize("broken", ["no mark", "no files"])
def test_crash_between_write_and_switch(spark, tmp_path, broken):
    rows = [[(1, n, 1), (2, 0, 1)] for n in range(6)]
    for n, part in enumerate(rows):
        batch(tmp_path, n, part)
    hourly.compact(spark, str(tmp_path), 3)
    assert hourly.compact(spark, str(tmp_path), 5) == 4
    # As if it had stopped before the mark: the older snapshot and its batches stand.
    folder = tmp_path / "_snapshots" / "upto=4"
    (folder / "_SUCCESS").unlink()
    if broken == "no files":
        for path in folder.glob("*.parquet"):
            path.unlink()
    assert sums(spark, tmp_path) == expected(rows)
    assert hourly.compact(spark, str(tmp_path), 5) == 4
    assert sums(spark, tmp_path) == expected(rows)


def test_crash_before_the_deletion_and_a_batch_without_mark(spark, tmp_path):
    rows = [[(1, n, 1), (2, 0, 1)] for n in range(4)]
    for n, part in enumerate(rows):
        batch(tmp_path, n, part)
    batch(tmp_path, 4, [(1, 0, 50)], mark=False)  # still being written
    assert sums(spark, tmp_path) == expected(rows)
    assert hourly.compact(spark, str(tmp_path)) == 2
    (tmp_path / "batch=4" / "_SUCCESS").touch()
    want = expected(rows + [[(1, 0, 50)]])
    assert hourly.compact(spark, str(tmp_path)) == 3 and sums(spark, tmp_path) == want
    batch(tmp_path, 0, rows[0])  # a deletion that didn't happen changes nothing
    assert sums(spark, tmp_path) == want


def test_stream_folds_its_own_batches(spark, tmp_path):
    """Eleven deliveries, the fold every three; a second run goes on; a foreign checkpoint is refused."""
    schema = "tpep_pickup_datetime timestamp_ntz, year int, month int, PULocationID int"
    data = [(START + timedelta(days=(7 * d) % 11, hours=h), 2024, 1, z) for d in range(11) for h in (0, 9) for z in (1, 2, None)]
    trips = spark.createDataFrame(data, schema)
    zones = spark.createDataFrame([(1, "A", "a", "s"), (2, "B", "b", "s")], "LocationID int, Borough string, Zone string, service_zone string")
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    for days in (range(7), range(7, 11)):
        for d in days:
            trips.filter(F.dayofmonth("tpep_pickup_datetime") == d + 1).coalesce(1).write.mode("append").parquet(source)
        hourly.run_available(hourly.read_stream(spark, source, trips.schema, 1), zones, out, state, batches_per_snapshot=3)
    covered, waiting = hourly._parts(spark, out)
    assert covered == 8 and waiting == [9, 10]
    got, want = hourly.demand_so_far(spark, out), gold.hourly_zone_demand_from_trips(trips, zones)
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    with pytest.raises(Exception, match="part of a snapshot"):
        hourly.run_available(hourly.read_stream(spark, source, trips.schema, 1), zones, out, str(tmp_path / "other"))


def test_nothing_has_arrived(spark, tmp_path):
    assert hourly.compact(spark, str(tmp_path / "none")) is None
    assert hourly.demand_so_far(spark, str(tmp_path / "none"), "2 HOUR").isEmpty()
