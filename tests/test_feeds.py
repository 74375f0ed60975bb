from datetime import datetime, timedelta

import json

import pytest
from pyspark.sql import functions as F

from kerbside.operators import gold, rank_history, silver
from kerbside.sources import digests, months, rank_feed
from kerbside.streaming import hourly

RECORD = dict(
    rank_id="Q-17", tsn="41", comments="None", total_bays="8", start_time="2025-07-03T21:30:00Z", end_time="2025-07-03T21:45:00Z",
    from_previous_count="3", total="9", new_arrivals="11", average_wait="75",
)
HISTORY = [
    {**RECORD, "class": "wat", "from_previous_count": "2", "total": "5", "new_arrivals": "3"},
    {**RECORD, "class": "Passenger", "from_previous_count": "High", "total": "Low", "new_arrivals": "Medium"},
    {**RECORD, "class": "Taxi"},
]


def documents(spark, tmp_path, payload, mark=""):
    folder = tmp_path / "feed"
    folder.mkdir(exist_ok=True)
    (folder / "history.json").write_text(mark + json.dumps(payload), encoding="utf-8")
    return rank_feed.read_documents(spark, str(folder))


def test_history_with_byte_order_mark(spark, tmp_path):
    docs = documents(spark, tmp_path, {"rank_history": HISTORY}, "\ufeff")
    records = rank_feed.require_records(rank_feed.root_records(docs, "historical"))
    table = rank_history.normalize(records)
    assert len(table.columns) == 27
    got = {r["class"]: r for r in table.collect()}
    assert got["passenger"].new_arrivals_band == 1 and got["passenger"].new_arrivals_count is None
    assert got["taxi"].new_arrivals_count == 11.0 and got["taxi"].new_arrivals_band is None
    assert got["taxi"].start_time_sydney.hour == 7 and got["taxi"].comments is None
    flags = {r.quality_flag: r.rows for r in rank_history.flag_counts(table).collect()}
    assert len(flags) == 7 and set(flags.values()) == {0}
    report = {(r.section, r.name): r.rows for r in rank_history.feed_report(table).collect()}
    assert report["class", "wat"] == 1 and report["flag", "dq_negative_wait"] == 0


def test_flags_of_bad_records(spark, tmp_path):
    bad = [
        {**RECORD, "class": "taxi", "rank_id": "N/A", "total": "many"},
        {**RECORD, "class": "bus", "start_time": "soon"},
        {**RECORD, "class": "passenger", "total": "4", "from_previous_count": "Low", "new_arrivals": "Low", "average_wait": "-1"},
        {**RECORD, "class": "wat", "end_time": "2025-07-03T21:40:00Z"},
    ]
    docs = documents(spark, tmp_path, {"rank_history": bad})
    table = rank_history.normalize(rank_feed.root_records(docs, "historical"))
    raised = [{c for c in table.columns if c.startswith("dq_") and r[c]} for r in table.collect()]
    assert raised[0] == {"dq_missing_rank_id", "dq_invalid_numeric_count"}
    assert raised[1] == {"dq_unknown_class", "dq_invalid_timestamp", "dq_invalid_interval"}
    assert raised[2] == {"dq_invalid_passenger_band", "dq_negative_wait"}
    assert raised[3] == {"dq_invalid_interval"}


def test_absent_key_is_not_a_null_value(spark, tmp_path):
    with_null = {**HISTORY[0], "average_wait": None}
    without = {k: v for k, v in HISTORY[0].items() if k != "average_wait"}
    docs = documents(spark, tmp_path, {"rank_history": [with_null, without, 5]})
    problems = [r.problem for r in rank_feed.root_records(docs, "historical").orderBy("position").collect()]
    assert problems == [None, "missing average_wait", "not an object"]
    with pytest.raises(Exception, match="missing average_wait"):
        rank_feed.require_records(rank_feed.root_records(docs, "historical")).select("record").collect()


def test_document_without_the_array(spark, tmp_path):
    docs = documents(spark, tmp_path, {"other": []})
    assert rank_feed.root_records(docs, "static").first().problem == "no ranks_info array"


def test_lineage_reads_only_what_was_declared(spark, tmp_path):
    for part in ("a", "b", "late"):
        spark.range(10).coalesce(1).write.parquet(str(tmp_path / part))
    found = digests.file_digests(spark, str(tmp_path))
    declared = found.filter(~F.col("path").contains("/late/")).select("path", "sha256")
    assert digests.read_declared(spark, declared, found).count() == 20
    changed = declared.withColumn("sha256", F.when(F.col("path").contains("/a/"), "0").otherwise(F.col("sha256")))
    with pytest.raises(ValueError, match="changed"):
        digests.read_declared(spark, changed, found)
    gone = declared.withColumn("path", F.concat("path", F.lit("x")))
    assert {r.status for r in digests.lineage_mismatches(gone, found).collect()} == {"missing"}


def test_latest_digest_per_path_wins(spark):
    old = spark.sql("SELECT 'p' AS path, 1L AS bytes, 'x' AS sha256, TIMESTAMP '2024-01-01' AS recorded_at")
    new = spark.sql("SELECT 'p' AS path, 2L AS bytes, 'y' AS sha256, TIMESTAMP '2024-02-01' AS recorded_at")
    assert [r.sha256 for r in digests.latest_records(old, new).collect()] == ["y"]


def test_release_window_and_months(spark):
    one = spark.sql("SELECT '2024-03' AS period")
    old = spark.sql("SELECT explode(array('2023-11', '2024-01')) AS period")
    got = [r.period for r in months.release_window(one, old).orderBy("period").collect()]
    assert got == ["2023-11", "2023-12", "2024-01", "2024-02", "2024-03"]
    assert [r.period for r in months.pending_months(one.unionByName(old), old).collect()] == ["2024-03"]
    assert months.pending_months(one.unionByName(old), old, force=True).count() == 3


def test_stream_loses_nothing_to_the_order_of_files(spark, tmp_path):
    """Days are delivered out of order, a file at a time; the second run resumes from the first."""
    day = lambda d: datetime(2024, 1, d)
    data = [(day(d) + timedelta(hours=h, minutes=m), 2024, 1, z) for d in (9, 2, 20, 1, 15) for h in (0, 7) for m in (1, 59) for z in (1, 2, None, 9)]
    data += [(datetime(2023, 5, 1), 2024, 1, 1), (None, 2024, 1, 1)]  # outside the partition, without a time
    schema = "tpep_pickup_datetime timestamp_ntz, year int, month int, PULocationID int"
    trips = spark.createDataFrame(data, schema)
    zones = spark.createDataFrame([(1, "A", "a", "s"), (2, "B", "b", "s")], "LocationID int, Borough string, Zone string, service_zone string")
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    for days in ((9, 2, 20), (1, 15)):
        for d in days:
            trips.filter(F.dayofmonth("tpep_pickup_datetime") == d).coalesce(1).write.mode("append").parquet(source)
        hourly.run_available(hourly.read_stream(spark, source, trips.schema, 1), zones, out, state)
    got = hourly.demand_so_far(spark, out)
    want = gold.hourly_zone_demand_from_trips(trips, zones)
    assert got.agg(F.sum("trip_count")).first()[0] == 5 * 2 * 2 * 2
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    closed = hourly.demand_so_far(spark, out, "2 HOUR")
    assert closed.agg(F.max("pickup_hour")).first()[0] == day(20)
    assert closed.count() == want.count() - 2


def test_gold_counts_only_eligible(rows):
    df = rows("dq_valid_for_demand boolean, PULocationID bigint, pickup_borough string, pickup_zone string, t string",
              (True, 1, "M", "A", "2024-01-01 10:30:00"), (False, 1, "M", "A", "2024-01-01 10:40:00"), (None, 1, "M", "A", "2024-01-01 10:50:00"))
    got = gold.hourly_zone_demand(df.withColumn(silver.PICKUP, F.col("t").cast("timestamp_ntz"))).collect()
    assert [r.trip_count for r in got] == [1]
