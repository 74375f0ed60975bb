"""Physical plans: no Python rows, pushed filters, pruned columns, bounded broadcasts."""

import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from __spark_entry__ import queries
from kerbside.catalog.tables import Tables
from kerbside.operators import gates, gold, series, silver
from kerbside.session import broadcast_if_small
from kerbside.sources import months

HEAVY = ("gold_demand", "silver_enrich", "feature_table", "score_forecast", "clean_trips", "history_normalize", "excess_error")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", HEAVY)
def test_no_python_and_no_cross_product(spark, name):
    text = plan(queries()[name](spark, SMALL))
    for node in ("PythonUDF", "BatchEvalPython", "ArrowEvalPython", "MapInPandas", "CartesianProduct"):
        assert node not in text
    assert "BroadcastNestedLoopJoin" not in text


def test_month_window_prunes_partitions(spark, tmp_path):
    trips = Tables(spark, SMALL).trips.filter("tpep_pickup_datetime IS NOT NULL")
    trips.withColumn("year", F.year("tpep_pickup_datetime")).write.partitionBy("year", "month").parquet(str(tmp_path / "b"))
    read = months.read_partitioned(spark, str(tmp_path / "b"), "2024-01", "2024-01")
    assert "InMemoryFileIndex(1 paths)" in plan(read)
    assert {f.split("/b/")[1].rsplit("/", 1)[0] for f in read.inputFiles()} == {"year=2024/month=1"}


def test_month_bounds_stay_on_the_raw_column(spark):
    t = Tables(spark, SMALL)
    text = plan(t.base("events").filter(F.col("ts") >= F.lit("2024-01-10").cast("timestamp_ntz")).select("ts"))
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts" in text and "ReadSchema: struct<ts:timestamp_ntz>" in text


def test_demand_counts_before_the_dimension_join(spark):
    t = Tables(spark, SMALL)
    text = plan(gold.hourly_zone_demand_from_trips(t.trips, t.zones))
    assert text.index("Join") < text.index("HashAggregate")
    assert "value" not in text.split("ReadSchema: ")[1].split(">")[0]


def test_both_ways_to_gold_agree(spark):
    t = Tables(spark, SMALL)
    left = gold.hourly_zone_demand_from_trips(t.trips, t.zones)
    right = gold.hourly_zone_demand(silver.build_silver(t.trips, t.zones))
    assert left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty() and not left.isEmpty()


def test_grid_is_not_shuffled_again_for_its_windows(spark):
    """Joining and windowing the dense grid needs no exchange above its generator."""
    text = plan(series.with_history(series.dense_series(Tables(spark, SMALL).hourly)))
    above = text[: text.index("Generate")]
    assert "Exchange" not in above and above.count("Sort [") == 1


def test_grid_tasks_follow_the_size_of_the_grid(spark, monkeypatch):
    """Adaptive execution must not merge the zones, which are few bytes, into few tasks that generate the whole grid."""
    demand = Tables(spark, SMALL).hourly
    want = series.time_grid(demand).count()
    monkeypatch.setattr(series, "GRID_ROWS_PER_TASK", 100)
    grid = series.time_grid(demand)
    assert grid.rdd.getNumPartitions() >= want // 150 > 5
    assert grid.count() == want == grid.distinct().count()
    missing = gates.grid_difference(demand, grid, "pickup_zone_id", "pickup_hour")
    assert missing.where("side = 'missing'").count() == want - demand.count() and missing.where("side <> 'missing'").isEmpty()


def test_large_side_is_not_broadcast(spark):
    small, large = spark.range(10), spark.range(1000)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin" in plan(large.join(broadcast_if_small(small, 10), "id"))
        assert "BroadcastHashJoin" not in plan(large.join(broadcast_if_small(small, 9), "id"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_results_hold_without_broadcasts(spark, monkeypatch):
    """The way beyond the size bound gives the same rows."""
    import kerbside.operators.gold as g
    import kerbside.operators.sampling as sa
    import kerbside.operators.silver as si

    t = Tables(spark, SMALL)
    want = silver.build_silver(t.trips, t.zones).select("trip_id", "pickup_zone", "dq_candidate_duplicate").collect()
    for module in (g, sa, si):
        monkeypatch.setattr(module, "broadcast_if_small", lambda df, limit=0, store=None: df)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = silver.build_silver(t.trips, t.zones).select("trip_id", "pickup_zone", "dq_candidate_duplicate").collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert sorted(map(str, got)) == sorted(map(str, want))
