"""One key, one row or one day holds a third of everything; results stay whole and exact."""

import pytest
from pyspark.sql import Window, functions as F

from kerbside.operators import gold, quantiles, sampling, silver

ROWS = 60_000


@pytest.fixture(scope="module")
def trips(spark):
    """A third of the rows are copies of one trip, which also makes one zone and one day hot."""
    row = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id"))
    base = F.lit("2024-01-01").cast("timestamp_ntz")
    at = base + F.make_dt_interval((row % 20).cast("int"), (row % 24).cast("int"), (row % 60).cast("int"))
    return (
        spark.range(0, ROWS, 1, 16)
        .select(
            F.col("id").alias("trip_id"),
            F.lit(1).alias("VendorID"),
            at.alias("tpep_pickup_datetime"),
            (at + F.expr("INTERVAL 10 MINUTE")).alias("tpep_dropoff_datetime"),
            (row % 50).alias("PULocationID"),
            (row % 7).alias("DOLocationID"),
            (row % 900 / 10).alias("trip_distance"),
            (row % 1300 / 7).alias("fare_amount"),
            (row % 1300 / 6).alias("total_amount"),
            F.lit(2024).alias("year"),
            F.lit(1).alias("month"),
        )
        .checkpoint()
    )


@pytest.fixture(scope="module")
def zones(spark):
    return spark.range(50).select(
        F.col("id").alias("LocationID"), F.lit("B").alias("Borough"), F.concat(F.lit("Z"), "id").alias("Zone"), F.lit("S").alias("service_zone")
    )


def test_copies_are_all_flagged(trips):
    window = F.count("*").over(Window.partitionBy(*silver.DUPLICATE_KEY)) > 1
    want = trips.select("trip_id", window.alias("dq_candidate_duplicate"))
    got = silver.flag_duplicates(trips).select("trip_id", "dq_candidate_duplicate")
    assert got.count() == ROWS and got.exceptAll(want).isEmpty()
    assert got.filter("dq_candidate_duplicate").count() >= ROWS // 3


def test_demand_of_a_hot_zone_is_whole(trips, zones):
    got = gold.hourly_zone_demand_from_trips(trips, zones)
    assert gold.product_totals(got).first().trips == ROWS
    hot = got.groupBy("pickup_zone_id").agg(F.sum("trip_count").alias("n")).orderBy(F.desc("n")).first()
    assert hot.pickup_zone_id == 0 and hot.n > ROWS // 3


def test_ranks_of_a_hot_day_are_dense(trips):
    ranked = sampling.rank_within_day(trips, "trip_id", key=("trip_id",))
    per_day = ranked.groupBy(F.to_date("tpep_pickup_datetime").alias("d")).agg(
        F.count("*").alias("n"), F.max("sample_rank").alias("m"), F.count_distinct("sample_rank").alias("k")
    )
    days = per_day.collect()
    assert sum(r.n for r in days) == ROWS and all(r.n == r.m == r.k for r in days)


def test_quantiles_of_a_hot_group_are_exact(trips):
    want = {r.DOLocationID: r.q for r in trips.groupBy("DOLocationID").agg(F.percentile("fare_amount", F.lit(0.95)).alias("q")).collect()}
    got = {r.DOLocationID: r.value for r in quantiles.exact_quantiles(trips, "fare_amount", (0.95,), "DOLocationID").collect()}
    assert got == pytest.approx(want)


@pytest.mark.parametrize("accuracy, cells, grid", [(10_000, 200_000, 500), (100, 50, 20), (200, 30, 10)])
def test_selection_of_a_hot_group_needs_few_values_in_one_place(spark, monkeypatch, accuracy, cells, grid):
    """One group with most rows over many tasks, a hot value and narrow brackets: several narrowing passes, exact results."""
    for name, value in (("ACCURACY", accuracy), ("CELLS", cells), ("GRID", grid), ("WHOLE_GROUP", 100)):
        monkeypatch.setattr(quantiles, name, value)
    i = F.col("id")
    df = spark.range(0, 40_000, 1, 16).select(
        F.when(i % 20 == 0, F.lit(None).cast("string")).when(i % 400 == 1, F.lit("small")).otherwise(F.lit("hot")).alias("g"),
        F.when(i % 3 == 0, 7.0).otherwise(F.pow(F.pmod(F.hash(i), F.lit(30_011)).cast("double"), F.lit(1.5))).alias("v"),
    )
    probabilities = (0.0, 0.25, 0.5, 0.9, 0.999, 1.0)
    want = {r.g: r.q for r in df.groupBy("g").agg(F.percentile("v", F.array(*map(F.lit, probabilities))).alias("q")).collect()}
    got = {(r.g, r.p): r.value for r in quantiles.exact_quantiles(df, "v", probabilities, "g").collect()}
    assert got == pytest.approx({(g, p): x for g, q in want.items() for p, x in zip(probabilities, q)})
    assert quantiles.exact_quantiles(df, "v", (0.5,)).first().value == pytest.approx(df.agg(F.percentile("v", F.lit(0.5))).first()[0])


def test_quantile_plans_have_no_windows(trips):
    text = quantiles.exact_quantiles(trips, "fare_amount", (0.5, 0.95), "DOLocationID")._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in text


@pytest.mark.parametrize("sizes, rows", [([5, 5, 5], 7), ([1, 9, 3], 10), ([100], 30), ([2, 2], 50), ([], 3), ([1, 1, 50], 3)])
def test_rounds_of_a_sample(sizes, rows):
    level = sampling.rounds_needed(sizes, rows)
    taken = lambda n: sum(min(s, n) for s in sizes)
    assert taken(level) >= min(rows, sum(sizes)) and (level == 0 or taken(level - 1) < min(rows, sum(sizes)))


def test_a_sample_ranks_only_what_its_thresholds_leave(trips):
    ranked = sampling.rank_within_day(trips, "trip_id", key=("trip_id",))
    day = F.to_date("tpep_pickup_datetime")
    first = ranked.withColumn("d", day).orderBy("sample_rank", F.md5(F.col("d").cast("string")), "d").limit(3_000)
    sample = sampling.stratified_sample(trips, 3_000, "trip_id", key=("trip_id",))
    assert {r.trip_id for r in sample.select("trip_id").collect()} == {r.trip_id for r in first.select("trip_id").collect()}
    plan = sample._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Window") < plan.index("_last")  # the threshold lies below the window
