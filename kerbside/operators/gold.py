"""Demand products and the descriptive report over them."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from kerbside.functions import clock, rules
from kerbside.operators.quantiles import quantile_columns, stacked_quantiles
from kerbside.operators.silver import DROPOFF, PICKUP
from kerbside.session import broadcast_if_small
from kerbside.sources.tables import require_zone_dimension


def hourly_zone_demand(silver: DataFrame) -> DataFrame:
    """Eligible trips per zone and hour; only observed groups.

    Counting is partial on the map side, so a zone with most of the trips sends one row per hour and
    task. Sort order is a matter of the writer (``sources.months.write_sorted``).
    """
    return (
        silver.filter("dq_valid_for_demand")
        .groupBy(
            F.col("PULocationID").cast("int").alias("pickup_zone_id"),
            "pickup_borough",
            "pickup_zone",
            clock.trunc("hour", PICKUP).alias("pickup_hour"),
        )
        .agg(F.count("*").alias("trip_count"))
    )


def hourly_zone_demand_from_trips(trips: DataFrame, zones: DataFrame) -> DataFrame:
    """The same product straight from Bronze, counting before the dimension is joined.

    Demand eligibility needs the pickup time and its zone only, so no other column is read, and the
    join sees one row per zone and hour. A zone without trips or a trip without a known zone drops
    out in the inner join, which relies on a unique zone key.
    """
    require_zone_dimension(zones)
    pickup = F.col(PICKUP)
    first = clock.month_start("year", "month")
    after = F.add_months(first.cast("date"), 1).cast("timestamp_ntz")
    counted = (
        trips.filter((pickup >= first) & (pickup < after))
        .groupBy("PULocationID", clock.trunc("hour", pickup).alias("pickup_hour"))
        .agg(F.count("*").alias("trip_count"))
    )
    known = zones.select(
        F.col("LocationID").alias("PULocationID"),
        F.col("Borough").alias("pickup_borough"),
        F.col("Zone").alias("pickup_zone"),
    )
    return counted.join(broadcast_if_small(known), "PULocationID").select(
        F.col("PULocationID").cast("int").alias("pickup_zone_id"),
        "pickup_borough",
        "pickup_zone",
        "pickup_hour",
        "trip_count",
    )


def hourly_demand_stats(trips: DataFrame) -> DataFrame:
    """Ungoverned zone-hour counts and averages for zones 1-265."""
    fare, distance = F.col("fare_amount"), F.col("trip_distance")
    forward = F.col(DROPOFF) >= F.col(PICKUP)
    return (
        trips.filter(F.col("PULocationID").between(1, 265) & F.col(PICKUP).isNotNull())
        .groupBy(
            F.col("PULocationID").cast("int").alias("pickup_zone_id"),
            clock.trunc("hour", PICKUP).alias("pickup_hour"),
        )
        .agg(
            F.count("*").alias("trip_count"),
            F.avg(F.when(fare >= 0, fare)).alias("avg_fare"),
            F.avg(F.when(distance >= 0, distance)).alias("avg_distance"),
            F.avg(F.when(forward, clock.seconds_between(PICKUP, DROPOFF))).alias("avg_duration_seconds"),
        )
    )


def product_totals(gold: DataFrame) -> DataFrame:
    return gold.agg(F.count("*").alias("rows"), F.sum("trip_count").alias("trips"))


def monthly(gold: DataFrame) -> DataFrame:
    return gold.groupBy(clock.trunc("month", "pickup_hour").alias("month")).agg(
        F.sum("trip_count").alias("trips")
    )


def weekday_hour(gold: DataFrame) -> DataFrame:
    """Weekday 0 = Sunday."""
    return gold.groupBy(
        clock.sunday_first_weekday("pickup_hour").alias("day_of_week"), F.hour("pickup_hour").alias("hour")
    ).agg(F.sum("trip_count").alias("trips"))


def weekday_hour_matrix(gold: DataFrame) -> DataFrame:
    """Seven weekday rows by 24 hour columns ``h00``..``h23``, absent cells 0."""
    cells = [
        F.sum(F.when(F.hour("pickup_hour") == hour, F.col("trip_count")).otherwise(0)).alias(f"h{hour:02d}")
        for hour in range(24)
    ]
    weekdays = gold.sparkSession.range(7).select(F.col("id").cast("int").alias("day_of_week"))
    seen = gold.groupBy(clock.sunday_first_weekday("pickup_hour").alias("day_of_week")).agg(*cells)
    return weekdays.join(seen, "day_of_week", "left").na.fill(0)


def by_borough(gold: DataFrame) -> DataFrame:
    return (
        gold.groupBy(F.col("pickup_borough").alias("borough"))
        .agg(F.sum("trip_count").alias("trips"))
        .orderBy(F.desc("trips"), "borough")
    )


def top_zones(gold: DataFrame, k: int = 15) -> DataFrame:
    return (
        gold.groupBy("pickup_zone_id", "pickup_zone", "pickup_borough")
        .agg(F.sum("trip_count").alias("trips"))
        .orderBy(F.desc("trips"), "pickup_zone_id")
        .limit(k)
    )


def by_airport(gold: DataFrame, airports: tuple[int, ...] = rules.AIRPORT_ZONE_IDS) -> DataFrame:
    segment = F.when(F.col("pickup_zone_id").isin(*airports), "Airport").otherwise("Non-airport")
    return gold.groupBy(segment.alias("segment")).agg(F.sum("trip_count").alias("trips"))


def by_day_type(gold: DataFrame) -> DataFrame:
    """Weekend and weekday totals, distinct days and trips per day.

    Days are counted from daily totals, so the distinct step sees one row per day.
    """
    day = F.to_date("pickup_hour")
    daily = gold.groupBy(day.alias("day")).agg(F.sum("trip_count").alias("trips"))
    kind = F.when(clock.sunday_first_weekday("day").isin(0, 6), "Weekend").otherwise("Weekday")
    return (
        daily.groupBy(kind.alias("day_type"))
        .agg(F.sum("trips").alias("trips"), F.count("day").alias("calendar_days"))
        .withColumn("pickups_per_day", F.col("trips") / F.col("calendar_days"))
    )


def fare_distribution(silver: DataFrame, exact: bool = True) -> DataFrame:
    """Fare, distance and duration summary of fare-eligible rows.

    ``exact=False`` takes the quantiles from sketches, in a single pass.
    """
    eligible = silver.filter("dq_valid_for_fare").select(*DISTRIBUTED)
    means = [
        F.count("*").alias("fare_eligible_rows"),
        F.avg("fare_amount").alias("mean_fare"),
        F.avg("trip_distance").alias("mean_distance"),
        (F.avg("derived_duration_seconds") / 60).alias("mean_duration_minutes"),
    ]
    if not exact:
        return eligible.agg(
            *means,
            _sketched("fare_amount", 0.5).alias("median_fare"),
            _sketched("fare_amount", 0.95).alias("p95_fare"),
            _sketched("trip_distance", 0.5).alias("median_distance"),
            (_sketched("derived_duration_seconds", 0.5) / 60).alias("median_duration_minutes"),
        )
    found = stacked_quantiles(eligible, DISTRIBUTED, {"middle": 0.5, "p95": 0.95})

    def pick(column: str, name: str):
        return F.max(F.when(F.col("column_name") == column, F.col(name)))

    quantiles = found.agg(
        F.struct(
            pick("fare_amount", "middle").alias("median_fare"),
            pick("fare_amount", "p95").alias("p95_fare"),
            pick("trip_distance", "middle").alias("median_distance"),
            (pick("derived_duration_seconds", "middle") / 60).alias("median_duration_minutes"),
        )
    )
    return eligible.agg(*means).withColumn("_q", quantiles.scalar()).select("*", "_q.*").drop("_q")


DISTRIBUTED = ("fare_amount", "trip_distance", "derived_duration_seconds")


def _sketched(column: str, p: float):
    return F.approx_percentile(column, F.lit(p), F.lit(10_000))


def by_payment(silver: DataFrame) -> DataFrame:
    return (
        silver.filter("dq_valid_for_fare")
        .groupBy("payment_type")
        .agg(F.count("*").alias("trips"))
        .orderBy(F.desc("trips"), "payment_type")
    )


def by_distance_band(silver: DataFrame, exact: bool = True) -> DataFrame:
    """Trips, median and 0.95 quantile of the fare per distance band, in band order."""
    banded = silver.filter("dq_valid_for_fare").select(
        rules.distance_band("trip_distance").alias("distance_miles"), "fare_amount"
    )
    if exact:
        counts = banded.groupBy("distance_miles").agg(F.count("*").alias("trips"))
        fares = quantile_columns(banded, "fare_amount", {"median_fare": 0.5, "p95_fare": 0.95}, "distance_miles")
        bands = counts.join(fares, "distance_miles", "left")
    else:
        bands = banded.groupBy("distance_miles").agg(
            F.count("*").alias("trips"),
            _sketched("fare_amount", 0.5).alias("median_fare"),
            _sketched("fare_amount", 0.95).alias("p95_fare"),
        )
    return bands.orderBy(rules.distance_band_rank("distance_miles"))


# Flags shown in the descriptive report.
REPORTED_FLAGS = (
    "pickup_outside_partition",
    "nonpositive_duration",
    "negative_fare",
    "negative_total",
    "implausible_speed",
    "candidate_duplicate_rows",
)


def flag_totals(reports: DataFrame) -> DataFrame:
    """Flag counts summed over monthly quality reports, one row per flag."""
    totals = reports.agg(*[F.sum(flag).alias(flag) for flag in REPORTED_FLAGS])
    return totals.unpivot([], list(REPORTED_FLAGS), "quality_flag", "rows")


def summary(gold: DataFrame, airports: tuple[int, ...] = rules.AIRPORT_ZONE_IDS) -> DataFrame:
    """One row: totals, peak month, leading borough and zone, airport share, per-day rates.

    One pass: trips by day and zone are expanded to four grouping sets, and one aggregate picks every measure from these.
    """
    cube = gold.groupBy(
        F.to_date("pickup_hour").alias("day"), "pickup_zone_id", "pickup_zone", "pickup_borough"
    ).agg(F.sum("trip_count").alias("trips")).withColumn("month", F.trunc("day", "month"))
    sets = {"month": ["month"], "borough": ["pickup_borough"], "zone": ["pickup_zone_id", "pickup_zone"], "day": ["day"]}
    columns = [name for own in sets.values() for name in own]
    totals = cube.groupingSets([[F.col(n) for n in own] for own in sets.values()], *columns).agg(
        F.sum("trips").alias("trips"), *[F.grouping(own[0]).alias(f"_{level}") for level, own in sets.items()]
    )

    def of(level: str, value):
        return F.when(F.col(f"_{level}") == 0, value)

    def leader(level: str, name: str, tie: str):
        """The name with most trips; of equals the one whose ``tie`` comes first."""
        return F.min_by(name, of(level, F.struct(-F.col("trips"), F.col(tie))))

    def rate(weekend: bool):
        days = of("day", F.when(clock.sunday_first_weekday("day").isin(0, 6) == weekend, F.col("trips")))
        return F.round(F.try_divide(F.sum(days), F.count(days)), 2)

    return totals.agg(
        F.sum(of("month", F.col("trips"))).alias("eligible_pickups"),
        leader("month", "month", "month").alias("peak_month"),
        leader("borough", "pickup_borough", "pickup_borough").alias("top_borough"),
        leader("zone", "pickup_zone", "pickup_zone_id").alias("top_zone"),
        F.coalesce(F.sum(of("zone", F.when(F.col("pickup_zone_id").isin(*airports), F.col("trips")))), F.lit(0)).alias("airport_pickups"),
        rate(False).alias("weekday_pickups_per_day"),
        rate(True).alias("weekend_pickups_per_day"),
    )
