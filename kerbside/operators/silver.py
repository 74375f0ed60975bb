"""Row-preserving trip enrichment with quality flags."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.observation import Observation

from kerbside.functions import clock
from kerbside.session import broadcast_if_small
from kerbside.sources.tables import require_zone_dimension

PICKUP, DROPOFF = "tpep_pickup_datetime", "tpep_dropoff_datetime"

# The columns that identify a candidate duplicate, and the speed limit.
DUPLICATE_KEY = (
    "VendorID",
    PICKUP,
    DROPOFF,
    "PULocationID",
    "DOLocationID",
    "trip_distance",
    "fare_amount",
    "total_amount",
)
IMPLAUSIBLE_MPH = 100.0

# Report name of each counted flag.
FLAG_COUNTS = {
    "missing_pickup_datetime": "dq_missing_pickup_datetime",
    "missing_dropoff_datetime": "dq_missing_dropoff_datetime",
    "pickup_outside_partition": "dq_pickup_outside_partition",
    "unknown_pickup_zone": "dq_unknown_pickup_zone",
    "unknown_dropoff_zone": "dq_unknown_dropoff_zone",
    "nonpositive_duration": "dq_nonpositive_duration",
    "negative_distance": "dq_negative_distance",
    "negative_fare": "dq_negative_fare",
    "negative_total": "dq_negative_total",
    "implausible_speed": "dq_implausible_speed",
    "candidate_duplicate_rows": "dq_candidate_duplicate",
    "demand_eligible": "dq_valid_for_demand",
    "fare_eligible": "dq_valid_for_fare",
}


def with_duration(trips: DataFrame) -> DataFrame:
    return trips.withColumn("derived_duration_seconds", clock.seconds_between(PICKUP, DROPOFF))


def with_speed(trips: DataFrame) -> DataFrame:
    """Miles per hour, NULL unless the duration is positive."""
    seconds = F.col("derived_duration_seconds")
    return trips.withColumn(
        "derived_speed_mph", F.when(seconds > 0, F.col("trip_distance") / (seconds / F.lit(3600.0)))
    )


def join_zone_roles(trips: DataFrame, zones: DataFrame) -> DataFrame:
    """Left join of the zone dimension in its pickup and dropoff roles.

    ``pickup_known`` / ``dropoff_known`` are NULL where no zone matched.
    """
    zones = broadcast_if_small(zones)
    for role, key in (("pickup", "PULocationID"), ("dropoff", "DOLocationID")):
        side = zones.select(
            F.col("LocationID").alias(key),
            F.col("Borough").alias(f"{role}_borough"),
            F.col("Zone").alias(f"{role}_zone"),
            F.col("service_zone").alias(f"{role}_service_zone"),
            F.lit(True).alias(f"{role}_known"),
        )
        trips = trips.join(side, key, "left")
    return trips


def quality_flags() -> dict[str, Column]:
    """Flags over a trip with zone roles, duration, speed and partition columns year, month.

    A NULL input gives a NULL flag except where the flag is about absence.
    """
    pickup = F.col(PICKUP)
    first = clock.month_start("year", "month")
    after = F.add_months(first.cast("date"), 1).cast("timestamp_ntz")
    return {
        "dq_unknown_pickup_zone": F.col("pickup_known").isNull(),
        "dq_unknown_dropoff_zone": F.col("dropoff_known").isNull(),
        "dq_missing_pickup_datetime": pickup.isNull(),
        "dq_missing_dropoff_datetime": F.col(DROPOFF).isNull(),
        "dq_pickup_outside_partition": (pickup < first) | (pickup >= after),
        "dq_nonpositive_duration": F.col("derived_duration_seconds") <= 0,
        "dq_negative_distance": F.col("trip_distance") < 0,
        "dq_negative_fare": F.col("fare_amount") < 0,
        "dq_negative_total": F.col("total_amount") < 0,
        "dq_implausible_speed": F.col("derived_speed_mph") > IMPLAUSIBLE_MPH,
    }


def _none_of(*flags: str) -> Column:
    return reduce(lambda a, b: a & b, [~F.col(flag) for flag in flags])


DEMAND_FLAGS = ("dq_missing_pickup_datetime", "dq_pickup_outside_partition", "dq_unknown_pickup_zone")
FARE_FLAGS = (
    "dq_missing_dropoff_datetime",
    "dq_nonpositive_duration",
    "dq_negative_distance",
    "dq_negative_fare",
    "dq_negative_total",
)


def eligibility() -> dict[str, Column]:
    return {
        "dq_valid_for_demand": _none_of(*DEMAND_FLAGS),
        "dq_valid_for_fare": _none_of(*DEMAND_FLAGS, *FARE_FLAGS),
    }


def duplicate_keys(trips: DataFrame, key: tuple[str, ...] = DUPLICATE_KEY) -> DataFrame:
    """Distinct key values carried by more than one row; NULLs are equal.

    The first pass shuffles only an eight-byte hash per distinct value and map task, and partial
    counting keeps a heavily copied row from reaching one reducer more than once per task. The
    exact keys are then counted among the few rows whose hash repeats.
    """
    hashed = trips.select(*key, F.xxhash64(*key).alias("_hash"))
    suspects = hashed.groupBy("_hash").count().filter("count > 1").select("_hash")
    suspects = broadcast_if_small(suspects, store="suspect-hashes")
    return (
        hashed.join(suspects, "_hash", "left_semi")
        .groupBy(*key)
        .count()
        .filter("count > 1")
        .select(*key)
    )


def flag_duplicates(trips: DataFrame, key: tuple[str, ...] = DUPLICATE_KEY) -> DataFrame:
    """Add ``dq_candidate_duplicate`` without sending copies of a row through one window task."""
    found = duplicate_keys(trips, key).select(
        *[F.col(column).alias(f"_dup_{column}") for column in key], F.lit(True).alias("_dup")
    )
    same = reduce(
        lambda a, b: a & b, [F.col(column).eqNullSafe(F.col(f"_dup_{column}")) for column in key]
    )
    return (
        trips.join(broadcast_if_small(found, store="duplicate-keys"), same, "left")
        .withColumn("dq_candidate_duplicate", F.col("_dup").isNotNull())
        .drop("_dup", *[f"_dup_{column}" for column in key])
    )


def with_flags(trips: DataFrame, zones: DataFrame) -> DataFrame:
    """Durations, zone attributes, single-row flags and eligibility; no duplicate check."""
    joined = join_zone_roles(trips, zones)
    return (
        with_speed(with_duration(joined))
        .withColumns(quality_flags())
        .withColumns(eligibility())
        .drop("pickup_known", "dropoff_known")
    )


def build_silver(trips: DataFrame, zones: DataFrame) -> DataFrame:
    """Every input row, enriched. ``trips`` carries the partition columns year and month."""
    require_zone_dimension(zones)
    return flag_duplicates(with_flags(trips, zones))


def quality_counts(silver: DataFrame, *by: str) -> DataFrame:
    """Row count and true-flag counts, overall or per group, in one pass."""
    counts = [F.count_if(F.col(flag)).alias(name) for name, flag in FLAG_COUNTS.items()]
    return silver.groupBy(*by).agg(F.count("*").alias("source_rows"), *counts)


def observe_counts(silver: DataFrame, name: str = "silver") -> tuple[DataFrame, Observation]:
    """Attach the flag counts to whatever job writes ``silver``, so they need no re-read."""
    seen = Observation(name)
    counts = [
        F.sum(F.when(F.col(flag), 1).otherwise(0)).alias(label) for label, flag in FLAG_COUNTS.items()
    ]
    return silver.observe(seen, F.count(F.lit(1)).alias("source_rows"), *counts), seen


def reconcile(source: DataFrame, result: DataFrame, *by: str) -> DataFrame:
    """Input and output row counts, counted independently of each other."""
    left = source.groupBy(*by).agg(F.count("*").alias("input_rows"))
    right = result.groupBy(*by).agg(F.count("*").alias("output_rows"))
    if by:
        both = left.join(right, list(by), "full")
    else:
        both = left.select("input_rows", right.select("output_rows").scalar().alias("output_rows"))
    return both.na.fill(0, ["input_rows", "output_rows"]).withColumn(
        "reconciled", F.col("input_rows") == F.col("output_rows")
    )
