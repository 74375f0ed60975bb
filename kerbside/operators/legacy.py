"""Historical trip and fare records: joining, cleaning, features, validity rules."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from kerbside.functions import clock, parsing, rules
from kerbside.sources.tables import ContractError, key_violations, require_columns

# Keys a trip and a fare record may share, in order of preference.
JOIN_KEYS = ("medallion", "hack_license", "vendor_id", "pickup_datetime")


@dataclass(frozen=True)
class CleaningLimits:
    # Default study area and plausibility limits.
    min_longitude: float = -74.3
    max_longitude: float = -72.9
    min_latitude: float = 40.5
    max_latitude: float = 41.8
    max_speed_mph: float = 100.0
    max_fare_per_minute: float = 3.0

    @property
    def box(self) -> rules.Box:
        return rules.Box(self.min_longitude, self.min_latitude, self.max_longitude, self.max_latitude)


# Input column names.
NUMERIC = (
    "trip_distance",
    "pickup_longitude",
    "pickup_latitude",
    "dropoff_longitude",
    "dropoff_latitude",
    "fare_amount",
)


def join_one_to_one(trips: DataFrame, fares: DataFrame) -> DataFrame:
    """Inner join on the preferred keys both sides have; fails when a key repeats on either side.

    Only the key columns take part in the uniqueness check.
    """
    keys = [key for key in JOIN_KEYS if key in trips.columns and key in fares.columns]
    if not keys:
        raise ContractError("Trips and fares share none of the supported join keys")
    for side, frame in (("trip", trips), ("fare", fares)):
        if not key_violations(frame.select(*keys), *keys).filter("rows > 1").isEmpty():
            raise ContractError(f"Join keys repeat on the {side} side: {', '.join(keys)}")
    return trips.join(fares, keys, "inner")


def join_shared_columns(trips: DataFrame, fares: DataFrame) -> DataFrame:
    """Inner join on every column name the two sides share."""
    return trips.join(fares, [c for c in trips.columns if c in fares.columns], "inner")


def coerce(df: DataFrame, times: tuple[str, ...] = (), numbers: tuple[str, ...] = ()) -> DataFrame:
    """Parse columns, turning unreadable values into NULL."""
    casts = {c: parsing.to_wall_time(F.col(c)) for c in times}
    casts.update({c: F.col(c).try_cast("double") for c in numbers})
    return df.withColumns(casts)


def clean_trips(trips: DataFrame, limits: CleaningLimits = CleaningLimits()) -> DataFrame:
    """Keep trips with readable, positive, in-area and plausible values."""
    require_columns(trips, {"pickup_datetime", "dropoff_datetime", *NUMERIC}, "required columns")
    timed = coerce(trips, ("pickup_datetime", "dropoff_datetime"), NUMERIC).withColumn(
        "trip_time_in_secs", clock.elapsed_seconds("pickup_datetime", "dropoff_datetime")
    )
    moved = (F.col("pickup_longitude") != F.col("dropoff_longitude")) | (
        F.col("pickup_latitude") != F.col("dropoff_latitude")
    )
    inside = [limits.box.contains(f"{end}_latitude", f"{end}_longitude") for end in rules.ENDS]
    # A NULL in any named column makes a conjunct NULL and drops the row.
    usable = reduce(
        lambda a, b: a & b,
        [F.col("trip_distance") > 0, F.col("trip_time_in_secs") > 0, F.col("fare_amount") >= 0, *inside, moved],
    )
    return (
        timed.filter(usable)
        .withColumn("drive_speed_mph", F.try_divide("trip_distance", F.col("trip_time_in_secs") / 3600))
        .withColumn("fare_amount_per_minute", F.try_divide("fare_amount", F.col("trip_time_in_secs") / 60))
        .filter(
            (F.col("drive_speed_mph") <= limits.max_speed_mph)
            & (F.col("fare_amount_per_minute") <= limits.max_fare_per_minute)
        )
    )


def add_trip_features(trips: DataFrame) -> DataFrame:
    """Calendar parts of the pickup and earnings per trip, minute and mile."""
    require_columns(trips, {"pickup_datetime"}, "required column")
    pickup = F.col("pickup_datetime")
    columns: dict[str, Column] = {
        "pickup_date": F.to_date(pickup),
        "pickup_hour": F.hour(pickup),
        "pickup_day": F.dayofmonth(pickup),
        "pickup_day_of_week": F.date_format(pickup, "EEEE"),
        "pickup_month": F.month(pickup),
        "pickup_year": F.year(pickup),
        "is_weekend": clock.is_weekend(pickup),
    }
    money = [c for c in ("fare_amount", "surcharge", "tip_amount") if c in trips.columns]
    if money:
        earning = reduce(lambda a, b: a + b, [F.coalesce(F.col(c), F.lit(0.0)) for c in money])
        columns["earning"] = earning
        if "trip_time_in_secs" in trips.columns:
            columns["earning_per_minute"] = F.try_divide(earning, F.col("trip_time_in_secs") / 60)
        if "trip_distance" in trips.columns:
            columns["earning_per_mile"] = F.try_divide(earning, F.col("trip_distance"))
    return trips.withColumns(columns)


# Limits of the exploratory validity rules.
MAX_STUDY_SPEED = 30.0
EARNING_PER_MINUTE_STEPS = (30.0, 22.0, 15.0)
MAX_FARE_PER_MILE = 1000.0


def validity_rules(longest_trip: Column) -> list[tuple[str, Column]]:
    """Exploratory rules in their order of application; a trip is kept when all are true."""
    seconds, miles = F.col("trip_time_in_secs"), F.col("trip_distance")
    fare = F.col("fare_amount")
    earning = fare + F.col("surcharge") + F.col("tip_amount")
    per_minute = F.try_divide(earning, seconds / 60)
    inside = [rules.CITY_BOX.contains(f"{end}_latitude", f"{end}_longitude") for end in rules.ENDS]
    return [
        ("passenger_count", F.col("passenger_count").between(1, 6)),
        ("rate_code", F.col("rate_code").between(1, 5)),
        ("distance", miles > 0),
        ("trip_time", (seconds > 0) & (seconds < longest_trip)),
        ("speed", F.try_divide(miles, seconds / 3600.0) <= MAX_STUDY_SPEED),
        (
            "endpoints_differ",
            (F.col("pickup_latitude") != F.col("dropoff_latitude"))
            | (F.col("pickup_longitude") != F.col("dropoff_longitude")),
        ),
        ("city_box", inside[0] & inside[1]),
        ("fare_per_minute", F.try_divide(fare, seconds / 60) <= 3.0),
        *[(f"earning_per_minute_{step:.0f}", per_minute <= step) for step in EARNING_PER_MINUTE_STEPS],
        ("fare_per_mile", F.try_divide(fare, miles) <= MAX_FARE_PER_MILE),
    ]


def _longest_trip(trips: DataFrame) -> Column:
    """Longest stated trip among rows passing the two code rules, as in the study."""
    coded = F.col("passenger_count").between(1, 6) & F.col("rate_code").between(1, 5)
    return trips.filter(coded).agg(F.max("trip_time_in_secs")).scalar()


def apply_validity(trips: DataFrame) -> DataFrame:
    keep = reduce(lambda a, b: a & b, [rule for _, rule in validity_rules(_longest_trip(trips))])
    return trips.filter(keep)


def validity_report(trips: DataFrame) -> DataFrame:
    """Rows removed by each rule, applied in order, from a single pass."""
    ordered = validity_rules(_longest_trip(trips))
    failed = F.coalesce(
        *[F.when(~F.coalesce(rule, F.lit(False)), place) for place, (_, rule) in enumerate(ordered)]
    )
    counts = trips.groupBy(failed.alias("rule_order")).agg(F.count("*").alias("removed_rows"))
    names = F.create_map(*[F.lit(v) for place, (name, _) in enumerate(ordered) for v in (place, name)])
    every = trips.sparkSession.range(len(ordered)).select(F.col("id").cast("int").alias("rule_order"))
    return every.join(counts, "rule_order", "left").select(
        "rule_order",
        names[F.col("rule_order")].alias("rule"),
        F.coalesce("removed_rows", F.lit(0)).alias("removed_rows"),
    )


def negative_money(trips: DataFrame) -> DataFrame:
    columns = ("fare_amount", "tip_amount", "total_amount", "mta_tax", "tolls_amount", "surcharge")
    return trips.agg(*[F.count_if(F.col(c) < 0).alias(f"negative_{c}") for c in columns])


def time_checks(trips: DataFrame) -> DataFrame:
    """Stated against derived duration: negative, zero and disagreeing rows.

    ``clock_disagreements`` compares with the derived value modulo one day, as a wall clock without
    dates would show it.
    """
    stated = F.col("trip_time_in_secs")
    derived = clock.seconds_between("pickup_datetime", "dropoff_datetime")
    return trips.agg(
        F.count_if(stated < 0).alias("stated_negative"),
        F.count_if(stated == 0).alias("stated_zero"),
        F.count_if(derived < 0).alias("derived_negative"),
        F.count_if(derived == 0).alias("derived_zero"),
        F.count_if(~derived.eqNullSafe(stated)).alias("disagreements"),
        F.count_if(~F.pmod(derived, F.lit(86400)).eqNullSafe(stated)).alias("clock_disagreements"),
    )


COORDINATES = ("pickup_latitude", "pickup_longitude", "dropoff_latitude", "dropoff_longitude")


def zero_coordinates(trips: DataFrame) -> DataFrame:
    any_zero = reduce(lambda a, b: a | b, [F.coalesce(F.col(c) == 0, F.lit(False)) for c in COORDINATES])
    return trips.agg(F.count_if(any_zero).alias("zero_coordinate_rows"))


def with_airport_flags(trips: DataFrame) -> DataFrame:
    return trips.withColumns(rules.airport_flags())


def with_boroughs(trips: DataFrame) -> DataFrame:
    return trips.withColumns(
        {f"{end}_borough": rules.borough_of(f"{end}_latitude", f"{end}_longitude") for end in rules.ENDS}
    )


def with_lower_manhattan(trips: DataFrame) -> DataFrame:
    return trips.withColumns(
        {
            f"is_{end}_lower_manhattan": rules.LOWER_MANHATTAN.flag(f"{end}_latitude", f"{end}_longitude")
            for end in rules.ENDS
        }
    )


def with_fare_outlier(trips: DataFrame) -> DataFrame:
    per_mile = F.try_divide("fare_amount", "trip_distance")
    outlier = F.coalesce(per_mile >= rules.FARE_PER_MILE_OUTLIER, F.lit(False)).cast("int")
    return trips.withColumns({"fare_amount_per_mile": per_mile, "is_outlier_fare_per_mile": outlier})


def non_airport(trips: DataFrame) -> DataFrame:
    return trips.filter(~rules.touches_airport())


def airport_trips(trips: DataFrame, airport: str, end: str = "pickup") -> DataFrame:
    return trips.filter(rules.AIRPORT_BOXES[airport].contains(f"{end}_latitude", f"{end}_longitude"))


def with_night_shift(trips: DataFrame) -> DataFrame:
    return trips.withColumn("is_night_shift", rules.night_shift("pickup_hour"))
