"""Per-driver income, hours and shift measures."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from kerbside.functions import rules
from kerbside.operators.quantiles import quantile_columns
from kerbside.session import broadcast_if_small

DRIVER, DAY = "hack_license", "pickup_date"


def _per_driver_day(trips: DataFrame, **sums: str) -> DataFrame:
    """Totals per driver and day: afterwards days are counted, not deduplicated."""
    return (
        trips.filter(F.col(DRIVER).isNotNull())
        .groupBy(DRIVER, DAY)
        .agg(*[F.sum(column).alias(name) for name, column in sums.items()])
    )


def daily_income(trips: DataFrame) -> DataFrame:
    """Total earning over distinct days worked."""
    days = _per_driver_day(trips, earning="earning")
    return days.groupBy(DRIVER).agg(
        F.try_divide(F.sum("earning"), F.count(DAY)).alias("average_daily_income")
    )


def daily_hours(trips: DataFrame) -> DataFrame:
    days = _per_driver_day(trips, seconds="trip_time_in_secs")
    return days.groupBy(DRIVER).agg(
        F.try_divide(F.sum("seconds") / 3600, F.count(DAY)).alias("average_daily_hours")
    )


def income_and_hours(trips: DataFrame) -> DataFrame:
    days = _per_driver_day(trips, earning="earning", seconds="trip_time_in_secs")
    return days.groupBy(DRIVER).agg(
        F.try_divide(F.sum("earning"), F.count(DAY)).alias("average_daily_income"),
        F.try_divide(F.sum("seconds") / 3600, F.count(DAY)).alias("average_daily_hours"),
    )


def night_ratio(trips: DataFrame) -> DataFrame:
    """Share of a driver's trips with a known hour that fall in the night shift."""
    night = rules.night_shift("pickup_hour")
    return (
        trips.filter(F.col(DRIVER).isNotNull())
        .groupBy(DRIVER)
        .agg(
            F.count_if(night == 1).alias("night_trips"),
            F.count(night).alias("trips"),
            F.avg(night).alias("night_trip_ratio"),
        )
    )


def top_drivers(trips: DataFrame, k: int = 50) -> DataFrame:
    """The k best average daily incomes; ties go to the smaller driver id."""
    return (
        daily_income(trips)
        .filter(F.col("average_daily_income").isNotNull())
        .orderBy(F.desc("average_daily_income"), DRIVER)
        .limit(k)
    )


def trips_of(trips: DataFrame, drivers: DataFrame) -> DataFrame:
    return trips.join(broadcast_if_small(drivers.select(DRIVER), store="driver-set"), DRIVER, "left_semi")


def group_night_share(trips: DataFrame) -> DataFrame:
    """Night trips over trips across a whole set of drivers."""
    night = rules.night_shift("pickup_hour")
    return trips.agg(
        F.count_if(night == 1).alias("night_trips"),
        F.count(night).alias("trips"),
        F.try_divide(F.count_if(night == 1), F.count(night)).alias("night_share"),
    )


def median_earnings(trips: DataFrame) -> DataFrame:
    """Median earning and earning per minute by pickup hour."""
    long = trips.filter(F.col("pickup_hour").isNotNull()).unpivot(
        "pickup_hour", ["earning_per_minute", "earning"], "measure", "value"
    )
    medians = quantile_columns(long, "value", {"median": 0.5}, "pickup_hour", "measure")
    return medians.groupBy("pickup_hour").agg(
        *[
            F.max(F.when(F.col("measure") == name, F.col("median"))).alias(f"median_{name}")
            for name in ("earning_per_minute", "earning")
        ]
    )
