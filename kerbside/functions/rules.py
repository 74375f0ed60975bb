"""Rectangles, shifts, markets and other constant classification rules."""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, functions as F


class Box(NamedTuple):
    """Inclusive longitude/latitude rectangle."""

    min_lng: float
    min_lat: float
    max_lng: float
    max_lat: float

    def contains(self, lat: Column | str, lng: Column | str) -> Column:
        lat, lng = (F.col(c) if isinstance(c, str) else c for c in (lat, lng))
        return lat.between(self.min_lat, self.max_lat) & lng.between(self.min_lng, self.max_lng)

    def flag(self, lat: Column | str, lng: Column | str) -> Column:
        """1 inside, 0 outside or when a coordinate is missing."""
        return F.coalesce(self.contains(lat, lng), F.lit(False)).cast("int")


# Rectangles of the 2013 study area, airports, boroughs and lower Manhattan.
CITY_BOX = Box(-74.255804, 40.495921, -73.700479, 40.915704)
AIRPORT_BOXES = {
    "jfk": Box(-73.8352, 40.6195, -73.7401, 40.6659),
    "ewr": Box(-74.1925, 40.6700, -74.1531, 40.7081),
    "la_guardia": Box(-73.8895, 40.7664, -73.8550, 40.7931),
}
# Rectangles overlap: the first match in this order wins.
BOROUGH_BOXES = {
    "manhattan": Box(-74.0479, 40.6829, -73.9067, 40.8820),
    "queens": Box(-73.9630, 40.5431, -73.7004, 40.8007),
    "brooklyn": Box(-74.0421, 40.5707, -73.8334, 40.7395),
    "bronx": Box(-73.9339, 40.7855, -73.7654, 40.9176),
    "staten_island": Box(-74.2558, 40.4960, -74.0522, 40.6490),
}
LOWER_MANHATTAN = Box(-74.0194, 40.6997, -73.9716, 40.7427)
AIRPORT_ZONE_IDS = (132, 138)
DAY_SHIFT_HOURS = (5, 16)
FARE_PER_MILE_OUTLIER = 30.0

ENDS = ("pickup", "dropoff")


def airport_flags() -> dict[str, Column]:
    """Six 0/1 membership flags, airport by trip end."""
    return {
        f"is_{end}_{name}": box.flag(f"{end}_latitude", f"{end}_longitude")
        for name, box in AIRPORT_BOXES.items()
        for end in ENDS
    }


def touches_airport() -> Column:
    """True when either end lies in an airport rectangle."""
    return reduce(lambda a, b: a | b, [flag == 1 for flag in airport_flags().values()])


def borough_of(lat: Column | str, lng: Column | str) -> Column:
    rule = F
    for name, box in BOROUGH_BOXES.items():
        rule = rule.when(box.contains(lat, lng), name)
    return rule.otherwise("others")


def night_shift(hour: Column | str) -> Column:
    """0 for pickups at 5-16 h, 1 otherwise, NULL for an unknown hour."""
    hour = F.col(hour) if isinstance(hour, str) else hour
    return F.when(hour.between(*DAY_SHIFT_HOURS), 0).when(hour.isNotNull(), 1)


def market(zone: Column | str, airports: tuple[int, ...] = AIRPORT_ZONE_IDS) -> Column:
    zone = F.col(zone) if isinstance(zone, str) else zone
    return F.when(zone.isin(*airports), "airport").otherwise("non_airport")


def calendar_segment(event_window: Column, holiday: Column, weekday: Column) -> Column:
    return (
        F.when(event_window == 1, "event_window")
        .when(holiday == 1, "holiday")
        .when(weekday >= 5, "weekend")
        .otherwise("ordinary_weekday")
    )


def model_route(zone: Column, event_window: Column, airports: tuple[int, ...] = AIRPORT_ZONE_IDS) -> Column:
    """Airport specialist first, then event specialist, else the global model."""
    return (
        F.when(zone.isin(*airports), "airport_specialist")
        .when(event_window == 1, "event_specialist")
        .otherwise("global")
    )


def distance_band(distance: Column | str) -> Column:
    distance = F.col(distance) if isinstance(distance, str) else distance
    return (
        F.when(distance < 1, "<1").when(distance < 3, "1-3").when(distance < 10, "3-10").otherwise("10+")
    )


def distance_band_rank(band: Column | str) -> Column:
    band = F.col(band) if isinstance(band, str) else band
    return F.when(band == "<1", 1).when(band == "1-3", 2).when(band == "3-10", 3).otherwise(4)


def stable_key(*cols: Column | str) -> Column:
    """Engine-independent ordering key of several columns."""
    return F.md5(F.concat_ws("|", *[(F.col(c) if isinstance(c, str) else c).cast("string") for c in cols]))


def hash_bucket(key: Column | str, buckets: int = 100) -> Column:
    """Bucket 0..buckets-1 from the first seven hex digits of the key's MD5."""
    key = F.col(key) if isinstance(key, str) else key
    digits = F.conv(F.substring(F.md5(key.cast("string")), 1, 7), 16, 10).cast("bigint")
    return (digits % buckets).cast("int")
