"""Wall-clock (TIMESTAMP_NTZ) helpers."""

from __future__ import annotations

from datetime import date, timedelta
from functools import cache

from pyspark.sql import Column, SparkSession, functions as F


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def trunc(unit: str, ts: Column | str) -> Column:
    """``date_trunc`` that keeps wall-clock type."""
    return F.date_trunc(unit, _col(ts)).cast("timestamp_ntz")


def epoch_seconds(ts: Column | str) -> Column:
    return F.unix_seconds(_col(ts).cast("timestamp"))


def seconds_between(start: Column | str, end: Column | str) -> Column:
    """Number of whole-second boundaries crossed, NULL if either end is NULL."""
    return epoch_seconds(end) - epoch_seconds(start)


def elapsed_seconds(start: Column | str, end: Column | str) -> Column:
    """Fractional seconds from ``start`` to ``end``."""
    micros = F.unix_micros(_col(end).cast("timestamp")) - F.unix_micros(_col(start).cast("timestamp"))
    return micros / F.lit(1_000_000.0)


def shift(ts: Column | str, **interval: int) -> Column:
    """Add an interval given as ``days=7``, ``hours=-1`` and so on."""
    parts = {name: F.lit(value) for name, value in interval.items()}
    return _col(ts) + F.make_interval(**parts)


def month_start(year: Column | str, month: Column | str) -> Column:
    return F.make_date(_col(year), _col(month), F.lit(1)).cast("timestamp_ntz")


def month_label(ts: Column | str) -> Column:
    return F.date_format(_col(ts), "yyyy-MM")


def sunday_first_weekday(ts: Column | str) -> Column:
    """0 = Sunday, the numbering of the descriptive reports."""
    return (F.dayofweek(_col(ts)) - 1).cast("int")


def monday_first_weekday(ts: Column | str) -> Column:
    """0 = Monday, the numbering of the model features."""
    return F.weekday(_col(ts)).cast("int")


def is_weekend(ts: Column | str) -> Column:
    """False when the timestamp is NULL."""
    return F.coalesce(F.weekday(_col(ts)) >= 5, F.lit(False))


def utc_to_local(ts: Column | str, zone: str) -> Column:
    """UTC wall time (NTZ) to local wall time (NTZ)."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), _col(ts).cast("timestamp_ntz"))


def local_to_utc(ts: Column | str, zone: str) -> Column:
    return F.convert_timezone(F.lit(zone), F.lit("UTC"), _col(ts).cast("timestamp_ntz"))


# Sizes of daylight-saving shifts in minutes in use since 1970.
DST_SHIFTS_MINUTES = (20, 30, 40, 60, 120)


# Transitions are listed for these years; other wall times are always converted.
LISTED_YEARS = (1970, 2070)


@cache
def _transition_days(zone: str) -> tuple[date, ...]:
    """Local days of the zone's clock changes within LISTED_YEARS, each with the days around it."""
    jvm = SparkSession.active()._jvm
    known = jvm.org.apache.spark.sql.catalyst.util.DateTimeUtils.getZoneId(zone).getRules()
    first, end = (jvm.java.time.Instant.parse(f"{year}-01-01T00:00:00Z") for year in LISTED_YEARS)
    days, change = set(), known.previousTransition(first) or known.nextTransition(first)
    while change is not None:
        ends = [date.fromisoformat(side.toLocalDate().toString()) for side in (change.getDateTimeBefore(), change.getDateTimeAfter())]
        span = (max(ends) - min(ends)).days
        days.update(min(ends) + timedelta(days=n) for n in range(-1, span + 2))
        if change.getInstant().isAfter(end):
            break
        change = known.nextTransition(change.getInstant())
    return tuple(sorted(days))


def classify_local_time(ts: Column | str, zone: str) -> Column:
    """'normal', 'ambiguous' or 'nonexistent' for a naive wall time in ``zone``.

    A wall time that does not survive the trip to UTC and back does not exist. It is ambiguous when
    a UTC instant one clock shift earlier or later shows the same wall time. Neither can be far from
    a clock change, so only wall times around one are converted.
    """
    wall = _col(ts).cast("timestamp_ntz")
    utc = local_to_utc(wall, zone)
    repeated = F.lit(False)
    for minutes in DST_SHIFTS_MINUTES:
        for sign in (1, -1):
            repeated = repeated | (utc_to_local(shift(utc, mins=sign * minutes), zone) == wall)
    first, end = (F.lit(date(year, 1, 1)) for year in LISTED_YEARS)
    day = wall.cast("date")
    return (
        F.when(wall.isNull(), F.lit(None).cast("string"))
        .when((day >= first) & (day < end) & ~day.isin(*_transition_days(zone)), "normal")
        .when(utc_to_local(utc, zone) != wall, "nonexistent")
        .when(repeated, "ambiguous")
        .otherwise("normal")
    )
