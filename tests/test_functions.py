from datetime import datetime, timedelta
from zoneinfo import ZoneInfo

import pytest
from pyspark.sql import functions as F

from kerbside.functions import almanac, clock, parsing, rules


def stamps(rows, *texts):
    return rows("t string", *[(x,) for x in texts]).select(F.col("t").cast("timestamp_ntz").alias("t"))


def test_event_timestamps(rows):
    columns = almanac.event_columns(F.col("t"))
    times = stamps(
        rows,
        "2024-12-31 20:00:00",
        "2025-01-01 03:00:00",
        "2025-01-02 03:00:00",
        "2026-05-23 12:00:00",
        "2026-05-24 12:00:00",
        "2026-05-25 12:00:00",
        "2026-05-26 12:00:00",
    )
    found = {
        str(r.t): r for r in times.select("t", *[c.alias(n) for n, c in columns.items()]).collect()
    }
    assert found["2024-12-31 20:00:00"].is_new_year_window == 1
    night = found["2025-01-01 03:00:00"]
    assert (night.event_code, night.is_event_overnight) == (1, 1)
    assert night.hours_since_major_event == 3.0
    assert found["2025-01-02 03:00:00"].is_event_window == 0
    assert found["2026-05-23 12:00:00"].is_event_window == 0
    eve = found["2026-05-24 12:00:00"]
    assert (eve.is_event_eve, eve.is_event_window, eve.event_code) == (1, 1, 0)
    assert eve.hours_to_major_event == 12.0
    day = found["2026-05-25 12:00:00"]
    assert (day.event_code, day.is_event_window) == (5, 1)
    assert found["2026-05-26 12:00:00"].is_event_window == 0


def test_fourth_and_last_monday_of_may_differ(rows):
    """2026 has four Mondays in May, 2027 has five."""
    times = stamps(rows, "2026-05-25 00:00:00", "2027-05-24 00:00:00", "2027-05-31 00:00:00")
    got = times.select(
        almanac.is_us_holiday(F.col("t")).alias("holiday"), almanac.event_columns(F.col("t"))["event_code"].alias("code")
    ).collect()
    assert [(r.holiday, r.code) for r in got] == [(1, 5), (1, 0), (0, 5)]


def test_hours_to_event_are_capped(rows):
    columns = almanac.event_columns(F.col("t"))
    row = stamps(rows, "2024-09-15 12:00:00").select(
        columns["hours_to_major_event"].alias("to"), columns["hours_since_major_event"].alias("since")
    ).first()
    assert (row.to, row.since) == (168.0, 168.0)


def test_seconds_count_boundaries(rows):
    df = rows("a string, b string", ("2024-01-01 00:00:00.900", "2024-01-01 00:00:02.100"), (None, "2024-01-01 00:00:00"))
    typed = df.select(*[F.col(c).cast("timestamp_ntz").alias(c) for c in "ab"])
    assert [r[0] for r in typed.select(clock.seconds_between("a", "b")).collect()] == [2, None]


@pytest.mark.parametrize("zone", ["Australia/Sydney", "America/New_York", "Australia/Lord_Howe", "Europe/London", "UTC"])
def test_wall_time_classes_match_the_time_zone_database(rows, zone):
    start = datetime(2024, 1, 1)
    walls = [start + timedelta(minutes=30 * i) for i in range(366 * 48)]

    def expected(wall):
        tz, good = ZoneInfo(zone), []
        for fold in (0, 1):
            aware = wall.replace(tzinfo=tz, fold=fold)
            if aware.astimezone(ZoneInfo("UTC")).astimezone(tz).replace(tzinfo=None) == wall:
                good.append(aware.utcoffset())
        if not good:
            return "nonexistent"
        return "ambiguous" if len(set(good)) == 2 else "normal"

    df = rows("w timestamp_ntz", *[(w,) for w in walls])
    got = {r.w: r.k for r in df.select("w", clock.classify_local_time("w", zone).alias("k")).collect()}
    assert got == {w: expected(w) for w in walls}


def test_only_wall_times_around_a_clock_change_are_converted(rows, spark):
    """Times far from clock changes must not pay for a dozen conversions of zones; others and unlisted years are classified alike."""
    assert len(clock._transition_days("Australia/Sydney")) < 1200
    walls = [datetime(1951, 6, 1), datetime(1943, 3, 28, 2, 30), datetime(2090, 10, 1, 2, 30), datetime(2011, 12, 30, 12), datetime(2020, 7, 1)]
    df = rows("w timestamp_ntz", *[(w,) for w in walls], (None,))
    sydney, samoa = (clock.classify_local_time("w", z) for z in ("Australia/Sydney", "Pacific/Apia"))
    got = {r.w: (r.s, r.a) for r in df.select("w", sydney.alias("s"), samoa.alias("a")).collect()}
    assert got.pop(None) == (None, None)
    assert [got[w] for w in walls] == [
        ("normal", "normal"), ("ambiguous", "normal"), ("nonexistent", "normal"), ("normal", "nonexistent"), ("normal", "normal")
    ]


def test_utc_to_local(rows):
    got = stamps(rows, "2024-06-25 00:00:00").select(clock.utc_to_local("t", "Australia/Sydney")).first()[0]
    assert got == datetime(2024, 6, 25, 10)


def test_lenient_parsing(rows):
    df = rows("x string", ("4",), ("N/A",), ("",), ("None",), ("four",), (None,))
    assert [r[0] for r in df.select(parsing.to_number(F.col("x"))).collect()] == [4.0, None, None, None, None, None]


def test_overlapping_boroughs_use_the_first_rectangle(rows):
    """The point lies in the Manhattan, Queens and Brooklyn rectangles."""
    df = rows("lat double, lng double", (40.70, -73.95), (40.70, -73.80), (0.0, 0.0), (None, -73.95))
    assert [r[0] for r in df.select(rules.borough_of("lat", "lng")).collect()] == ["manhattan", "queens", "others", "others"]


def test_night_shift_keeps_unknown_hours(rows):
    df = rows("h int", (4,), (5,), (16,), (17,), (None,))
    assert [r[0] for r in df.select(rules.night_shift("h")).collect()] == [1, 0, 0, 1, None]
