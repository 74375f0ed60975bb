"""Holiday and major-event calendar as pure functions of a wall-clock timestamp.

Every rule is a closed expression, so a calendar needs no lookup table and can be evaluated per
row, per distinct hour, or inside a recursive forecast round.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

from kerbside.functions import clock

# Event codes, fixed-date holidays and nth-weekday holidays (month, weekday with
# Monday = 0, occurrence).
EVENT_CODES = {
    "none": 0,
    "new_year": 1,
    "independence_day": 2,
    "thanksgiving": 3,
    "christmas": 4,
    "memorial_day": 5,
}
FIXED_HOLIDAYS = ("01-01", "06-19", "07-04", "11-11", "12-25")
NTH_WEEKDAY_HOLIDAYS = ((1, 0, 3), (2, 0, 3), (5, 0, 4), (9, 0, 1), (11, 3, 4))
EVENT_HORIZON_HOURS = 168.0

EVENT_COLUMNS = (
    "event_code",
    "is_event_window",
    "is_event_eve",
    "is_event_overnight",
    "is_new_year_window",
    "hours_to_major_event",
    "hours_since_major_event",
)


def is_us_holiday(ts: Column) -> Column:
    """1 on a listed holiday; observed-day shifts are not applied."""
    occurrence = F.floor((F.dayofmonth(ts) - 1) / 7) + 1
    movable = reduce(
        lambda left, right: left | right,
        [
            (F.month(ts) == month) & (F.weekday(ts) == weekday) & (occurrence == nth)
            for month, weekday, nth in NTH_WEEKDAY_HOLIDAYS
        ],
    )
    fixed = F.date_format(ts, "MM-dd").isin(*FIXED_HOLIDAYS)
    return F.coalesce(fixed | movable, F.lit(False)).cast("int")


def _day(year: Column, month: int, day: int) -> Column:
    return F.make_date(year, F.lit(month), F.lit(day))


def thanksgiving(year: Column) -> Column:
    """Fourth Thursday of November."""
    return F.date_add(F.next_day(_day(year, 10, 31), "Thu"), 21)


def memorial_day(year: Column) -> Column:
    """Last Monday of May."""
    return F.next_day(_day(year, 5, 24), "Mon")


def events_of_year(year: Column) -> list[tuple[str, Column]]:
    return [
        ("new_year", _day(year, 1, 1)),
        ("independence_day", _day(year, 7, 4)),
        ("thanksgiving", thanksgiving(year)),
        ("christmas", _day(year, 12, 25)),
        ("memorial_day", memorial_day(year)),
    ]


def event_code_on(day: Column) -> Column:
    """Code of the event on ``day``, 0 on any other day."""
    code = F.lit(0)
    for name, date in events_of_year(F.year(day)):
        code = F.when(day == date, EVENT_CODES[name]).otherwise(code)
    return code.cast("int")


def event_columns(ts: Column) -> dict[str, Column]:
    """The seven event features of one timestamp, by column name."""
    day = F.to_date(ts)
    code = event_code_on(day)
    tomorrow = event_code_on(F.date_add(day, 1))
    first_of_year = (F.month(ts) == 1) & (F.dayofmonth(ts) == 1)
    new_year = ((F.month(ts) == 12) & (F.dayofmonth(ts) == 31) & (F.hour(ts) >= 18)) | (
        first_of_year & (F.hour(ts) <= 6)
    )
    memorial = EVENT_CODES["memorial_day"]
    window = (code > 0) | new_year | (tomorrow == memorial)

    # Event midnights of the previous, current and next year bracket every timestamp.
    midnights = [
        F.unix_seconds(date.cast("timestamp"))
        for offset in (-1, 0, 1)
        for _, date in events_of_year(F.year(ts) + offset)
    ]
    micros = F.unix_micros(ts.cast("timestamp"))
    gaps = [midnight * 1_000_000 - micros for midnight in midnights]
    hour_micros = 3_600_000_000.0
    ahead = F.least(*[F.when(gap >= 0, gap) for gap in gaps]) / hour_micros
    behind = F.least(*[F.when(gap <= 0, -gap) for gap in gaps]) / hour_micros
    return {
        "event_code": code,
        "is_event_window": window.cast("int"),
        "is_event_eve": (tomorrow > 0).cast("int"),
        "is_event_overnight": (first_of_year & (F.hour(ts) <= 5)).cast("int"),
        "is_new_year_window": new_year.cast("int"),
        "hours_to_major_event": F.least(ahead, F.lit(EVENT_HORIZON_HOURS)),
        "hours_since_major_event": F.least(behind, F.lit(EVENT_HORIZON_HOURS)),
    }


def calendar_columns(ts: Column) -> dict[str, Column]:
    """Hour, weekday, month, weekend, holiday and their cyclic encodings."""
    hour, weekday = F.hour(ts), clock.monday_first_weekday(ts)
    turn = 2 * F.pi()
    return {
        "hour": hour,
        "day_of_week": weekday,
        "month": F.month(ts),
        "is_weekend": clock.is_weekend(ts).cast("int"),
        "is_us_holiday": is_us_holiday(ts),
        "hour_sin": F.sin(turn * hour / 24),
        "hour_cos": F.cos(turn * hour / 24),
        "dow_sin": F.sin(turn * weekday / 7),
        "dow_cos": F.cos(turn * weekday / 7),
    }
