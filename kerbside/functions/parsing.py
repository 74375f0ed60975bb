"""Lenient parsing of text fields."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Tokens meaning "missing" and the ordinal passenger bands of the rank feed.
MISSING_TOKENS = ("", "N/A", "None")
PASSENGER_BANDS = {"Low": 0, "Medium": 1, "High": 2}
PERIOD_PATTERN = r"_(\d{4})-(\d{2})\.parquet$"


def missing_to_null(text: Column) -> Column:
    return F.when(~text.isin(*MISSING_TOKENS), text)


def to_number(text: Column) -> Column:
    """Double, or NULL for a missing token or unreadable text."""
    return missing_to_null(text).try_cast("double")


def to_wall_time(text: Column) -> Column:
    return text.try_cast("timestamp_ntz")


def to_utc(text: Column) -> Column:
    """Instant read from ISO text with an offset, as UTC wall time."""
    return missing_to_null(text).try_cast("timestamp").cast("timestamp_ntz")


def passenger_band(text: Column) -> Column:
    band = F
    for name, rank in PASSENGER_BANDS.items():
        band = band.when(text == name, rank)
    return band.otherwise(F.lit(None)).cast("int")


def period_of_file(name: Column) -> dict[str, Column]:
    """Year, month and time bounds named by ``..._YYYY-MM.parquet``; NULL when there is none."""
    year = F.nullif(F.regexp_extract(name, PERIOD_PATTERN, 1), F.lit("")).cast("int")
    month = F.nullif(F.regexp_extract(name, PERIOD_PATTERN, 2), F.lit("")).cast("int")
    start = F.make_date(year, month, F.lit(1))
    return {
        "year": year,
        "month": month,
        "first_instant": start.cast("timestamp_ntz"),
        "last_instant": F.add_months(start, 1).cast("timestamp_ntz") - F.expr("INTERVAL '0.000001' SECOND"),
    }
