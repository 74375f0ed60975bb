"""Taxi-rank history: non-destructive normalisation of text records."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from kerbside.functions import clock, parsing

# Known classes, interval length, business time zone.
CLASSES = ("taxi", "passenger", "wat")
INTERVAL_SECONDS = 900
LOCAL_ZONE = "Australia/Sydney"

MEASURES = {"from_previous": "from_previous_count", "total": "total", "new_arrivals": "new_arrivals"}


def _any(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def normalize(records: DataFrame) -> DataFrame:
    """Typed columns and seven quality flags per record; no record is dropped.

    ``records`` carries ``source_file`` and ``record map<string,string>``. Passenger measures are
    ordinal bands and never become counts.
    """

    def raw(key: str) -> Column:
        return F.col("record")[key]

    # Parsed once here, read several times below.
    parsed = records.select(
        "source_file",
        *[parsing.missing_to_null(raw(key)).alias(key) for key in ("rank_id", "tsn", "comments")],
        parsing.to_number(raw("total_bays")).alias("total_bays"),
        F.lower(F.coalesce(raw("class"), F.lit("none"))).alias("class"),
        parsing.to_utc(raw("start_time")).alias("start_time_utc"),
        parsing.to_utc(raw("end_time")).alias("end_time_utc"),
        *[parsing.missing_to_null(raw(key)).alias(f"{name}_raw") for name, key in MEASURES.items()],
        parsing.to_number(raw("average_wait")).alias("average_wait_seconds"),
    )
    passenger = F.col("class") == "passenger"
    start, end = F.col("start_time_utc"), F.col("end_time_utc")
    texts = {name: F.col(f"{name}_raw") for name in MEASURES}
    counts = {
        ("total_count" if name == "total" else f"{name}_count"): F.when(~passenger, parsing.to_number(text))
        for name, text in texts.items()
    }
    bands = {f"{name}_band": F.when(passenger, parsing.passenger_band(text)) for name, text in texts.items()}
    typed = parsed.withColumns({**counts, **bands})
    seconds = clock.elapsed_seconds(start, end)
    return typed.select(
        "rank_id",
        "tsn",
        "comments",
        "total_bays",
        "start_time_utc",
        "end_time_utc",
        clock.utc_to_local(start, LOCAL_ZONE).alias("start_time_sydney"),
        clock.utc_to_local(end, LOCAL_ZONE).alias("end_time_sydney"),
        "class",
        *[f"{name}_raw" for name in MEASURES],
        *counts,
        *bands,
        "average_wait_seconds",
        "source_file",
        F.col("rank_id").isNull().alias("dq_missing_rank_id"),
        (~F.col("class").isin(*CLASSES)).alias("dq_unknown_class"),
        (start.isNull() | end.isNull()).alias("dq_invalid_timestamp"),
        F.coalesce(seconds != INTERVAL_SECONDS, F.lit(True)).alias("dq_invalid_interval"),
        (passenger & _any([F.col(band).isNull() for band in bands])).alias("dq_invalid_passenger_band"),
        (~passenger & _any([F.col(count).isNull() for count in counts])).alias("dq_invalid_numeric_count"),
        F.coalesce(F.col("average_wait_seconds") < 0, F.lit(False)).alias("dq_negative_wait"),
    )


def flag_counts(silver: DataFrame) -> DataFrame:
    flags = [c for c in silver.columns if c.startswith("dq_")]
    return silver.agg(*[F.count_if(F.col(f)).alias(f) for f in flags]).unpivot([], flags, "quality_flag", "rows")


def feed_report(silver: DataFrame) -> DataFrame:
    """Rows per class and per raised flag, as (section, name, rows), from one pass.

    Flags are counted per class first; totals then add a handful of rows.
    """
    flags = [c for c in silver.columns if c.startswith("dq_")]
    compact = silver.groupBy("class").agg(
        F.count("*").alias("rows"), *[F.count_if(F.col(f)).alias(f) for f in flags]
    )
    entries = [F.struct(F.lit("class").alias("section"), F.col("class").alias("name"), F.col("rows"))]
    entries += [
        F.struct(F.lit("flag").alias("section"), F.lit(f).alias("name"), F.col(f).alias("rows")) for f in flags
    ]
    return (
        compact.select(F.inline(F.array(*entries)))
        .groupBy("section", "name")
        .agg(F.sum("rows").alias("rows"))
    )
