"""Monthly trip partitions: discovery, time bounds, incremental builds."""

from __future__ import annotations

import re
from collections.abc import Iterable
from datetime import date

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from kerbside.functions import clock, parsing
from kerbside.sources import widening
from kerbside.sources.tables import TRIP_CONTRACT

Contract = dict[str, tuple[str, ...]] | None  # columns and the type families that each may have


def month_floor(period: str) -> Column:
    """First day of a ``YYYY-MM`` period."""
    return F.to_date(F.lit(period + "-01"))


def within_months(start: str | None, end: str | None) -> Column:
    """Predicate on the partition columns ``year`` and ``month``, both bounds inclusive.

    It names partition columns only and therefore prunes directories.
    """
    ordinal = F.col("year") * 12 + F.col("month")
    keep = F.lit(True)
    if start:
        year, month = map(int, start.split("-"))
        keep = keep & (ordinal >= year * 12 + month)
    if end:
        year, month = map(int, end.split("-"))
        keep = keep & (ordinal <= year * 12 + month)
    return keep


def partition_folders(spark: SparkSession, root: str) -> dict[str, list[str]]:
    """The folders ``root/year=YYYY/month=MM`` by period; a listing, not a scan."""
    found: dict[str, list[str]] = {}
    for path in widening.matching_folders(spark, f"{root}/year=*/month=*"):
        if match := re.search(r"year=(\d+)/month=(\d+)/?$", path):
            found.setdefault(f"{int(match[1]):04d}-{int(match[2]):02d}", []).append(path)
    return found


def read_periods(spark: SparkSession, root: str, periods: Iterable[str], contract: Contract = TRIP_CONTRACT) -> DataFrame:
    """The given months below ``root``, columns aligned by name and widened by type; no other month is opened."""
    folders = partition_folders(spark, root)
    return widening.read_widened(spark, [p for period in sorted(set(periods)) for p in folders.get(period, [])], root, contract)


def read_partitioned(
    spark: SparkSession, root: str, start: str | None = None, end: str | None = None, contract: Contract = TRIP_CONTRACT
) -> DataFrame:
    """Trips below ``root/year=YYYY/month=MM/`` from one month to another, both inclusive, as ``read_periods``."""
    chosen = [p for p in partition_folders(spark, root) if (start or p) <= p <= (end or p)]
    if not chosen:
        raise ValueError(f"No months from {start or 'the first'} to {end or 'the last'} below {root}")
    return read_periods(spark, root, chosen, contract)


def read_month_bounded(
    spark: SparkSession, path: str, pickup: str = "tpep_pickup_datetime", contract: Contract = TRIP_CONTRACT
) -> DataFrame:
    """Monthly files, keeping only rows whose pickup lies in the month their file name states.

    Each month is a scan of its own with literal bounds, so that row groups outside them are skipped. Reading stops with an
    error on a file whose name states no month.
    """
    by_period: dict[str, list[str]] = {}
    for file in widening.data_files(spark, path):
        match = re.search(parsing.PERIOD_PATTERN, file)
        if not match or not 1 <= int(match[2]) <= 12:
            raise ValueError(f"No year and month in file name {file}")
        by_period.setdefault(f"{match[1]}-{match[2]}", []).append(file)
    if not by_period:
        raise ValueError(f"No files below {path}")
    period_of = {file: period for period, files in by_period.items() for file in files}

    def months_of(scan: DataFrame, group: widening.Group) -> DataFrame:
        own: dict[str, list[str]] = {}
        for file in group.paths:
            own.setdefault(period_of[file], []).append(file)
        return union_by_name(
            *[_within(spark.read.schema(group.schema).parquet(*files), pickup, period) for period, files in sorted(own.items())]
        )

    return widening.read_widened(spark, list(period_of), None, contract, months_of)


def _within(scan: DataFrame, pickup: str, period: str) -> DataFrame:
    first = date.fromisoformat(period + "-01")
    after = date(first.year + first.month // 12, first.month % 12 + 1, 1)
    kind = scan.schema[pickup].dataType
    first, after = (F.lit(f"{day} 00:00:00").cast(kind) for day in (first, after))
    return scan.filter((F.col(pickup) >= first) & (F.col(pickup) < after))


def union_by_name(*frames: DataFrame) -> DataFrame:
    """UNION ALL aligned by column name; absent columns become NULL."""
    merged = frames[0]
    for frame in frames[1:]:
        merged = merged.unionByName(frame, allowMissingColumns=True)
    return merged


def month_range(bounds: DataFrame, start: str, end: str) -> DataFrame:
    """One row per month from column ``start`` to column ``end``, inclusive, as ``period``."""
    months = F.sequence(F.trunc(start, "month"), F.trunc(end, "month"), F.expr("INTERVAL 1 MONTH"))
    return bounds.select(F.explode(months).alias("month_start")).select(
        clock.month_label("month_start").alias("period")
    )


def release_window(requested: DataFrame, published: DataFrame) -> DataFrame:
    """Months from the earliest to the latest of the requested and already published periods.

    Both inputs carry ``period`` as ``YYYY-MM``.
    """
    both = requested.select("period").unionByName(published.select("period"))
    ends = both.select(F.to_date(F.concat("period", F.lit("-01"))).alias("day")).agg(
        F.min("day").alias("first"), F.max("day").alias("last")
    )
    return month_range(ends, "first", "last")


def pending_months(wanted: DataFrame, built: DataFrame, force: bool = False) -> DataFrame:
    """Wanted periods that have no output yet; all of them when forced."""
    wanted = wanted.select("period").distinct()
    return wanted if force else wanted.join(built.select("period"), "period", "left_anti")


def write_partitioned(df: DataFrame, path: str, by: tuple[str, ...] = ("year", "month")) -> None:
    """ZSTD Parquet by month; rewrites only the months present in ``df``.

    Rows of one month are spread over several writers by adaptive execution, so that a month holding
    most of the data does not become a single task.
    """
    (
        df.hint("rebalance", *by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "zstd")
        .partitionBy(*by)
        .parquet(path)
    )


def write_sorted(df: DataFrame, path: str, *order: str, measures: dict[str, Column] | None = None) -> dict:
    """ZSTD Parquet whose files hold consecutive, internally sorted key ranges.

    Returns the aggregates ``measures`` over the rows written. They are observed by the writing job itself, behind its
    exchange, where neither the sampling of key ranges nor a repeated stage adds to them.
    """
    ordered, seen = df.repartitionByRange(*order).sortWithinPartitions(*order), Observation()
    if measures:
        ordered = ordered.observe(seen, *[value.alias(name) for name, value in measures.items()])
    ordered.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return dict(seen.get) if measures else {}


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)
