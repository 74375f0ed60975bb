"""Reproducible samples and splits."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from kerbside.functions import rules
from kerbside.operators.silver import PICKUP
from kerbside.session import broadcast_if_small, stored

SAMPLE_KEY = (PICKUP, "PULocationID", "DOLocationID")
SLOT_DIGITS = 3  # leading hexadecimal digits of a hash by which trips of a day are counted
HASH_SLOTS = 16**SLOT_DIGITS


def rank_within_day(trips: DataFrame, *tie: str, key: tuple[str, ...] = SAMPLE_KEY) -> DataFrame:
    """Add ``sample_rank``: hash order of ``key`` within the pickup day, then ``tie``.

    The order digest is uniform, so its first two hexadecimal digits cut every day into 256
    consecutive runs. Rows are ranked inside a run and shifted by the size of the day's earlier
    runs; a day holding most of the trips is thereby ranked by many tasks.
    """
    keyed = trips.filter(F.col(PICKUP).isNotNull()).withColumns(
        {"_day": F.to_date(PICKUP), "_key": rules.stable_key(*key)}
    )
    keyed = keyed.withColumn("_run", F.substring("_key", 1, 2))
    before = Window.partitionBy("_day").orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        keyed.groupBy("_day", "_run")
        .agg(F.count("*").alias("_rows"))
        .select("_day", "_run", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    )
    inside = Window.partitionBy("_day", "_run").orderBy("_key", *tie)
    return (
        keyed.withColumn("_place", F.row_number().over(inside))
        .join(broadcast_if_small(offsets, store="run-offsets"), ["_day", "_run"])
        .withColumn("sample_rank", F.col("_place") + F.col("_offset"))
        .drop("_day", "_key", "_run", "_place", "_offset")
    )


def rounds_needed(day_rows: list[int], rows: int) -> int:
    """How many times each day is drawn from until ``rows`` are reached: the least level with sum(min(day, level)) >= rows."""
    level, left = 0, rows
    for place, size in enumerate(sorted(day_rows)):
        open_days = len(day_rows) - place
        step = size - level
        if step * open_days >= left:
            return level + -(-left // open_days)
        level, left = size, left - step * open_days
    return level


def stratified_sample(
    trips: DataFrame, rows: int = 10_000, *tie: str, key: tuple[str, ...] = SAMPLE_KEY
) -> DataFrame:
    """``rows`` trips taken round-robin over the days, each day in hash order.

    Selection by threshold: a histogram of the leading hash digits per day says from which digits on a day has as many trips
    as the sample takes from it; later digits are dropped where they are read, and only the rest, that number and one part
    in HASH_SLOTS of the day at most, is put in order.
    """
    if rows <= 0:
        raise ValueError("rows must be positive")
    keyed = trips.filter(F.col(PICKUP).isNotNull()).withColumns({"_day": F.to_date(PICKUP), "_key": rules.stable_key(*key)})
    keyed = keyed.withColumn("_slot", F.substring("_key", 1, SLOT_DIGITS))
    histogram = stored(keyed.groupBy("_day", "_slot").agg(F.count("*").alias("_rows")), "sample-histogram")
    sizes = [row.n for row in histogram.groupBy("_day").agg(F.sum("_rows").alias("n")).toLocalIterator()]  # a row per day
    needed = rounds_needed(sizes, rows)
    before = Window.partitionBy("_day").orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    limits = (
        histogram.withColumn("_before", F.coalesce(F.sum("_rows").over(before), F.lit(0)))
        .filter(F.col("_before") < needed)
        .groupBy("_day")
        .agg(F.max("_slot").alias("_last"))
    )
    overall = Window.partitionBy("_day").orderBy("_key", *tie)
    return (
        keyed.join(broadcast_if_small(limits, store="sample-limits"), "_day")
        .filter("_slot <= _last")
        .withColumn("_n", F.row_number().over(overall))
        .filter(F.col("_n") <= needed)
        .orderBy("_n", F.md5(F.col("_day").cast("string")), "_day")
        .limit(rows)
        .drop("_day", "_key", "_slot", "_last", "_n")
    )


def head_slice(df: DataFrame, rows: int, *key: str) -> DataFrame:
    """The first rows in hash order of a key: a bounded, repeatable stand-in for a positional head."""
    return df.orderBy(rules.stable_key(*key), *key).limit(rows)


def hash_split(df: DataFrame, key: str, train_share: int = 70, bucket: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Row split by hash of a key, independent of partitioning and row order.

    ``bucket`` names a column that holds ``rules.hash_bucket(key)`` already.
    """
    bucket = F.col(bucket) if bucket else rules.hash_bucket(key)
    return df.filter(bucket < train_share), df.filter(bucket >= train_share)
