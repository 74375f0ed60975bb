"""Rank feed documents: a JSON object with one root array of flat records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Root array and required keys per feed.
FEEDS = {
    "static": (
        "ranks_info",
        "rank_id rank_name comments city state lga operating_hours longitude latitude bays".split(),
    ),
    "realtime": (
        "ranks_realtime",
        "rank_id status rank_capacity taxis_at_rank passengers_at_rank passenger_wait_time_mins "
        "last_updated_UTC".split(),
    ),
    "historical": (
        "rank_history",
        "rank_id total_bays start_time end_time class from_previous_count total new_arrivals "
        "average_wait".split(),
    ),
}

BYTE_ORDER_MARK = "\ufeff"


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Whole JSON files as ``source_file`` and ``document``, without a byte-order mark."""
    return spark.read.text(path, wholetext=True, recursiveFileLookup=True).select(
        F.col("_metadata.file_path").alias("source_file"),
        F.regexp_replace("value", f"^{BYTE_ORDER_MARK}", "").alias("document"),
    )


def root_records(documents: DataFrame, feed: str) -> DataFrame:
    """One row per record of the feed's root array, as ``record map<string,string>``.

    ``problem`` is NULL for a good record. A document without the array yields one row with a
    problem. A map keeps the difference between an absent key and a null value.
    """
    root, required = FEEDS[feed]
    array = F.from_json(F.get_json_object("document", f"$.{root}"), "array<string>")
    exploded = documents.select("*", F.posexplode_outer(array).alias("position", "text"))
    record = F.from_json("text", "map<string,string>")
    absent = F.filter(
        F.array(*[F.lit(key) for key in required]),
        lambda key: ~F.coalesce(F.map_contains_key(F.col("record"), key), F.lit(False)),
    )
    problem = (
        F.when(F.col("position").isNull(), f"no {root} array")
        .when(~F.coalesce(F.ltrim("text").startswith("{"), F.lit(False)), "not an object")
        .when(F.size("absent") > 0, F.concat(F.lit("missing "), F.array_join("absent", ",")))
    )
    return (
        exploded.withColumn("record", F.when(F.ltrim("text").startswith("{"), record))
        .withColumn("absent", absent)
        .select(*documents.columns, "position", "record", problem.alias("problem"))
    )


def require_records(records: DataFrame) -> DataFrame:
    """Fail the job on the first malformed record while it is being read."""
    checked: Column = F.when(F.col("problem").isNull(), F.col("record")).otherwise(
        F.raise_error(F.concat(F.lit("Malformed feed: "), F.col("problem"))).cast("map<string,string>")
    )
    return records.withColumn("record", checked).drop("problem")
