"""Incremental zone-hour demand over newly arrived trip files.

Files arrive in any order, whole months late, so no event may be lost to a watermark. Every micro-batch adds its own
eligible counts to the output, in a folder named after the batch; a batch that runs again after a failure replaces its
folder. Readers add the batches up, so the result doesn't depend on how files were cut into batches.

Batches are folded into snapshots, so that readers open few files. A snapshot holds the counts of all batches up to the
number it is named after, sorted by hour; readers take the newest complete one and the batches behind it. Late batches go
on adding to it, and the next snapshot takes them in. A folder counts once its success mark is there, the last thing that
is written: a snapshot that broke off is no snapshot, and the batches that it was made from are still read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from kerbside.operators import gold
from kerbside.sources.widening import file_system

COUNTS = "pickup_zone_id int, pickup_borough string, pickup_zone string, pickup_hour timestamp_ntz, trip_count bigint"
BATCHES_PER_SNAPSHOT = 100
SNAPSHOTS = "_snapshots"  # a hidden name: whoever reads the folder by itself sees batches only
MARK = "_SUCCESS"
_MARKED = {"mapreduce.fileoutputcommitter.marksuccessfuljobs": "true"}


def read_stream(spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int | None = None) -> DataFrame:
    """Stream of Parquet trip files as they arrive below ``path``."""
    reader = spark.readStream.schema(schema).option("recursiveFileLookup", True)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def run_available(
    trips: DataFrame, zones: DataFrame, output: str, checkpoint: str, batches_per_snapshot: int = BATCHES_PER_SNAPSHOT
) -> None:
    """Count everything that has arrived, under the demand rules of the batch path, then stop.

    A batch finds all earlier ones settled, and folds them when they have become ``batches_per_snapshot``. A batch that a
    snapshot covers already is an error: the output belongs to another checkpoint.
    """

    def add(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        covered, waiting = _parts(spark, output)
        if covered is not None and number <= covered:
            raise ValueError(f"Batch {number} is part of a snapshot of {output}: the checkpoint is not the one that it was made with")
        if sum(n < number for n in waiting) >= batches_per_snapshot:
            compact(spark, output, number)
        counted = gold.hourly_zone_demand_from_trips(batch, zones)
        counted.write.mode("overwrite").options(**_MARKED).parquet(f"{output}/batch={number}")

    query = (
        trips.writeStream.foreachBatch(add)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def _numbers(spark: SparkSession, folder: str, name: str, complete: bool = True) -> list[int]:
    """The numbers of the folders ``name=number``, in order; only those with their mark unless ``complete`` is False."""
    system, root = file_system(spark, folder)
    if not system.exists(root):
        return []
    inside = [status.getPath() for status in system.listStatus(root) if status.isDirectory()]
    named = [path for path in inside if path.getName().startswith(f"{name}=")]
    return sorted(int(path.getName().partition("=")[2]) for path in named if not complete or system.exists(path.suffix(f"/{MARK}")))


def _parts(spark: SparkSession, output: str) -> tuple[int | None, list[int]]:
    """The last batch that the newest snapshot covers (None without one), and the batches behind it."""
    covered = max(_numbers(spark, f"{output}/{SNAPSHOTS}", "upto"), default=None)
    batches = _numbers(spark, output, "batch")
    return covered, [n for n in batches if covered is None or n > covered]


def _counts(spark: SparkSession, output: str, covered: int | None, batches: list[int]) -> DataFrame:
    paths = [f"{output}/batch={n}" for n in batches]
    if covered is not None:
        paths.append(f"{output}/{SNAPSHOTS}/upto={covered}")
    return spark.read.schema(COUNTS).parquet(*paths) if paths else spark.createDataFrame([], COUNTS)


def _added(parts: DataFrame) -> DataFrame:
    keys = [c for c in parts.columns if c != "trip_count"]
    return parts.groupBy(*keys).agg(F.sum("trip_count").alias("trip_count"))


def compact(spark: SparkSession, output: str, before: int | None = None) -> int | None:
    """Fold the batches before number ``before`` into a new snapshot; returns the last batch that is covered now.

    Without ``before`` all but the newest batch are folded: the newest may still run again. What the snapshot before this
    one covers is deleted, and this one's batches are not yet, so that readers who began before the switch can finish. Only
    one process at a time may compact an output.
    """
    covered, batches = _parts(spark, output)
    settled = [n for n in batches if n < (max(batches) if before is None else before)]
    if not settled:
        return covered
    total = _added(_counts(spark, output, covered, settled)).repartitionByRange("pickup_hour")
    writer = total.sortWithinPartitions("pickup_hour", "pickup_zone_id").write.mode("overwrite").options(**_MARKED)
    writer.option("compression", "zstd").parquet(f"{output}/{SNAPSHOTS}/upto={settled[-1]}")
    if covered is not None:
        _delete_covered(spark, output, covered)
    return settled[-1]


def _delete_covered(spark: SparkSession, output: str, covered: int) -> None:
    """Remove older snapshots, and then the batches that snapshot ``covered`` holds.

    In this order, as a reader who still means an older snapshot must miss it, not its batches alone.
    """
    for folder, name, last in ((f"{output}/{SNAPSHOTS}", "upto", covered - 1), (output, "batch", covered)):
        system, root = file_system(spark, folder)
        for number in _numbers(spark, folder, name, complete=False):
            if number <= last:
                system.delete(root.suffix(f"/{name}={number}"), True)


def demand_so_far(spark: SparkSession, output: str, delay: str | None = None) -> DataFrame:
    """Demand of all batches together: the newest snapshot and the batches behind it.

    With ``delay`` only hours that ended so long before the newest counted hour; later deliveries may still correct them.
    """
    parts = _counts(spark, output, *_parts(spark, output))
    total = _added(parts)
    if delay:
        newest = parts.agg(F.max("pickup_hour")).scalar()
        total = total.filter(F.col("pickup_hour") + F.expr("INTERVAL 1 HOUR") <= newest - F.expr(f"INTERVAL {delay}"))
    return total
