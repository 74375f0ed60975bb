"""Session settings, lineage cutting and size-checked broadcasts."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

# Runtime settings the jobs rely on. UTC keeps wall-clock (NTZ) values unshifted when Spark routes
# them through TIMESTAMP; the co-partition setting lets a join on (entity, hour) reuse a
# partitioning on entity, so the dense grid is not shuffled again before its windows.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}

# Whether a query's shuffle files go when it ends, rather than when the driver happens to collect garbage.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

# A broadcast table is held whole by the driver and every executor.
BROADCAST_ROW_LIMIT = 500_000
BROADCAST_BYTE_LIMIT = 64 << 20


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def build_session(app: str = "kerbside", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("Set spark.checkpoint.dir to a folder shared by the cluster")
    path = tempfile.mkdtemp(prefix="kerbside-")
    spark.conf.set("spark.checkpoint.dir", path)
    return path


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path for a table written between two stages of a job.

    Tables of one application share a folder, which may be removed once the application has ended.
    """
    application = spark.sparkContext.applicationId
    return os.path.join(shared_dir(spark), application, f"{label}-{uuid.uuid4().hex}")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: survives executor loss and ends plan growth in iterative jobs."""
    spark = df.sparkSession
    folder = shared_dir(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, label: str, settings: dict[str, str] | None = None) -> DataFrame:
    """Write a table to the shared folder and read it back, with file statistics for the planner.

    The shuffle files of the write are removed once it is done: nothing reads its plan again. ``settings`` hold for the
    write only.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    settings = {SHUFFLE_CLEANUP: "true", **(settings or {})}
    before = {key: spark.conf.get(key, None) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        df.write.parquet(path)
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    return spark.read.schema(df.schema).parquet(path)


def broadcast_if_small(
    df: DataFrame, limit: int = BROADCAST_ROW_LIMIT, store: str | None = None
) -> DataFrame:
    """Broadcast hint only when rows and bytes are proven to be within their limits.

    Both are sums of partial aggregates, so no rows meet in one task. Beyond a limit the DataFrame is
    returned without a hint: the join then shuffles and adaptive execution splits its skewed
    partitions. ``store`` names a table to write first, for an input that is costly to compute once
    for the sums and again for the join.
    """
    if store:
        df = stored(df, store)
    width = F.lit(8 * (len(df.columns) + 1)).cast("long")
    for field in df.schema:
        if field.dataType.simpleString() not in _FIXED:
            width += F.coalesce(F.length(F.to_json(F.struct(F.col(f"`{field.name}`")))), F.lit(0))
    rows, size = df.agg(F.count("*"), F.sum(width)).first()
    within = rows <= limit and (size or 0) <= BROADCAST_BYTE_LIMIT
    return F.broadcast(df) if within else df


_FIXED = {"boolean", "tinyint", "smallint", "int", "bigint", "float", "double", "date", "timestamp", "timestamp_ntz"}
