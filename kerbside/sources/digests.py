"""File digests, lineage records and their checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from kerbside.sources import widening
from kerbside.sources.widening import data_files


WHOLE_BYTES = 64 << 20  # larger files are digested in blocks
BLOCK_BYTES = 8 << 20


def _digested(files: DataFrame, whole_bytes: int, block_bytes: int) -> DataFrame:
    """Path, size, SHA-256 and time of files of any size, from rows of the binary file source.

    Files up to ``whole_bytes`` are digested as values. Of larger ones only the listing is taken, packed into tasks by size
    as every scan is; tasks open them where they lie and never hold more than a block. A file that ends before its listed
    size raises an error.
    """

    def in_blocks(batches):
        import hashlib
        from urllib.parse import quote

        import pyarrow as pa
        from pyarrow import fs

        for batch in batches:
            found = []
            for path, size in zip(batch.column("path").to_pylist(), batch.column("bytes").to_pylist()):
                scheme, _, rest = path.partition(":")  # listed without escapes, and local files without an authority
                system, name = fs.FileSystem.from_uri(f"{scheme}:{'' if rest.startswith('//') else '//'}{quote(rest)}")
                sha, left = hashlib.sha256(), size
                with system.open_input_stream(name, compression=None) as file:
                    while block := file.read(block_bytes):
                        sha.update(block)
                        left -= len(block)
                if left:
                    raise ValueError(f"{path} has {size - left} bytes in place of {size}")
                found.append(sha.hexdigest())
            columns = [batch.column("path"), batch.column("bytes"), pa.array(found, pa.string()), batch.column("recorded_at")]
            yield pa.RecordBatch.from_arrays(columns, names=["path", "bytes", "sha256", "recorded_at"])

    listed = ("path", F.col("length").alias("bytes"), F.col("modificationTime").alias("recorded_at"))
    whole = files.filter(F.col("length") <= whole_bytes).select(*listed[:2], F.sha2("content", 256).alias("sha256"), listed[2])
    large = files.filter(F.col("length") > whole_bytes).select(*listed)
    return whole.unionByName(large.mapInArrow(in_blocks, whole.schema))


def file_digests(
    spark: SparkSession, path: str, pattern: str = "*.parquet", whole_bytes: int = WHOLE_BYTES, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """Path, size, SHA-256 and modification time of each file below ``path``, whatever its size.

    Spark's file sources pass over files without any bytes, so these have no row and count as missing in a lineage check.
    """
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .load(path)
    )
    return _digested(files, whole_bytes, block_bytes)


def digests_of(spark: SparkSession, paths: list[str]) -> DataFrame:
    """``file_digests`` of named files."""
    files = spark.read.format("binaryFile").load(paths)
    return _digested(files, WHOLE_BYTES, BLOCK_BYTES).drop("recorded_at")


SOURCE, OUTPUT = "source", "output"


def write_lineage(spark: SparkSession, product: str, sources: list[str], outputs: list[str], totals: dict, path: str) -> DataFrame:
    """Record what a product was made from and consists of: a row per file with its digest, and the product's totals.

    Written after the product. Where a run stops in between, the digests of the older record no longer fit the product's
    files, so that the checks below refuse it.
    """
    made = [digests_of(spark, files).withColumn("kind", F.lit(kind)) for kind, files in ((SOURCE, sources), (OUTPUT, outputs))]
    record = made[0].unionByName(made[1]).withColumns(
        {"product": F.lit(product), **{name: F.lit(value).cast("long") for name, value in totals.items()}, "generated_at": F.current_timestamp()}
    )
    record.coalesce(1).write.mode("overwrite").parquet(path)  # a row per monthly file
    return spark.read.parquet(path)


def broken_lineage(spark: SparkSession, lineage: DataFrame) -> DataFrame:
    """Recorded sources and outputs that are gone or no longer have the recorded digest, as (kind, path, status)."""
    there = [row.path for row in lineage.select("path").distinct().toLocalIterator() if data_files(spark, row.path)]
    found = digests_of(spark, there) if there else lineage.limit(0)
    broken = lineage_mismatches(lineage, found.select("path", "sha256"))
    return lineage.select("path", "kind").join(broken, "path").select("kind", "path", "status")


def read_product(spark: SparkSession, lineage: DataFrame) -> DataFrame:
    """The product of a lineage record, after all its sources and outputs have been verified."""
    broken = broken_lineage(spark, lineage).take(5)
    if broken:
        raise ValueError(f"Lineage check failed: {[tuple(row) for row in broken]}")
    outputs = lineage.filter(F.col("kind") == OUTPUT)
    return read_declared(spark, outputs, outputs)


def latest_records(manifest: DataFrame, *new: DataFrame) -> DataFrame:
    """Manifest with the most recent record per path."""
    for frame in new:
        manifest = manifest.unionByName(frame)
    latest = Window.partitionBy("path").orderBy(F.desc("recorded_at"), "sha256")
    return manifest.withColumn("_n", F.row_number().over(latest)).filter("_n = 1").drop("_n")


def lineage_mismatches(declared: DataFrame, digests: DataFrame) -> DataFrame:
    """Declared sources that are missing or whose digest changed.

    Files that were not declared are ignored.
    """
    found = digests.select("path", F.col("sha256").alias("found_sha256"))
    status = F.when(F.col("found_sha256").isNull(), "missing").when(
        F.col("found_sha256") != F.col("sha256"), "changed"
    )
    return (
        declared.select("path", "sha256")
        .join(found, "path", "left")
        .select("path", status.alias("status"))
        .filter(F.col("status").isNotNull())
    )


def read_declared(spark: SparkSession, declared: DataFrame, digests: DataFrame) -> DataFrame:
    """Read exactly the declared files, after their digests have been verified.

    The declared list is release metadata: one row per monthly file.
    """
    broken = lineage_mismatches(declared, digests).take(5)
    if broken:
        raise ValueError(f"Lineage check failed: {[tuple(row) for row in broken]}")
    paths = [row.path for row in declared.select("path").sort("path").toLocalIterator()]
    if not paths:
        raise ValueError("No sources declared")
    return widening.read_widened(spark, paths, contract=None)
