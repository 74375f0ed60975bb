"""Small helpers shared by the registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from kerbside.session import scratch_path


def rounded(df: DataFrame, digits: int = 6, only: tuple[str, ...] | None = None) -> DataFrame:
    """Round double columns: sums of doubles depend on their order in the last digits."""
    return df.select(
        *[
            (F.round(F.col(f.name), digits) + F.lit(0.0)).alias(f.name)
            if f.dataType.simpleString() == "double" and (only is None or f.name in only)
            else F.col(f.name)
            for f in df.schema
        ]
    )


def dates_as_text(df: DataFrame) -> DataFrame:
    return df.select(
        *[
            F.col(f.name).cast("string").alias(f.name) if f.dataType.simpleString() == "date" else F.col(f.name)
            for f in df.schema
        ]
    )


def written(df: DataFrame, label: str, *by: str) -> str:
    """Write a derived table to the shared folder; returns its path."""
    path = scratch_path(df.sparkSession, label)
    writer = df.write.option("compression", "zstd")
    (writer.partitionBy(*by) if by else writer).parquet(path)
    return path


def name_files_by_month(spark: SparkSession, path: str, period: str) -> None:
    """Give the Parquet files of a folder the ``_YYYY-MM.parquet`` ending of monthly deliveries."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    folder = hadoop.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    for status in files.listStatus(folder):
        name = status.getPath().getName()
        if name.endswith(".parquet"):
            files.rename(status.getPath(), hadoop.Path(folder, name.replace(".parquet", f"_{period}.parquet")))
