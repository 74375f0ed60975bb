"""Incremental monthly release: Bronze to gated Gold."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from kerbside.operators import gates, gold, silver
from kerbside.sources import digests, months, tables, widening


@dataclass(frozen=True)
class ReleasePaths:
    bronze: str
    silver: str
    reports: str
    gold: str

    @property
    def lineage(self) -> str:
        return self.gold.rstrip("/") + "_lineage"


def existing_periods(spark: SparkSession, root: str) -> DataFrame:
    """Periods that have a ``year=/month=`` folder below ``root``; a listing, not a scan."""
    return spark.createDataFrame([(period,) for period in months.partition_folders(spark, root)], "period string")


def build_silver(spark: SparkSession, paths: ReleasePaths, zones: DataFrame, wanted: DataFrame, force: bool = False) -> int:
    """Build the wanted months that have no Silver partition and report yet.

    All pending months are one job: trips are enriched and written once; the reports are then
    counted from Silver and reconciled with an independent count of Bronze.
    """
    done = existing_periods(spark, paths.silver).join(
        existing_periods(spark, paths.reports), "period", "left_semi"
    )
    pending = months.pending_months(wanted, done, force)
    periods = [row.period for row in pending.toLocalIterator()]
    if not periods:
        return 0
    bronze = tables.check_contract(months.read_periods(spark, paths.bronze, periods))
    months.write_partitioned(silver.build_silver(bronze, zones), paths.silver)
    written = months.read_periods(spark, paths.silver, periods)
    report = quality_report(bronze, written)
    months.write_partitioned(report, paths.reports)
    return len(periods)


def quality_report(bronze: DataFrame, enriched: DataFrame) -> DataFrame:
    """Flag counts and reconciliation per month."""
    counts = silver.quality_counts(enriched, "year", "month")
    checked = silver.reconcile(bronze, enriched, "year", "month").select("year", "month", "reconciled")
    label = F.format_string("%04d-%02d", "year", "month")
    return counts.join(checked, ["year", "month"]).withColumn("period", label)


PRODUCT = "hourly_zone_demand"


def publish_gold(spark: SparkSession, paths: ReleasePaths, wanted: DataFrame) -> DataFrame:
    """Gate the release window and, if it passes, write Gold and its lineage; returns its totals.

    The window covers the wanted months and every month already in Silver.
    """
    window = months.release_window(wanted, existing_periods(spark, paths.silver))
    reports = months.read_partitioned(spark, paths.reports, contract=None)
    verdict = gates.completeness(window, gates.quality_verdict(gates.quality_checks(reports))).first()
    if not verdict.passed:
        raise RuntimeError("Quality gate failed; Gold release was not updated")
    return write_gold(spark, paths.silver, paths.gold, paths.lineage).select("rows", "trips").distinct()


def write_gold(spark: SparkSession, silver_path: str, gold_path: str, lineage_path: str) -> DataFrame:
    """Gold of all months in Silver, then its lineage record, which is returned.

    Rows and trips are those that the writing job saw.
    """
    sources = widening.data_files(spark, silver_path)
    product = gold.hourly_zone_demand(months.read_partitioned(spark, silver_path))
    measures = {"rows": F.count(F.lit(1)), "trips": F.coalesce(F.sum("trip_count"), F.lit(0))}
    totals = months.write_sorted(product, gold_path, "pickup_hour", "pickup_zone_id", measures=measures)
    return digests.write_lineage(spark, PRODUCT, sources, widening.data_files(spark, gold_path), totals, lineage_path)
