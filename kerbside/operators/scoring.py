"""Forecast scoring: maturity, baselines, metrics, segments, drift."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from kerbside.functions import clock, errors, rules
from kerbside.operators.series import COUNT, HOUR, ZONE, presum

FORECAST_HOUR, PREDICTED, BASELINE = "forecast_hour", "predicted_trip_count", "previous_week"

# Quantile that defines high demand, drift limits.
HIGH_DEMAND_QUANTILE = 0.9
DRIFT_WAPE, DRIFT_BIAS, DRIFT_RECALL = 0.25, 0.10, 0.90


def matured(forecast: DataFrame, actual: DataFrame) -> DataFrame:
    """Forecast rows whose hour is covered by the actuals."""
    return forecast.filter(F.col(FORECAST_HOUR) <= actual.agg(F.max(HOUR)).scalar())


def maturity_status(forecast: DataFrame, actual: DataFrame) -> DataFrame:
    rows = matured(forecast, actual).agg(F.count("*").alias("scored_rows"))
    status = F.when(F.col("scored_rows") == 0, "waiting_for_actuals").otherwise("scored")
    return rows.select(status.alias("status"), "scored_rows")


def join_actuals(forecast: DataFrame, actual: DataFrame) -> DataFrame:
    """Add the observed count per forecast row; no observation means zero trips."""
    observed = presum(actual).withColumnRenamed(HOUR, FORECAST_HOUR)
    return forecast.join(observed, [ZONE, FORECAST_HOUR], "left").withColumn(
        COUNT, F.coalesce(F.col(COUNT).cast("double"), F.lit(0.0))
    )


def join_previous_week(frame: DataFrame, actual: DataFrame, time: str = FORECAST_HOUR) -> DataFrame:
    """Add the count observed seven days earlier, 0 when there was none."""
    earlier = presum(actual).select(
        ZONE, clock.shift(HOUR, days=7).alias(time), F.col(COUNT).cast("double").alias(BASELINE)
    )
    return frame.join(earlier, [ZONE, time], "left").na.fill({BASELINE: 0.0})


def join_previous_year(frame: DataFrame, actual: DataFrame, time: str = HOUR) -> DataFrame:
    """Add the count of the same hour one calendar year earlier; 29 February maps to 28 February."""
    earlier = presum(actual).select(
        F.col(ZONE),
        F.col(HOUR).alias("comparison_hour"),
        F.col(COUNT).cast("double").alias("previous_year"),
    )
    return (
        frame.withColumn("comparison_hour", F.col(time) - F.expr("INTERVAL '1' YEAR"))
        .join(earlier, [ZONE, "comparison_hour"], "left")
        .drop("comparison_hour")
        .na.fill({"previous_year": 0.0})
    )


def scored_frame(forecast: DataFrame, actual: DataFrame) -> DataFrame:
    """Matured forecast rows with actual, baseline and reporting columns."""
    joined = join_previous_week(join_actuals(matured(forecast, actual), actual), actual)
    return joined.withColumns(
        {
            "hour": F.hour(FORECAST_HOUR),
            "month": clock.month_label(FORECAST_HOUR),
            "market": rules.market(ZONE),
        }
    )


def high_demand_threshold(frame: DataFrame, column: str = COUNT) -> Column:
    """Linear-interpolated 0.9 quantile of trip counts, of which there are few distinct values."""
    return frame.agg(F.percentile(column, F.lit(HIGH_DEMAND_QUANTILE))).scalar()


def _melt(metrics: dict[str, Column]) -> Column:
    return F.array(*[F.struct(F.lit(n).alias("metric"), v.cast("double").alias("value")) for n, v in metrics.items()])


def metric_rows(
    frame: DataFrame, truth: str, predictions: dict[str, str], threshold: Column, *by: str
) -> DataFrame:
    """Long table (scope, metric, value), several predictions measured in one pass."""
    melted = [
        F.struct(
            F.lit(scope).alias("scope"),
            _melt(errors.measures(F.col(truth), F.col(column), F.col("_threshold"))).alias("metrics"),
        )
        for scope, column in predictions.items()
    ]
    return (
        frame.withColumn("_threshold", threshold)
        .groupBy(*by)
        .agg(F.array(*melted).alias("scopes"))
        .select(*by, F.inline("scopes"))
        .select(*by, "scope", F.inline("metrics"))
    )


def overall_report(scored: DataFrame) -> DataFrame:
    """One row: candidate and baseline measures, bias, improvement and drift verdict."""
    high = high_demand_threshold(scored)
    truth, guess, base = F.col(COUNT), F.col(PREDICTED), F.col(BASELINE)
    limit = F.col("_threshold")
    candidate = errors.measures(truth, guess, limit)
    baseline = {f"baseline_{n}": c for n, c in errors.measures(truth, base, limit).items()}
    columns = {**candidate, "bias": errors.bias(truth, guess), **baseline}
    measured = scored.withColumn("_threshold", high).agg(
        F.count("*").alias("scored_rows"), *[c.alias(n) for n, c in columns.items()]
    )
    return with_drift(
        measured.withColumn(
            "relative_wape_improvement", errors.relative_improvement(F.col("baseline_wape"), F.col("wape"))
        )
    )


def with_drift(report: DataFrame) -> DataFrame:
    """Add the three drift checks and their conjunction; a missing measure fails."""
    checks = {
        "wape_below_25pct": F.col("wape") < DRIFT_WAPE,
        "absolute_bias_below_10pct": F.abs("bias") < DRIFT_BIAS,
        "high_demand_recall_above_90pct": F.col("high_demand_recall") >= DRIFT_RECALL,
    }
    safe = {name: F.coalesce(check, F.lit(False)) for name, check in checks.items()}
    first, second, third = safe.values()
    return report.withColumns({**safe, "drift_passed": first & second & third})


def _ranked(segments: DataFrame, scope: str, limit: int | None = None) -> DataFrame:
    """Rank inside each scope by falling WAPE, ties by segment."""
    order = Window.partitionBy(scope).orderBy(F.desc("wape"), "segment")
    ranked = segments.withColumn("position", F.row_number().over(order))
    return ranked if limit is None else ranked.filter(F.col("position") <= limit)


def _grouped(scored: DataFrame, scopes: dict[str, str]) -> DataFrame:
    """Candidate and baseline error sums per segment of every scope, in one scan.

    Sums per combination come first; the grouping sets then expand that compact table, not the
    scored rows.
    """
    truth, guess = F.col(COUNT), F.col(PREDICTED)
    base = F.col(BASELINE) if BASELINE in scored.columns else F.lit(None).cast("double")
    parts = scored.groupBy(*scopes.values()).agg(
        F.count("*").alias("rows"),
        F.sum(truth).alias("actual"),
        F.sum(F.abs(truth - guess)).alias("error"),
        F.sum(guess - truth).alias("signed"),
        F.sum(F.abs(truth - base)).alias("base_error"),
    )
    labelled = F.array(
        *[
            F.struct(F.lit(scope).alias("scope"), F.col(column).cast("string").alias("segment"))
            for scope, column in scopes.items()
        ]
    )
    sums = ("rows", "actual", "error", "signed", "base_error")
    total = F.greatest(F.col("actual"), F.lit(1.0))
    return (
        parts.select(F.inline(labelled), *sums)
        .groupBy("scope", "segment")
        .agg(*[F.sum(name).alias(name) for name in sums])
        .select(
            "scope",
            "segment",
            "rows",
            "actual",
            (F.col("error") / F.col("rows")).alias("mae"),
            (F.col("error") / total).alias("wape"),
            (F.col("signed") / total).alias("bias"),
            (F.col("base_error") / total).alias("baseline_wape"),
        )
    )


def monitoring_segments(scored: DataFrame, worst: int = 15, min_actual: float = 100.0) -> DataFrame:
    """Errors by month, hour, market and the worst zones, ranked inside each scope."""
    scopes = {"month": "month", "hour": "hour", "market": "market", "zone": ZONE}
    found = _grouped(scored, scopes).filter((F.col("scope") != "zone") | (F.col("actual") >= min_actual))
    ranked = _ranked(found, "scope").filter((F.col("scope") != "zone") | (F.col("position") <= worst))
    return ranked.select("scope", "position", "segment", "rows", "mae", "wape", "bias")


def shadow_segments(scored: DataFrame, worst: int = 15, min_actual: float = 100.0) -> DataFrame:
    """Errors against the baseline by horizon, calendar segment, market and worst zones."""
    scopes = {"horizon": "horizon_hour", "calendar": "calendar_segment", "market": "market", "zone": ZONE}
    found = _grouped(scored, scopes).filter((F.col("scope") != "zone") | (F.col("actual") >= min_actual))
    ranked = _ranked(found, "scope").filter((F.col("scope") != "zone") | (F.col("position") <= worst))
    return ranked.select("scope", "position", "segment", "rows", "wape", "bias", "baseline_wape")


def test_segments(predicted: DataFrame, guess: str = "prediction", worst: int = 10) -> DataFrame:
    """Rows, MAE and WAPE per hour, and for the zones with the largest MAE."""
    clipped = predicted.withColumns(
        {PREDICTED: errors.clip(F.col(guess)), "hour": F.hour(HOUR), COUNT: F.col(COUNT).cast("double")}
    )
    found = _grouped(clipped, {"hour": "hour", "zone": ZONE})
    order = Window.partitionBy("scope").orderBy(F.desc("mae"), "segment")
    return (
        found.withColumn("position", F.row_number().over(order))
        .filter((F.col("scope") == "hour") | (F.col("position") <= worst))
        .select("scope", "segment", "rows", "mae", "wape")
    )
