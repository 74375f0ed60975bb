"""Table checks that decide whether a product may be released."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from kerbside.functions import clock, errors
from kerbside.operators.scoring import FORECAST_HOUR, PREDICTED
from kerbside.operators.series import HOUR, ZONE

# Largest (or, for eligibility, smallest) admissible share per check.
RATE_LIMITS = {
    "pickup_outside_partition": 0.0002,
    "unknown_pickup_zone": 0.01,
    "candidate_duplicate_rows": 0.001,
    "negative_fare": 0.03,
    "implausible_speed": 0.005,
}
MIN_ELIGIBLE_RATE = 0.95


def quality_checks(reports: DataFrame, product: str = "demand", limits: dict[str, float] | None = None) -> DataFrame:
    """One row per period and check: value, limit, passed, blocking.

    The negative-fare rate blocks only the fare product.
    """
    limits = {**RATE_LIMITS, "demand_eligible": MIN_ELIGIBLE_RATE, **(limits or {})}
    total = F.greatest(F.col("source_rows"), F.lit(1))

    def check(name: str, value: Column, limit: float, passed: Column, blocking: bool = True) -> Column:
        return F.struct(
            F.lit(name).alias("check"),
            value.cast("double").alias("value"),
            F.lit(float(limit)).alias("limit"),
            F.coalesce(passed, F.lit(False)).alias("passed"),
            F.lit(blocking).alias("blocking"),
        )

    reconciled = F.col("reconciled")
    rows = [check("reconciled", reconciled.cast("int"), 1.0, reconciled)]
    for field in RATE_LIMITS:
        rate = F.col(field) / total
        blocking = field != "negative_fare" or product == "fare"
        rows.append(check(f"{field}_rate", rate, limits[field], rate <= limits[field], blocking))
    eligible = F.col("demand_eligible") / total
    floor = limits["demand_eligible"]
    rows.append(check("demand_eligible_rate", eligible, floor, eligible >= floor))
    return reports.select("period", F.inline(F.array(*rows)))


def quality_verdict(checks: DataFrame) -> DataFrame:
    """Per period: passed unless a blocking check failed, and the failed warnings."""
    return checks.groupBy("period").agg(
        F.bool_and(F.col("passed") | ~F.col("blocking")).alias("passed"),
        F.count_if(~F.col("passed") & ~F.col("blocking")).alias("warnings"),
    )


def missing_reports(expected: DataFrame, reports: DataFrame) -> DataFrame:
    return expected.select("period").distinct().join(reports.select("period"), "period", "left_anti")


def completeness(expected: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Release verdict over the expected periods; an absent report fails the release."""
    joined = expected.select("period").distinct().join(verdicts, "period", "left")
    return joined.agg(
        F.count("*").alias("expected_periods"),
        F.count_if(F.col("passed").isNull()).alias("missing_reports"),
        F.bool_and(F.coalesce("passed", F.lit(False))).alias("passed"),
    )


def grid_difference(actual: DataFrame, expected: DataFrame, *key: str) -> DataFrame:
    """Keys on one side only, with the side; empty when the two sets are equal."""
    marked = (
        actual.select(*key)
        .distinct()
        .withColumn("_a", F.lit(1))
        .join(expected.select(*key).distinct().withColumn("_e", F.lit(1)), list(key), "full")
    )
    side = F.when(F.col("_e").isNull(), "unexpected").otherwise("missing")
    return marked.filter(F.col("_a").isNull() | F.col("_e").isNull()).select(*key, side.alias("side"))


def forecast_checks(
    forecast: DataFrame, zones: DataFrame, horizon: int, airports: tuple[int, ...]
) -> DataFrame:
    """Eight forecast checks as rows (check, passed)."""
    whole = forecast.withColumn("_all", F.lit(0))
    checks = forecast_checks_by(whole, zones.withColumn("_all", F.lit(0)), horizon, airports, "_all")
    return checks.drop("_all")


def forecast_checks_by(
    forecast: DataFrame, zones: DataFrame, horizon: int, airports: tuple[int, ...], key: str
) -> DataFrame:
    """Eight checks of each forecast that ``key`` tells apart, as rows (key, check, passed).

    ``zones`` holds the zones that each of them must cover. Completeness needs no expected grid: with every pair distinct
    and every zone known, the pair count equals zones times hours exactly when the grid is full. A key of ``zones`` without
    any forecast fails.
    """
    event = (
        F.col("is_event_window") == 1 if "is_event_window" in forecast.columns else F.col("event_code") != 0
    )
    airport = F.col(ZONE).isin(*airports)
    known = zones.filter(F.col(ZONE).isNotNull()).select(key, ZONE).distinct().withColumn("_known", F.lit(True))
    per_pair = (
        forecast.join(known, [key, ZONE], "left")
        .groupBy(key, ZONE, FORECAST_HOUR, "_known")
        .agg(
            F.count("*").alias("rows"),
            F.count_if(F.col(PREDICTED).isNull()).alias("nulls"),
            F.count_if(~F.coalesce(F.col(PREDICTED) >= 0, F.lit(False))).alias("not_positive"),
            F.count_if(airport).alias("airport"),
            F.count_if(airport & ~F.col("model_type").eqNullSafe(F.lit("airport_specialist"))).alias("bad_airport"),
            F.count_if(~airport & event & ~F.col("model_type").eqNullSafe(F.lit("event_specialist"))).alias("bad_event"),
            F.count_if(~airport & ~event & ~F.col("model_type").eqNullSafe(F.lit("global"))).alias("bad_global"),
        )
    )
    names = ("rows", "nulls", "not_positive", "airport", "bad_airport", "bad_event", "bad_global")
    hours = forecast.select(key, FORECAST_HOUR).distinct().groupBy(key).agg(F.count("*").alias("hours"))
    counted = per_pair.groupBy(key).agg(
        *[F.sum(n).alias(n) for n in names],
        F.count("*").alias("pairs"),
        F.count_if(F.col("_known").isNull()).alias("unknown_pairs"),
    )
    expected = known.groupBy(key).agg(F.count("*").alias("zones"))
    sums = expected.join(hours, key, "full").join(counted, key, "left").na.fill(0)
    # Names of the checks.
    checks = {
        "expected_row_count": F.col("rows") == F.col("zones") * horizon,
        "complete_zone_hour_grid": (F.col("hours") == horizon)
        & (F.col("unknown_pairs") == 0)
        & (F.col("pairs") == F.col("zones") * F.col("hours")),
        "unique_zone_hour": F.col("rows") == F.col("pairs"),
        "no_null_predictions": F.col("nulls") == 0,
        "no_negative_predictions": F.col("not_positive") == 0,
        "airport_model_routing": (F.col("airport") > 0) & (F.col("bad_airport") == 0),
        "event_model_routing": F.col("bad_event") == 0,
        "global_model_routing": F.col("bad_global") == 0,
    }
    rows = [F.struct(F.lit(n).alias("check"), F.coalesce(c, F.lit(False)).alias("passed")) for n, c in checks.items()]
    return sums.select(key, F.inline(F.array(*rows)))


# Thresholds of the model release decision.
MIN_FOLDS, MIN_WIN_RATE, MIN_MEDIAN_GAIN = 4, 0.75, 0.05
WORST_LOSS, MIN_AIRPORT_WIN_RATE = -0.02, 2 / 3
MIN_EVENT_FOLDS, MIN_NEW_YEAR_RECALL = 3, 0.80


def fold_improvements(folds: DataFrame) -> DataFrame:
    """One row per fold with its relative WAPE improvements.

    ``folds`` is the long table (test_month, scope, metric, value). A zero baseline gives NULL.
    """

    def value(scope: str, metric: str = "wape") -> Column:
        return F.max(F.when((F.col("scope") == scope) & (F.col("metric") == metric), F.col("value")))

    def gain(base: str, candidate: str) -> Column:
        return errors.relative_improvement(value(base), value(candidate))

    return folds.groupBy("test_month").agg(
        gain("baseline", "candidate").alias("overall"),
        gain("airport_global_model", "airport_specialist").alias("airport"),
        gain("event_previous_year", "event_candidate").alias("event"),
        gain("ordinary_baseline", "ordinary_candidate").alias("ordinary"),
        value("event_candidate").isNotNull().alias("has_event"),
        value("new_year_candidate").isNotNull().alias("has_new_year"),
        (value("new_year_candidate") < value("new_year_previous_week")).alias("new_year_better"),
        (value("new_year_candidate", "high_demand_recall") >= MIN_NEW_YEAR_RECALL).alias("new_year_recall"),
    )


def release_checks(folds: DataFrame) -> DataFrame:
    """Ten release checks as rows (check, passed); an undefined improvement counts against."""
    gains = fold_improvements(folds)

    def win_rate(column: str) -> Column:
        return F.avg(F.coalesce(F.col(column) > 0, F.lit(False)).cast("int"))

    def never_below(column: str, floor: float) -> Column:
        return F.bool_and(F.coalesce(F.col(column) >= floor, F.lit(False)))

    def on_new_year(column: str) -> Column:
        return F.bool_and(F.when(F.col("has_new_year"), F.coalesce(column, F.lit(False))))

    checks = {
        "minimum_four_folds": F.count("*") >= MIN_FOLDS,
        "overall_win_rate_at_least_75pct": win_rate("overall") >= MIN_WIN_RATE,
        "median_wape_improvement_at_least_5pct": F.median("overall") >= MIN_MEDIAN_GAIN,
        "worst_fold_degradation_no_more_than_2pct": never_below("overall", WORST_LOSS),
        "airport_win_rate_at_least_two_thirds": win_rate("airport") >= MIN_AIRPORT_WIN_RATE,
        "at_least_three_major_event_folds": F.count_if("has_event") >= MIN_EVENT_FOLDS,
        "event_median_improves_previous_year": F.median(F.when(F.col("has_event"), F.col("event"))) > 0,
        "ordinary_days_never_degrade_over_2pct": never_below("ordinary", WORST_LOSS),
        "new_year_window_improves_previous_week": on_new_year("new_year_better"),
        "new_year_high_demand_recall_at_least_80pct": on_new_year("new_year_recall"),
    }
    rows = [F.struct(F.lit(n).alias("check"), F.coalesce(c, F.lit(False)).alias("passed")) for n, c in checks.items()]
    return gains.agg(F.array(*rows).alias("checks")).select(F.inline("checks"))


def promotion(checks: DataFrame) -> DataFrame:
    """One row (passed, failed, status, reason): a candidate that fails any check is blocked, one that passes waits for a person.

    No checks at all count as failed. ``failed`` lists the names in order, separated by commas.
    """
    failed = F.array_sort(F.collect_list(F.when(~F.coalesce("passed", F.lit(False)), F.col("check"))))
    decided = checks.agg(F.coalesce(F.bool_and(F.coalesce("passed", F.lit(False))), F.lit(False)).alias("passed"), F.array_join(failed, ",").alias("failed"))
    # Names of the states.
    return decided.withColumns(
        {
            "status": F.when(F.col("passed"), "awaiting_human_approval").otherwise("blocked"),
            "reason": F.when(~F.col("passed"), "release_gate_failed"),
        }
    )


def short_history(demand: DataFrame, origins: DataFrame, hours: int = 168) -> DataFrame:
    """Forecast origins with less than ``hours`` of history before them."""
    first = demand.agg(F.min(HOUR)).scalar()
    return origins.filter(F.col("origin") - F.make_interval(hours=F.lit(hours)) < first)


def training_overlap(folds: DataFrame) -> DataFrame:
    """Folds whose training does not end before the scored month starts."""
    return folds.filter(F.col("train_end") >= clock.trunc("month", "test_start"))


def leaking_rows(features: DataFrame, demand: DataFrame, lag: int, unit: str = "hours") -> DataFrame:
    """Feature rows whose ``lag_n`` differs from the count observed n steps earlier."""
    earlier = demand.select(
        ZONE,
        clock.shift(HOUR, **{unit: lag}).alias(HOUR),
        F.col("trip_count").cast("double").alias("_then"),
    )
    return (
        features.join(earlier, [ZONE, HOUR], "left")
        .filter(F.col(f"lag_{lag}") != F.coalesce("_then", F.lit(0.0)))
        .select(ZONE, HOUR, f"lag_{lag}", "_then")
    )


def days_without_actuals(demand: DataFrame, origins: DataFrame) -> DataFrame:
    """Days of ``origins`` on which nothing was observed in any zone."""
    days = origins.select(F.to_date("origin").alias("day")).distinct()
    return days.join(demand.select(F.to_date(HOUR).alias("day")).distinct(), "day", "left_anti")
