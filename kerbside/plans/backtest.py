"""Expanding-window backtest of the routed model."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession, functions as F

from kerbside.functions import clock, errors
from kerbside.operators import gates, scoring, series
from kerbside.operators.series import COUNT, HOUR, ZONE, SeriesShape
from kerbside.plans import model_store
from kerbside.plans.demand_models import RoutedModel, fit_routed, quantile_of
from kerbside.session import scratch_path, stored

PASSTHROUGH = ("is_event_window", "is_new_year_window")
FOLDS_AT_ONCE = 4

# Fits the three models on the rows before a fold's month.
Fit = Callable[[DataFrame, SeriesShape, int], RoutedModel]


def test_months(features: DataFrame, first_test: str, last_test: str | None = None) -> list[str]:
    """Calendar months to test, earliest first; one row per month reaches the driver."""
    period = clock.month_label(HOUR).alias("period")
    months = features.select(period).distinct().filter(F.col("period") >= first_test)
    if last_test:
        months = months.filter(F.col("period") <= last_test)
    return [row.period for row in months.orderBy("period").toLocalIterator()]


def fold_predictions(
    features: DataFrame, month: str, shape: SeriesShape, max_iter: int, fit: Fit = fit_routed
) -> DataFrame | None:
    """Test-month rows with global and routed predictions; the fit sees only earlier months."""
    start = F.to_timestamp_ntz(F.lit(f"{month}-01 00:00:00"))
    train = features.filter(F.col(HOUR) < start)
    test = features.filter((F.col(HOUR) >= start) & (F.col(HOUR) < start + F.expr("INTERVAL 1 MONTH")))
    if train.isEmpty() or test.isEmpty():
        return None
    model = fit(train, shape, max_iter)
    baseline = f"lag_{shape.week}"
    return (
        model.predict(model.overall(test, "global_prediction"), "candidate_prediction")
        .withColumns(
            {
                "test_month": F.lit(month),
                "_threshold": F.lit(quantile_of(train)),
                "is_airport": F.col(ZONE).isin(*shape.airports),
                "baseline_prediction": F.col(baseline),
            }
        )
        .select(
            "test_month",
            ZONE,
            HOUR,
            COUNT,
            "_threshold",
            "is_airport",
            *PASSTHROUGH,
            "baseline_prediction",
            "global_prediction",
            "candidate_prediction",
        )
    )


def fold_metrics(predictions: DataFrame, history: DataFrame) -> DataFrame:
    """Long table (test_month, scope, metric, value) of all folds from one aggregation.

    A scope without rows in a fold is absent.
    """
    rows = scoring.join_previous_year(predictions, history)
    event, new_year = F.col("is_event_window") == 1, F.col("is_new_year_window") == 1
    everything, airport = F.lit(True), F.col("is_airport")
    # Names of the scopes.
    scopes = {
        "baseline": (everything, "baseline_prediction"),
        "candidate": (everything, "candidate_prediction"),
        "ordinary_baseline": (~event, "baseline_prediction"),
        "ordinary_candidate": (~event, "candidate_prediction"),
        "airport_global_model": (airport, "global_prediction"),
        "airport_specialist": (airport, "candidate_prediction"),
        "event_previous_week": (event, "baseline_prediction"),
        "event_previous_year": (event, "previous_year"),
        "event_candidate": (event, "candidate_prediction"),
        "new_year_previous_week": (new_year, "baseline_prediction"),
        "new_year_previous_year": (new_year, "previous_year"),
        "new_year_candidate": (new_year, "candidate_prediction"),
    }
    entries = []
    for name, (mask, column) in scopes.items():
        truth, guess = F.when(mask, F.col(COUNT)), F.when(mask, F.col(column))
        measured = errors.measures(truth, guess, F.col("_threshold"))
        values = [
            F.struct(F.lit(metric).alias("metric"), value.cast("double").alias("value"))
            for metric, value in measured.items()
        ]
        entries.append(
            F.struct(
                F.lit(name).alias("scope"), F.count_if(mask).alias("rows"), F.array(*values).alias("metrics")
            )
        )
    return (
        rows.groupBy("test_month")
        .agg(F.array(*entries).alias("scopes"))
        .select("test_month", F.inline("scopes"))
        .filter("rows > 0")
        .select("test_month", "scope", "rows", F.inline("metrics"))
    )


def finished_folds(spark: SparkSession, folder: str) -> set[str]:
    """Months whose fold has been written whole: a job marks its folder when all its files are there."""
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/fold=*/_SUCCESS")
    found = pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern) or []
    return {status.getPath().getParent().getName().removeprefix("fold=") for status in found}


def rolling_backtest(
    demand: DataFrame,
    first_test: str,
    last_test: str | None = None,
    shape: SeriesShape = series.HOURLY,
    max_iter: int = 60,
    fit: Fit = fit_routed,
    folder: str | None = None,
) -> DataFrame:
    """Fold metrics for every test month.

    Features are written once. Folds are fitted FOLDS_AT_ONCE at a time, each by distributed jobs, and each writes its
    predictions to ``folder`` (a scratch one unless given); a run that broke off goes on with the folds that aren't there,
    for the same demand and settings.
    """
    spark = demand.sparkSession
    features = stored(series.feature_table(demand, None, shape), "backtest-features")
    folder = folder or scratch_path(spark, "folds")
    done = finished_folds(spark, folder)

    def run(month: str) -> None:
        fold = fold_predictions(features, month, shape, max_iter, fit)
        if fold is not None:
            fold.write.mode("overwrite").parquet(f"{folder}/fold={month}")

    pending = [month for month in test_months(features, first_test, last_test) if month not in done]
    with ThreadPoolExecutor(FOLDS_AT_ONCE) as pool:
        list(pool.map(run, pending))
    if not finished_folds(spark, folder):
        raise ValueError("No month has rows to learn from and rows to test")
    return fold_metrics(spark.read.parquet(f"{folder}/fold=*"), features.select(ZONE, HOUR, COUNT))


def final_candidate(demand: DataFrame, shape: SeriesShape = series.HOURLY, max_iter: int = 60) -> RoutedModel:
    """The three models refitted on all data."""
    return fit_routed(stored(series.feature_table(demand, None, shape), "final-features"), shape, max_iter)


def release_candidate(
    demand: DataFrame,
    path: str,
    first_test: str,
    last_test: str | None = None,
    shape: SeriesShape = series.HOURLY,
    max_iter: int = 60,
    folder: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Backtest, decide on its folds, refit on all data and store the model with the decision.

    Returns the fold metrics and one row (passed, failed, status, reason, sha256). The decision is part of the stored
    description, so a reader of the model sees whether its kind passed; the digest is that of the model to approve and
    NULL for a blocked one.
    """
    spark = demand.sparkSession
    folds = stored(rolling_backtest(demand, first_test, last_test, shape, max_iter, folder=folder), "fold-metrics")
    decision = gates.promotion(gates.release_checks(folds)).first()
    fitted = final_candidate(demand, shape, max_iter)
    digest = model_store.save_model(spark, fitted, path, release_gate={"passed": decision.passed, "failed": decision.failed})
    row = (*decision, digest if decision.passed else None)
    return folds, spark.createDataFrame([row], "passed boolean, failed string, status string, reason string, sha256 string")
