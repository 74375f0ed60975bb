"""Models, recursion, clusters and the streaming job."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from kerbside.catalog.demand import BACKTEST_RELEASE, DAILY
from kerbside.catalog.records import featured
from kerbside.catalog.registry import query
from kerbside.catalog.support import rounded, written
from kerbside.catalog.tables import Tables, with_views
from kerbside.operators import drivers, gates, series
from kerbside.operators.series import COUNT, HOUR, ZONE
from kerbside.plans import backtest, demand_models, driver_clusters, model_store, money_models, recursion
from kerbside.session import scratch_path, stored
from kerbside.streaming import hourly

# Boosting rounds of the registered model queries; the plans default to 120 and 60. The backtest fits three models for
# every month that it tests.
ROUNDS, BACKTEST_ROUNDS = 20, 5


@query("train_forecast")
def train_forecast(t: Tables) -> DataFrame:
    report = demand_models.train_forecast(t.daily, None, DAILY, ROUNDS)
    return rounded(report.metrics.select("stage", "scope", "metric", "value"))


@query("rolling_backtest")
def rolling_backtest(t: Tables) -> DataFrame:
    return rounded(backtest.rolling_backtest(t.daily, "2001-01", "2001-04", DAILY, BACKTEST_ROUNDS))


def lag_models(train: DataFrame, shape: series.SeriesShape, max_iter: int) -> demand_models.RoutedModel:
    """Predictors of closed form in place of fitted ones: the step before, and the same step a week before at airports."""
    before = lambda n: lambda frame, output: frame.withColumn(output, F.col(f"lag_{n}"))
    return demand_models.RoutedModel(before(1), before(shape.week), None, shape.airports)


@query(
    "rolling_backtest_lags",
    with_views(
        """, lagged AS (
          SELECT pickup_zone_id AS z, pickup_hour AS h, trip_count AS y, strftime(pickup_hour, '%Y-%m') AS test_month,
            lag(trip_count, 28) OVER w AS far, lag(trip_count, 7) OVER w AS week, lag(trip_count) OVER w AS last
          FROM day_grid WINDOW w AS (PARTITION BY pickup_zone_id ORDER BY pickup_hour)),
        months AS (
          SELECT a.test_month, quantile_cont(b.y, 0.9) AS high
          FROM (SELECT DISTINCT test_month FROM lagged WHERE far IS NOT NULL) a JOIN lagged b
            ON b.far IS NOT NULL AND b.test_month < a.test_month GROUP BY 1),
        scopes AS (
          SELECT test_month, 'baseline' AS scope, y, week AS p, high FROM lagged JOIN months USING (test_month) WHERE far IS NOT NULL
          UNION ALL SELECT test_month, 'candidate', y, CASE WHEN z IN (132, 138) THEN week ELSE last END, high
          FROM lagged JOIN months USING (test_month) WHERE far IS NOT NULL
          UNION ALL SELECT test_month, 'airport_specialist', y, week, high FROM lagged JOIN months USING (test_month)
          WHERE far IS NOT NULL AND z IN (132, 138)
          UNION ALL SELECT test_month, 'airport_global_model', y, last, high FROM lagged JOIN months USING (test_month)
          WHERE far IS NOT NULL AND z IN (132, 138)),
        wide AS (
          SELECT test_month, scope, count(*) AS rows, avg(abs(y - p)) AS mae, sqrt(avg((y - p) * (y - p))) AS rmse,
            sum(abs(y - p)) / greatest(sum(y), 1) AS wape,
            count(*) FILTER (WHERE y >= high AND p >= high)::DOUBLE / greatest(count(*) FILTER (WHERE p >= high), 1) AS high_demand_precision,
            count(*) FILTER (WHERE y >= high AND p >= high)::DOUBLE / greatest(count(*) FILTER (WHERE y >= high), 1) AS high_demand_recall
          FROM scopes GROUP BY 1, 2)
        SELECT test_month, scope, rows, metric, round(value, 6) AS value
        FROM wide UNPIVOT (value FOR metric IN (mae, rmse, wape, high_demand_precision, high_demand_recall))""",
        "day_grid",
    ),
)
def rolling_backtest_lags(t: Tables) -> DataFrame:
    """Every month that can be tested, with predictors of closed form; the four scopes without calendar events."""
    return rounded(_lag_folds(t).filter(F.col("scope").isin("baseline", "candidate", "airport_specialist", "airport_global_model")))


def _lag_folds(t: Tables) -> DataFrame:
    if "lag-folds" not in t.kept:
        t.kept["lag-folds"] = stored(backtest.rolling_backtest(t.daily, "1900-01", None, DAILY, fit=lag_models), "lag-folds")
    return t.kept["lag-folds"]


@query("backtest_release", BACKTEST_RELEASE)
def backtest_release(t: Tables) -> DataFrame:
    """The release decision on the backtest's own folds, over every month that can be tested."""
    return gates.promotion(gates.release_checks(_lag_folds(t)))


@query("final_candidate")
def final_candidate(t: Tables) -> DataFrame:
    """In-sample error and rows per route of the refitted models, as they are after being stored and read again."""
    features = stored(series.feature_table(t.daily, None, DAILY), "features")
    path = scratch_path(t.spark, "candidate")
    digest = model_store.save_model(t.spark, demand_models.fit_routed(features, DAILY, ROUNDS), path)
    fitted = model_store.load_model(t.spark, path, digest).predict(features)
    return rounded(
        fitted.groupBy("model_type").agg(
            F.count("*").alias("rows"), F.avg(F.abs(F.col(COUNT) - F.col("prediction"))).alias("mae")
        )
    )


@query(
    "boosting_round",
    with_views(
        """, rows AS (
          SELECT CAST(pickup_zone_id AS DOUBLE) AS zone, CAST(isodow(pickup_hour) - 1 AS DOUBLE) AS weekday,
            CAST(month(pickup_hour) AS DOUBLE) AS month, CAST(trip_count AS DOUBLE) AS y FROM daily),
        mean AS (SELECT avg(y) AS mu FROM rows),
        stacked AS (UNPIVOT rows ON zone, weekday, month INTO NAME feature VALUE v),
        cells AS (SELECT feature, v, count(*) AS n, sum(y) AS s FROM stacked GROUP BY 1, 2),
        cuts AS (
          SELECT feature, v, sum(n) OVER upto AS n1, sum(s) OVER upto AS s1,
            sum(n) OVER (PARTITION BY feature) AS n, sum(s) OVER (PARTITION BY feature) AS s
          FROM cells WINDOW upto AS (PARTITION BY feature ORDER BY v)),
        best AS (
          SELECT feature, v, mu, n1, s1, n - n1 AS n2, s - s1 AS s2 FROM cuts, mean WHERE n1 >= 20 AND n - n1 >= 20
          ORDER BY (s1 - mu * n1) ^ 2 / (mu * n1) + (s - s1 - mu * (n - n1)) ^ 2 / (mu * (n - n1)) DESC LIMIT 1)
        SELECT CAST(n1 AS BIGINT) AS rows, CAST(s1 AS BIGINT) AS trips, round(mu * exp(0.08 * (s1 - mu * n1) / (mu * n1)), 6) AS prediction
        FROM best UNION ALL
        SELECT CAST(n2 AS BIGINT), CAST(s2 AS BIGINT), round(mu * exp(0.08 * (s2 - mu * n2) / (mu * n2)), 6) FROM best""",
        "daily",
    ),
)
def boosting_round(t: Tables) -> DataFrame:
    """One round of Poisson boosting with one split, and the two counts that it predicts."""
    at = F.col(HOUR)
    frame = t.daily.select(
        F.col(ZONE).cast("double").alias("zone"), F.weekday(at).alias("weekday"), F.month(at).alias("month"), F.col(COUNT)
    )
    fitted = demand_models.fit_poisson(frame, ["zone", "weekday", "month"], max_iter=1, depth=1)
    return fitted(frame, "prediction").groupBy(F.round("prediction", 6).alias("prediction")).agg(
        F.count("*").alias("rows"), F.sum(COUNT).alias("trips")
    )


def _candidate_before_shadow(t: Tables) -> demand_models.RoutedModel:
    early = t.daily.filter(F.col(HOUR) < F.to_timestamp_ntz(F.lit("2001-01-01 00:00:00")))
    return backtest.final_candidate(early, DAILY, ROUNDS)


@query("recursive_forecast")
def recursive_forecast(t: Tables) -> DataFrame:
    model = backtest.final_candidate(t.daily, DAILY, ROUNDS)  # refitted on all data, as the forecast starts after them
    forecast = recursion.publishable_forecast(t.daily, model, 24, DAILY)
    return rounded(forecast.drop("forecast_generated_at"))


# Shapes, horizons and predictors of the recursions that SQL can repeat: all zones, and airports.
_LINEAR = {
    "daily": (14, "0.5 * lag_1 + 0.3 * lag_7 + 0.2 * rolling_mean_3", "lag_7 + 0.5"),
    "hourly": (24, "0.5 * lag_24 + 0.3 * lag_168 + 0.2 * rolling_mean_3", "lag_24 + 0.5"),
}


def _walk(scope: str, steps: int, weekly: int, far: int, near: int) -> str:
    """The recursion of a scope: ``h`` holds the last ``steps`` values; lags count from its end."""
    lag = lambda n: f"h[{steps - n + 1}]"
    return f"""{scope}_walk AS (
      SELECT z, 0 AS step, h, CAST(NULL AS DOUBLE) AS p FROM {scope}_past
      UNION ALL SELECT z, step + 1, list_append(h[2:], p), p FROM (
        SELECT z, step, h, CASE WHEN z IN (132, 138) THEN {lag(weekly)} + 0.5e0
          ELSE 0.5e0 * {lag(near)} + 0.3e0 * {lag(far)} + 0.2e0 * ({lag(1)} + {lag(2)} + {lag(3)}) / 3 END AS p
        FROM {scope}_walk WHERE step < {_LINEAR[scope][0]}))"""


@query(
    "recursive_linear",
    with_views(
        f""", hours AS (
          SELECT unnest(generate_series(max(pickup_hour) - INTERVAL 167 HOUR, max(pickup_hour), INTERVAL 1 HOUR)) AS hr FROM demand),
        hourly_past AS (
          SELECT z, list(CAST(coalesce(trip_count, 0) AS DOUBLE) ORDER BY hr) AS h
          FROM (SELECT DISTINCT pickup_zone_id AS z FROM demand) CROSS JOIN hours
            LEFT JOIN demand ON pickup_zone_id = z AND pickup_hour = hr GROUP BY 1),
        daily_past AS (
          SELECT pickup_zone_id AS z, list(trip_count ORDER BY pickup_hour) AS h FROM day_grid
          WHERE pickup_hour > (SELECT max(pickup_hour) FROM day_grid) - INTERVAL 28 DAY GROUP BY 1),
        {_walk("daily", 28, 7, 7, 1)}, {_walk("hourly", 168, 24, 168, 24)}
        SELECT 'daily' AS scope, z AS pickup_zone_id, (SELECT max(pickup_hour) FROM day_grid) + to_days(step) AS forecast_hour,
          round(p, 6) AS predicted_trip_count, CASE WHEN z IN (132, 138) THEN 'airport_specialist' ELSE 'global' END AS model_type
        FROM daily_walk WHERE step > 0 UNION ALL
        SELECT 'hourly', z, (SELECT max(pickup_hour) FROM demand) + to_hours(step), round(p, 6),
          CASE WHEN z IN (132, 138) THEN 'airport_specialist' ELSE 'global' END
        FROM hourly_walk WHERE step > 0""",
        "day_grid",
        "demand",
    ).replace("WITH ", "WITH RECURSIVE ", 1),
)
def recursive_linear(t: Tables) -> DataFrame:
    """Daily and hourly recursion with linear predictors, from the last observation on."""
    parts = []
    for scope, demand, shape in (("daily", t.daily, DAILY), ("hourly", t.demand, series.HOURLY)):
        horizon, everywhere, airport = _LINEAR[scope]
        linear = lambda text: lambda frame, output: frame.withColumn(output, F.expr(text))
        model = demand_models.RoutedModel(linear(everywhere), linear(airport), None, shape.airports)
        found = recursion.recursive_forecast(demand, model, recursion.next_origin(demand, shape), horizon, shape)
        parts.append(found.select(F.lit(scope).alias("scope"), ZONE, "forecast_hour", "predicted_trip_count", "model_type"))
    return rounded(parts[0].unionByName(parts[1]))


@query("recursive_shadow")
def recursive_shadow(t: Tables) -> DataFrame:
    result = recursion.shadow_evaluation(t.daily, _candidate_before_shadow(t), "2001-02-01", "2001-02-28", DAILY)
    return rounded(result["daily"].withColumn("day", F.col("day").cast("string")))


@query("kmeans_elbow")
def kmeans_elbow(t: Tables) -> DataFrame:
    return rounded(driver_clusters.elbow(drivers.income_and_hours(featured(t)), restarts=10), 3)


@query("kmeans_profile")
def kmeans_profile(t: Tables) -> DataFrame:
    return rounded(driver_clusters.cluster_profile(drivers.income_and_hours(featured(t)), restarts=10), 3)


def _money(t: Tables, target: str) -> money_models.MoneyModels:
    trips = t.legacy.na.fill({"surcharge": 0.0})
    return money_models.MoneyModels(trips, target, "trip_id")


@query("fare_models")
def fare_models(t: Tables) -> DataFrame:
    return rounded(_money(t, "fare_amount").fit().comparison(), 4)


@query("tip_models")
def tip_models(t: Tables) -> DataFrame:
    return rounded(_money(t, "tip_amount").fit().comparison(), 4)


@query("model_comparison")
def model_comparison(t: Tables) -> DataFrame:
    """Models of both targets ranked by test RMSE."""
    parts = [
        _money(t, target).fit().comparison().withColumn("target", F.lit(target))
        for target in ("fare_amount", "tip_amount")
    ]
    return rounded(parts[0].unionByName(parts[1]), 4).orderBy("target", "rmse")


@query("feature_importance")
def feature_importance(t: Tables) -> DataFrame:
    return rounded(_money(t, "fare_amount").fit("random_forest").importance(), 4)


@query(
    "money_models_closed_form",
    with_views(
        """, measured AS (
          SELECT CAST(trip_distance AS DOUBLE) AS x, unnest([fare_amount, tip_amount]) AS y, unnest(['fare_amount', 'tip_amount']) AS target,
            CAST(('0x' || substr(md5(CAST(trip_id AS VARCHAR)), 1, 7)) AS BIGINT) % 100 < 70 AS train FROM legacy),
        usable AS (SELECT * FROM measured WHERE x IS NOT NULL AND y IS NOT NULL),
        moments AS (
          SELECT target, avg(x) AS mx, avg(y) AS my, var_pop(x) AS vx, covar_pop(y, x) AS c, count(*) AS n FROM usable WHERE train GROUP BY 1),
        lines AS (
          SELECT target, mx, my, 'baseline' AS model, 0 AS slope FROM moments
          UNION ALL SELECT target, mx, my, 'linear_regression', c / vx FROM moments
          UNION ALL SELECT target, mx, my, 'lasso', sign(c) * greatest(abs(c) - 0.1e0, 0) / vx FROM moments
          UNION ALL SELECT target, mx, my, 'ridge', c / (vx + 0.1e0 / n) FROM moments)
        SELECT target, model, round(sqrt(avg((y - my - slope * (x - mx)) ^ 2)), 4) AS rmse
        FROM usable JOIN lines USING (target) WHERE NOT train GROUP BY 1, 2""",
        "legacy",
    ),
)
def money_models_closed_form(t: Tables) -> DataFrame:
    """Test error of the linear fare and tip models on distance alone, where their normal equations can be written down."""
    parts = []
    for target in ("fare_amount", "tip_amount"):
        fitted = money_models.MoneyModels(t.legacy, target, "trip_id", trees=1, depth=1, only=["trip_distance"]).fit()
        parts.append(fitted.comparison().filter("model <> 'random_forest'").withColumn("target", F.lit(target)))
    return rounded(parts[0].unionByName(parts[1]), 4)


@query("forest_grid_search")
def forest_grid_search(t: Tables) -> DataFrame:
    """All 90 points of the grid, with 5 folds."""
    return rounded(_money(t, "fare_amount").grid_search(), 4)


@query(
    "stream_hourly_demand",
    with_views(
        """SELECT * FROM gold WHERE pickup_hour + INTERVAL 1 HOUR <= (SELECT max(pickup_hour) FROM gold) - INTERVAL 2 HOUR""",
        "gold",
    ),
)
def stream_hourly_demand(t: Tables) -> DataFrame:
    """Governed demand of all closed hours, streamed a file at a time in whatever order the files have."""
    files = written(t.trips.repartition(4), "arriving")
    output, checkpoint = scratch_path(t.spark, "stream-out"), scratch_path(t.spark, "stream-state")
    trips = hourly.read_stream(t.spark, files, t.trips.schema, files_per_batch=1)
    hourly.run_available(trips, t.zones, output, checkpoint)
    return hourly.demand_so_far(t.spark, output, "2 HOUR")


@query("stream_snapshots", with_views("SELECT * FROM gold", "gold"))
def stream_snapshots(t: Tables) -> DataFrame:
    """All governed demand of a stream that has folded its batches twice on the way."""
    files = written(t.trips.repartition(6), "arriving")
    output, checkpoint = scratch_path(t.spark, "stream-out"), scratch_path(t.spark, "stream-state")
    trips = hourly.read_stream(t.spark, files, t.trips.schema, files_per_batch=1)
    hourly.run_available(trips, t.zones, output, checkpoint, batches_per_snapshot=2)
    return hourly.demand_so_far(t.spark, output)
