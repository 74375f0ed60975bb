"""Demand regressors: training, specialist routing and test reports."""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.ml import Model
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import (
    DecisionTreeRegressor,
    GBTRegressionModel,
    GBTRegressor,
    GeneralizedLinearRegression,
    LinearRegression,
)
from pyspark.sql import Column, DataFrame, functions as F

from kerbside.functions import errors, rules
from kerbside.operators import scoring, series
from kerbside.operators.series import COUNT, HOUR, ZONE, SeriesShape
from kerbside.session import stored
from kerbside.sources.tables import require_columns

# Adds a non-negative prediction column of the given name to a frame of model features.
Predictor = Callable[[DataFrame, str], DataFrame]

# Learning rate, seed and ridge strength; five levels bound a tree to 32 leaves, each of 20 rows at least.
LEARNING_RATE, TREE_DEPTH, LEAF_ROWS, SEED, RIDGE_ALPHA = 0.08, 5, 20, 42, 10.0
ROUNDS_PER_STORE = 10  # boosting rounds between two writes of the margins
MARGIN_LIMIT = 30.0  # logarithms of counts beyond this only come from rows that no training row resembles


def _assembled(frame: DataFrame, features) -> DataFrame:
    return VectorAssembler(inputCols=list(features), outputCol="features").transform(frame)


@dataclass(frozen=True)
class Fitted:
    """A fitted model over named features. With ``log_link`` the model gives the logarithm of a count less ``offset``."""

    model: Model
    features: tuple[str, ...]
    log_link: bool = False
    offset: float = 0.0

    def __call__(self, frame: DataFrame, output: str) -> DataFrame:
        require_columns(frame, self.features, "model features")
        return self.score(_assembled(frame, self.features), output).drop("features")

    def score(self, assembled: DataFrame, output: str) -> DataFrame:
        """Add the prediction to a frame whose vector of features has been assembled."""
        scored = self.model.transform(assembled, {self.model.predictionCol: "_raw"})
        # The model's column is named once, so that a choice between models evaluates only the chosen one for a row.
        count = F.exp(F.least(F.col("_raw") + self.offset, F.lit(MARGIN_LIMIT))) if self.log_link else F.greatest("_raw", F.lit(0.0))
        return scored.withColumn(output, count).drop("_raw")


def fit_boosted(frame: DataFrame, features: list[str], max_iter: int = 120, weight: str | None = None) -> Fitted:
    """Gradient-boosted trees on squared loss."""
    trees = GBTRegressor(
        featuresCol="features",
        labelCol=COUNT,
        maxIter=max_iter,
        stepSize=LEARNING_RATE,
        maxDepth=TREE_DEPTH,
        seed=SEED,
    )
    if weight:
        trees = trees.setWeightCol(weight)
    columns = ["features", COUNT, *([weight] if weight else [])]
    return Fitted(trees.fit(_assembled(frame, features).select(*columns)), tuple(features))


def fit_poisson(
    frame: DataFrame,
    features: list[str],
    max_iter: int = 120,
    weight: str | None = None,
    depth: int = TREE_DEPTH,
    leaf_rows: int = LEAF_ROWS,
) -> Fitted:
    """Gradient-boosted trees on Poisson deviance.

    A round fits a regression tree to the working response (y - mu) / mu with weights mu: its leaves then are
    sum(y - mu) / sum(mu), the Newton step of the deviance in each leaf. Margins, the logarithms of mu, grow by the learning
    rate times the tree and are written every ROUNDS_PER_STORE rounds, which bounds the lineage. Counts must not be negative.
    """
    own = F.col(weight).cast("double") if weight else F.lit(1.0)
    rows = _assembled(frame, features).select("features", F.col(COUNT).cast("double").alias("y"), own.alias("w"))
    mean = rows.agg(F.try_divide(F.sum(F.col("w") * F.col("y")), F.sum("w"))).first()[0]
    offset = math.log(max(mean or 0.0, 1e-9))
    state, trees = stored(rows.withColumn("margin", F.lit(0.0)), "boosting"), []
    expected = F.exp(F.least(F.col("margin") + offset, F.lit(MARGIN_LIMIT)))
    learner = DecisionTreeRegressor(
        featuresCol="features", labelCol="response", weightCol="curvature", predictionCol="step",
        maxDepth=depth, minInstancesPerNode=leaf_rows, seed=SEED,
    )
    for done in range(1, max_iter + 1):
        work = state.withColumn("mu", expected)
        work = work.select("features", ((F.col("y") - F.col("mu")) / F.col("mu")).alias("response"), (F.col("w") * F.col("mu")).alias("curvature"))
        tree = learner.fit(work)
        trees.append(tree)
        state = tree.transform(state).select("features", "y", "w", (F.col("margin") + LEARNING_RATE * F.col("step")).alias("margin"))
        if done % ROUNDS_PER_STORE == 0 and done < max_iter:
            state = stored(state, "boosting")
    return Fitted(_ensemble(frame, trees), tuple(features), log_link=True, offset=offset)


def _ensemble(frame: DataFrame, trees: list) -> GBTRegressionModel:
    """The trees, times the learning rate, as one model that can be stored."""
    gateway, jvm = frame.sparkSession.sparkContext._gateway, frame.sparkSession._jvm
    kind = jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel
    all_trees, weights = gateway.new_array(kind, len(trees)), gateway.new_array(jvm.double, len(trees))
    for i, tree in enumerate(trees):
        all_trees[i], weights[i] = tree._java_obj, LEARNING_RATE
    uid = jvm.org.apache.spark.ml.util.Identifiable.randomUID("poisson")
    return GBTRegressionModel(jvm.org.apache.spark.ml.regression.GBTRegressionModel(uid, all_trees, weights))


def fit_poisson_linear(frame: DataFrame, features: list[str], penalty: float = 0.01) -> Fitted:
    """A linear model of the logarithm of counts, fitted on Poisson deviance with an L2 penalty on unscaled coefficients."""
    linear = GeneralizedLinearRegression(
        family="poisson", link="log", featuresCol="features", labelCol=COUNT, regParam=penalty, maxIter=50
    )
    return Fitted(linear.fit(_assembled(frame, features).select("features", F.col(COUNT).cast("double").alias(COUNT))), tuple(features))


def fit_ridge(frame: DataFrame, features: list[str], alpha: float = RIDGE_ALPHA) -> Fitted:
    """Least squares with an unscaled L2 penalty of ``alpha`` on the sum of squares."""
    rows = frame.count()
    ridge = LinearRegression(
        featuresCol="features",
        labelCol=COUNT,
        regParam=alpha / max(rows, 1),
        elasticNetParam=0.0,
        standardization=False,
        solver="normal",
    )
    return Fitted(ridge.fit(_assembled(frame, features).select("features", COUNT)), tuple(features))


@dataclass(frozen=True)
class RoutedModel:
    """A global model with airport and optional event specialists.

    ``trained`` holds the first and last time of the training rows, as text.
    """

    overall: Predictor
    airport: Predictor
    event: Predictor | None = None
    airports: tuple[int, ...] = rules.AIRPORT_ZONE_IDS
    trained: tuple[str, str] | None = None

    def by_route(self) -> dict[str, Predictor]:
        models = {"global": self.overall, "airport_specialist": self.airport}
        return models | ({"event_specialist": self.event} if self.event else {})

    def route(self) -> Column:
        window = F.col("is_event_window") if self.event else F.lit(0)
        return rules.model_route(F.col(ZONE), window, self.airports)

    def predict(self, frame: DataFrame, output: str = "prediction") -> DataFrame:
        """Add ``output`` and ``model_type``.

        Features are assembled once and every model's column is used in one branch of one choice only. The optimizer moves
        it there, so a row is scored by the model of its route and by no other, without a pass over the rows for each route.
        """
        models = self.by_route()
        frame, chosen = frame.withColumn("model_type", self.route()), F
        shared = {m.features if isinstance(m, Fitted) else None for m in models.values()}
        together = len(shared) == 1 and None not in shared
        if together:
            frame = _assembled(require_columns(frame, *shared, "model features"), *shared)
        for kind, predictor in models.items():
            frame = predictor.score(frame, f"_{kind}") if together else predictor(frame, f"_{kind}")
        for kind in models:
            chosen = chosen.when(F.col("model_type") == kind, F.col(f"_{kind}"))
        frame = frame.withColumn(output, chosen.otherwise(F.lit(None)))
        frame = frame.withColumn(output, errors.clip(F.col(output)))
        return frame.drop(*[f"_{kind}" for kind in models], *(["features"] if together else []))


def event_training(frame: DataFrame, threshold: float, airports: tuple[int, ...]) -> DataFrame:
    """Non-airport event hours, weighted up in the New-Year window and at high demand."""
    weight = 1.0 + 2.0 * F.col("is_new_year_window") + (F.col(COUNT) >= threshold).cast("double")
    return frame.filter((F.col("is_event_window") == 1) & ~F.col(ZONE).isin(*airports)).withColumn(
        "event_weight", weight
    )


def quantile_of(frame: DataFrame) -> float:
    """The high-demand threshold of a training set, as a number."""
    return frame.agg(F.percentile(COUNT, F.lit(scoring.HIGH_DEMAND_QUANTILE))).first()[0]


def fit_routed(frame: DataFrame, shape: SeriesShape, max_iter: int = 60, fit: Callable[..., Fitted] = fit_boosted) -> RoutedModel:
    """Fit the three models on one training set by ``fit``; each fit filters the same stored table."""
    features = shape.feature_columns
    events = event_training(frame, quantile_of(frame), shape.airports)
    event = None
    if not events.isEmpty():
        event = fit(events, features, max_iter, "event_weight")
    first, last = frame.agg(F.min(HOUR).cast("string"), F.max(HOUR).cast("string")).first()
    return RoutedModel(
        overall=fit(frame, features, max_iter),
        airport=fit(frame.filter(F.col(ZONE).isin(*shape.airports)), features, max_iter),
        event=event,
        airports=shape.airports,
        trained=(first, last),
    )


@dataclass(frozen=True)
class ForecastReport:
    metrics: DataFrame
    segments: DataFrame
    predictions: DataFrame
    months: tuple[str, str, str]
    model: Fitted


def train_forecast(
    demand: DataFrame,
    weather: DataFrame | None = None,
    shape: SeriesShape = series.HOURLY,
    max_iter: int = 120,
) -> ForecastReport:
    """Validate boosted trees on Poisson and on squared loss, a Poisson linear model and ridge; refit the first on train and
    validation and report on the test month.

    ``metrics`` is long: (stage, scope, metric, value), with the lag baselines beside the model.
    """
    table = stored(series.feature_table(demand, weather, shape), "features")
    split = series.time_split(table)
    threshold = F.lit(quantile_of(split.train))
    features = shape.feature_columns

    candidates = {
        "boosted": fit_poisson(split.train, features, max_iter),
        "boosted_squared": fit_boosted(split.train, features, max_iter),
        "poisson_linear": fit_poisson_linear(split.train, features),
        "ridge": fit_ridge(split.train, features),
    }
    validated = split.validation
    for name, predictor in candidates.items():
        validated = predictor(validated, name)
    validation = scoring.metric_rows(validated, COUNT, {n: n for n in candidates}, threshold)

    final = fit_poisson(split.train.unionByName(split.validation), features, max_iter)
    predicted = stored(final(split.test, "prediction"), "test-predictions")
    scopes = {f"previous_{lag}": f"lag_{lag}" for lag in shape.lags[1:]}
    scopes = {f"previous_{shape.lags[0]}": f"lag_{shape.lags[0]}", **scopes, "boosted": "prediction"}
    test = scoring.metric_rows(predicted, COUNT, scopes, threshold)
    metrics = validation.withColumn("stage", F.lit("validation")).unionByName(
        test.withColumn("stage", F.lit("test"))
    )
    return ForecastReport(
        metrics=metrics,
        segments=scoring.test_segments(predicted),
        predictions=predicted.select(ZONE, HOUR, COUNT, "prediction"),
        months=split.months,
        model=final,
    )
