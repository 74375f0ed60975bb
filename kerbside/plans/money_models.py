"""Fare and tip regressors on cleaned historical trips."""

from __future__ import annotations

import itertools
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pandas as pd
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import DecisionTreeRegressor, LinearRegression, RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession, functions as F

from kerbside.functions import rules
from kerbside.operators import legacy, profile, sampling
from kerbside.session import scratch_path, stored

# Levels of the encoded categories, penalty of the linear models.
WEEKDAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
BOROUGHS = [*rules.BOROUGH_BOXES, "others"]
PENALTY = 0.1
SEED = 0
GUIDE_DEPTH = 6  # of the tree by whose leaves rows are laid out
# A method beyond 8000 bytes of bytecode is interpreted, never compiled: such a stage is generated in smaller ones instead.
SMALL_METHODS = {"spark.sql.codegen.hugeMethodLimit": "8000"}

# The whole grid of a forest's parameters.
GRID = {
    "featureSubsetStrategy": ["20", "25", "all"],
    "numTrees": [10, 20, 30, 40, 50],
    "maxDepth": [5, 6, 7, 8, 9, 10],
}

# Forests of the grid fitted at once, while their training rows together are no more than these: a fit keeps its rows in memory.
FORESTS_AT_ONCE, ROWS_AT_ONCE = 4, 2_000_000

NUMERIC = [
    "passenger_count",
    "trip_time_in_secs",
    "trip_distance",
    "pickup_longitude",
    "pickup_latitude",
    "dropoff_longitude",
    "dropoff_latitude",
    "mta_tax",
    "tolls_amount",
    "pickup_day",
    "pickup_hour",
]
FLAGS = [f"is_{end}_{name}" for name in rules.AIRPORT_BOXES for end in rules.ENDS]
ENCODED = {"pickup_day_of_week": WEEKDAYS, "pickup_borough": BOROUGHS, "dropoff_borough": BOROUGHS}


def model_table(trips: DataFrame, target: str, key: str, only: list[str] | None = None) -> tuple[DataFrame, list[str]]:
    """Numeric feature columns for one target; the tip model also sees fare and surcharge.

    ``only`` names the features to keep. Rows that miss one of the features or the target are dropped.
    """
    extra = ["fare_amount", "surcharge"] if target == "tip_amount" else []
    known = legacy.add_trip_features(trips).withColumn("label", F.col(target).cast("double"))
    # Only these can be missing. Dropped before the 0/1 columns are made: a condition on those repeats their rules for each, too
    # much code to be compiled.
    known = known.na.drop(subset=[key, "label", *[c for c in (*NUMERIC, *extra) if c in (only or known.columns)]])
    enriched = legacy.with_airport_flags(legacy.with_boroughs(known))
    features = [*NUMERIC, *extra, *FLAGS]
    table = enriched.select(key, "label", *features, *ENCODED)
    for column, levels in ENCODED.items():
        table = profile.one_hot(table, column, levels)
        features += [f"{column}_{level}" for level in levels]
    features = only or features
    return table.select(key, "label", *features), features


def mean_baseline_rmse(train: DataFrame, test: DataFrame, label: str = "label") -> DataFrame:
    mean = train.agg(F.avg(label)).scalar()
    return test.agg(F.sqrt(F.avg((F.col(label) - mean) * (F.col(label) - mean))).alias("rmse"))


def regressors(rows: int, trees: int, depth: int) -> dict:
    """Ordinary, lasso and ridge least squares and a random forest."""
    linear = {"standardization": False}
    return {
        "linear_regression": LinearRegression(**linear),
        "lasso": LinearRegression(regParam=PENALTY, elasticNetParam=1.0, **linear),
        "ridge": LinearRegression(regParam=PENALTY / max(rows, 1), elasticNetParam=0.0, **linear),
        "random_forest": RandomForestRegressor(
            numTrees=trees, maxDepth=depth, featureSubsetStrategy="all", seed=SEED
        ),
    }


def cut_predictions(spark: SparkSession, model: RandomForestRegressionModel, depths: list[int]) -> np.ndarray:
    """By tree, leaf and depth: what a row in the leaf is predicted if the tree ends at the depth.

    Taken from the nodes of the stored model. A node is numbered before its left side, and that before its right side; leaves are
    counted in this order. Their number follows the model's parameters, not the rows.
    """
    path = scratch_path(spark, "forest")
    model.write().save(path)
    nodes = spark.read.parquet(f"{path}/data").select("treeID", *[f"nodeData.{c}" for c in ("id", "prediction", "leftChild", "rightChild")])
    paths, leaves = {}, [[] for _ in range(model.getNumTrees)]
    ordered = nodes.toArrow().sort_by([("treeID", "ascending"), ("id", "ascending")])
    for tree, at, prediction, left, right in zip(*[column.to_pylist() for column in ordered.columns]):
        way = [*paths.pop((tree, at), ()), prediction]  # predictions from the root on
        if left < 0:
            leaves[tree].append([way[min(depth, len(way) - 1)] for depth in depths])
        else:
            paths[tree, left] = paths[tree, right] = way
    values = np.zeros((len(leaves), max(map(len, leaves)), len(depths)))
    for tree, cut in enumerate(leaves):
        values[tree, : len(cut)] = cut
    return values


def cut_errors(values: np.ndarray, sizes: list[int], depths: list[int]):
    """Sums of squared errors of the first trees, ended at each depth, from each row's leaves."""

    def errors(frames):
        counts, total, rows = np.array(sizes), np.zeros((len(sizes), len(depths))), 0
        for frame in frames:
            if len(frame):
                reached = values[np.arange(len(values)), np.stack(frame["leaves"]).astype(int)]  # rows, trees, depths
                means = reached.cumsum(axis=1)[:, counts - 1] / counts[:, None]
                total += ((means - frame["label"].to_numpy()[:, None, None]) ** 2).sum(axis=0)
                rows += len(frame)
        points = [(size, depth) for size in sizes for depth in depths]
        found = pd.DataFrame(points, columns=["numTrees", "maxDepth"])
        yield found.assign(errors=total.ravel(), rows=rows)

    return errors


class MoneyModels:
    """Fitted models of one target over a fixed 70/30 split."""

    def __init__(
        self, trips: DataFrame, target: str, key: str, trees: int = 50, depth: int = 10, only: list[str] | None = None
    ):
        # One file for each core, whatever the files of the trips: every pass of a fit has a task for each file, and each task
        # of a forest sends its own statistics of all nodes. Sorted, so that a file's rows are drawn alike in every run.
        files = trips.sparkSession.sparkContext.defaultParallelism
        dealt = trips.repartition(files, key).sortWithinPartitions(key)
        table, self.features = model_table(dealt, target, key, only)
        assembler = VectorAssembler(inputCols=self.features, outputCol="features")
        vectors = assembler.transform(table).select(key, "label", "features", rules.hash_bucket(key).alias("bucket"))
        table = stored(vectors, f"{target}-dealt", SMALL_METHODS)
        # Laid out again by the leaves of one small tree: rows that follow each other are in the same nodes of a forest's trees, so
        # that their statistics are near at hand. The layout takes part in no result but through the forest's draws.
        guide = DecisionTreeRegressor(maxDepth=GUIDE_DEPTH, leafCol="leaf", seed=SEED)
        placed = guide.fit(sampling.hash_split(table, key, bucket="bucket")[0].coalesce(files)).transform(table).drop("prediction")
        table = stored(placed.repartitionByRange(files, "leaf", key).sortWithinPartitions("leaf", key), f"{target}-vectors")
        # Large files are read in parts; a task of a fit takes several.
        self.train, self.test = [part.coalesce(files) for part in sampling.hash_split(table, key, bucket="bucket")]
        self.key, self.trees, self.depth = key, trees, depth
        self.rmse = RegressionEvaluator(metricName="rmse")

    def fit(self, *names: str) -> "MoneyModels":
        """Fit all models, or only those named."""
        rows, self.mean = self.train.agg(F.count("*"), F.avg("label")).first()
        found = regressors(rows, self.trees, self.depth)
        self.models = {name: estimator.fit(self.train) for name, estimator in found.items() if not names or name in names}
        return self

    def comparison(self) -> DataFrame:
        """Test RMSE of the mean and of each model, from one pass."""
        scored = self.test.withColumn("baseline", F.lit(self.mean))
        for name, model in self.models.items():
            scored = model.copy({model.predictionCol: name}).transform(scored)
        names = ["baseline", *self.models]
        errors = scored.agg(*[F.sqrt(F.avg((F.col("label") - F.col(n)) * (F.col("label") - F.col(n)))) for n in names]).first()
        return self.train.sparkSession.createDataFrame(list(zip(names, errors)), "model string, rmse double")

    def importance(self) -> DataFrame:
        """Forest importance per feature, largest first."""
        weights = self.models["random_forest"].featureImportances.toArray()
        rows = [(name, float(weight)) for name, weight in zip(self.features, weights)]
        table = self.train.sparkSession.createDataFrame(rows, "feature string, importance double")
        return table.orderBy(F.desc("importance"), "feature")

    def grid_search(self, grid: dict[str, list] = GRID, folds: int = 5) -> DataFrame:
        """Cross-validated RMSE of forests at every point of a parameter grid, from all training rows.

        A forest is grown for each feature subset and fold, with the most trees and the greatest depth. Trees are drawn one by one
        and grown level by level, so that its first trees, ended at a lesser depth, are a forest with these parameters: it is
        scored as that at every number of trees and depth.
        """
        sizes, depths = sorted(grid["numTrees"]), sorted(grid["maxDepth"])
        spark, fold = self.train.sparkSession, F.pmod(F.xxhash64(self.key), F.lit(folds))

        def scores(point: tuple[str, int]) -> list[tuple]:
            subset, left_out = point
            forest = RandomForestRegressor(
                numTrees=sizes[-1], maxDepth=depths[-1], featureSubsetStrategy=subset, seed=SEED, leafCol="leaves"
            )
            model = forest.fit(self.train.filter(fold != left_out))
            values = cut_predictions(spark, model, depths)
            leaves = model.transform(self.train.filter(fold == left_out)).select("label", vector_to_array("leaves").alias("leaves"))
            errors = leaves.mapInPandas(cut_errors(values, sizes, depths), "numTrees int, maxDepth int, errors double, rows long")
            found = errors.groupBy("numTrees", "maxDepth").agg(F.sqrt(F.sum("errors") / F.sum("rows")).alias("rmse"))
            return [(subset, str(r.numTrees), str(r.maxDepth), r.rmse) for r in found.collect()]

        at_once = min(FORESTS_AT_ONCE, ROWS_AT_ONCE // max(self.train.count(), 1))
        with ThreadPoolExecutor(max(at_once, 1)) as pool:
            found = list(itertools.chain(*pool.map(scores, itertools.product(grid["featureSubsetStrategy"], range(folds)))))
        names = list(GRID)
        table = spark.createDataFrame(found, ", ".join(f"{name} string" for name in names) + ", rmse double")
        return table.groupBy(*names).agg(F.avg("rmse").alias("rmse")).orderBy("rmse", *names)
