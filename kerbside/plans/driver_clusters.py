"""Clusters of drivers by daily income and hours."""

from __future__ import annotations

from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, functions as F

from kerbside.session import stored

FIELDS = ["average_daily_income", "average_daily_hours"]
POINTS_PER_TASK = 200_000  # every task of every iteration of every restart answers the driver


def vectors(drivers: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=FIELDS, outputCol="features").transform(drivers.na.drop(subset=FIELDS))


def stored_points(drivers: DataFrame) -> DataFrame:
    """The vectors, written once and read by as few tasks as their number needs, not by one for each file or core."""
    points = stored(vectors(drivers), "driver-vectors")
    return points.coalesce(max(1, -(-points.count() // POINTS_PER_TASK)))


def _single_cluster_cost(points: DataFrame) -> float:
    """Squared distance to the common mean: the cost of one cluster."""
    spread = [F.var_pop(field) * F.count(field) for field in FIELDS]
    return points.agg(sum(spread[1:], spread[0]).alias("cost")).first().cost


def best_kmeans(points: DataFrame, k: int, restarts: int = 10, max_iter: int = 300):
    """The restart with the lowest within-cluster cost."""
    models = [
        KMeans(k=k, maxIter=max_iter, seed=seed, featuresCol="features").fit(points)
        for seed in range(restarts)
    ]
    return min(models, key=lambda model: model.summary.trainingCost)


def elbow(drivers: DataFrame, largest: int = 10, restarts: int = 10) -> DataFrame:
    """Within-cluster cost for one to ``largest`` clusters."""
    points = stored_points(drivers)
    costs = [(1, _single_cluster_cost(points))]
    costs += [
        (k, float(best_kmeans(points, k, restarts).summary.trainingCost)) for k in range(2, largest + 1)
    ]
    return drivers.sparkSession.createDataFrame(costs, "k int, inertia double")


def cluster_profile(drivers: DataFrame, k: int = 6, restarts: int = 10) -> DataFrame:
    """Size, income range, mean hours and centre per cluster, ordered by income."""
    points = stored_points(drivers)
    labelled = best_kmeans(points, k, restarts).transform(points)
    return (
        labelled.groupBy("prediction")
        .agg(
            F.count("*").alias("drivers"),
            F.floor(F.min(FIELDS[0])).alias("min_income"),
            F.floor(F.max(FIELDS[0])).alias("max_income"),
            F.round(F.avg(FIELDS[1]), 1).alias("mean_hours"),
            F.avg(FIELDS[0]).alias("centre_income"),
            F.avg(FIELDS[1]).alias("centre_hours"),
        )
        .withColumnRenamed("prediction", "cluster")
        .orderBy("centre_income")
    )
