"""Fitted demand models on disk: a folder for each route beside a description with the bundle's digest."""

from __future__ import annotations

import json
import os

from pyspark.ml.util import DefaultParamsReader
from pyspark.sql import DataFrame, SparkSession, functions as F

from kerbside.plans.demand_models import Fitted, RoutedModel
from kerbside.sources import digests

ABOUT = "about"


class ModelError(ValueError):
    """A stored model is missing, incomplete or changed."""


def bundle_digest(spark: SparkSession, path: str) -> str | None:
    """SHA-256 over the paths and digests of a bundle's files, without its description.

    The list of files is that of three models, whatever the data they were fitted on.
    """
    files = digests.file_digests(spark, path, "*")
    inside = F.expr("substring(path, instr(path, '/{0}/') + {1})".format(os.path.basename(path.rstrip("/")), len(os.path.basename(path.rstrip("/"))) + 2))
    lines = files.select(inside.alias("file"), "sha256").filter(~F.col("file").startswith(f"{ABOUT}/"))
    listed = F.array_join(F.array_sort(F.collect_list(F.concat_ws(" ", "file", "sha256"))), "\n")
    return lines.agg(F.when(F.count("*") > 0, F.sha2(listed, 256))).first()[0]


def save_model(spark: SparkSession, model: RoutedModel, path: str, **about) -> str:
    """Write a routed model of fitted parts to a new folder; returns its digest.

    The description is written last: a folder without one is an unfinished write and is not read.
    """
    routes = {}
    for route, part in model.by_route().items():
        if not isinstance(part, Fitted):
            raise ModelError(f"The {route} model isn't a fitted one")
        part.model.write().save(f"{path}/{route}")
        routes[route] = {"features": list(part.features), "log_link": part.log_link, "offset": part.offset}
    digest = bundle_digest(spark, path)
    description = {**about, "routes": routes, "airports": list(model.airports), "trained": model.trained, "sha256": digest}
    spark.createDataFrame([(json.dumps(description, sort_keys=True),)], "value string").coalesce(1).write.text(f"{path}/{ABOUT}")
    return digest


def describe_model(spark: SparkSession, path: str) -> dict:
    try:
        return json.loads(spark.read.text(f"{path}/{ABOUT}").first().value)
    except Exception as error:
        raise ModelError(f"No complete model in {path}") from error


def load_model(spark: SparkSession, path: str, sha256: str | None = None) -> RoutedModel:
    """Read a stored model after its files have been checked against its digest, and against ``sha256`` where given."""
    about = describe_model(spark, path)
    if bundle_digest(spark, path) != about["sha256"] or sha256 not in (None, about["sha256"]):
        raise ModelError(f"The model in {path} has changed since it was written")
    parts = {
        route: Fitted(DefaultParamsReader.loadParamsInstance(f"{path}/{route}", spark), tuple(own["features"]), own["log_link"], own["offset"])
        for route, own in about["routes"].items()
    }
    return RoutedModel(
        parts["global"], parts["airport_specialist"], parts.get("event_specialist"), tuple(about["airports"]),
        tuple(about["trained"]) if about["trained"] else None,
    )
