"""Saved models (M11, M8): a registry of fitted forests with their scores.

A registry is a folder of versions (``sinks.versioned``). Each version has the
node table of its models, sorted by model so that a read for some of them
skips the others' row groups, and a table of a row per model: horizon,
commodity, base, features, depth, test scores, and whether it is the best of
its horizon. A version is there as a whole or not at all.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from harvestline.functions import ts_literal
from harvestline.operators import models
from harvestline.operators.boosting import Forest
from harvestline.sinks import versioned


def save(forest: Forest, results: DataFrame, path: str, created_at: dt.datetime) -> str:
    """Save the forest with its results (``models.RESULT``); returns the version."""
    best = models.select_best(results).select("horizon", "commodity", F.lit(True).alias("is_best"))
    rows = (
        results.withColumn("model", models.model_key("commodity"))
        .join(forest.bases, "model")
        .join(best, ["horizon", "commodity"], "left")
        .select(
            "model",
            "horizon",
            "commodity",
            "base",
            F.lit(forest.features).alias("features"),
            F.lit(forest.max_depth).alias("max_depth"),
            "model_mae",
            "model_rmse",
            "model_mape",
            "naive_mape",
            "mape_improvement_pct",
            F.coalesce("is_best", F.lit(False)).alias("is_best"),
            ts_literal(created_at).alias("created_at"),
        )
    )
    nodes = forest.nodes.repartitionByRange("model", "tree").sortWithinPartitions("model", "tree", "node")
    return versioned.replace({"nodes": nodes, "models": rows}, path)


def entries(spark: SparkSession, path: str, version: str | None = None) -> DataFrame:
    """The row of each saved model, with the folder of its version."""
    version = version or versioned.current(spark, path)
    place = f"{path}/{versioned.VERSIONS}/{version}"
    return versioned.read(spark, path, "models", version).withColumn("path", F.lit(place))


def load(spark: SparkSession, path: str, version: str | None = None, where: Column | None = None) -> Forest:
    """The saved forest, or those of its models that meet ``where`` (on the entries)."""
    version = version or versioned.current(spark, path)
    rows = entries(spark, path, version)
    if where is not None:
        rows = rows.where(where)
    shape = rows.select("features", "max_depth").first()
    if shape is None:
        raise LookupError(f"no such model in {path}")
    nodes = versioned.read(spark, path, "nodes", version)
    if where is not None:
        nodes = nodes.join(rows.select("model"), "model", "left_semi")
    return Forest(nodes, rows.select("model", "base"), list(shape["features"]), shape["max_depth"])
