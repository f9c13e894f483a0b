"""Fitted models with what is known of them: a table of files, parameters, seeds and ROC areas.

A registry is a folder: ``models/<name>`` has the saved models, ``entries/<name>`` one row each.
The row is written after its model, so a model without a row is one whose run
was lost, and isn't found.
"""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

_ENTRY = (
    "name string, kind int, seed bigint, params string, path string, "
    "auc_train double, auc_valid double, auc_test double, rounds int"
)
_PARTS = ("train", "valid", "test")


def register(
    spark: SparkSession, root: str, name: str, model: PipelineModel, kind: int, seed: int = 0,
    params: Mapping | None = None, areas: Mapping[str, float | None] | None = None,
) -> None:
    """Save a model and write its row; an earlier one of that name is replaced."""
    path = f"{root}/models/{name}"
    model.write().overwrite().save(path)
    rounds = getattr(model.stages[-1], "getNumTrees", None)
    known = [None if (areas or {}).get(p) is None else float(areas[p]) for p in _PARTS]
    entry = (name, kind, seed, json.dumps(dict(params or {}), sort_keys=True, default=str), path, *known, rounds)
    spark.createDataFrame([entry], _ENTRY).coalesce(1).write.mode("overwrite").parquet(f"{root}/entries/{name}")


def entries(spark: SparkSession, root: str) -> DataFrame:
    """One row for each registered model: ``name, kind, seed, params, path, auc_*, rounds``; none in an empty folder."""
    try:
        return spark.read.schema(_ENTRY).parquet(f"{root}/entries/*")
    except AnalysisException as missing:
        if "PATH_NOT_FOUND" not in str(missing):
            raise
        return spark.createDataFrame([], _ENTRY)


def restore(spark: SparkSession, root: str, condition: Column | None = None) -> dict[str, PipelineModel]:
    """Registered models by name, all or those whose row meets the condition, e.g. ``F.col("auc_valid") > 0.6``."""
    chosen = entries(spark, root) if condition is None else entries(spark, root).where(condition)
    return {r["name"]: PipelineModel.load(r["path"]) for r in chosen.orderBy("name").collect()}


def best(spark: SparkSession, root: str, by: str = "auc_valid") -> tuple[str, PipelineModel]:
    """Name and model with the largest area; of equals the first name."""
    row = entries(spark, root).where(F.col(by).isNotNull()).orderBy(F.desc(by), "name").first()
    if row is None:
        raise ValueError(f"no registered model has {by}")
    return row["name"], PipelineModel.load(row["path"])


def score_with_registered(spark: SparkSession, root: str, rows: DataFrame, condition: Column | None = None) -> DataFrame:
    """``user_id, seller_id, prob, run_id`` and the areas of each restored model, below each other."""
    from tallybuy.operators.models import pair_scores

    out: DataFrame | None = None
    for name, model in restore(spark, root, condition).items():
        part = pair_scores(model, rows).withColumn("run_id", F.lit(name))
        out = part if out is None else out.unionByName(part)
    if out is None:
        raise ValueError("no registered model meets the condition")
    known = entries(spark, root).select(F.col("name").alias("run_id"), *[f"auc_{p}" for p in _PARTS])
    return out.join(F.broadcast(known), "run_id", "left")  # a row for each model
