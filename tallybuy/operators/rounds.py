"""What boosted trees are worth after each of their rounds, by a named metric."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import VectorSlicer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressionModel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallybuy.session import intermediate_path

#: Metrics of each task; the first is the one taken where none is named.
CLASSIFICATION_METRICS = ("auc", "binary_logloss")
REGRESSION_METRICS = ("l2", "l1")

#: Probabilities nearer than one over this count as tied in an area.
_BINS = 1 << 16
#: Cells of rows x rounds that a task holds at once.
_CELLS = 1 << 20


@dataclass(frozen=True)
class _Trees:
    """The trees of a model as flat arrays; a leaf is its own child."""

    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    depth: int

    def margins(self, x: np.ndarray) -> np.ndarray:
        """Sum of the first 1, 2, ... trees for each row, rows by rounds."""
        at = np.repeat(self.roots[None, :], len(x), 0)
        rows = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            goes_left = x[rows, self.feature[at]] <= self.threshold[at]
            at = np.where(goes_left, self.left[at], self.right[at])
        return np.cumsum(self.value[at], axis=1)


def _trees_of(model, spark: SparkSession) -> tuple[_Trees, list[int]]:
    """Trees of a model by its stored form, and the features they look at.

    The number of nodes is bounded by the rounds and the depth, not by the data.
    """
    path = intermediate_path(spark, "trees")
    model.write().save(path)
    # Column names of the stored form.
    split = F.col("nodeData.split")
    nodes = (
        spark.read.parquet(f"{path}/data")
        .select(
            F.col("treeID").alias("tree"), F.col("nodeData.id").alias("id"), F.col("nodeData.prediction").alias("value"),
            F.col("nodeData.leftChild").alias("left"), F.col("nodeData.rightChild").alias("right"),
            split["featureIndex"].alias("feature"), split["numCategories"].alias("categories"),
            split["leftCategoriesOrThreshold"].alias("at"),
        )
        .orderBy("tree", "id")
        .collect()
    )
    if any(n["categories"] > 2 for n in nodes):
        raise ValueError("features are numbers or 0/1; a tree splits on more categories")
    first: dict[int, int] = {}
    for i, n in enumerate(nodes):
        first.setdefault(n["tree"], i)
    weights = model.treeWeights
    used = sorted({n["feature"] for n in nodes if n["left"] >= 0})
    slot = {f: i for i, f in enumerate(used)}
    size = len(nodes)
    feature, threshold = np.zeros(size, np.int64), np.zeros(size)
    left, right = np.arange(size), np.arange(size)
    level = np.zeros(size, np.int64)
    for i, n in enumerate(nodes):
        if n["left"] < 0:
            continue
        base = first[n["tree"]]
        left[i], right[i] = base + n["left"], base + n["right"]
        feature[i] = slot[n["feature"]]
        if n["categories"] == 2:
            # A 0/1 column: its left values are one of the two.
            threshold[i] = 0.5
            if n["at"] == [1.0]:
                left[i], right[i] = right[i], left[i]
        else:
            threshold[i] = n["at"][0]
        # Nodes are numbered before their children.
        level[left[i]] = level[right[i]] = level[i] + 1
    value = np.array([n["value"] * weights[n["tree"]] for n in nodes])
    trees = _Trees(np.array([first[t] for t in range(len(weights))]), feature, threshold, left, right, value, int(level.max()))
    return trees, used


def round_areas(model, rows: DataFrame) -> list[float] | None:
    """ROC area of a boosted classifier on ``rows`` (features, label) after each of its rounds.

    One pass for all rounds: a task turns rows into counts per (round, score), scores
    rounded to 1/65536, and the counts are summed. None where ``rows`` have fewer than two classes.
    """
    trees, used = _trees_of(model, rows.sparkSession)
    held = rows.select("label", "features")
    if used:
        held = VectorSlicer(inputCol="features", outputCol="_used", indices=used).transform(held)
        values = vector_to_array("_used")
    else:
        values = F.array(F.lit(0.0))  # all trees are single leaves
    width = max(1, len(used))
    rounds = len(trees.roots)

    def count(batches):
        step = max(1, _CELLS // rounds)
        for batch in batches:
            flat = np.asarray(batch["x"].flatten()).reshape(-1, width)
            label = np.asarray(batch["label"]) > 0
            for i in range(0, len(flat), step):
                scores = 1.0 / (1.0 + np.exp(-2.0 * trees.margins(flat[i : i + step])))
                bins = np.minimum((scores * _BINS).astype(np.int64), _BINS - 1)
                cell = (np.arange(rounds)[None, :] * _BINS + bins) * 2 + label[i : i + step, None]
                found, n = np.unique(cell, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found // (2 * _BINS)), pa.array(found // 2 % _BINS), pa.array(found % 2), pa.array(n)],
                    names=["round", "bin", "positive", "n"],
                )

    counts = held.select("label", values.alias("x")).mapInArrow(count, "round bigint, bin bigint, positive bigint, n bigint")
    cells = counts.groupBy("round", "bin").agg(
        F.sum(F.col("n") * F.col("positive")).alias("pos"), F.sum(F.col("n") * (1 - F.col("positive"))).alias("neg")
    )
    below = Window.partitionBy("round").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    won = F.col("pos") * (F.coalesce(F.sum("neg").over(below), F.lit(0)) + F.col("neg") / 2)
    areas = (
        cells.withColumn("won", won)
        .groupBy("round")
        .agg(F.try_divide(F.sum("won"), F.sum("pos").cast("double") * F.sum("neg")).alias("area"))
        .collect()
    )
    found = [r["area"] for r in sorted(areas, key=lambda r: r["round"])]
    return found if found and found[0] is not None else None


def round_losses(model, rows: DataFrame, metric: str | None = None) -> list[float]:
    """Loss by ``metric`` on ``rows`` after each round; smaller is better.

    Classifiers: ``auc`` (one less the ROC area; log loss where the rows are of one
    class, which have no area) or ``binary_logloss``. Regressors: ``l2`` or ``l1``.
    """
    regression = isinstance(model, GBTRegressionModel)
    check_metric("regression" if regression else "classification", metric)
    if regression:
        return model.evaluateEachIteration(rows, "absolute" if metric == "l1" else "squared")
    if metric != "binary_logloss":
        areas = round_areas(model, rows)
        if areas is not None:
            return [1.0 - a for a in areas]
    return model.evaluateEachIteration(rows)


def check_metric(task: str, metric: str | None) -> None:
    known = REGRESSION_METRICS if task == "regression" else CLASSIFICATION_METRICS
    if metric is not None and metric not in known:
        raise ValueError(f"{task} is measured by one of {', '.join(known)}, not {metric}")
