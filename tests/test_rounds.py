"""Metrics per round against models of fewer rounds."""

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from tallybuy.operators import models, rounds
from tallybuy.operators.blend import roc_area
from tallybuy.operators.sparse import one_hot_vectors


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(4)
    data = [
        (float(a), float(b), "xyz"[c], float(a + (c == 1) + rng.normal() > 0.4))
        for a, b, c in zip(rng.normal(size=500), rng.normal(size=500), rng.integers(0, 3, 500))
    ]
    rows = spark.createDataFrame(data, "a double, b double, c string, label double")
    return one_hot_vectors(rows, ["label"], ["a", "b"], ["c"]).withColumn("fold", F.pmod(F.xxhash64("features"), F.lit(3)))


def _area(model, rows):
    scored = model.transform(rows).select("label", vector_to_array("probability")[1].alias("prob"))
    return roc_area(scored).first()["auc"]


def test_area_of_each_round_is_that_of_the_shorter_model(vectors):
    train, valid = vectors.where("fold > 0"), vectors.where("fold = 0")
    trees = GBTClassifier(maxIter=4, maxDepth=3, seed=5)
    areas = rounds.round_areas(trees.fit(train), valid)
    assert len(areas) == 4
    for n, area in enumerate(areas, 1):
        assert area == pytest.approx(_area(trees.copy({trees.maxIter: n}).fit(train), valid), abs=1e-3)


def test_one_class_has_no_area(vectors):
    model = GBTClassifier(maxIter=2, maxDepth=2).fit(vectors)
    one = vectors.where("label = 1")
    assert rounds.round_areas(model, one) is None
    assert rounds.round_losses(model, one) == rounds.round_losses(model, one, "binary_logloss")
    assert rounds.round_areas(model, vectors.limit(0)) is None


def test_trees_without_a_split_tie_all_rows(vectors):
    model = GBTClassifier(maxIter=2, minInstancesPerNode=400).fit(vectors)
    assert rounds.round_areas(model, vectors) == [0.5, 0.5]


def test_the_named_metric_decides(vectors):
    train, valid = vectors.where("fold > 0"), vectors.where("fold = 0")
    trees = GBTClassifier(maxIter=12, maxDepth=4, stepSize=0.7, seed=1)
    whole = trees.fit(train)
    for metric in rounds.CLASSIFICATION_METRICS:
        kept = models.fit_with_patience(trees, train, valid, 50, metric)
        assert kept.getNumTrees == 1 + int(np.argmin(rounds.round_losses(whole, valid, metric)))
    regressor = GBTRegressor(maxIter=2, labelCol="label").fit(train)
    assert rounds.round_losses(regressor, valid, "l1") == regressor.evaluateEachIteration(valid, "absolute")
    for task, wrong in (("classification", "l2"), ("regression", "auc"), ("classification", "f1")):
        with pytest.raises(ValueError):
            rounds.check_metric(task, wrong)


def test_first_rounds_are_those_of_the_shorter_fit(vectors, tmp_path):
    train = vectors.where("fold > 0")
    for trees in (GBTClassifier(maxIter=5, maxDepth=3, seed=5, subsamplingRate=0.8), GBTRegressor(maxIter=5, maxDepth=3, seed=5, labelCol="label")):
        cut, short = models.first_rounds(trees.fit(train), 2), trees.copy({trees.maxIter: 2}).fit(train)
        cut.write().save(str(tmp_path / type(trees).__name__))
        again = type(cut).load(str(tmp_path / type(trees).__name__))
        want = [r["prediction"] for r in short.transform(vectors).select("prediction").collect()]
        for model in (cut, again):
            assert model.getNumTrees == 2 and model.getOrDefault("maxIter") == 2 and model.treeWeights == short.treeWeights
            assert [r["prediction"] for r in model.transform(vectors).select("prediction").collect()] == want
        found = cut.featureImportances.toArray()
        assert found == pytest.approx(short.featureImportances.toArray()[: len(found)], abs=1e-12)


def test_patience_fits_once_where_the_budget_is_used_up(vectors, monkeypatch):
    train, valid = vectors.where("fold > 0"), vectors.where("fold = 0")
    fits, fit = [], GBTClassifier.fit
    monkeypatch.setattr(GBTClassifier, "fit", lambda self, *a: (fits.append(1), fit(self, *a))[1])
    monkeypatch.setattr(models, "round_losses", lambda model, rows, metric: [0.5, 0.2, 0.4, 0.3])
    assert models.fit_with_patience(GBTClassifier(maxIter=4, maxDepth=2), train, valid, 50).getNumTrees == 2
    assert len(fits) == 1
