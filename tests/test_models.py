"""Fits on small frames: shapes, ranges, repeatability."""

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.sql import functions as F

from tallybuy.operators import models, scaling
from tallybuy.operators.selection import FeatureSelector


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, 3))
    y = (x[:, 0] + 0.2 * rng.normal(size=300) > 0).astype(int)
    data = [
        (i, i % 7, int(y[i]), float(x[i, 0]), float(x[i, 1]), 1.0, None if i % 4 else float(x[i, 2]))
        for i in range(300)
    ]
    df = spark.createDataFrame(
        data, "user_id bigint, seller_id bigint, label int, good double, noise double, flat double, gaps double"
    )
    return models.mark_split(df, 0.8, keep=0.5)


@pytest.mark.parametrize("kind", sorted(models.MODEL_KINDS))
def test_each_kind_learns(spark, rows, kind):
    params = {"max_iter": 5} if kind in (2, 3) else {"max_iter": 5, "minInstancesPerNode": 5}
    model = models.fit_model(rows, kind, **params)
    scored = models.pair_scores(model, rows)
    assert scored.count() == 300
    assert scored.where("prob < 0 or prob > 1 or prob is null").count() == 0
    assert models.area_by_part(model, rows)["train"] > 0.8


def test_saved_models_score_the_same(rows, tmp_path):
    model = models.fit_model(rows, 1, max_iter=3, minInstancesPerNode=5)
    path = str(tmp_path / "m")
    models.save_model(model, path)
    again = models.score_with_saved({"m": path}, rows).drop("run_id")
    assert again.exceptAll(models.pair_scores(model, rows)).count() == 0


def test_importance_finds_the_useless_column(rows):
    columns = ["user_id", "seller_id", "label", "good", "noise", "flat"]
    selector = FeatureSelector(rows.select(*columns), models.PAIR, "label")
    with pytest.raises(NotImplementedError):
        selector.identify_low_importance(0.9)
    with pytest.raises(ValueError):
        selector.identify_zero_importance("classification")
    assert "flat" in selector.identify_zero_importance("classification", "auc", 1, max_iter=3)
    low = selector.identify_low_importance(0.99)
    assert "good" not in low
    with pytest.raises(ValueError):
        selector.identify_all({"task": "classification"})
    assert "flat" not in selector.remove(["zero_importance"]).columns


def test_importance_of_a_regression_without_keys(rows):
    frame = rows.select("good", "noise", (F.col("good") * 2).alias("target"))
    selector = FeatureSelector(frame, label="target")
    selector.identify_zero_importance("regression", "l2", 1, max_iter=3)
    top = selector.feature_importances.orderBy(F.desc("importance")).first()
    assert top["feature"] == "good"


def test_draws_repeat_and_stay_in_range():
    for space in (models.STAGED_SPACE, models.RANDOM_SPACE):
        one, two = models.draw_settings(space, 20, 7), models.draw_settings(space, 20, 7)
        assert one == two
        for chosen in one:
            for name, draw in space.items():
                low, high = (0.0, 1.0) if draw.shape == "beta" else (draw.low, draw.high)
                assert low - 1 <= chosen[name] <= high + 1


def test_search_reports_every_setting(rows):
    settings = [{"maxDepth": 1}, {"maxDepth": 2}]
    got = models.cross_validate(rows, settings, n_folds=2, max_iter=2).collect()
    assert [r["setting"] for r in got] == [0, 1]
    assert all(abs(r["auc"] + r["loss"] - 1.0) < 1e-12 for r in got)


def test_factors_are_non_negative(spark):
    counts = spark.createDataFrame(
        [(u * 1000, s * 10, 1 + (u * s) % 3) for u in range(12) for s in range(6) if (u + s) % 2],
        "user_id bigint, seller_id bigint, counts bigint",
    )
    got = models.pair_factors(counts, rank=3, max_iter=2)
    assert got.users.count() == 12 and got.sellers.count() == 6
    low = got.users.select(F.least(*[F.min(str(i)) for i in range(3)])).first()[0]
    assert low >= 0.0


def test_components_are_half_of_all_columns(rows):
    df = rows.select("user_id", "seller_id", "label", "good", "noise", "gaps")
    got = scaling.reduce_dimension(df)
    assert got.columns == ["user_id", "seller_id", "label", "pc0", "pc1", "pc2"]
    assert abs(got.agg(F.avg("pc0")).first()[0]) < 1e-9


def test_class_weights_balance(rows):
    sums = models.balanced_weights(rows).groupBy("label").agg(F.sum("weight").alias("w")).collect()
    assert abs(sums[0]["w"] - sums[1]["w"]) < 1e-6


def test_weights_balance_the_train_rows_alone(spark, rows):
    lopsided = rows.withColumn("label", F.when(F.col("part") == "valid", 1).otherwise(F.col("label")))
    train = rows.where("part = 'train'").agg(F.avg("label")).first()[0]
    model = models.fit_model(lopsided, 2)
    again = models.fit_model(rows.where("part = 'train'"), 2)
    assert 0 < train < 1
    assert np.allclose(model.stages[-1].coefficients.toArray(), again.stages[-1].coefficients.toArray(), atol=1e-6)


def test_slow_learners_keep_learning(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(1500, 3))
    y = (x[:, 0] + 0.5 * x[:, 1] + rng.normal(size=1500) > 0).astype(int)
    df = spark.createDataFrame(
        [(i, 0, int(y[i]), *map(float, x[i])) for i in range(1500)],
        "user_id bigint, seller_id bigint, label int, a double, b double, c double",
    )
    marked = models.mark_split(df, 0.7)
    model = models.fit_model(marked, 0, max_iter=40, minInstancesPerNode=20, maxDepth=3)
    assert model.stages[-1].getNumTrees > 20
    fast = models.fit_model(marked, 1, max_iter=40, patience=5, minInstancesPerNode=20)
    assert fast.stages[-1].getNumTrees < 40
    best = models.tree_importances(marked, ["a", "b", "c"], "label", "classification", 1, max_iter=25)
    assert best["a"] > 0 and best["b"] > 0


def test_search_ends_in_a_model(rows):
    settings = [{"maxDepth": 1, "stepSize": 0.1}, {"maxDepth": 2, "stepSize": 0.1}]
    table = models.cross_validate(rows, settings, n_folds=2, max_iter=3)
    model, chosen, area = models.fit_best(rows, settings, table, max_iter=3)
    assert chosen in settings and area == table.agg(F.max("auc")).first()[0]
    assert models.pair_scores(model, rows).count() == 300


def test_search_goes_on_where_it_stopped(rows, tmp_path, monkeypatch):
    """Finished (setting, fold) results are kept; a broken search fits only the rest, and other rows have a search of their own."""
    settings = [{"maxDepth": 1, "stepSize": 0.1}, {"maxDepth": 2, "stepSize": 0.1}, {"maxDepth": 2, "stepSize": 0.3}]
    store, fitted, plain = str(tmp_path / "search"), [], models.fit_with_patience

    def broken(estimator, train, valid, patience):
        fitted.append(1)
        if len(fitted) > 3:
            raise RuntimeError("executor lost")
        return plain(estimator, train, valid, patience)

    kw = {"n_folds": 2, "max_iter": 3, "store": store, "side_by_side": 1}
    monkeypatch.setattr(models, "fit_with_patience", broken)
    with pytest.raises(RuntimeError):
        models.cross_validate(rows, settings, **kw)
    count = []
    monkeypatch.setattr(models, "fit_with_patience", lambda *a: (count.append(1), plain(*a))[1])
    resumed = models.cross_validate(rows, settings, **kw).orderBy("setting").collect()
    assert len(count) == 3
    again = models.cross_validate(rows, settings, **kw).orderBy("setting").collect()
    whole = models.cross_validate(rows, settings, **{**kw, "store": str(tmp_path / "other"), "side_by_side": 4}).orderBy("setting").collect()
    assert resumed == again == whole and len(count) == 9
    models.cross_validate(rows.where("user_id <> 5"), settings[:1], **kw)
    assert len(count) == 11


def test_best_setting_of_a_search_is_fitted(rows, tmp_path):
    space = {"maxDepth": models.Draw("randint", 1, 4, integer=True), "stepSize": models.Draw("uniform", 0.1, 0.3)}
    model, chosen, area = models.best_by_search(rows, space, 3, 2, 1, max_iter=3, patience=2, store=str(tmp_path))
    assert chosen in models.draw_settings(space, 3, 1) and 0.5 < area <= 1
    assert model.stages[-1].getMaxDepth() == chosen["maxDepth"]


def test_registry_keeps_areas_and_picks_by_condition(spark, rows, tmp_path):
    from tallybuy.operators import registry

    root = str(tmp_path / "registry")
    assert registry.entries(spark, root).count() == 0
    with pytest.raises(ValueError):
        registry.score_with_registered(spark, root, rows)
    labelled, unlabelled = rows.select("user_id", "seller_id", "label"), rows.select("user_id", "seller_id").limit(20)
    runs = models.fit_score_runs(rows.drop("part"), labelled, unlabelled, 2, 1, registered=root, max_iter=3, minInstancesPerNode=5)
    kept = {r["name"]: r for r in registry.entries(spark, root).collect()}
    assert sorted(kept) == ["kind1-run0", "kind1-run1"]
    for run, areas in runs.areas.items():
        row = kept[f"kind1-run{run}"]
        assert {p: row[f"auc_{p}"] for p in areas} == areas and row["seed"] == run and row["rounds"] >= 1
    name, model = registry.best(spark, root)
    top = max(kept.values(), key=lambda r: (r["auc_valid"], [-ord(c) for c in r["name"]]))
    assert name == top["name"]
    some = registry.score_with_registered(spark, root, unlabelled.join(rows, ["user_id", "seller_id"]), F.col("seed") == 1)
    assert {r["run_id"] for r in some.collect()} == {"kind1-run1"}
    assert some.first()["auc_train"] == runs.areas[1]["train"]


def test_optimality_residuals(spark, rows):
    """Zero at the solutions, not elsewhere."""
    from pyspark.ml.classification import LogisticRegressionModel

    from tallybuy.operators import optimality

    columns = models.feature_columns(rows)
    noisy = rows.withColumn("label", F.when(F.col("user_id") % 5 == 0, 1 - F.col("label")).otherwise(F.col("label")))
    model = models.fit_model(noisy, 2)
    train = models.balanced_weights(models.fill_features(noisy.where("part = 'train'"), columns))
    train = train.withColumn("label", F.col("label").cast("double"))
    slopes = optimality.logistic_gradient(model, train).collect()
    assert len(slopes) == len(columns) + 1 and isinstance(model.stages[-1], LogisticRegressionModel)
    assert all(abs(r.gradient) <= 0.02 * r.scale + 1e-6 for r in slopes)
    early = optimality.logistic_gradient(models.fit_model(noisy, 2, max_iter=1), train).collect()
    assert any(abs(r.gradient) > 0.02 * r.scale + 1e-6 for r in early)
    counts = spark.createDataFrame([(u, s, 1 + (u * s) % 3) for u in range(30) for s in range(9) if (u + s) % 3], "user_id bigint, seller_id bigint, counts bigint")
    f = models.pair_factors(counts, rank=4, max_iter=3)
    for users, good in ((f.users, True), (f.users.select("user_id", *[(F.col(str(i)) * 1.5 + 0.1).alias(str(i)) for i in range(4)]), False)):
        got = optimality.factor_stationarity(counts, users, f.sellers, "user_id").collect()
        assert len(got) == 30 and all((r.worst <= 1e-3 * r.scale) == good and r.smallest >= 0 for r in got)


def test_factor_tables_are_never_broadcast(spark):
    """Ids and factors are far smaller in files than on a driver; blocks of factors grow in number, not in size."""
    from tallybuy.operators import optimality

    counts = spark.createDataFrame([(u, s, 1) for u in range(12) for s in range(6) if (u + s) % 2], "user_id bigint, seller_id bigint, counts bigint")
    f = models.pair_factors(counts, rank=2, max_iter=1)
    for df in (f.users, f.sellers, optimality.factor_stationarity(counts, f.users, f.sellers, "user_id")):
        assert "Broadcast" not in df._jdf.queryExecution().executedPlan().toString()
    assert models.factor_blocks(15_000, 114_000) == (10, 10)
    assert models.factor_blocks(5_400_000, 41_000_000) == (83, 157)


def test_covariances_are_those_of_numpy(spark, monkeypatch):
    """From one array of sums for each task, not from an aggregate for each pair."""
    from tallybuy.operators import optimality

    monkeypatch.delattr(F, "covar_samp")
    x = np.random.default_rng(3).normal(5.0, 2.0, (200, 3))
    df = spark.createDataFrame([tuple(map(float, r)) for r in x], "a double, b double, c double").repartition(5)
    want = np.cov(x.T)
    got = {(r.feature, r.earlier_feature): (r.covariance, r.scale) for r in optimality.component_covariances(df, ["a", "b", "c"]).collect()}
    assert set(got) == {("b", "a"), ("c", "a"), ("c", "b")}
    for (later, earlier), found in got.items():
        i, j = "abc".index(later), "abc".index(earlier)
        assert found == pytest.approx((want[i, j], np.sqrt(want[i, i] * want[j, j])), abs=1e-9)
    assert [r.covariance for r in optimality.component_covariances(df.limit(1), ["a", "b"]).collect()] == [None]


def test_linear_model_starts_no_more_tasks_than_its_rows_are_worth(rows, monkeypatch):
    """Its passes are many and short: on few rows one task does each of them, on more rows more tasks do."""
    seen, fit = [], LogisticRegression.fit
    monkeypatch.setattr(LogisticRegression, "fit", lambda self, df, *a: (seen.append((df.rdd.getNumPartitions(), df.count())), fit(self, df, *a))[1])
    spread = rows.repartition(8, "user_id", "seller_id")
    n = rows.where("part = 'train'").count()
    models.fit_model(spread, 2, max_iter=3)
    monkeypatch.setattr(models, "_NUMBERS_A_TASK", n)
    models.fit_model(spread, 2, max_iter=3)
    assert seen[0] == (1, n) and seen[1][1] == n
    assert 1 < seen[1][0] <= len(models.feature_columns(rows))


class _Asked(Exception):
    """Ends a query once it has asked for its fits."""


def _asked(monkeypatch, name):
    """What a call of ``models.<name>`` is given, defaults included, in a dictionary that it fills."""
    import inspect

    given, signature = {}, inspect.signature(getattr(models, name))

    def ask(*args, **kw):
        bound = signature.bind(*args, **kw)
        bound.apply_defaults()
        given.update(bound.arguments)
        raise _Asked

    monkeypatch.setattr(models, name, ask)
    return given


class _Tables:
    """Stands in for the tables of a query whose rows are given."""

    def stored(self):
        return self

    def labelled(self):
        return None


def test_best_of_search_is_a_whole_search(rows, monkeypatch):
    """Fifteen settings, four folds, 5,000 rounds and a patience of 40."""
    from tallybuy.plans import models as plans

    monkeypatch.setattr(plans, "_features", lambda fx: rows)
    monkeypatch.setattr(plans, "training_rows", lambda rows, labelled, keep: rows)
    given = _asked(monkeypatch, "cross_validate")
    with pytest.raises(_Asked):
        plans._best_of_search(_Tables())
    assert (len(given["settings"]), given["n_folds"], given["max_iter"], given["patience"]) == (15, 4, 5000, 40)
    assert given["rows"].count() == rows.count()


def test_important_features_makes_all_its_runs(rows, monkeypatch):
    """Six runs of up to 1,000 rounds with a patience of 100."""
    from tallybuy.plans import models as plans

    monkeypatch.setattr(plans, "_labelled_features", lambda fx: rows)
    given = _asked(monkeypatch, "tree_importances")
    with pytest.raises(_Asked):
        plans._important_features(_Tables())
    assert (given["n_runs"], given["max_iter"], given["patience"]) == (6, 1000, 100)


def test_runs_side_by_side_add_up_to_the_same(rows):
    """The mean over seeds doesn't depend on how many fits run at a time."""
    given = rows, ["good", "noise"], "label", "classification", 3
    alone = models.tree_importances(*given, max_iter=3, side_by_side=1)
    assert models.tree_importances(*given, max_iter=3) == pytest.approx(alone, abs=1e-12)


def test_random_search_is_a_whole_search(rows, monkeypatch):
    """Ten settings, five folds and a patience of 40; rounds are drawn."""
    from tallybuy.plans import models as plans

    monkeypatch.setattr(plans, "_labelled_features", lambda fx: rows)
    given = _asked(monkeypatch, "cross_validate")
    with pytest.raises(_Asked):
        plans._random_search(_Tables())
    assert (len(given["settings"]), given["n_folds"], given["patience"]) == (10, 5, 40)
    assert all(20 <= s["maxIter"] < 200 for s in given["settings"])
