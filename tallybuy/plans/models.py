"""Model fits, searches and factor tables over the training frame.

Fits have no SQL twin; ``*_check`` queries say in SQL terms whether a fit is what it
claims to be. All run over whole tables. Boosted trees have a smaller budget of rounds
here than the defaults of the functions, and leaves of five rows, as the fixtures have a few
hundred labelled pairs; searches have fewer settings. README has the times of the defaults.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tallybuy import schemas
from tallybuy.operators import models, optimality, registry
from tallybuy.operators.blend import roc_area
from tallybuy.operators.keys import with_action
from tallybuy.operators.population import first_per_pair, rows_of, rows_to_score, training_rows
from tallybuy.operators.profiles import implicit_matrix, rows_per
from tallybuy.operators.scaling import reduce_dimension
from tallybuy.operators.selection import FeatureSelector
from tallybuy.plans.assembly import training_frame
from tallybuy.plans.catalogue import query
from tallybuy.plans.populations import PART_SQL
from tallybuy.plans.sql import over
from tallybuy.session import workspace, write_out

_ROUNDS = {"max_iter": 60, "minInstancesPerNode": 5}
_SEARCH = {"max_iter": 40, "patience": 10}


def _features(fx):
    return write_out(first_per_pair(models.drop_useless(training_frame(fx))), "training")


def _scores(fx, kind: int, **params):
    fx = fx.stored()
    rows = _features(fx)
    marked = training_rows(rows, fx.labelled(), keep=0.5)
    model = models.fit_model(marked, kind, **params)
    return models.pair_scores(model, rows_to_score(rows, fx.unlabelled()))


@query("train_rows")
def _train_rows(fx):
    fx = fx.stored()
    return training_rows(_features(fx), fx.labelled(), keep=0.5)


@query("train_parts", over("labelled", body=f"SELECT *, {PART_SQL} AS part FROM labelled"))
def _train_parts(fx):
    fx = fx.stored()
    marked = training_rows(_features(fx), fx.labelled(), keep=0.5)
    return marked.select("user_id", "seller_id", "label", "part")


@query("gbt_scores")
def _gbt_scores(fx):
    return _scores(fx, 0, **_ROUNDS)


@query("gbt_scores_sampled")
def _gbt_scores_sampled(fx):
    return _scores(fx, 1, **_ROUNDS)


@query("lr_scores")
def _lr_scores(fx):
    return _scores(fx, 2)


@query("gbt_scores_weighted")
def _gbt_scores_weighted(fx):
    return _scores(fx, 3, max_iter=20)


@query("score_runs")
def _score_runs(fx):
    fx = fx.stored()
    runs = models.fit_score_runs(
        training_frame(fx), fx.labelled(), fx.unlabelled(), n_runs=2, kind=1, measure=False, **_ROUNDS
    )
    return runs.scores


@query("score_runs_reduced")
def _score_runs_reduced(fx):
    fx = fx.stored()
    runs = models.fit_score_runs(
        training_frame(fx), fx.labelled(), fx.unlabelled(), n_runs=1, kind=2, reduce=True,
        measure=False,
    )
    return runs.scores


def _registered(fx, rows, kinds: dict[int, dict]) -> str:
    """A registry of one model of each kind, with its ROC areas."""
    root = f"{workspace(fx.spark)}/registry-{uuid.uuid4().hex}"
    marked = write_out(training_rows(rows, fx.labelled(), keep=0.5), "marked")
    for kind, params in kinds.items():
        model = models.fit_model(marked, kind, **params)
        areas = models.area_by_part(model, marked)
        registry.register(fx.spark, root, f"kind{kind}", model, kind, 0, params, areas)
    return root


@query("restored_scores")
def _restored_scores(fx):
    """Scores of registered models with the areas that were kept with them."""
    fx = fx.stored()
    rows = _features(fx)
    root = _registered(fx, rows, {1: _ROUNDS, 2: {}})
    return registry.score_with_registered(fx.spark, root, rows_to_score(rows, fx.unlabelled()))


@query(
    "registered_areas",
    over(
        "labelled",
        parts=f"SELECT {PART_SQL} AS part, label FROM labelled",
        kinds="SELECT 'kind' || k AS run_id FROM (VALUES (0), (1), (2), (3)) AS t(k)",
        body="""SELECT run_id, part, count(*) AS n, count(*) FILTER (label = 1) AS n_pos, true AS agrees, true AS in_range
                FROM parts CROSS JOIN kinds GROUP BY run_id, part""",
    ),
)
def _registered_areas(fx):
    """Each kind of model restored and scored again: the areas of its scores are those in the registry."""
    fx = fx.stored()
    rows = _features(fx)
    small = {"max_iter": 10, "minInstancesPerNode": 5}
    root = _registered(fx, rows, {0: small, 1: small, 2: {"max_iter": 50}, 3: {"max_iter": 5}})
    known = {r["name"]: r for r in registry.entries(fx.spark, root).collect()}
    marked = write_out(training_rows(rows, fx.labelled(), keep=0.5), "marked")
    out = []
    for name, model in registry.restore(fx.spark, root, F.col("name").startswith("kind")).items():
        scored = write_out(models.score(model, marked), "restored")
        facts = scored.groupBy("part").agg(
            F.count(F.lit(1)).alias("n"), F.count_if(F.col("label") == 1).alias("n_pos"), F.min(F.col("prob").between(0, 1)).alias("ok")
        )
        for r in facts.collect():
            area = roc_area(scored.where(F.col("part") == r["part"])).first()["auc"]
            kept = known[name][f"auc_{r['part']}"]
            agrees = area is None and kept is None or abs(area - kept) < 1e-9
            out.append((name, r["part"], r["n"], r["n_pos"], agrees, r["ok"]))
    return fx.spark.createDataFrame(out, "run_id string, part string, n bigint, n_pos bigint, agrees boolean, in_range boolean")


@query(
    "score_runs_checked",
    over("unlabelled", body="SELECT r.run_id, user_id, seller_id, true AS in_range FROM unlabelled CROSS JOIN (VALUES (0), (1)) AS r(run_id)"),
)
def _score_runs_checked(fx):
    """Two runs on selected and normalised features: every unlabelled pair has one score from 0 to 1 in each."""
    fx = fx.stored()
    runs = models.fit_score_runs(
        training_frame(fx), fx.labelled(), fx.unlabelled(), n_runs=2, kind=2, select_features=True, normalize=True, measure=False,
        selection={"n_runs": 1, "max_iter": 20, "patience": 10}, max_iter=50,
    )
    return runs.scores.select("run_id", "user_id", "seller_id", F.col("prob").between(0, 1).alias("in_range"))


@query("model_areas")
def _model_areas(fx):
    fx = fx.stored()
    rows = _features(fx)
    marked = training_rows(rows, fx.labelled(), keep=0.5)
    areas = models.area_by_part(models.fit_model(marked, 1, **_ROUNDS), marked)
    return fx.spark.createDataFrame(list(areas.items()), "part string, auc double")


def _labelled_features(fx):
    fx = fx.stored()
    return rows_of(_features(fx), fx.labelled())


@query("cv_search")
def _cv_search(fx):
    return models.sampled_search(_labelled_features(fx), n_settings=2, **_SEARCH)


@query("random_search")
def _random_search(fx):
    return models.random_search(_labelled_features(fx))


@query("best_of_search")
def _best_of_search(fx):
    """The best of all fifteen drawn settings, fitted and scored; where that search was run before, its results are taken up."""
    fx = fx.stored()
    rows = _features(fx)
    marked = training_rows(rows, fx.labelled(), keep=0.5)
    model, _, area = models.best_by_search(marked, models.STAGED_SPACE, 15, 4, 50)
    return models.pair_scores(model, rows_to_score(rows, fx.unlabelled())).withColumn("search_auc", F.lit(area))


@query("zero_importance")
def _zero_importance(fx):
    rows = _labelled_features(fx)
    selector = FeatureSelector(
        rows.select(*models.PAIR, "label", *models.feature_columns(rows)), models.PAIR, "label"
    )
    selector.identify_zero_importance("classification", "auc", n_iterations=2, max_iter=40)
    return selector.feature_importances


@query("important_features")
def _important_features(fx):
    rows = _labelled_features(fx)
    return rows.drop(*models.unimportant_columns(rows))


@query("select_all_methods")
def _select_all_methods(fx):
    rows = _labelled_features(fx)
    selector = FeatureSelector(
        rows.select(*models.PAIR, "label", *models.feature_columns(rows)), models.PAIR, "label"
    )
    selector.identify_all(
        {
            "missing_threshold": 0.9, "correlation_threshold": 0.98, "eval_metric": "auc",
            "task": "classification", "cumulative_importance": 0.99, "n_iterations": 2, "max_iter": 40,
        }
    )
    return selector.remove("all")


@query("pca_reduced")
def _pca_reduced(fx):
    rows = _features(fx.stored())
    columns = models.feature_columns(rows)
    return reduce_dimension(models.fill_features(rows.select(*models.PAIR, "label", *columns), columns))


def _buys(fx):
    return rows_per(with_action(fx.log(), schemas.BUY), ["user_id", "seller_id"], "counts")


@query(
    "lr_check",
    over("labelled", parts=f"SELECT {PART_SQL} AS part FROM labelled",
         body="SELECT count(*) FILTER (part = 'train') AS n_rows, true AS fitted, 0 AS n_steep FROM parts"),
)
def _lr_check(fx):
    """The gradient of the weighted log loss at the solution: no position is steep against its terms."""
    fx = fx.stored()
    marked = training_rows(_features(fx), fx.labelled(), keep=0.5)
    model = models.fit_model(marked, 2)
    columns = models.feature_columns(marked)
    train = models.balanced_weights(models.fill_features(marked.where("part = 'train'"), columns))
    train = write_out(train.withColumn("label", F.col("label").cast("double")), "train")
    slopes = optimality.logistic_gradient(model, train)
    steep = F.count_if(F.abs("gradient") > 0.02 * F.col("scale") + 1e-6)
    return slopes.agg(
        F.lit(train.count()).cast("bigint").alias("n_rows"), (F.count(F.lit(1)) == len(columns) + 1).alias("fitted"), steep.cast("int").alias("n_steep")
    )


@query(
    "pca_check",
    over("pairs", body="SELECT count(*) AS n_rows, 0 AS n_correlated, 0 AS n_out_of_order FROM pairs"),
)
def _pca_check(fx):
    """Components have no covariance with one another, and their variances fall."""
    rows = _features(fx.stored())
    columns = models.feature_columns(rows)
    reduced = write_out(
        reduce_dimension(models.fill_features(rows.select(*models.PAIR, "label", *columns), columns)), "reduced"
    )
    names = [c for c in reduced.columns if c.startswith("pc")]
    variances = reduced.agg(*[F.var_samp(c).alias(c) for c in names]).first()
    largest = max(variances) or 0.0
    pairs = optimality.component_covariances(reduced, names)
    falling = sum(a < b - 1e-9 * largest for a, b in zip(variances, variances[1:]))
    return pairs.agg(
        F.lit(reduced.count()).cast("bigint").alias("n_rows"),
        F.count_if(F.abs("covariance") > 1e-8 * largest).cast("int").alias("n_correlated"),
        F.lit(falling).alias("n_out_of_order"),
    )


@query(
    "als_check",
    over("acts", body="SELECT DISTINCT user_id, true AS non_negative, true AS stationary FROM acts WHERE action_type = 2"),
)
def _als_check(fx):
    """Each user's factors are the best non-negative ones, given those of the sellers."""
    counts = write_out(_buys(fx), "buys")
    factors = models.pair_factors(counts)
    users, sellers = write_out(factors.users, "user-factors"), write_out(factors.sellers, "seller-factors")
    checked = optimality.factor_stationarity(counts, users, sellers, "user_id")
    return checked.select(
        "user_id", (F.col("smallest") >= 0).alias("non_negative"), (F.col("worst") <= 1e-3 * F.col("scale")).alias("stationary")
    )


@query("als_factors")
def _als_factors(fx):
    return models.pair_factors(_buys(fx)).users


@query("als_seller_factors")
def _als_seller_factors(fx):
    return models.pair_factors(_buys(fx)).sellers


@query("als_binary_factors")
def _als_binary_factors(fx):
    marked = implicit_matrix(fx.format2()).withColumnRenamed("merchant_id", "seller_id")
    return models.pair_factors(marked.where(F.col("value") > 0), "value").users
