"""Training, scoring and searching of purchase models with MLlib."""

from __future__ import annotations

import hashlib
import json
import math
import time
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

import numpy as np
from pyspark import SparkContext
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier, LogisticRegression
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import RobustScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.recommendation import ALS
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException
from pyspark.util import inheritable_thread_target

from tallybuy.operators import registry
from tallybuy.operators.blend import mean_per_pair, roc_area
from tallybuy.operators.factors import rounds_of_factors
from tallybuy.operators.joins import lookup
from tallybuy.operators.keys import dense_id_table
from tallybuy.operators.population import PAIR, mark_split, rows_of
from tallybuy.operators.population import first_per_pair, rows_to_score, training_rows
from tallybuy.operators.rounds import round_losses
from tallybuy.operators.scaling import reduce_dimension, robust_scale
from tallybuy.operators.selection import FeatureSelector
from tallybuy.operators.sparse import one_hot_vectors
from tallybuy.session import workspace, write_out

NOT_FEATURES = (
    "user_id", "seller_id", "user_seller", "label", "part", "weight", "is_valid",
    "item_id", "cat_id", "brand_id", "seller_brand", "seller_catalog",
)
# Columns a feature frame drops before training (the pair key stays).
USELESS = ("item_id", "cat_id", "brand_id", "seller_brand", "seller_catalog")


def drop_useless(rows: DataFrame) -> DataFrame:
    return rows.drop(*USELESS)


def feature_columns(df: DataFrame) -> list[str]:
    numeric = ("tinyint", "smallint", "int", "bigint", "float", "double", "boolean")
    return [c for c, kind in df.dtypes if c not in NOT_FEATURES and kind in numeric]


def fill_features(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """MLlib vectors take no NULLs: missing features count as zero."""
    rest = [F.col(c) for c in df.columns if c not in columns]
    return df.select(
        *rest, *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in columns]
    )


def balanced_weights(rows: DataFrame) -> DataFrame:
    """Weight of a row: n / (2 · rows of its class)."""
    sizes = rows.agg(F.count("label").alias("n"), F.count_if(F.col("label") == 1).alias("pos")).first()
    pos, neg = sizes["pos"], sizes["n"] - sizes["pos"]
    up = sizes["n"] / (2.0 * pos) if pos else 1.0
    down = sizes["n"] / (2.0 * neg) if neg else 1.0
    return rows.withColumn("weight", F.when(F.col("label") == 1, up).otherwise(down))


def class_weights(rows: DataFrame, negative: float = 0.05, positive: float = 0.95) -> DataFrame:
    return rows.withColumn("weight", F.when(F.col("label") == 1, positive).otherwise(negative))


def _trees(**params) -> GBTClassifier:
    return GBTClassifier(featuresCol="features", labelCol="label", **params)


# The settings of the three tree learners and the patience of the first two.
def histogram_trees(max_iter: int = 3000, seed: int = 0, **params) -> GBTClassifier:
    """Deep slow learner: depth 6, step 0.02, 63 bins."""
    settings = {"maxDepth": 6, "stepSize": 0.02, "maxBins": 63, "minInstancesPerNode": 500}
    return _trees(maxIter=max_iter, seed=seed, **{**settings, **params})


def sampled_trees(max_iter: int = 3000, seed: int = 0, **params) -> GBTClassifier:
    """Shallow fast learner on row and column samples: depth 3, step 0.8."""
    settings = {
        "maxDepth": 3, "stepSize": 0.8, "subsamplingRate": 0.8, "featureSubsetStrategy": "0.75",
        "minInstancesPerNode": 1000,
    }
    return _trees(maxIter=max_iter, seed=seed, **{**settings, **params})


def weighted_trees(max_iter: int = 1000, seed: int = 0, **params) -> GBTClassifier:
    """Trees on class-weighted rows: depth 8, step 0.01."""
    settings = {"maxDepth": 8, "stepSize": 0.01, "weightCol": "weight"}
    return _trees(maxIter=max_iter, seed=seed, **{**settings, **params})


PATIENCE = {0: 200, 1: 30}


def fit_with_patience(estimator, train: DataFrame, valid: DataFrame, patience: int | None, metric: str | None = None):
    """Boosted trees up to the round that is best on the valid rows by ``metric`` (see :func:`.rounds.round_losses`).

    Training ends once ``patience`` rounds bring nothing better, or with the
    estimator's budget; without patience the budget is used up. Rounds are fitted
    in doubling numbers: equal seeds give equal first trees, so a longer fit goes
    on where the shorter one ended.
    """
    _keep_lineage_short(train.sparkSession)
    budget = estimator.getMaxIter()
    if patience is None or valid.isEmpty():
        return estimator.fit(train)
    rounds = min(budget, max(20, patience + patience // 4))
    while True:
        model = estimator.copy({estimator.maxIter: rounds}).fit(train)
        best = int(np.argmin(round_losses(model, valid, metric)))
        if rounds == budget or rounds - 1 - best >= patience:
            break
        rounds = min(budget, 2 * rounds)
    return model if best + 1 == rounds else first_rounds(model, best + 1)


def first_rounds(model, rounds: int):
    """The model of the first ``rounds`` trees, as a fit with that budget gives it; nothing is fitted again.

    The number of features isn't known to it, so its importances end with the last feature in use.
    """
    context = SparkContext._active_spark_context
    jvm, new_array = context._jvm, context._gateway.new_array
    trees, weights = model._java_obj.trees(), model.treeWeights
    kept = new_array(jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, rounds)
    shares = new_array(jvm.double, rounds)
    for i in range(rounds):
        kept[i], shares[i] = trees[i], float(weights[i])
    if isinstance(model, GBTClassificationModel):
        build = jvm.org.apache.spark.ml.classification.GBTClassificationModel
    else:
        build = jvm.org.apache.spark.ml.regression.GBTRegressionModel
    return model._copyValues(type(model)(build(model.uid, kept, shares)), {model.maxIter: rounds})


def _keep_lineage_short(spark) -> None:
    """Boosting checkpoints every few rounds, if there is a folder for it."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(f"{workspace(spark)}/boosting")


def logistic(max_iter: int = 5000, seed: int = 0, **params) -> LogisticRegression:
    return LogisticRegression(
        featuresCol="features", labelCol="label", weightCol="weight", maxIter=max_iter, **params
    )


#: Numbers that one task sums up in a pass of the linear model: some 30 ms of work.
_NUMBERS_A_TASK = 4_000_000


def for_short_passes(vectors: DataFrame, width: int) -> DataFrame:
    """``vectors`` in no more partitions than their size is worth; all rows stay, none is moved.

    The linear model may pass over its rows thousands of times. The sums of a
    pass also take fewer stages from fewer partitions.
    """
    tasks = -(-vectors.count() * width // _NUMBERS_A_TASK)
    return vectors.coalesce(max(tasks, 1))


@dataclass(frozen=True)
class ModelKind:
    """How one family of models prepares its rows and builds its estimator."""

    estimator: Callable
    weigh: Callable[[DataFrame], DataFrame] | None = None
    scale: bool = False
    # Passes so short that on small tables their tasks take longer to start than to run.
    short_passes: bool = False


MODEL_KINDS: dict[int, ModelKind] = {
    0: ModelKind(histogram_trees),
    1: ModelKind(sampled_trees),
    2: ModelKind(logistic, weigh=balanced_weights, scale=True, short_passes=True),
    3: ModelKind(weighted_trees, weigh=class_weights),
}


def fit_model(rows: DataFrame, kind: int = 0, seed: int = 0, **params) -> PipelineModel:
    """Fit one model on rows marked ``part`` = train or valid.

    Trees stop early on the valid rows, with the patience of their kind; the
    linear model and the weighted trees see train rows only, and class weights
    balance the train rows.
    """
    family = MODEL_KINDS[kind]
    columns = feature_columns(rows)
    ready = fill_features(rows.where(F.col("part").isin("train", "valid")), columns)
    ready = write_out(ready.withColumn("label", F.col("label").cast("double")), "fit")
    train, valid = ready.where("part = 'train'"), ready.where("part = 'valid'")
    if family.weigh:
        train = family.weigh(train)
    stages: list = [VectorAssembler(inputCols=columns, outputCol="raw" if family.scale else "features")]
    if family.scale:
        stages.append(
            RobustScaler(
                lower=0.01, upper=0.99, withCentering=True, relativeError=1e-4,
                inputCol="raw", outputCol="features",
            )
        )
    prepare = Pipeline(stages=stages).fit(train)
    # Fitting passes over the rows many times.
    kept = ["features", "label", *(["weight"] if family.weigh else [])]
    vectors = write_out(prepare.transform(train).select(*kept), "fit-vectors")
    patience = params.pop("patience", PATIENCE.get(kind))
    estimator = family.estimator(seed=seed, **params)
    if kind in PATIENCE:
        checked = write_out(prepare.transform(valid).select("features", "label"), "valid-vectors")
        last = fit_with_patience(estimator, vectors, checked, patience)
    else:
        _keep_lineage_short(ready.sparkSession)
        last = estimator.fit(for_short_passes(vectors, len(columns)) if family.short_passes else vectors)
    return PipelineModel([*prepare.stages, last])


def score(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """Probability of the positive class for every row, label kept if there."""
    columns = model.stages[0].getInputCols()
    ready = fill_features(rows, columns)
    out = model.transform(ready).withColumn("prob", vector_to_array("probability")[1])
    kept = [c for c in (*PAIR, "label", "part") if c in rows.columns]
    return out.select(*kept, "prob")


def pair_scores(model: PipelineModel, rows: DataFrame) -> DataFrame:
    return mean_per_pair(score(model, rows))


def area_by_part(model: PipelineModel, rows: DataFrame) -> dict[str, float | None]:
    """Exact ROC area on each part of the rows."""
    scored = write_out(score(model, rows), "scored")
    parts = [r["part"] for r in scored.select("part").distinct().collect()]
    return {p: roc_area(scored.where(F.col("part") == p)).first()["auc"] for p in sorted(parts)}


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def score_with_saved(paths: Mapping[str, str], rows: DataFrame) -> DataFrame:
    """Scores of every saved model, with the model's name as ``run_id``."""
    out: DataFrame | None = None
    for name, path in paths.items():
        part = pair_scores(PipelineModel.load(path), rows).withColumn("run_id", F.lit(name))
        out = part if out is None else out.unionByName(part)
    if out is None:
        raise ValueError("no saved models given")
    return out


def tree_importances(
    rows: DataFrame, columns: Sequence[str], label: str, task: str, n_runs: int,
    early_stopping: bool = True, max_iter: int = 1000, step: float = 0.05, keys: Sequence[str] = PAIR,
    patience: int = 100, index: DataFrame | None = None, metric: str | None = None, side_by_side: int = 8,
    **params,
) -> dict[str, float]:
    """Mean feature importance of boosted trees over seeds 0 … n_runs − 1, ``side_by_side`` of them at a time.

    String columns among ``columns`` go in as sparse 0/1 positions by ``index``
    (:func:`.sparse.feature_index` of these columns); a column has the sum of its positions.
    """
    kinds = dict(rows.dtypes)
    numeric, strings = ([c for c in columns if (kinds[c] == "string") == text] for text in (False, True))
    usable = fill_features(rows, numeric).withColumn("label", F.col(label).cast("double"))
    # Rows without a key are told apart by an id written out with them.
    known = [k for k in keys if k in rows.columns] or ["_row"]
    usable = usable.withColumn("_row", F.monotonically_increasing_id())
    vectors = write_out(one_hot_vectors(usable, [*known, "label"], numeric, strings, index), "vectors")
    owner = [*numeric, *([strings[r["place"]] for r in index.select("place").orderBy("index").toLocalIterator()] if strings else [])]
    build = GBTClassifier if task == "classification" else GBTRegressor

    def run(seed: int) -> np.ndarray:
        settings = {"maxIter": max_iter, "stepSize": step, "seed": seed, **params}
        train, valid = vectors, vectors.limit(0)
        if early_stopping:
            chosen = F.pmod(F.xxhash64(*known, F.lit(f"importance/{seed}")), F.lit(100)) < 15
            train, valid = vectors.where(~chosen), vectors.where(chosen)
        model = fit_with_patience(build(**settings), train, valid, patience if early_stopping else None, metric)
        return model.featureImportances.toArray()

    spark = rows.sparkSession
    _keep_lineage_short(spark)
    total = np.zeros(len(owner))
    # Added up in the order of seeds, so that the sum doesn't depend on which run came first.
    with ThreadPoolExecutor(max(1, side_by_side)) as pool:
        for finished in [pool.submit(inheritable_thread_target(spark)(run), seed) for seed in range(n_runs)]:
            found = finished.result()
            total[: len(found)] += found
    out = dict.fromkeys(columns, 0.0)
    for column, value in zip(owner, (total / n_runs).tolist()):
        out[column] += value
    return out


def unimportant_columns(
    rows: DataFrame, n_runs: int = 6, cumulative: float = 0.99, share: float = 0.999, **training
) -> list[str]:
    """Columns with no or little importance for the label."""
    sample = mark_split(rows, share, "importance").where(F.col("part") == "train")
    columns = feature_columns(sample)
    selector = FeatureSelector(sample.select(*PAIR, "label", *columns), PAIR, "label")
    zero = selector.identify_zero_importance("classification", "auc", n_runs, **training)
    low = selector.identify_low_importance(cumulative)
    return sorted({*zero, *low})


@dataclass
class ScoreRuns:
    """Scores of repeated runs and the ROC areas each run reached."""

    scores: DataFrame
    areas: dict[int, dict[str, float | None]] = field(default_factory=dict)


def fit_score_runs(
    features: DataFrame,
    labelled: DataFrame,
    unlabelled: DataFrame,
    n_runs: int = 1,
    kind: int = 1,
    share: float = 0.85,
    select_features: bool = False,
    normalize: bool = False,
    reduce: bool = False,
    measure: bool = True,
    selection: Mapping | None = None,
    registered: str | None = None,
    **params,
) -> ScoreRuns:
    """Train on a fresh split and score the unlabelled pairs, ``n_runs`` times.

    Run *i* uses split and model seed *i*. The joined features are written out
    once and shared by all runs. ``registered`` names a folder for the models and their
    areas, see :mod:`.registry`.
    """
    rows = first_per_pair(drop_useless(features))
    if select_features:
        labelled_rows = rows_of(rows, labelled)
        rows = rows.drop(*unimportant_columns(labelled_rows, **(selection or {})))
    if normalize:
        rows = robust_scale(fill_features(rows, feature_columns(rows)))
    if reduce:
        rows = reduce_dimension(fill_features(rows, feature_columns(rows)))
    rows = write_out(rows, "features")
    to_score = write_out(rows_to_score(rows, unlabelled), "to-score")
    runs = ScoreRuns(scores=to_score)
    stacked: DataFrame | None = None
    for run in range(n_runs):
        keep = 0.5 if kind in (0, 1) else None
        marked = training_rows(rows, labelled, share, salt=run, keep=keep)
        model = fit_model(marked, kind, seed=run, **params)
        if measure:
            runs.areas[run] = area_by_part(model, marked)
        if registered:
            registry.register(
                rows.sparkSession, registered, f"kind{kind}-run{run}", model, kind, run, params, runs.areas.get(run)
            )
        part = pair_scores(model, to_score).withColumn("run_id", F.lit(run))
        stacked = part if stacked is None else stacked.unionByName(part)
    runs.scores = stacked
    return runs


# --- search -----------------------------------------------------------------


@dataclass(frozen=True)
class Draw:
    """A named distribution to draw one parameter from."""

    shape: str
    low: float
    high: float
    step: float = 1.0
    integer: bool = False

    def sample(self, rng: np.random.Generator) -> float | int:
        if self.shape == "uniform":
            value = rng.uniform(self.low, self.high)
        elif self.shape == "quniform":
            value = round(rng.uniform(self.low, self.high) / self.step) * self.step
        elif self.shape == "loguniform":
            value = math.exp(rng.uniform(math.log(self.low), math.log(self.high)))
        elif self.shape == "randint":
            value = rng.integers(int(self.low), int(self.high))
        elif self.shape == "beta":
            value = rng.beta(self.low, self.high)
        else:
            raise ValueError(f"unknown distribution {self.shape}")
        return int(value) if self.integer else float(value)


# Search spaces over the tree parameters MLlib has.
STAGED_SPACE = {
    "stepSize": Draw("loguniform", 0.01, 0.1),
    "maxBins": Draw("quniform", 5, 31, 1, integer=True),
    "minInstancesPerNode": Draw("loguniform", 1800, 10000, integer=True),
    "minInfoGain": Draw("loguniform", 0.1, 100),
    "featureSubsetStrategy": Draw("uniform", 0.3, 0.8),
    "maxDepth": Draw("quniform", 3, 5, 1, integer=True),
}
RANDOM_SPACE = {
    "maxIter": Draw("randint", 20, 200, integer=True),
    "maxDepth": Draw("randint", 1, 10, integer=True),
    "stepSize": Draw("uniform", 0.005, 0.505),
    "featureSubsetStrategy": Draw("beta", 10, 1),
    "subsamplingRate": Draw("beta", 10, 1),
    "minInfoGain": Draw("uniform", 0, 20),
    "minInstancesPerNode": Draw("uniform", 1, 500, integer=True),
}


def draw_settings(space: Mapping[str, Draw], n: int, seed: int = 50) -> list[dict]:
    rng = np.random.default_rng(seed)
    return [{name: d.sample(rng) for name, d in space.items()} for _ in range(n)]


_RESULT = "setting int, fold int, auc double, rounds int, seconds double"


def _search_id(rows: DataFrame, *parts) -> str:
    """Names a search by its settings and its rows, so that results of another one are never taken for its own."""
    print_of = rows.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64(*rows.columns)).alias("x")).first()
    text = json.dumps([*parts, print_of["n"], print_of["x"]], sort_keys=True, default=str)
    return hashlib.md5(text.encode()).hexdigest()


def _finished(spark, folder: str) -> DataFrame:
    """Results of (setting, fold) pairs so far; a pair whose write was lost has none."""
    try:
        return spark.read.schema(_RESULT).parquet(f"{folder}/*")
    except AnalysisException as missing:
        if "PATH_NOT_FOUND" not in str(missing):
            raise
        return spark.createDataFrame([], _RESULT)


def cross_validate(
    rows: DataFrame, settings: Sequence[dict], n_folds: int = 4, seed: int = 50,
    max_iter: int = 5000, patience: int = 40, store: str | None = None, side_by_side: int = 8,
) -> DataFrame:
    """Mean ROC area and loss of each parameter setting over the folds.

    A fold's trees stop early on the fold itself, at their best round.

    Rows are assembled and written out once; folds come from a key hash, so
    they do not change between attempts of a task. Each finished (setting, fold) is a file in
    ``store`` (by default a folder of the workspace named by rows and settings); a search that was
    broken off goes on with the rest. ``side_by_side`` fits run at a time: their
    jobs are small and mostly wait for one another.
    """
    spark = rows.sparkSession
    columns = feature_columns(rows)
    ready = fill_features(rows.where(F.col("label").isNotNull()), columns)
    fold = F.pmod(F.xxhash64(*PAIR, F.lit(f"fold/{seed}")), F.lit(n_folds)).cast("int")
    vectors = write_out(
        VectorAssembler(inputCols=columns, outputCol="features")
        .transform(ready.withColumn("label", F.col("label").cast("double")))
        .select(*PAIR, "features", "label", fold.alias("fold")),
        "folds",
    )
    known = ready.select(*PAIR, "label", *columns)
    root = store or f"{workspace(spark)}/searches"
    folder = f"{root}/{_search_id(known, list(settings), n_folds, seed, max_iter, patience)}"
    done = {(r["setting"], r["fold"]) for r in _finished(spark, folder).collect()}

    def run(job: tuple[int, int]) -> None:
        i, k = job
        began = time.monotonic()
        valid = vectors.where(F.col("fold") == k)
        trees = setting_trees(settings[i], max_iter, seed)
        model = fit_with_patience(trees, vectors.where(F.col("fold") != k), valid, patience)
        measure = BinaryClassificationEvaluator(labelCol="label", metricName="areaUnderROC")
        result = (i, k, float(measure.evaluate(model.transform(valid))), model.getNumTrees, time.monotonic() - began)
        spark.createDataFrame([result], _RESULT).coalesce(1).write.mode("overwrite").parquet(f"{folder}/{i}-{k}")

    todo = [(i, k) for i in range(len(settings)) for k in range(n_folds) if (i, k) not in done]
    _keep_lineage_short(spark)
    with ThreadPoolExecutor(max(1, side_by_side)) as pool:
        for finished in [pool.submit(inheritable_thread_target(spark)(run), job) for job in todo]:
            finished.result()
    # In the order of folds, so that a mean doesn't depend on which fold came first.
    area = F.aggregate(F.sort_array(F.collect_list(F.struct("fold", "auc"))), F.lit(0.0), lambda s, x: s + x["auc"]) / F.count("auc")
    names = spark.createDataFrame([(i, str(sorted(s.items()))) for i, s in enumerate(settings)], "setting int, params string")
    means = _finished(spark, folder).groupBy("setting").agg(area.alias("auc"))
    return names.join(F.broadcast(means), "setting").select("setting", "params", "auc", (1.0 - F.col("auc")).alias("loss"))


def setting_trees(chosen: Mapping, max_iter: int = 5000, seed: int = 50) -> GBTClassifier:
    """Boosted trees with drawn parameters; a drawn number of rounds is the budget."""
    named = {k: (str(v) if k == "featureSubsetStrategy" else v) for k, v in chosen.items()}
    return _trees(**{"maxIter": max_iter, "seed": seed, **named})


def fit_best(rows: DataFrame, settings: Sequence[dict], table: DataFrame, max_iter: int = 5000, seed: int = 50,
             patience: int = 40) -> tuple[PipelineModel, dict, float]:
    """Model of the best setting of a search on rows marked train and valid, its parameters and its ROC area there."""
    best = table.orderBy(F.desc("auc"), "setting").first()
    chosen = settings[best["setting"]]
    columns = feature_columns(rows)
    ready = fill_features(rows.where(F.col("part").isin("train", "valid")), columns)
    assembler = VectorAssembler(inputCols=columns, outputCol="features")
    vectors = write_out(
        assembler.transform(ready.withColumn("label", F.col("label").cast("double"))).select("part", "features", "label"), "best"
    )
    train, valid = vectors.where("part = 'train'"), vectors.where("part = 'valid'")
    model = fit_with_patience(setting_trees(chosen, max_iter, seed), train, valid, patience)
    return PipelineModel([assembler, model]), chosen, float(best["auc"])


def sampled_search(rows: DataFrame, n_settings: int = 15, seed: int = 50, **kw) -> DataFrame:
    """Draws from the staged space, four folds."""
    return cross_validate(rows, draw_settings(STAGED_SPACE, n_settings, seed), 4, seed, **kw)


def random_search(rows: DataFrame, n_settings: int = 10, seed: int = 0, **kw) -> DataFrame:
    """Draws from the random-search space, five folds."""
    return cross_validate(rows, draw_settings(RANDOM_SPACE, n_settings, seed), 5, seed, **kw)


def best_by_search(
    marked: DataFrame, space: Mapping[str, Draw], n_settings: int, n_folds: int, seed: int, max_iter: int = 5000,
    patience: int = 40, **kw,
) -> tuple[PipelineModel, dict, float]:
    """Search over the labelled rows, then the best setting fitted on those marked train and valid: model, setting, area."""
    settings = draw_settings(space, n_settings, seed)
    table = cross_validate(marked.drop("part"), settings, n_folds, seed, max_iter, patience, **kw)
    return fit_best(marked, settings, table, max_iter, seed, patience)


# --- factors ----------------------------------------------------------------


@dataclass(frozen=True)
class Factors:
    users: DataFrame
    sellers: DataFrame


#: Users of one block of a factorisation, and pairs of one block of sellers, at most about; MLlib's least number of blocks.
_BLOCK_USERS, _BLOCK_PAIRS, _LEAST_BLOCKS = 1 << 16, 1 << 18, 10


def factor_blocks(n_users: int, n_pairs: int) -> tuple[int, int]:
    """Blocks of users and of sellers.

    A task solves one block and holds the factors it meets: those of its users and of all sellers, or of
    the users behind its pairs. With a fixed number of blocks these would grow with the input.
    """
    return max(_LEAST_BLOCKS, -(-n_users // _BLOCK_USERS)), max(_LEAST_BLOCKS, -(-n_pairs // _BLOCK_PAIRS))


def pair_factors(
    counts: DataFrame, value: str = "counts", rank: int = 128, max_iter: int = 10, seed: int = 0
) -> Factors:
    """Non-negative user and seller factors of a (user, seller) count table.

    The fit of MLlib's ALS, with rounds of its own (:mod:`.factors`). 32-bit ids name rows there,
    hence the dense ids in between; the factor tables carry the raw ids again. Id tables are never broadcast.
    """
    counts = write_out(counts, "pair-counts")
    table = write_out(dense_id_table(counts, ["user_id", "seller_id"]), "dense-ids")
    users = table.where(F.col("column") == "user_id").drop("column")
    sellers = table.where(F.col("column") == "seller_id").drop("column")
    user_blocks, seller_blocks = factor_blocks(users.count(), counts.count())
    counts = lookup(
        counts, users.select(F.col("raw_id").alias("user_id"), F.col("dense_id").alias("u")), ["user_id"], "inner", grows=True
    )
    counts = lookup(
        counts, sellers.select(F.col("raw_id").alias("seller_id"), F.col("dense_id").alias("s")), ["seller_id"], "inner", grows=True
    )
    rated = F.col(value).cast("float")
    rated = F.when(rated.isNull() | F.isnan(rated), F.raise_error(F.lit("a pair has no value"))).otherwise(rated)
    indexed = write_out(counts.select(F.col("u").cast("int"), F.col("s").cast("int"), rated.alias("v")), "indexed-pairs")
    _keep_lineage_short(counts.sparkSession)
    # Without rounds it gives the factors that a fit with this seed begins with.
    begun = ALS(
        rank=rank, maxIter=0, implicitPrefs=True, nonnegative=True, seed=seed,
        userCol="u", itemCol="s", ratingCol="v", numUserBlocks=user_blocks, numItemBlocks=seller_blocks,
    ).fit(indexed)
    of_users, of_sellers = rounds_of_factors(indexed, begun.userFactors, user_blocks, seller_blocks, rank, max_iter)

    def raw(factors: DataFrame, ids: DataFrame, key: str) -> DataFrame:
        named = factors.select(F.col("id").cast("bigint").alias("dense_id"), "features")
        return named.join(ids.hint("merge"), "dense_id").select(
            F.col("raw_id").alias(key),
            *[F.col("features")[i].cast("double").alias(f"{i}") for i in range(rank)],
        )

    return Factors(raw(of_users, users, "user_id"), raw(of_sellers, sellers, "seller_id"))
