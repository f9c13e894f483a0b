"""Feature selection: missing, constant, collinear, unimportant columns.

A selector runs statistics jobs over the whole frame; what reaches the driver
is at most a few numbers per column or column pair. Removing columns is then a
plain projection.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybuy.functions.ordering import running_totals
from tallybuy.operators import correlation, sparse
from tallybuy.operators.joins import lookup
from tallybuy.operators.keys import one_hot_strings
from tallybuy.operators.rounds import check_metric
from tallybuy.session import write_out

METHODS = ("missing", "single_unique", "collinear", "zero_importance", "low_importance")
#: Values of string columns that get a column each; more stay in sparse form.
MOST_WIDE = 1000


def _present(c: str) -> Column:
    """The column with NaN read as missing."""
    return F.col(f"`{c}`")


def _numeric(df: DataFrame, columns: Sequence[str]) -> list[str]:
    plain = ("tinyint", "smallint", "int", "bigint", "float", "double", "boolean")
    kinds = dict(df.dtypes)
    return [c for c in columns if kinds[c] in plain or kinds[c].startswith("decimal")]


def nan_to_null(df: DataFrame) -> DataFrame:
    return df.select(
        *[
            F.nanvl(f"`{c}`", F.lit(None)).alias(c) if kind in ("float", "double") else F.col(f"`{c}`")
            for c, kind in df.dtypes
        ]
    )


def missing_fractions(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(feature, missing_fraction)`` for all columns from one pass."""
    rows = F.count(F.lit(1))
    wide = df.agg(
        *[(1.0 - F.try_divide(F.count(_present(c)), rows)).alias(c) for c in columns]
    )
    return wide.unpivot([], list(columns), "feature", "missing_fraction")


def _families(df: DataFrame, columns: Sequence[str]) -> list[tuple[str, list[str]]]:
    """Columns by the type their values share a column in: whole numbers, doubles, and each other type by itself."""
    whole = ("tinyint", "smallint", "int", "bigint")
    kinds = dict(df.dtypes)
    out: dict[str, list[str]] = {}
    for c in columns:
        kind = "bigint" if kinds[c] in whole else "double" if kinds[c] in ("float", "double") else kinds[c]
        out.setdefault(kind, []).append(c)
    return list(out.items())


def distinct_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(feature, nunique)``, NULLs not counted; columns without values give 0.

    Values are compared in their own type. Those of columns with a common type go through one shuffle.
    """
    out = None
    for kind, names in _families(df, columns):
        held = df.select(*[(F.lit(None).cast("int") if kind == "void" else _present(c).cast(kind)).alias(c) for c in names])
        cells = held.unpivot([], names, "feature", "value").distinct()
        part = cells.groupBy("feature").agg(F.count("value").alias("nunique"))
        out = part if out is None else out.unionByName(part)
    return out


def distinct_sketches(df: DataFrame, columns: Sequence[str], by: Sequence[str] = (), lg_size: int = 14) -> DataFrame:
    """``(by..., feature, sketch)``: a sketch of the distinct values of each column, kept for each ``by`` (a day, say).

    Sketches are a few KB, can be stored, and merge without the rows, see :func:`merged_distinct`. The
    error of a count is about 1.04 / sqrt(2 ** lg_size), 0.8 % by default.
    """
    def hashable(c: str) -> Column:
        kind = dict(df.dtypes)[c]
        return _present(c) if kind in ("int", "bigint", "string", "binary") else _present(c).cast("string")

    wide = df.groupBy(*by).agg(*[F.hll_sketch_agg(hashable(c), F.lit(lg_size)).alias(f"s{k}") for k, c in enumerate(columns)])
    held = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"s{k}").alias("sketch")) for k, c in enumerate(columns)])
    return wide.select(*by, F.explode(held).alias("_c")).select(*by, "_c.feature", "_c.sketch").where(F.col("sketch").isNotNull())


def merged_distinct(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``(by..., feature, estimate)`` from stored sketches, merged over all else."""
    merged = sketches.groupBy(*by, "feature").agg(F.hll_union_agg("sketch").alias("sketch"))
    return merged.select(*by, "feature", F.hll_sketch_estimate("sketch").alias("estimate"))


def single_valued(df: DataFrame, columns: Sequence[str]) -> list[str]:
    """Columns with exactly one distinct value, without counting distinct values."""
    found = df.agg(
        *[
            F.coalesce(F.min(_present(c)) == F.max(_present(c)), F.lit(False)).alias(c)
            for c in columns
        ]
    ).first()
    return [c for c in columns if found[c]]


def correlation_pairs(df: DataFrame, columns: Sequence[str], threshold: float | None = None) -> DataFrame:
    """``(feature, earlier_feature, r)`` of the numeric columns among ``columns``, see :mod:`.correlation`."""
    return correlation.correlation_pairs(df, _numeric(df, columns), threshold)


def collinear_pairs(df: DataFrame, columns: Sequence[str], threshold: float) -> DataFrame:
    """Pairs beyond the threshold: the later column of each goes."""
    return _as_drops(correlation_pairs(df, columns, threshold))


def _as_drops(pairs: DataFrame) -> DataFrame:
    return pairs.select(
        F.col("feature").alias("drop_feature"),
        F.col("earlier_feature").alias("corr_feature"),
        F.col("r").alias("corr_value"),
    )


def cumulative_importance(importances: DataFrame) -> DataFrame:
    """Add the normalised importance and its running sum, largest first, equals by name.

    Features may be many (users, say), so the sum runs over slices, without a one-task window.
    """
    kept = write_out(importances.select("feature", F.col("importance")), "importances")
    whole = kept.agg(F.sum("importance").alias("s")).first()["s"]
    share = F.try_divide("importance", F.lit(whole).cast("double"))
    shares = kept.select("feature", "importance", share.alias("normalized_importance"), (-F.col("importance")).alias("_down"))
    ordered = running_totals(shares, [], ["_down", "feature"], {"cumulative_importance": F.col("normalized_importance")})
    return ordered.drop("_down")


def low_importance(importances: DataFrame, cumulative: float) -> DataFrame:
    """Features behind the point where the running sum passes ``cumulative``."""
    return cumulative_importance(importances).where(F.col("cumulative_importance") > cumulative)


class FeatureSelector:
    """Collects columns to drop method by method, then removes them.

    ``keys`` (and ``label``) stay in the frame and are never candidates.
    """

    def __init__(
        self, data: DataFrame, keys: Sequence[str] = (), label: str | None = None, most_wide: int = MOST_WIDE
    ) -> None:
        self.data = data
        self.keys = list(keys)
        self.label = label
        fixed = {*self.keys, label}
        self.features = [c for c in data.columns if c not in fixed]
        self.ops: dict[str, list[str]] = {}
        self.missing_stats: DataFrame | None = None
        self.unique_stats: DataFrame | None = None
        self.record_collinear: DataFrame | None = None
        self.feature_importances: DataFrame | None = None
        self.encoded: DataFrame | None = None
        self.one_hot_features: list[str] = []
        self.dropped_values: DataFrame | None = None
        self.most_wide = most_wide
        self._one_hot_correlated = False
        self._index: DataFrame | None = None
        self._wide: bool | None = None

    @property
    def strings(self) -> list[str]:
        kinds = dict(self.data.dtypes)
        return [c for c in self.features if kinds[c] == "string"]

    def value_index(self) -> DataFrame:
        """Values of the string features, numbered, see :func:`.sparse.feature_index`."""
        if self._index is None:
            self._index = sparse.feature_index(self.data, self.strings)
        return self._index

    def _is_wide(self) -> bool:
        """Whether there are too many values to give each a column; results are the same either way."""
        if self._wide is None:
            self._wide = bool(self.strings) and self.value_index().count() > self.most_wide
        return self._wide

    def _encode(self) -> DataFrame:
        """The data with 0/1 columns of its string features in front of them, unless they are too many."""
        if self.encoded is None and self._is_wide():
            self.encoded = self.data
        if self.encoded is None:
            domains: dict[str, list[str]] = {c: [] for c in self.strings}
            if self.strings:
                for r in self.value_index().orderBy("index").collect():  # at most `most_wide` rows
                    domains[self.strings[r["place"]]].append(r["value"])
            wide = one_hot_strings(self.data, domains)
            self.one_hot_features = [c for c in wide.columns if c not in self.data.columns]
            self.encoded = wide.select(
                *self.keys, *self.one_hot_features, *self.features,
                *([self.label] if self.label else []),
            )
        return self.encoded

    def _model_columns(self) -> list[str]:
        """Numeric features and 0/1 columns; of too many values, their string columns."""
        wide = self._encode()
        return _numeric(wide, self.features) + (self.strings if self._is_wide() else self.one_hot_features)

    def identify_missing(self, threshold: float) -> list[str]:
        stats = missing_fractions(nan_to_null(self.data), self.features)
        self.missing_stats = stats.orderBy(F.desc("missing_fraction"), "feature")
        found = {r["feature"] for r in stats.where(F.col("missing_fraction") > threshold).collect()}
        self.ops["missing"] = [c for c in self.features if c in found]
        return self.ops["missing"]

    def identify_single_unique(self) -> list[str]:
        clean = nan_to_null(self.data)
        self.unique_stats = distinct_counts(clean, self.features).orderBy("nunique", "feature")
        self.ops["single_unique"] = single_valued(clean, self.features)
        return self.ops["single_unique"]

    def identify_collinear(self, threshold: float, one_hot: bool = False) -> list[str]:
        """Later columns of pairs beyond the threshold.

        With ``one_hot`` also among 0/1 columns of strings. Where these are too many for
        columns, ``dropped_values`` has those that go, and the list only the others.
        """
        self._one_hot_correlated = one_hot
        clean = nan_to_null(self.data)
        if one_hot and self._is_wide():
            columns = _numeric(clean, self.features)
            pairs = _as_drops(
                correlation.sparse_correlations(clean, columns, self.strings, threshold, self.value_index())
            )
            pairs = write_out(pairs, "collinear")
            values = self.value_index().select(F.col("feature").alias("drop_feature"))
            self.dropped_values = lookup(pairs.select("drop_feature").distinct(), values, ["drop_feature"], "left_semi")
            pairs_of_columns = pairs.where(F.col("drop_feature").isin(columns))
        else:
            columns = self._model_columns() if one_hot else self.features
            pairs = collinear_pairs(nan_to_null(self._encode()) if one_hot else clean, columns, threshold)
            pairs_of_columns = pairs
        self.record_collinear = pairs
        found = {r["drop_feature"] for r in pairs_of_columns.select("drop_feature").distinct().collect()}
        self.ops["collinear"] = [c for c in columns if c in found]
        return self.ops["collinear"]

    def identify_zero_importance(
        self, task: str, eval_metric: str | None = None, n_iterations: int = 10,
        early_stopping: bool = True, **training,
    ) -> list[str]:
        """Columns no boosted tree used, over ``n_iterations`` seeds.

        With early stopping, a run ends at the round that is best by ``eval_metric``
        (see :func:`.rounds.round_losses`) on the rows it holds out.
        """
        from tallybuy.operators.models import tree_importances

        if early_stopping and eval_metric is None:
            raise ValueError("early stopping needs an eval_metric, e.g. 'auc' or 'l2'")
        if self.label is None:
            raise ValueError("no label column given")
        if task not in ("classification", "regression"):
            raise ValueError("task must be 'classification' or 'regression'")
        check_metric(task, eval_metric)
        columns = self._model_columns()
        wide = self._encode().where(F.col(self.label).isNotNull())
        index = self.value_index() if self._is_wide() else None
        mean = tree_importances(
            wide, columns, self.label, task, n_iterations, early_stopping, index=index, metric=eval_metric, **training
        )
        rows = [(c, float(v)) for c, v in mean.items()]
        table = self.data.sparkSession.createDataFrame(rows, "feature string, importance double")
        self.feature_importances = cumulative_importance(table)
        self.ops["zero_importance"] = [c for c in columns if mean[c] == 0.0]
        return self.ops["zero_importance"]

    def identify_low_importance(self, cumulative: float) -> list[str]:
        if self.feature_importances is None:
            raise NotImplementedError("run identify_zero_importance first")
        tail = self.feature_importances.where(F.col("cumulative_importance") > cumulative)
        found = {r["feature"] for r in tail.select("feature").collect()}
        self.ops["low_importance"] = [c for c in self._model_columns() if c in found]
        return self.ops["low_importance"]

    def identify_all(self, params: dict) -> list[str]:
        needed = (
            "missing_threshold", "correlation_threshold", "eval_metric", "task",
            "cumulative_importance",
        )
        for name in needed:
            if name not in params:
                raise ValueError(f"identify_all needs {name}")
        self.identify_missing(params["missing_threshold"])
        self.identify_single_unique()
        self.identify_collinear(params["correlation_threshold"])
        extra = {k: v for k, v in params.items() if k not in needed}
        self.identify_zero_importance(params["task"], params["eval_metric"], **extra)
        self.identify_low_importance(params["cumulative_importance"])
        return self.check_removal()

    def check_removal(self, keep_one_hot: bool = True) -> list[str]:
        """All columns identified so far; without ``keep_one_hot`` with all 0/1 columns of strings."""
        found = {c for dropped in self.ops.values() for c in dropped}
        return sorted(found if keep_one_hot else found | set(self.one_hot_features))

    def removable_one_hot(self) -> int:
        """How many 0/1 columns of strings would go by ``keep_one_hot=False`` over those identified so far."""
        found = {c for dropped in self.ops.values() for c in dropped}
        if not self._is_wide():
            self._encode()
            return len(set(self.one_hot_features) - found)
        gone = 0 if self.dropped_values is None else self.dropped_values.count()
        return self.value_index().count() - gone

    def remove(self, methods: Sequence[str] | str, keep_one_hot: bool = True) -> DataFrame:
        chosen = list(self.ops) if methods == "all" else list(methods)
        for m in chosen:
            if m not in self.ops:
                raise NotImplementedError(f"nothing identified by {m} yet")
        on_encoded = methods == "all" or self._one_hot_correlated
        on_encoded = on_encoded or bool({"zero_importance", "low_importance"} & set(chosen))
        frame = self.encoded if on_encoded and self.encoded is not None else self.data
        dropped = {c for m in chosen for c in self.ops[m]}
        if not keep_one_hot:
            dropped |= set(self.one_hot_features)
        return frame.select(*[F.col(f"`{c}`") for c in frame.columns if c not in dropped])
