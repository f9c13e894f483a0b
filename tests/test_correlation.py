"""Tiles of sums, and correlations of 0/1 columns that are never made."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallybuy.operators import correlation, keys, selection, sparse


def _frame(spark, n=240, p=11, seed=4):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 3)) @ rng.normal(size=(3, p)) + rng.normal(size=(n, p)) * 0.4
    x[:, 5] = 2.0
    gone = rng.random((n, p)) < 0.15
    rows = [[None if g else float(v) for v, g in zip(a, b)] for a, b in zip(x, gone)]
    names = [f"f {k}" for k in range(p)]
    return spark.createDataFrame(rows, ", ".join(f"`{c}` double" for c in names)).repartition(7), names, np.where(gone, np.nan, x)


def _want(x, names):
    out = {}
    for j in range(len(names)):
        for i in range(j):
            there = ~np.isnan(x[:, i]) & ~np.isnan(x[:, j])
            a, b = x[there, i], x[there, j]
            out[names[j], names[i]] = None if a.std() < 1e-9 or b.std() < 1e-9 else float(np.corrcoef(a, b)[0, 1])
    return out


@pytest.mark.parametrize("tile, pass_bytes", [(128, 1 << 25), (4, 1 << 25), (3, 1)])
def test_tiles_match_numpy(spark, tile, pass_bytes):
    df, names, x = _frame(spark)
    want = _want(x, names)
    got = {(r.feature, r.earlier_feature): r.r for r in correlation.correlation_pairs(df, names, None, tile, pass_bytes).collect()}
    assert set(got) == set(want)
    for pair, r in want.items():
        assert (got[pair] is None) == (r is None) and (r is None or abs(got[pair] - r) < 1e-9)
    over = {(r.feature, r.earlier_feature) for r in correlation.correlation_pairs(df, names, 0.6, tile, pass_bytes).collect()}
    assert over == {pair for pair, r in want.items() if r is not None and abs(r) > 0.6}


def test_shuffled_rows_are_tasks_times_tiles(spark):
    df, names, x = _frame(spark)
    tiles = [t for group in correlation._passes(len(names), 4, 1 << 25) for t in group]
    assert len(tiles) == 6
    values = df.select(*[F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(names)])
    sums = correlation.tile_sums(values, np.zeros(len(names)), tiles, 4)
    assert sums.count() <= 7 * 6
    lanes = correlation.folded(sums).groupBy("a", "b").count().agg(F.max("count")).first()[0]
    assert lanes <= math.isqrt(7) + 1


def _dense(df, numeric, strings, threshold):
    wide = keys.one_hot_strings(df.select(*numeric, *strings))
    names = [*numeric, *[f"{c}_{v}" for c, values in keys.string_domains(df.select(*strings)).items() for v in values]]
    found = correlation.correlation_pairs(wide, names, threshold).collect()
    return {(r.feature, r.earlier_feature): r.r for r in found}


@pytest.mark.parametrize("threshold", [0.05, 0.3, 0.9])
def test_sparse_equals_dense(spark, threshold):
    rng = np.random.default_rng(6)
    rows = []
    for _ in range(300):
        a = str(rng.choice(["x", "y", "z"], p=[0.6, 0.38, 0.02]))
        b = {"x": "left", "y": "right", "z": None}[a] if rng.random() < 0.95 else "other"
        rows.append((a, b, "always", float(rng.normal() + (a == "y")), None if rng.random() < 0.2 else float(rng.normal())))
    df = spark.createDataFrame(rows, "a string, b string, c string, n double, m double").repartition(5)
    want = _dense(df, ["n", "m"], ["a", "b", "c"], threshold)
    got = {(r.feature, r.earlier_feature): r.r for r in correlation.sparse_correlations(df, ["n", "m"], ["a", "b", "c"], threshold).collect()}
    assert set(got) == set(want) and all(abs(got[k] - want[k]) < 1e-9 for k in want)


def test_domain_of_a_hundred_thousand_values(spark):
    n = 100_000
    df = spark.range(n).select(
        F.concat(F.lit("v"), "id").alias("key"), F.when(F.col("id") % 2 == 0, "even").otherwise("odd").alias("half"),
        (F.col("id") % 2).cast("double").alias("bit"), F.col("id"),
    )
    cells = sparse.one_hot_cells(df, ["id"], ["key", "half"])
    assert cells.count() == 2 * n and cells.agg(F.countDistinct("index")).first()[0] == n + 2
    got = {(r.feature, r.earlier_feature, round(r.r, 9)) for r in correlation.sparse_correlations(df, ["bit"], ["key", "half"], 0.5).collect()}
    assert got == {("half_odd", "half_even", -1.0), ("half_even", "bit", -1.0), ("half_odd", "bit", 1.0)}
    selector = selection.FeatureSelector(df, ["id"])
    assert selector.identify_collinear(0.5, one_hot=True) == []
    assert sorted(r[0] for r in selector.dropped_values.collect()) == ["half_even", "half_odd"]
    assert selector.removable_one_hot() == n and selector.remove("all").columns == ["key", "half", "bit", "id"]


def test_one_hot_vectors(spark):
    df = spark.createDataFrame([(1, "a", None, 2.0), (2, None, "q", None), (3, "b", "p", 5.0)], "k int, s string, t string, x double")
    got = {r.k: r.features.toArray().tolist() for r in sparse.one_hot_vectors(df, ["k"], ["x"], ["s", "t"]).collect()}
    assert got == {1: [2, 1, 0, 0, 0], 2: [0, 0, 0, 0, 1], 3: [5, 0, 1, 1, 0]}


def test_wide_selector_equals_narrow(spark):
    """The same decisions whether values get columns or not; importances belong to the string column."""
    rng = np.random.default_rng(2)
    rows = []
    for i in range(400):
        s, x = "ab"[i % 2], float(rng.normal())
        rows.append((i, s, "only", x, 2 * x, int(s == "a")))
    df = spark.createDataFrame(rows, "id int, s string, t string, x double, y double, label int")
    narrow, wide = (selection.FeatureSelector(df, ["id"], "label", most_wide=w) for w in (1000, 1))
    assert narrow.identify_collinear(0.9, one_hot=True) == ["s_b", "y"] or narrow.ops["collinear"] == ["y", "s_b"]
    assert wide.identify_collinear(0.9, one_hot=True) == ["y"]
    assert [r[0] for r in wide.dropped_values.collect()] == ["s_b"]
    assert narrow.removable_one_hot() == wide.removable_one_hot() == 2
    assert narrow.check_removal(keep_one_hot=False) == ["s_a", "s_b", "t_only", "y"]
    zero = wide.identify_zero_importance("classification", "auc", 1, max_iter=3, patience=2, keys=["id"])
    assert "s" not in zero and "t" in zero
