"""Rounds of factors against MLlib's own, and the solvers against each other."""

import numpy as np
import pytest
from pyspark.ml.recommendation import ALS
from pyspark.sql import functions as F

from tallybuy.operators import factors, models


def _table(df, key, rank):
    return {r[key]: np.array([r[str(i)] for i in range(rank)]) for r in df.collect()}


def test_factors_are_those_of_mllib(spark, monkeypatch):
    """In the same rounds from the same beginning; MLlib is only asked for the beginning."""
    rows = [(u * 10, s * 3, (u * s) % 4 - 1) for u in range(120) for s in range(40) if (u * 7 + s * u) % 13 < 4]
    counts = spark.createDataFrame([*rows, rows[5]], "user_id bigint, seller_id bigint, counts bigint")
    given, fit = [], ALS.fit
    monkeypatch.setattr(ALS, "fit", lambda self, df, *a: (given.append((self, df)), fit(self, df, *a))[1])
    got = models.pair_factors(counts, rank=8, max_iter=4, seed=3)
    (als, indexed), = given
    assert als.getMaxIter() == 0
    whole = fit(als.copy({als.maxIter: 4}), indexed)
    for side, key, raw in ((got.users, "user_id", whole.userFactors), (got.sellers, "seller_id", whole.itemFactors)):
        want = np.array(sorted(tuple(r["features"]) for r in raw.collect()))
        have = np.array(sorted(tuple(v.astype(np.float32)) for v in _table(side, key, 8).values()))
        # Sorted by values that may differ in the last place, so sums are compared as well.
        assert have.shape == want.shape
        assert np.sort(have.sum(1)) == pytest.approx(np.sort(want.sum(1)), abs=1e-4)
        assert np.sort(have, axis=0) == pytest.approx(np.sort(want, axis=0), abs=1e-4)


def test_a_pair_without_a_value_is_refused(spark):
    counts = spark.createDataFrame([(1, 1, 1), (2, 1, None)], "user_id bigint, seller_id bigint, counts bigint")
    with pytest.raises(Exception, match="no value"):
        models.pair_factors(counts, rank=2, max_iter=1)


def _problem(n, rank):
    rng = np.random.default_rng(n)
    a = rng.normal(size=(n, rank, 2 * rank))
    a = a @ a.transpose(0, 2, 1) + 0.1 * np.eye(rank)
    return a, rng.normal(size=(n, rank))


def test_pivots_find_what_gradients_find(monkeypatch):
    """From no guess, from a wrong and from a right one; the right one takes one solution for each row."""
    a, b = _problem(150, 12)
    b[7] = -1.0  # zero is best

    def times(rows, d):
        return np.matmul(a[rows], d[:, :, None])[:, :, 0]

    def part(rows, places):
        return a[rows[:, None, None], places[:, :, None], places[:, None, :]]

    want = factors.non_negative(times, b)
    slope = times(np.arange(150), want) - b
    assert np.abs(np.minimum(want, slope)).max() < 1e-5 and not want[7].any()
    solved, solve = [], np.linalg.solve
    monkeypatch.setattr(factors.np.linalg, "solve", lambda p, q: (solved.append(len(p)), solve(p, q))[1])
    none = np.zeros(b.shape, bool)
    for guess in (none, want == 0, want > 0):
        solved.clear()
        assert factors.exact_non_negative(times, part, b, guess) == pytest.approx(want, abs=1e-5)
    assert sum(solved) == (b > 0).any(axis=1).sum()
    monkeypatch.setattr(factors, "_TURNS", 1)
    assert factors.exact_non_negative(times, part, b, none) == pytest.approx(want, abs=1e-5)


def test_rows_of_many_pairs_are_solved_like_those_of_few(monkeypatch):
    rng = np.random.default_rng(1)
    other = np.abs(rng.normal(size=(30, 5))).astype(np.float32)
    first = np.array([0, 3, 4, 24, 30])
    places, v = rng.integers(0, 30, 30).astype(np.int32), rng.integers(-1, 4, 30).astype(float)
    gram = other.astype(float).T @ other
    few = factors.solve_rows(first, places, v, other, gram, 0.1, 1.0)
    monkeypatch.setattr(factors, "_FEW", 2)
    monkeypatch.setattr(factors, "_PAIRS", 4)
    assert factors.solve_rows(first, places, v, other, gram, 0.1, 1.0) == pytest.approx(few, abs=1e-5)


def test_dropped_tables_have_no_files(spark, tmp_path):
    from pathlib import Path

    from tallybuy.session import drop_written, write_out

    one, two = (write_out(spark.range(3).withColumn("x", F.lit(i)), "drop") for i in range(2))
    places = [Path(df.inputFiles()[0].removeprefix("file:").replace("//", "/")).parent for df in (one, two)]
    drop_written(one)
    assert not places[0].exists() and places[1].exists() and two.count() == 3
