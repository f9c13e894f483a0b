"""Exact search by inner product."""

import math

import numpy as np
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallybuy.llm import top_k

SCHEMA = T.StructType(
    [
        T.StructField("vec_id", T.LongType()),
        T.StructField("embedding", T.ArrayType(T.FloatType())),
        T.StructField("label", T.IntegerType()),
        T.StructField("row", T.StringType()),
    ]
)


def _brute_force(rows, k=5):
    held = []
    for at, (i, v) in enumerate(rows):
        if v is not None and all(x is not None and math.isfinite(x) for x in v):
            held.append((at, i, [math.floor(256 * float(np.float32(x))) for x in v]))
    out = []
    for at, i, v in held:
        if i is None or i % 50:
            continue
        scores = sorted(
            (-sum(a * b for a, b in zip(v, w)), j is None, j or 0, other) for other, j, w in held if other != at
        )
        out += [(i, r + 1, None if null else j, -s) for r, (s, null, j, _) in enumerate(scores[:k])]
    return sorted(out, key=str)


def _got(spark, rows):
    df = spark.createDataFrame([(i, v, 0, "clash") for i, v in rows], SCHEMA)
    found = top_k.top_k(df, F.col("vec_id") % 50 == 0)
    return sorted(((r.query_id, r["rank"], r.vec_id, r.score) for r in found.collect()), key=str)


def test_odd_vectors_ties_and_repeats(spark):
    rng = np.random.default_rng(1)
    rows = [(int(k), rng.normal(size=6).round(2).tolist()) for k in range(300)]
    rows += [(k, [0.5, -0.25, 0.125, 0.0, 1.0, -1.0]) for k in range(300, 460)]
    rows += [(50, rows[50][1]), (100, None), (150, [1.0, None]), (200, [float("nan")] * 6), (250, [float("inf")] * 6)]
    rows += [(350, []), (400, [2.0]), (None, [3.0] * 6), (None, None), (451, [1e6] * 6)]
    assert _got(spark, rows) == _brute_force(rows)


def test_few_or_no_rows(spark):
    assert _got(spark, []) == []
    assert _got(spark, [(1, [1.0])]) == []
    assert _got(spark, [(0, [1.0])]) == []
    rows = [(0, [1.0, 2.0]), (50, [2.0, 1.0]), (7, [0.5, 0.5])]
    assert _got(spark, rows) == _brute_force(rows)


def test_blocks_and_bounds_lose_nothing():
    rng = np.random.default_rng(2)
    v = (rng.normal(size=(5000, 16)) * rng.lognormal(0, 1, (5000, 1)) * 100).astype(np.int64)
    v[4000:] = v[4000]
    order = np.argsort(-np.linalg.norm(v, axis=1), kind="stable")
    v = v[order]
    ids = rng.permutation(5000)
    basis = np.linalg.eigh((v.T @ v).astype(float))[1][:, ::-1]
    q = v[:40]
    want = q @ v.T
    want[np.arange(40), np.arange(40)] = np.iinfo(np.int64).min
    for threshold in (np.full(40, -np.inf), np.sort(want, axis=1)[:, -5].astype(float)):
        best = top_k.search_block(
            {"v": q, "rows": np.arange(40), "threshold": threshold}, {"v": v, "ids": ids, "rows": np.arange(5000)}, basis, 5, 4
        )
        for i in range(40):
            top = np.lexsort((ids, ~want[i]))[:5]
            assert best.scores[i].tolist() == want[i][top].tolist() and best.ids[i].tolist() == ids[top].tolist()


def test_large_numbers_stay_exact():
    a = np.array([[2**30 + 1, 3]])
    b = np.array([[2**30 + 7, 5], [1, 1]])
    assert top_k._dot(a, b).tolist() == [[(2**30 + 1) * (2**30 + 7) + 15, 2**30 + 4]]


def test_queries_meet_the_blocks_they_may_reach(spark):
    """Against every pair of a query and a block; zero lengths, negative thresholds and none at all are among them."""
    rng = np.random.default_rng(8)
    queries = [(i, float(x), None if i % 7 == 0 else float(t)) for i, (x, t) in enumerate(zip(rng.integers(0, 60, 60), rng.integers(-50, 4000, 60)))]
    blocks = [(b, float(x)) for b, x in enumerate([0, 0, 1, 1, 2, 3, *rng.integers(1, 120, 40)])]
    got = top_k._sent(
        spark.createDataFrame(queries, "row bigint, length double, threshold double"), spark.createDataFrame(blocks, "block int, longest double")
    )
    want = {(i, b) for i, x, t in queries for b, y in blocks if t is None or x * y * (1 + 1e-9) + 1e-6 >= t}
    found = [(r.row, r.block) for r in got.collect()]
    assert len(found) == len(set(found)) and set(found) == want
    assert top_k._sent(got.select("row", "length", "threshold"), spark.createDataFrame([], "block int, longest double")).count() == 0
