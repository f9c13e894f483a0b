"""Toxicity scores."""

import zlib

import numpy as np
import pandas as pd
import pytest

from tallybuy.llm import toxicity
from tests.llm.helpers import ODD, documents

WORDS = [a + b for a in ("ba", "ko", "mi", "re", "tu", "lan") for b in ("to", "ri", "sel", "ne", "va", "dor")]


def _texts(rng, n, toxic):
    texts = []
    for k in range(n):
        words = list(rng.choice(WORDS, int(rng.integers(20, 160))))
        if toxic:
            bad = ("vile" + rng.choice(["ling", "st", "er", "ness"])) if k % 2 else "scoundrel"
            for at in rng.integers(0, len(words), 2):
                words[at] = bad
        texts.append(" ".join(words))
    return texts


@pytest.fixture(scope="module")
def model():
    rng = np.random.default_rng(0)
    texts = _texts(rng, 150, True) + _texts(rng, 450, False)
    labels = np.array([1.0] * 150 + [0.0] * 450)
    net, slope, shift = toxicity.train(texts, labels, 0.1, epochs=4)
    return toxicity.ToxicityModel(net.dump(), slope, shift, 0.1)


def _ranked(score, label):
    """ROC area."""
    rank = pd.Series(score).rank().to_numpy()
    ones = label == 1
    return (rank[ones].sum() - ones.sum() * (ones.sum() + 1) / 2) / (ones.sum() * (~ones).sum())


def test_learns_words_and_parts_of_words(spark, model):
    rng = np.random.default_rng(9)
    texts = _texts(rng, 60, True) + _texts(rng, 200, False)
    rows = toxicity.score_toxicity(documents(spark, texts), model).orderBy("doc_id").collect()
    label = np.array([1] * 60 + [0] * 200)
    score = np.array([r.score for r in rows])
    assert _ranked(score, label) > 0.97
    assert all(r.predicted == int(r.score >= 0.3) for r in rows)
    # One bad word far inside a long text is in some window.
    long = " ".join(rng.choice(WORDS, 5000)) + " scoundrel " + " ".join(rng.choice(WORDS, 5000))
    clean = long.replace(" scoundrel ", " ")
    scorer = toxicity._Scorer(model.network)
    high, low = scorer.logits([long, clean])
    assert high > low


def test_odd_texts_and_equal_texts(spark, model):
    rows = toxicity.score_toxicity(documents(spark, ODD), model).orderBy("doc_id").collect()
    assert all(0 <= r.score <= 1 for r in rows) and [rows[k].score for k in range(3)] == [0, 0, 0]
    assert rows[3].score == rows[4].score
    assert toxicity.score_toxicity(documents(spark, []), model).collect() == []


def test_windows_cover_all_words():
    sizes = np.array([0, 1, 31, 32, 33, 56, 57, 500])
    first, size, text = toxicity._windows(sizes)
    begins = np.cumsum(sizes) - sizes
    for k, n in enumerate(sizes):
        covered = set()
        for f, s in zip(first[text == k] - begins[k], size[text == k]):
            assert 0 < s <= 32 and f + s <= n
            covered |= set(range(f, f + s))
        assert covered == set(range(n))


def test_gradients_match_differences():
    rng = np.random.default_rng(3)
    net = toxicity.Network(1)
    gates = rng.normal(size=(9, 6 * toxicity._HIDDEN)).astype(np.float32)
    codes = rng.integers(0, 9, (4, toxicity._WINDOW))
    sizes = np.array([32, 5, 1, 20])
    weight = rng.normal(size=4).astype(np.float32)
    kept = {"ahead": [], "back": []}
    net.forward(gates, codes, sizes, kept)
    grads, d_gates = net.backward(gates, codes, sizes, kept, weight)

    def loss():
        return float((net.forward(gates, codes, sizes).astype(np.float64) * weight).sum())

    for array, grad in [(net.p[k], g) for k, g in grads.items()] + [(gates, d_gates)]:
        for at in rng.integers(0, array.size, 6):
            old = array.flat[at]
            array.flat[at] = old + 1e-2
            up = loss()
            array.flat[at] = old - 1e-2
            down = loss()
            array.flat[at] = old
            assert grad.flat[at] == pytest.approx((up - down) / 2e-2, abs=5e-3, rel=0.05)


def test_held_out_rows_teach_nothing(spark):
    docs = documents(spark, ["a b c"] * 40)
    labels = spark.createDataFrame([(k, k % 2) for k in range(40)] + [(None, 1), (3, None), (4, 7)], "doc_id bigint, toxic int")
    assert toxicity.fit_toxicity(docs, labels.where("toxic = 1")).network is None
    assert toxicity.fit_toxicity(docs, labels.limit(0)).share == 0
    assert toxicity.fit_toxicity(docs, labels).network is not None


def test_held_out_accuracy(spark):
    from tallybuy.llm.queries import QUERIES

    directory = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{directory}/labels.parquet").collect()}
    rows = [r for r in QUERIES["op1_toxicity"](spark, directory).collect() if r.held_out and r.doc_id in labels]
    assert all(zlib.crc32(str(r.doc_id).encode()) % 4 == 2 for r in rows)
    score, label = np.array([r.score for r in rows]), np.array([labels[r.doc_id] for r in rows])
    assert _ranked(score, label) > 0.9
