"""Periodic runs of words."""

import hashlib
import re
import zlib

import numpy as np
from pyspark.sql import functions as F

from tallybuy.llm import periodic_runs, queries
from tests.llm.helpers import ODD, SMALL, documents, small_texts


def _words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def runs_of(words):
    """All runs, from every lag by itself."""
    n, out, seen = len(words), [], set()
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            k = i
            while k + q < n and words[k] == words[k + q]:
                k += 1
            length = k + q - i
            # The same stretch of a smaller period was found before.
            if length >= max(6, 4 * q) and (i, length) not in seen:
                seen.add((i, length))
                out.append((i, length, q))
            i = k + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def _looped(doc_id, words):
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if doc_id is None or h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def brute_force(doc_id, text):
    words = _looped(doc_id, _words(text))
    runs = runs_of(words)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = max(runs, key=lambda r: (r[1], -r[0], -r[2])) if runs else (None, None, None)
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    return (
        len(runs), *best, 1000 * best[1] // best[2] if runs else None,
        hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest(),
    )


def test_query_matches_brute_force(spark):
    got = {r.doc_id: tuple(r)[1:] for r in queries.QUERIES["op13_periodic_runs"](spark, SMALL).collect()}
    texts = small_texts(spark)
    short = {i for i, t in texts.items() if len(_words(t)) < 4000}
    assert len(short) > 190 and set(got) == set(texts)
    assert {i: got[i] for i in short} == {i: brute_force(i, texts[i]) for i in short}


def test_runs_of_random_words():
    rng = np.random.default_rng(8)
    for k in range(600):
        parts = []
        for _ in range(int(rng.integers(1, 5))):
            unit = rng.integers(0, int(rng.integers(1, 4)), int(rng.integers(1, 12)))
            parts.append(np.tile(unit, int(rng.integers(1, 9)))[: int(rng.integers(1, 60))])
        words = np.concatenate(parts)
        assert periodic_runs.find_runs(words) == runs_of(words.tolist()), words.tolist()


def test_grams_that_occur_twice_in_each_period():
    """A cycle in which each gram of five stands twice, so a next occurrence of five words is no period."""

    def cycle(k):
        seen, out = set(), "0" * k
        while True:
            for c in "10":
                if (out + c)[-k:] not in seen:
                    seen.add((out + c)[-k:])
                    out += c
                    break
            else:
                return out[k:]

    unit = [int(c) for c in cycle(6)]
    assert len(unit) == 64
    words = np.array(unit * 5 + [7])
    assert periodic_runs.find_runs(words) == runs_of(words.tolist()) and (0, 320, 64) in periodic_runs.find_runs(words)


def test_seeds_of_one_word_are_one():
    """A word repeated a million times is one seed, not a pair for each two of its places."""
    words = np.zeros(1_000_000, np.int64)
    one = periodic_runs._Grams.made(words, np.arange(len(words)), len(words))
    assert len(periodic_runs._seeds(one, one, 1, 1, 1)) == 1
    assert periodic_runs.find_runs(words) == [(0, 1_000_000, 1)]


def test_odd_texts_clashing_columns_and_nothing(spark):
    texts = [*ODD, "a b a b a b a b a b c a b", "x\x00y \x00 \x00 \x00 \x00 \x00 \x00 \x00", "é é é é é é", "tail"]
    ids = [None, *range(1, len(texts))]
    docs = documents(spark, texts, ids).withColumns({c: F.lit(1) for c in ("seed", "runs", "n_words", "words")})
    seed = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    got = {r.doc_id: r for r in periodic_runs.periodic_runs(docs, loop_seed=seed).collect()}
    for i, t in zip(ids, texts):
        if len(t or "") < 100_000:
            want = brute_force(i, t)
            assert (len(got[i].runs), got[i].runs_sha256, got[i].collapsed_sha256) == (want[0], *want[5:])
            assert hashlib.sha256(got[i].collapsed.encode()).hexdigest() == want[6]
    same = periodic_runs.periodic_runs(documents(spark, ["word " * 60_000], [1])).collect()[0]
    assert [tuple(r) for r in same.runs] == [(0, 60_000, 1)] and same.collapsed == "word"
    assert periodic_runs.periodic_runs(documents(spark, [])).collect() == []
