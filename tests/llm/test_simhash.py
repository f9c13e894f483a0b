"""SimHash fingerprints, the trie join and groups."""

import re

import numpy as np
import xxhash

from pyspark.sql import functions as F

from tallybuy.llm import simhash
from tests.llm.helpers import ODD, SMALL, documents, small_texts


def _fingerprint(text, n=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if c.isascii() else c for c in text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + n]) for i in range(max(1, len(words) - n + 1))]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def _groups(prints):
    ids = sorted(prints)
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            if (prints[a] ^ prints[b]).bit_count() <= 4:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: (f"{prints[i]:016x}", find(i)) for i in ids}


def test_fingerprints_of_odd_texts():
    for text in ODD:
        if len(text or "") < 400_000:
            assert simhash.fingerprint(text or "") == _fingerprint(text)


def test_groups_match_brute_force(spark):
    texts = small_texts(spark)
    base = "one two three four five six seven eight nine ten " * 30
    for k in range(40):
        texts[1000 + k] = base + " ".join(f"w{j}" for j in range(k))
    texts |= {2000: None, 2001: " \n", 2002: "two words", 2003: "two words"}
    docs = documents(spark, list(texts.values()), list(texts))
    want = _groups({i: _fingerprint(t) for i, t in texts.items()})
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.near_duplicates(docs).collect()}
    assert got == want


def test_trie_pairs_match_all_pairs():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 63, 60).astype(np.uint64)
    flips = np.uint64(1) << rng.integers(0, 64, (3000, 3)).astype(np.uint64)
    values = np.unique(np.concatenate([base, base[rng.integers(0, 60, 3000)] ^ flips[:, 0] ^ flips[:, 1] ^ flips[:, 2]]))
    near = np.bitwise_count(values[:, None] ^ values[None, :]) <= 4
    want = {(i, j) for i, j in zip(*np.nonzero(near)) if i < j}
    got = [(i, j) for a, b in simhash.trie_pairs(values, values, 4) for i, j in zip(a.tolist(), b.tolist())]
    assert len(got) == len(set(got)) and set(got) == want
    left, right = values[::2].copy(), values[1::2].copy()
    want = {(i, j) for i, j in zip(*np.nonzero(near[::2, 1::2]))}
    got = {(i, j) for a, b in simhash.trie_pairs(left, right, 4) for i, j in zip(a.tolist(), b.tolist())}
    assert got == want


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(-50, 50)] + [(200, 199), (7, 7)], "a bigint, b bigint")
    got = {r.bits: r.root for r in simhash.components(edges).collect()}
    assert got == {k: -50 for k in range(-50, 51)} | {199: 199, 200: 199}


def test_nothing_and_null_ids(spark):
    assert simhash.near_duplicates(documents(spark, [])).collect() == []
    docs = documents(spark, ["some words", "some words", None], [None, 9, None])
    got = sorted((str(r.doc_id), str(r.component_id)) for r in simhash.near_duplicates(docs).collect())
    assert got == [("9", "9"), ("None", "9"), ("None", "None")]


def _near_values(rng, n):
    """Distinct fingerprints: random ones, near ones, and a ball of variants around one."""
    base = rng.integers(0, 1 << 63, n).astype(np.uint64)
    flips = np.uint64(1) << rng.integers(0, 64, (n, 4)).astype(np.uint64)
    near = base[rng.integers(0, n // 4, n)] ^ flips[:, 0] ^ flips[:, 1] ^ flips[:, 2] ^ flips[:, 3]
    ball = base[0] ^ flips[:, 0] ^ flips[:, 1] ^ flips[:, 2]
    return np.unique(np.concatenate([base, near, ball]))


def _roots(values):
    root = np.arange(len(values))
    near = np.bitwise_count(values[:, None] ^ values[None, :]) <= 4
    i, j = np.nonzero(np.triu(near, 1))
    return simhash.forest(len(values), i, j), (i, j)


def test_blocks_find_every_link_at_any_size(spark):
    """The same components whatever the number of blocks, and with groups that are split by further bits."""
    values = _near_values(np.random.default_rng(21), 500)
    root, pairs = _roots(values)
    classes = spark.createDataFrame([(int(v),) for v in values.view(np.int64)], "bits bigint")
    signed = values.view(np.int64).tolist()
    by_root = {}
    for k, r in enumerate(root.tolist()):
        by_root.setdefault(r, set()).add(signed[k])
    want = {frozenset(g) for g in by_root.values() if len(g) > 1}
    for heavy_rows in (1 << 15, 40):
        got = {}
        for r in simhash.components(simhash.linked_fingerprints(classes, 4, heavy_rows)).collect():
            got.setdefault(r.root, set()).add(r.bits)
        assert {frozenset(g) for g in got.values()} == want
    for rows in (1, 10**6, 10**9, 10**12):
        keys = {}
        for r in simhash.keyed(classes, 4, rows).collect():
            keys.setdefault(r.bits, set()).add((r.choice, r.key))
        assert all(keys[signed[i]] & keys[signed[j]] for i, j in zip(*(x.tolist() for x in pairs)))


def test_copies_do_not_grow_with_the_rows(spark):
    """From half a GB to 30 GB of documents and beyond, each fingerprint is in five groups, and keys are as many as groups need."""
    for rows in (235_000, 13_000_000, 130_000_000):
        assert len(simhash._blocks(rows, 4)) == 5
        width = sum(w for _, w in simhash._blocks(rows, 4)[0])
        assert rows / (1 << width) < 1 << 15
    classes = spark.range(100).select(F.xxhash64("id").alias("bits"))
    assert simhash.keyed(classes, 4, 13_000_000).count() == 500


def test_dense_ball_is_linked_without_all_pairs():
    """Variants that are all near are linked by neighbours first, so few pairs are left to compare."""
    rng = np.random.default_rng(2)
    flips = np.uint64(1) << rng.integers(0, 64, (20_000, 2)).astype(np.uint64)
    values = np.unique(np.uint64(0x0123456789ABCDEF) ^ flips[:, 0] ^ flips[:, 1])
    a, _ = simhash._linked(values, values, 4)
    assert len(a) == len(values) - 1
    root = simhash.forest(len(values), *simhash._neighbours(values, 4))
    assert len(np.unique(root)) < len(values) / 10


def test_other_columns_are_not_read(spark):
    docs = documents(spark, ["a b c d e", "a b c d e"]).withColumns({c: F.lit("x") for c in ("bits", "root", "first", "key", "u")})
    assert [r.component_id for r in simhash.near_duplicates(docs).collect()] == [0, 0]
