"""Removal of benchmark passages."""

import hashlib
import re

import numpy as np
from pyspark.sql import functions as F

from tallybuy.llm import decontaminate
from tests.llm.helpers import ODD, SMALL, documents, small_texts
from tests.oracle import compare, connect

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def _lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def brute_force(texts, items, window):
    """(words, hit places, items) of each text."""
    windows = {}
    for item, text in items:
        words = WORD.findall(_lower(text))
        n = min(window, len(words))
        for k in range(len(words) - n + 1 if n else 0):
            windows.setdefault(tuple(words[k : k + n]), set()).add("" if item is None else str(item))
    out = []
    for text in texts:
        words, hit, found = WORD.findall(_lower(text)), set(), set()
        for n in {len(w) for w in windows}:
            for k in range(len(words) - n + 1):
                if tuple(words[k : k + n]) in windows:
                    hit |= set(range(k, k + n))
                    found |= windows[tuple(words[k : k + n])]
        out.append((len(words), hit, sorted(found)))
    return out


def _got(df):
    out = []
    for r in df.orderBy("doc_id").collect():
        out.append((r.n_words, {k for s in r.spans for k in range(s.start, s.stop)}, r["items"]))
        assert r.n_hit == len(out[-1][1]) and r.contaminated == (r.n_hit > 0)
    return out


def _items(spark, items):
    return spark.createDataFrame(items, "item_id bigint, text string")


def _texts(rng, n, vocabulary, size):
    return [" ".join(f"W{k}" for k in rng.integers(0, vocabulary, int(rng.integers(0, size)))) for _ in range(n)]


def test_random_texts_match_brute_force(spark):
    rng = np.random.default_rng(3)
    for window, vocabulary in ((3, 3), (4, 5), (10, 2)):
        items = list(enumerate(_texts(rng, 25, vocabulary, 14)))
        texts = _texts(rng, 120, vocabulary, 60)
        docs = documents(spark, texts)
        want = brute_force(texts, items, window)
        assert _got(decontaminate.decontaminate(docs, _items(spark, items), window)) == want
        # Several blocks: each has few items, and their hits meet.
        assert _got(decontaminate.decontaminate(docs, _items(spark, items), window, block_words=40)) == want


def test_whole_tables_match_brute_force(spark):
    texts = small_texts(spark)
    items = [tuple(r) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    got = _got(decontaminate.decontaminate(docs, _items(spark, items)))
    assert got == brute_force([texts[i] for i in sorted(texts)], items, 10)
    assert sum(bool(h) for _, h, _ in got) > 0


def test_long_items_are_cut_without_loss(spark):
    rng = np.random.default_rng(9)
    words = [f"w{k}" for k in rng.integers(0, 5000, 20_000)]
    texts = [" ".join(words[a : a + 30]) for a in range(4070, 4110)] + [" ".join(words)]
    got = _got(decontaminate.decontaminate(documents(spark, texts), _items(spark, [(5, " ".join(words))])))
    assert got == [(len(t.split()), set(range(len(t.split()))), ["5"]) for t in texts]


def test_kept_texts_and_odd_rows(spark):
    passage = "One, two three; four five six seven eight NINE ten eleven"
    items = [(1, passage), (1, passage), (None, "alone here"), (7, None), (8, ""), (9, " ! "), (10, "same words in this line\nanother")]
    texts = [*ODD, f"Before ({passage.lower()}), after and much more text that stays as it was, {'x ' * 30}", "so alone HERE!", passage]
    ids = list(range(len(texts)))
    docs = documents(spark, texts, ids).withColumns({c: F.lit("z") for c in ("_row", "spans", "items", "kept", "body")})
    table = _items(spark, items).withColumns({c: F.lit("z") for c in ("item", "all", "words", "block", "first")})
    want = brute_force(texts, items, 10)
    for block_words in (1 << 17, 4):
        df = decontaminate.decontaminate(docs, table, block_words=block_words)
        assert _got(df) == want
        kept = {r.doc_id: (r.kept, r.dropped) for r in df.collect()}
        n = len(ODD)
        assert kept[n] == (texts[n].replace(passage.lower(), ""), False)
        assert kept[n + 1] == ("", True) and kept[n + 2] == ("", True) and kept[1] == ("", False)
        assert kept[7] == (ODD[7], False)
    nothing = _items(spark, [])
    assert [r.contaminated for r in decontaminate.decontaminate(docs, nothing).collect()] == [False] * len(texts)
    assert decontaminate.decontaminate(documents(spark, []), table).collect() == []
    nulls = decontaminate.decontaminate(documents(spark, [passage, passage, None], [None, None, None]), table).collect()
    assert sorted((r.doc_id, r.n_hit) for r in nulls) == [(None, 0), (None, 11), (None, 11)]


def test_query_matches_sql(spark):
    from tallybuy.llm import queries

    df = queries.QUERIES["op11_decontamination"](spark, SMALL)
    assert compare(df, connect(SMALL), queries.CHECK_SQL["op11_decontamination"]) is None
    one = df.where("contaminated").first()
    assert len(one.items_sha256) == 64 and one.items_sha256 != hashlib.sha256(b"").hexdigest()
