"""Removal of repeated byte strings."""

import subprocess
import sys
from pathlib import Path

import numpy as np
from pyspark.sql import functions as F

from tallybuy.llm import suffix_dedup
from tests.llm.helpers import ODD, documents, small_texts


def brute_force(texts, length=50):
    """(bytes, removed, spans, kept) of each document, by a table of all strings."""
    first = {}
    data = {i: (t or "").encode() for i, t in texts.items()}
    for i in sorted(data):
        for k in range(len(data[i]) - length + 1):
            first.setdefault(data[i][k : k + length], i)
    out = {}
    for i, d in data.items():
        gone = np.zeros(len(d), bool)
        for k in range(len(d) - length + 1):
            if first[d[k : k + length]] < i:
                gone[k : k + length] = True
        edges = np.count_nonzero(np.diff(np.concatenate([[0], gone.astype(int)])) == 1)
        out[i] = (len(d), int(gone.sum()), int(edges), np.frombuffer(d, np.uint8)[~gone].tobytes())
    return out


def _got(df):
    return {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in df.collect()}


def _texts(spark):
    texts = small_texts(spark)
    rng = np.random.default_rng(4)
    base = "".join(chr(c) for c in rng.integers(97, 123, 3000))
    for k in range(60):
        a = int(rng.integers(0, 2800))
        texts[1000 + k] = f"{k} own " + base[a : a + int(rng.integers(40, 200))] + f" and {k * 7919}"
    texts |= {2000 + k: t for k, t in enumerate(ODD) if len(t or "") < 20_000}
    texts |= {3000: "ab" * 400, 3001: "ba" * 300, 3002: "é" * 120, 3003: "x" * 49, 3004: "x" * 49, 3005: "y" * 50, 3006: "y" * 50}
    return texts


def test_matches_brute_force(spark, monkeypatch):
    texts = _texts(spark)
    docs = documents(spark, list(texts.values()), list(texts)).repartition(3)
    assert _got(suffix_dedup.remove_repeats(docs)) == brute_force(texts)


def test_blocks_and_batches_change_nothing(spark):
    """Small blocks, chunks and batches, set in the module that the workers load."""
    texts = _texts(spark)
    data = [(i, (t or "").encode()) for i, t in texts.items()]
    body = suffix_dedup._squeeze(
        np.array([i for i, _ in data]), np.zeros(len(data), np.uint8), np.array([len(d) for _, d in data]),
        np.frombuffer(b"".join(d for _, d in data), np.uint8),
    )
    block = suffix_dedup._Block(body)
    hashes, first, strings, document = suffix_dedup._anchors(block, 50)
    starts = np.concatenate([np.arange(a, a + n) for a, n in zip(first, strings)])
    want = np.concatenate([np.arange(a, max(a, b - 49)) for a, b in zip(block.starts, block.ends)])
    assert np.array_equal(starts, want)
    by_string = {}
    raw = block.data.tobytes()
    for h, a, n in zip(hashes.tolist(), first.tolist(), strings.tolist()):
        for k in range(a, a + n):
            assert by_string.setdefault(raw[k : k + 50], h) == h
    index, seen = suffix_dedup.SuffixIndex(), {}
    rng = np.random.default_rng(7)
    for document in range(0, 400, 10):
        words = rng.integers(0, 300, 25)
        texts = np.array([b"%050d" % w for w in words], "S50")
        own = rng.integers(document, document + 10, 25)
        for w, d in zip(words.tolist(), own.tolist()):
            seen[w] = min(seen.get(w, d), d)
        assert index.scan(texts, own).tolist() == [seen[w] < d for w, d in zip(words.tolist(), own.tolist())]
    sizes = [len(a) for a, _ in index.levels]
    assert all(a >= 2 * b for a, b in zip(sizes, sizes[1:]))


def test_hot_copies_nulls_and_nothing(spark):
    passage = "a passage that a third of all documents hold, in full length and more"
    texts = {k: (passage if k % 3 == 0 else f"only {k} " * 9) for k in range(300)}
    docs = documents(spark, list(texts.values()), list(texts))
    assert _got(suffix_dedup.remove_repeats(docs)) == brute_force(texts)
    docs = documents(spark, [passage, passage, passage, None], [None, None, 4, 4])
    got = sorted((str(r.doc_id), r.n_removed) for r in suffix_dedup.remove_repeats(docs).collect())
    n = len(passage)
    assert got == [("4", 0), ("4", 0), ("None", n), ("None", n)]
    assert suffix_dedup.remove_repeats(documents(spark, [])).collect() == []


def test_hot_anchors_are_dealt_string_by_string(spark):
    """A line shorter than a string ends a third of all texts, each after other words; a passage has other edges."""
    line = "under the license of this example corpora"
    passage = "a passage that many documents hold, in full length and with a few more words"
    texts = {k: f"{k * 7919} words {k} before {line if k % 3 else passage}{k % 5} {k * 31} and words after {k}" for k in range(600)}
    texts |= {600 + k: "=" * (60 + k % 40) for k in range(60)}
    docs = documents(spark, list(texts.values()), list(texts)).repartition(4)
    want = brute_force(texts)
    blocks = suffix_dedup.write_out(suffix_dedup._blocks(docs, 50, 4 << 20), "text-blocks")
    largest = []
    for hot in (20, 1 << 30):
        assert _got(suffix_dedup.remove_repeats(docs, hot=hot)) == want
        shared = suffix_dedup._shared_anchors(blocks, 50, 8, hot)
        sent = suffix_dedup._segments(blocks, shared, 50, 11, 8).where("shard >= 0").collect()
        strings = {}
        for r in sent:
            strings[r.shard] = strings.get(r.shard, 0) + int(suffix_dedup._expand(r.body, "i8", "<u4", "u1", "u1", "u1")[2].sum(dtype=np.int64))
        largest.append(max(strings.values()))
    assert largest[1] > 2_000 and largest[0] < largest[1] / 4


def test_long_texts_are_cut(spark):
    """Texts of many parts, with runs over their edges, equal to one another, and of one letter."""
    rng = np.random.default_rng(12)
    base = "".join(chr(c) for c in rng.integers(97, 107, 9_000))
    texts = {5: base[:3_000], 7: base, 8: "x" + base, 9: base[4_000:4_060], 11: "z" * 2_500, 12: "z" * 700, 13: None, 14: "é" * 900, 15: "é" * 901}
    texts |= {20: base[:1_000], 21: base[:999], 22: base[:1_001]}
    docs = documents(spark, list(texts.values()), list(texts)).repartition(2).withColumns({c: F.lit("q") for c in ("block", "body", "part", "did")})
    want = brute_force(texts)
    for block_bytes in (1_000, 333, 4 << 20):
        assert _got(suffix_dedup.remove_repeats(docs, block_bytes=block_bytes)) == want


def test_very_long_text_and_its_copy(spark):
    """30 MB texts, one the copy of the other: all of the later goes."""
    rng = np.random.default_rng(1)
    text = rng.integers(97, 123, 30_000_000, dtype=np.uint8).tobytes().decode()
    docs = documents(spark, [text[:100], text, "lead " + text], [0, 1, 2]).repartition(3)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans) for r in suffix_dedup.remove_repeats(docs).drop("kept").collect()}
    assert got == {0: (100, 0, 0), 1: (30_000_000, 100, 1), 2: (30_000_005, 30_000_000, 1)}


def test_worker_memory_of_a_long_text_is_bounded():
    """Anchors of a block are what a worker holds at most of any text; a hundred MB of text are only cut."""
    code = """
import resource, numpy as np, pyarrow as pa
from unittest import mock
from tallybuy.llm import suffix_dedup as s
rng = np.random.default_rng(3)
text = rng.integers(97, 123, 100_000_000, dtype=np.uint8).tobytes()
batch = pa.RecordBatch.from_pydict({"did": pa.array([4]), "doc_id": pa.array([4]), "text": pa.array([text.decode()], pa.string())})
class Frame:
    def select(self, *a): return self
    def mapInArrow(self, run, schema): return run([batch])
before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
with mock.patch.object(s, "TaskContext"), mock.patch.object(s, "F"), mock.patch.object(s, "id_key"), mock.patch.object(s, "text_of"):
    s.TaskContext.get.return_value.partitionId.return_value = 0
    n = 0
    for row in s._blocks(Frame(), 50, s._BLOCK_BYTES):
        block = s._Block(row["body"][0].as_py())
        assert len(block.data) <= s._BLOCK_BYTES + 49
        if n < 2: s._anchors(block, 50)
        n += 1
print(n, (resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) / 1024)
"""
    root = Path(__file__).resolve().parents[2]
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=root, check=True).stdout.split()
    assert out[0] == "24" and float(out[1]) < 300
