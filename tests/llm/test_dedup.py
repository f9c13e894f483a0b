"""Exact and line deduplication."""

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa

from tallybuy.llm import line_dedup
from tallybuy.llm.exact_dedup import exact_dedup
from tests.llm.helpers import ODD, documents


def _exact(rows):
    groups = defaultdict(list)
    for at, (i, t) in enumerate(rows):
        digest = hashlib.sha256(re.sub(r"[\x20\x09-\x0D]", "", t or "").encode()).hexdigest()
        groups[digest].append((-len(t or ""), i is None, i or 0, at, i))
    return sorted(
        (str(i), str(min(g)[4]), len(g), digest) for digest, g in groups.items() for *_, i in g
    )


def test_exact_dedup_matches_brute_force(spark):
    texts = [*ODD, *[f"text {k % 7}" for k in range(60)], *[f"alone {k}" for k in range(300)]]
    ids = [*range(len(texts) - 2), 5, None]
    got = exact_dedup(documents(spark, texts, ids).withColumn("digest", spark_lit()), bits_per_row=16).collect()
    assert sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.text_sha256) for r in got) == _exact(zip(ids, texts))
    kept = Counter(r.text_sha256 for r in got if r.kept)
    assert set(kept.values()) == {1} and len(kept) == len({r.text_sha256 for r in got})


def spark_lit():
    from pyspark.sql import functions as F

    return F.lit("clash")


def test_a_full_filter_changes_nothing(spark):
    docs = documents(spark, [f"text {k % 50}" for k in range(3000)] + [f"alone {k}" for k in range(3000)])
    few, many = exact_dedup(docs, most_bits=32768), exact_dedup(docs)
    assert sorted(few.collect()) == sorted(many.collect())


def test_exact_dedup_of_nothing(spark):
    assert exact_dedup(documents(spark, [])).collect() == []


def _lines(rows):
    def key(line):
        return "".join(c.lower() if c.isascii() else c for c in line.strip(" \t\n\x0b\x0c\r"))

    holders = defaultdict(set)
    for i, t in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= 10:
                holders[key(line)].add(i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        stay = [x for x in lines if len(holders.get(key(x), ())) < 2 or min(holders[key(x)]) == i]
        out.append((i, "\n".join(stay), len(lines), len(lines) - len(stay)))
    return sorted(out)


def _got(df):
    return sorted((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in df.collect())


ROWS = list(enumerate([*ODD, *[f"shared line {k % 5} here\nown line {k} stays\n Shared LINE {k % 3} here" for k in range(80)]]))


def test_line_dedup_matches_brute_force(spark):
    docs = documents(spark, [t for _, t in ROWS])
    assert _got(line_dedup.line_dedup(docs)) == _lines(ROWS)


def test_index_takes_documents_in_and_out(spark):
    docs = documents(spark, [t for _, t in ROWS])
    index = line_dedup.build_index(docs.where("doc_id < 30"), shards=4)
    index = line_dedup.insert_documents(index, docs.where("doc_id >= 30"))
    assert _got(line_dedup.drop_lines(index, docs)) == _lines(ROWS)
    gone = [i for i, _ in ROWS if i % 3 == 0]
    index = line_dedup.delete_documents(index, docs.where(docs.doc_id.isin(gone)))
    left = [(i, t) for i, t in ROWS if i not in gone]
    assert _got(line_dedup.drop_lines(index, docs.where(~docs.doc_id.isin(gone)))) == _lines(left)
    counts = {(r.n_docs, r.first) for r in index.counts.collect()}
    assert counts and all(first not in gone for _, first in counts)


def test_line_dedup_of_nothing_and_of_null_ids(spark):
    assert line_dedup.line_dedup(documents(spark, [])).collect() == []
    docs = documents(spark, ["the same line here", "the same line here", None], [None, 4, None])
    got = {(r.doc_id, r.text) for r in line_dedup.line_dedup(docs).collect()}
    assert got == {(4, "the same line here"), (None, "")}


def test_cuckoo_filter():
    keys = np.random.default_rng(1).integers(1, 1 << 63, 20_000).astype(np.uint64)
    table = line_dedup.cuckoo_filter(keys[:10_000])
    assert line_dedup.cuckoo_has(table, keys[:10_000]).all()
    assert line_dedup.cuckoo_has(table, keys[10_000:]).mean() < 0.01
    less = line_dedup.cuckoo_remove(table, keys[:4_000])
    assert line_dedup.cuckoo_has(less, keys[4_000:10_000]).all()
    assert line_dedup.cuckoo_has(less, keys[:4_000]).mean() < 0.02
    assert line_dedup.cuckoo_add(table, keys) is None


def test_filters_meet_lines_in_the_executors(spark, monkeypatch):
    """No filter in a broadcast of the driver; shards grow with the keys, a hot shard has more copies of its filter."""
    texts = [f"shared line number {k // 2} here\nthe line that all documents hold" for k in range(600)]
    docs = documents(spark, texts)
    monkeypatch.setattr(line_dedup, "_SHARD_KEYS", 3)
    index = line_dedup.build_index(docs)
    assert index.shards == 101 and index.filters.count() <= 101
    assert index.counts.where("n_docs > 1").count() == 301
    with monkeypatch.context() as m:
        m.setattr(type(spark.sparkContext), "broadcast", None)
        probed = line_dedup._probed(index, most=20)
    copies = sorted(r.copies for r in line_dedup._copies(index, 20).collect())
    assert copies[-1] >= 30 and copies[len(copies) // 2] <= 2
    assert probed.count() == 1200
    assert _got(line_dedup.drop_lines(index, docs)) == _lines(list(enumerate(texts)))
    index = line_dedup.build_index(docs.where("doc_id < 20"), shards=4)
    index = line_dedup.insert_documents(index, docs.where("doc_id >= 20"))
    assert index.shards == 101 and _got(line_dedup.drop_lines(index, docs)) == _lines(list(enumerate(texts)))


def test_texts_are_taken_apart_in_slices():
    """One slice of texts at a time becomes objects, however much a batch holds."""
    texts = ["a line of text\n" * 200_000, "", "b line of text\n" * 200_000, "short\nkept"]
    batch = pa.RecordBatch.from_pydict({"doc_id": [0, 1, 2, 3], "text": texts, "drops": pa.array([None] * 4, pa.list_(pa.binary()))})
    found = list(line_dedup._rebuild([batch, batch.slice(0, 0)]))
    assert sum(b.num_rows > 0 for b in found) > 1
    assert [t for b in found for t in b["text"].to_pylist()] == texts
    assert [n for b in found for n in b["n_lines"].to_pylist()] == [200_001, 1, 200_001, 2]
