"""Byte-level BPE and packing."""

import base64
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tallybuy.llm import byte_bpe, packing, tokens
from tallybuy.llm.queries import QUERIES
from tests.llm.helpers import ODD, SMALL, documents, small_texts

JSON = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def reference():
    tokenizer = Tokenizer.from_file(JSON)
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return {
        JSON: lambda t: tokenizer.encode(t, add_special_tokens=False).ids,
        RANKS: encoding.encode_ordinary,
    }


HARD = [
    *[t or "" for t in ODD],
    "'s's 's 'll'll don't !'s a's's' 'sst ''s \n's\t're  've 'd 'M 'S x'y",
    "  two  three   \n\n mixed \t x y  ",
    "12 34,56 ½ Ⅷ x² ９９ a1b2 _under_ <|endoftext|> é é ﬁ ß 日本語 हिन्दी 👩‍👩‍👧",
    "<|endoftext|>",
    "x <|endoftext|> y<|endoftext|><|endoftext|>  \n <|endoftext |> <|endoftext|>'s <|EndOfText|>",
    "\x1c\x1d\x1e\x1f\x85 ᠎ ​ ﻿",
    "aaaaaaaaaaaaaaaaaaaa bbbbbbb abababababab ........... ------ ======",
]


@pytest.mark.parametrize("path", [JSON, RANKS])
def test_ids_match_the_libraries(path, reference):
    encoder = byte_bpe.encoder(path)
    texts = HARD + list(small_texts_cached())
    got = [x.tolist() for x in encoder.encode(texts)]
    for text, ids in zip(texts, got):
        assert ids == reference[path](text)
        assert encoder.decode(np.array(ids, np.uint32)) == text.encode()


def small_texts_cached():
    import duckdb

    return [r[0] for r in duckdb.sql(f"select text from '{SMALL}/documents.parquet'").fetchall()]


PIECES = st.sampled_from(["<|endoftext|>", "<|", "'", "s", "ll", "re", " ", "  ", "\n", "\t", " ", "word", "9", "!", "é", "'s", "T", "　"])


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(PIECES, max_size=12).map("".join), max_size=4))
def test_ids_of_made_up_texts(texts):
    tokenizer = Tokenizer.from_file(JSON) if not hasattr(test_ids_of_made_up_texts, "t") else test_ids_of_made_up_texts.t
    test_ids_of_made_up_texts.t = tokenizer
    encoder = byte_bpe.encoder(JSON)
    got = [x.tolist() for x in encoder.encode(texts)]
    assert got == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def test_offsets_cover_split_characters():
    encoder = byte_bpe.encoder(JSON)
    text = "a 👩‍👩 日本é x"
    (ids,) = encoder.encode([text])
    spans = encoder.offsets(text, ids)
    assert spans[0][0] == 0 and spans[-1][1] == len(text)
    for (a, b), (c, d) in zip(spans, spans[1:]):
        assert a < b and (c == b or c == b - 1)


def test_equal_hashes_change_nothing(monkeypatch, reference):
    encoder = byte_bpe.PieceEncoder(byte_bpe.encoder(JSON)._model, [b""])
    whole = byte_bpe.encoder(JSON)
    encoder.sizes, encoder.begins, encoder.table = whole.sizes, whole.begins, whole.table
    monkeypatch.setattr(byte_bpe, "_piece_hash", lambda units, starts, ends: (ends - starts).astype(np.uint64))
    texts = ["one two six ten", "abc def ghi"]
    assert [x.tolist() for x in encoder.encode(texts)] == [reference[JSON](t) for t in texts]


def test_encode_and_decode_tables(spark, reference):
    docs = documents(spark, ODD)
    encoded = tokens.encode(docs, RANKS, offsets=True)
    rows = tokens.decode(encoded, RANKS).collect()
    assert sorted(bytes(r.decoded) for r in rows) == sorted((t or "").encode() for t in ODD)
    for r in rows:
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert ids == reference[RANKS](ODD[r.doc_id] or "") and r.n_tokens == len(ids) == len(r.offsets)
    assert tokens.encode(documents(spark, []), RANKS).collect() == []


def _check_pieces(rows, want):
    """Every id in one piece, sequences gapless, full or a power of two long."""
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append(r)
    assert set(pieces) == set(want)
    for doc, own in pieces.items():
        ids, at = np.append(np.array(want[doc], np.uint32), np.uint32(1)).astype("<u4"), 0
        for r in sorted(own, key=lambda r: r["start"]):
            assert r["start"] == at and r["length"] > 0 and r["doc_tokens"] == len(ids)
            at += r["length"]
            assert r["ids_crc32"] == zlib.crc32(ids[r["start"] : at].tobytes())
        assert at == len(ids)
    odd = 0
    for own in sequences.values():
        at = 0
        for r in sorted(own, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 2048 and at & (at - 1) == 0
        odd += at < 2048
    return len(sequences), odd


def test_packing_query(spark, reference):
    texts = small_texts(spark)
    rows = [r.asDict() for r in QUERIES["op2_packing"](spark, SMALL).collect()]
    sequences, odd = _check_pieces(rows, {i: reference[JSON](t) for i, t in texts.items()})
    assert odd <= 11 and sequences - odd == sum(r["length"] for r in rows) // 2048


def test_packing_of_odd_texts(spark, reference):
    from pyspark.sql import functions as F

    docs = documents(spark, ODD).withColumn("ids", F.lit(1)).repartition(3)
    rows = packing.pack(docs, JSON).withColumn("ids_crc32", F.crc32("ids")).collect()
    _check_pieces([r.asDict() for r in rows], {i: reference[JSON](t or "") for i, t in enumerate(ODD)})
    assert packing.pack(documents(spark, []), JSON).collect() == []


def test_level_minimises_squares():
    rng = np.random.default_rng(2)
    packer = packing.SumOfSquares(32)
    for size in rng.integers(1, 32, 500).tolist():
        best = []
        for level in range(0, 32 - size + 1):
            if level and not packer.counts[level]:
                continue
            counts = packer.counts.copy()
            if level:
                counts[level] -= 1
            if level + size < 32:
                counts[level + size] += 1
            best.append(((counts**2).sum(), -level))
        assert packer.level_for(size) == -min(best)[1]
        packer.place(size, "piece")
    assert packer.open == packer.counts.sum() == sum(map(len, packer.windows))


def test_many_open_windows_are_cut_together(monkeypatch):
    monkeypatch.setattr(packing, "_MOST_OPEN", 3)
    ids = {k: np.arange(k % 9 + 1, dtype=np.uint32) for k in range(200)}
    seen = defaultdict(list)
    for pieces in packing.pack_stream(iter(ids.items()), 16):
        n = sum(len(p[2]) for p in pieces)
        assert n <= 16 and n & (n - 1) == 0
        for doc, start, part, total in pieces:
            seen[doc].append((start, part.tolist()))
    assert {k: [x for _, p in sorted(v) for x in p] for k, v in seen.items()} == {k: v.tolist() for k, v in ids.items()}
