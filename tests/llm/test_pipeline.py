"""The pipeline, stage by stage, against brute force on what the stage before kept."""

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tests.llm.helpers import ODD, SMALL, documents
from tests.llm.test_dedup import _lines
from tests.llm.test_secrets import base_spans
from tests.llm.test_simhash import _fingerprint, _groups
from tests.llm.test_tokens import JSON, _check_pieces


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Result of each stage, written and read again."""
    folder = tmp_path_factory.mktemp("stages")
    secret = [
        f"The letter number {k} in this text says password = {k:x}abcdef{k * 7919} and AKIA{'Q' * 15}{k % 10}{k} and so on."
        for k in range(1, 9)
    ]
    more = documents(spark, secret, range(5000, 5008))
    spark.read.parquet(f"{SMALL}/documents.parquet").unionByName(more).write.parquet(f"{folder}/documents.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    out = {"documents": docs, "folder": str(folder)}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, str(folder)).write.parquet(f"{folder}/{name}")
        docs = out[name] = spark.read.parquet(f"{folder}/{name}")
    return out


def _texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_columns(stages):
    for name, df in stages.items():
        if name not in ("packing", "folder"):
            assert tuple(df.columns) == corpus_pipeline.COLUMNS and df.dtypes == stages["documents"].dtypes
            assert df.where(F.length("text") != F.col("n_chars")).count() == 0


def test_language_keeps_clean_documents(stages):
    before, after = _texts(stages["documents"]), _texts(stages["language ID"])
    assert set(after.items()) <= set(before.items()) and len(after) >= 0.99 * len(before)


def test_lines(stages):
    before = sorted(_texts(stages["language ID"]).items())
    assert _texts(stages["line dedup"]) == {i: t for i, t, _, _ in _lines(before)}


def test_near_duplicates(stages):
    before = _texts(stages["line dedup"])
    groups = _groups({i: _fingerprint(t) for i, t in before.items()})
    assert _texts(stages["SimHash near-dedup"]) == {i: t for i, t in before.items() if groups[i][1] == i}


def test_secrets(stages):
    before, after = _texts(stages["SimHash near-dedup"]), _texts(stages["secret scans"])
    assert set(before) == set(after)
    masked = 0
    for i, text in before.items():
        for a, _, b in base_spans(text):
            assert text[a:b] not in after[i]
        if base_spans(text):
            masked += 1
            assert "[secret]" in after[i]
        elif text != after[i]:
            assert "[secret]" in after[i]
    assert masked


def test_packing_and_run(spark, stages):
    tokenizer = Tokenizer.from_file(JSON)
    want = {i: tokenizer.encode(t, add_special_tokens=False).ids for i, t in _texts(stages["secret scans"]).items()}
    rows = [r.asDict() for r in stages["packing"].collect()]
    _check_pieces(rows, want)
    again = corpus_pipeline.run(spark, stages["folder"])
    assert sum(r["length"] for r in rows) == again.agg(F.sum("length")).first()[0]


@pytest.mark.parametrize("ids", [None, [*range(len(ODD) - 2), None, None]])
def test_stages_stand_odd_rows(spark, tmp_path, ids):
    docs = documents(spark, ODD, ids)
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SMALL).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
    assert docs.count() > 0


def test_stages_stand_no_rows(spark, tmp_path):
    docs = documents(spark, [])
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SMALL).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        assert docs.count() == 0
