"""Training corpus from ``documents``: language, repeated lines, near-duplicates, secrets, packing.

Each stage takes (spark, docs, sf_dir) and works on all rows that the stage
before it kept. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybuy.llm import language_id, line_dedup, packing, secrets, simhash
from tallybuy.llm.common import id_key
from tallybuy.operators.joins import lookup
from tallybuy.session import tune, write_out

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _documents(df: DataFrame) -> DataFrame:
    """The columns of ``documents``, with the length of the text as it is now."""
    return df.withColumn("n_chars", F.length("text").cast("bigint")).select(*COLUMNS)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is found; texts that no language explains go. A null text stays null."""
    model = language_id.fit_language_model(docs)
    return language_id.identify(docs, model).where("accepted").select(*COLUMNS)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that an earlier document holds; a document without lines left is empty."""
    return _documents(line_dedup.line_dedup(docs, carry=("lang", "source")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest id. Rows that share an id stay or go together."""
    groups = simhash.near_duplicates(docs, words=4, most_bits=4)
    stay = groups.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(id_key().alias("_id")).distinct()
    return lookup(docs.withColumn("_id", id_key()), stay, ["_id"], "left_semi").select(*COLUMNS)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with each secret replaced by a mark."""
    found = secrets.find_secrets(docs, carry=("text", "lang", "source"))
    return _documents(found.withColumn("text", secrets.mask_text(F.coalesce("text", F.lit("")), F.col("spans"))))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 2048 tokens, with the checksum of their ids."""
    pieces = packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), capacity=2048, end_id=1)
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


STAGES = [
    ("language ID", language),
    ("line dedup", lines),
    ("SimHash near-dedup", near_duplicates),
    ("secret scans", secret_scan),
    ("packing", packed),
]

#: XXH64, the language model and the tokenizer have no counterpart in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result but the last is written and read again."""
    docs = tune(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = write_out(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
