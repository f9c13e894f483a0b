"""Small tables for the text operators."""

from pyspark.sql import types as T

DOCUMENTS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)

SMALL = "/root/testdata/sf0.001"


def documents(spark, texts, ids=None):
    """Texts as rows of ``documents``; ids count up from 0 unless given."""
    ids = range(len(texts)) if ids is None else ids
    rows = [(i, t, "en", "src0", len(t or "")) for i, t in zip(ids, texts)]
    return spark.createDataFrame(rows, DOCUMENTS)


def small_texts(spark, directory=SMALL):
    rows = spark.read.parquet(f"{directory}/documents.parquet").select("doc_id", "text").collect()
    return {r["doc_id"]: r["text"] for r in rows}


#: Texts that every operator has to stand: null, empty, blanks, ties and repeats, very long, odd characters.
ODD = [
    None,
    "",
    " \t\n\r ",
    "same words in this line\nanother line of some length",
    "same words in this line\nanother line of some length",
    "same  words in this line\nanother line of some length ",
    "\U0001f600 emoji and İstanbul \x00 nul \x1c sep   nbsp 'll don't it's  two   spaces\r\n\r\nend ",
    "word " * 60_000,
    "a",
    "line twelve long\n" * 500 + "other ending here",
]
