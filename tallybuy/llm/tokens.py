"""Token ids of documents, and texts of token ids."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybuy.llm import byte_bpe
from tallybuy.llm.common import text_of

#: Rows that are taken, and go out, at once.
_ROWS = 500
_OFFSETS = "array<struct<start: int, end: int>>"


def _slices(batches):
    for batch in batches:
        for at in range(0, batch.num_rows, _ROWS):
            yield batch.slice(at, _ROWS)


def encode(docs: DataFrame, path: str, offsets: bool = False) -> DataFrame:
    """``doc_id``, ``n_tokens`` and ``ids`` (binary, unsigned 32-bit little-endian) of each row.

    ``path`` names a byte-level tokenizer file, ``.json`` or ranks, that every
    executor has. With ``offsets`` an array of the code points ``[start, end)``
    that each id covers is added; where ids split a character, each of them covers
    it. Null and empty texts have no ids. Repeated rows are encoded like others;
    other columns aren't read.
    """

    def run(batches):
        encoder = byte_bpe.encoder(path)
        for batch in _slices(batches):
            texts = batch["text"].to_pylist()
            ids = list(encoder.encode(texts))
            columns = [
                batch["doc_id"],
                pa.array([len(x) for x in ids], pa.int64()),
                pa.array([x.astype("<u4").tobytes() for x in ids], pa.binary()),
            ]
            if offsets:
                spans = [[{"start": a, "end": b} for a, b in encoder.offsets(t, x)] for t, x in zip(texts, ids)]
                columns.append(pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))))
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_tokens", "ids", "offsets"][: len(columns)])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_of().alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, n_tokens bigint, ids binary" + f", offsets {_OFFSETS}" * offsets)


def decode(tokens: DataFrame, path: str) -> DataFrame:
    """The rows of ``encode`` with ``decoded`` for ``ids``: the bytes of the ids, binary.

    Bytes, as ids may end within a character; ``decode(decoded, 'UTF-8')`` makes
    text of them. Null ids are no ids.
    """
    kept = [c for c in tokens.columns if c not in ("ids", "decoded")]

    def run(batches):
        table = byte_bpe.table(path)
        for batch in _slices(batches):
            out = [table.decode(np.frombuffer(x or b"", "<u4")) for x in batch["ids"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*(batch[c] for c in kept), batch["ids"], pa.array(out, pa.binary())], names=[*kept, "ids", "decoded"]
            )

    kinds = dict(tokens.dtypes)
    schema = "".join(f"`{c}` {kinds[c]}, " for c in kept) + "ids binary, decoded binary"
    return tokens.select(*[F.col(f"`{c}`") for c in kept], "ids").mapInArrow(run, schema)
