"""Packing of tokenized documents into sequences by the sum-of-squares rule."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybuy.llm import byte_bpe
from tallybuy.llm.common import text_of

#: With so many open sequences in one task, their rests are cut together, which bounds memory.
_MOST_OPEN = 4096


class SumOfSquares:
    """Online packing of integer sizes into windows of one capacity.

    ``counts[h]`` is the number of open windows filled up to level ``h``. A new
    piece goes to the level, or a new window, that makes the sum of squared
    counts smallest; full windows aren't open and don't count.
    """

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.counts = np.zeros(capacity + 1, np.int64)
        self.windows: list[list[list]] = [[] for _ in range(capacity)]
        self.open = 0

    def level_for(self, size: int) -> int:
        """Best level; 0 is a new window. Of equals the fullest."""
        top = self.capacity - size
        after = 2 * self.counts[size : self.capacity + 1] + 1  # windows that reach levels size, size + 1, ...
        after[-1] = 0
        here = self.counts[: top + 1]
        change = np.where(here > 0, after + 1 - 2 * here, np.iinfo(np.int64).max)
        change[0] = after[0]
        return top - int(np.argmin(change[::-1]))

    def place(self, size: int, piece) -> list | None:
        """Put a piece into a window; its pieces, if that window is now full."""
        level = self.level_for(size)
        if level:
            pieces = self.windows[level].pop()
            self.counts[level] -= 1
            self.open -= 1
        else:
            pieces = []
        pieces.append(piece)
        if level + size == self.capacity:
            return pieces
        self.windows[level + size].append(pieces)
        self.counts[level + size] += 1
        self.open += 1
        return None

    def drain(self) -> Iterator:
        """All pieces of open windows, fullest windows first; then none is open."""
        for level in range(self.capacity - 1, 0, -1):
            for pieces in self.windows[level]:
                yield from pieces
            self.windows[level] = []
        self.counts[:] = 0
        self.open = 0


def _part(piece: tuple, begin: int, end: int) -> tuple:
    doc, start, ids, total = piece
    return doc, start + begin, ids[begin:end], total


def _recut(pieces: Iterator, capacity: int) -> tuple[list[list], list]:
    """Pieces laid end to end and cut: full windows, and what is left over."""
    full, rest, filled = [], [], 0
    for piece in pieces:
        while len(piece[2]):
            take = min(capacity - filled, len(piece[2]))
            rest.append(_part(piece, 0, take))
            piece, filled = _part(piece, take, len(piece[2])), filled + take
            if filled == capacity:
                full.append(rest)
                rest, filled = [], 0
    return full, rest


def _powers(pieces: list, capacity: int) -> Iterator[list]:
    """A rest cut into sequences whose lengths are powers of two, the largest first."""
    left = sum(len(p[2]) for p in pieces)
    while left:
        size = 1 << (left.bit_length() - 1)
        head, tail = _recut(iter(pieces), size)
        flat = [p for group in head[1:] for p in group] + tail
        yield head[0]
        pieces, left = flat, left - size


def pack_stream(documents: Iterator[tuple], capacity: int) -> Iterator[list[tuple]]:
    """Sequences, as lists of pieces (document, start, ids, tokens of the document), without padding.

    ``documents`` gives (document, ids). Whole windows of a long document go out
    as they are; its rest is placed by the sum-of-squares rule. What is open at
    the end is cut anew into full windows; the last rest goes out in sequences
    of powers of two, which need no padding. Documents that can't share windows (all
    of 1,500 tokens, say) leave a window open each; so that memory stays bounded, open
    windows are cut anew as at the end whenever there are ``_MOST_OPEN`` of them.
    """
    packer = SumOfSquares(capacity)
    for doc, ids in documents:
        total, at = len(ids), 0
        while total - at >= capacity:
            yield [(doc, at, ids[at : at + capacity], total)]
            at += capacity
        if at < total:
            full = packer.place(total - at, (doc, at, ids[at:].copy(), total))
            if full:
                yield full
            if packer.open >= _MOST_OPEN:
                windows, rest = _recut(packer.drain(), capacity)
                yield from windows
                if rest:
                    level = sum(len(p[2]) for p in rest)
                    packer.windows[level].append(rest)
                    packer.counts[level] += 1
                    packer.open += 1
    windows, rest = _recut(packer.drain(), capacity)
    yield from windows
    yield from _powers(rest, capacity)


_SCHEMA = (
    "doc_id bigint, start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint"
)
_FLUSH_ROWS = 2000


def pack(docs: DataFrame, path: str, capacity: int = 2048, end_id: int = 1) -> DataFrame:
    """Pieces of all documents in sequences of at most ``capacity`` tokens: one row for each piece.

    A document is its ids by the tokenizer file at ``path``, added tokens in a text included, and ``end_id``. Columns:
    ``doc_id, start`` (ids of the document before the piece)``, length, ids``
    (binary, unsigned 32-bit little-endian)``, doc_tokens, sequence_id, offset``
    (place in the sequence). Every id is in one piece; sequences have
    ``capacity`` tokens, but for a few of each task, whose lengths are powers of two.

    Each task packs the rows it reads and nothing is shuffled; the number of the
    task is part of the sequence's id. Null and empty texts are just ``end_id``.
    Repeated rows are packed like others. An empty table gives no rows.
    """

    def run(batches):
        encoder = byte_bpe.encoder(path)
        sequence = TaskContext.get().partitionId() << 40

        def documents():
            for batch in batches:
                for at in range(0, batch.num_rows, _FLUSH_ROWS):
                    part = batch.slice(at, _FLUSH_ROWS)
                    for doc, ids in zip(part["doc_id"].to_pylist(), encoder.encode(part["text"].to_pylist())):
                        yield doc, np.append(ids, np.uint32(end_id)).astype("<u4")

        rows: list[tuple] = []
        for pieces in pack_stream(documents(), capacity):
            offset = 0
            for doc, start, ids, total in pieces:
                rows.append((doc, start, len(ids), ids.tobytes(), total, sequence, offset))
                offset += len(ids)
            sequence += 1
            if len(rows) >= _FLUSH_ROWS:
                yield _batch(rows)
                rows = []
        yield _batch(rows)

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_of().alias("text"))
    return rows.mapInArrow(run, _SCHEMA)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    names = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
    columns = list(zip(*rows)) or [()] * len(names)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, pa.binary() if n == "ids" else pa.int64()) for n, c in zip(names, columns)], names=names
    )
