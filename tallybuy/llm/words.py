"""Words of texts as numbers, by array operations on whole Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

#: Bytes of text that are cut at a time; a longer text is cut alone.
GROUP_BYTES = 4 << 20


class Words(NamedTuple):
    """Words of some texts, end to end: those of text ``t`` are ``edges[t]`` to ``edges[t + 1]``."""

    values: pa.Array  # binary
    edges: np.ndarray
    starts: np.ndarray  # first byte of each word, counted from the first byte of the first text
    ends: np.ndarray


def byte_table(separators, lower: bool) -> tuple[np.ndarray, np.ndarray]:
    """Whether each byte belongs to words, and the byte that stands for it."""
    inside = np.ones(256, bool)
    inside[list(separators)] = False
    shown = np.arange(256, dtype=np.uint8)
    if lower:
        shown[65:91] += 32
    return inside, shown


def groups(batch: pa.RecordBatch, column: str = "text", limit: int = GROUP_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``limit`` bytes of text each, one row at least."""
    ends = text_offsets(batch[column])[1:].astype(np.int64)
    at = 0
    while at < batch.num_rows:
        base = int(ends[at - 1]) if at else int(text_offsets(batch[column])[0])
        stop = max(at + 1, int(np.searchsorted(ends, base + limit, side="right")))
        yield batch.slice(at, stop - at)
        at = stop


def text_offsets(texts: pa.Array) -> np.ndarray:
    """Where each text begins and ends in the buffer of ``texts`` (without nulls)."""
    if not len(texts):
        return np.zeros(1, np.int32)
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    offsets = np.frombuffer(texts.buffers()[1], np.int64 if wide else np.int32)
    return offsets[texts.offset : texts.offset + len(texts) + 1]


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of ``texts`` and the place where each text begins in them, and the last ends."""
    offsets = text_offsets(texts)
    buffer = texts.buffers()[2] if len(texts) else None
    data = np.frombuffer(buffer, np.uint8) if buffer is not None and buffer.size else np.empty(0, np.uint8)
    return data[int(offsets[0]) : int(offsets[-1])], (offsets - offsets[0]).astype(np.int64)


def words_of(texts: pa.Array, table: tuple[np.ndarray, np.ndarray]) -> Words:
    """Maximal runs of word bytes in each text; they never cross texts."""
    inside, shown = table
    data, offsets = text_bytes(texts)
    mask = np.zeros(len(data) + 2, bool)
    mask[1:-1] = inside[data]
    begins = mask[1:-1] & ~mask[:-2]
    ends = mask[1:-1] & ~mask[2:]
    border = offsets[1:-1][(offsets[1:-1] > 0) & (offsets[1:-1] < len(data))]
    begins[border] = mask[1:-1][border]
    ends[border - 1] = mask[1:-1][border - 1]
    starts, stops = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    sizes = np.zeros(len(starts) + 1, np.int32)
    np.cumsum(stops - starts, out=sizes[1:])
    kept = shown[data[mask[1:-1]]]
    values = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(sizes), pa.py_buffer(kept)])
    return Words(values, np.searchsorted(starts, offsets), starts, stops)
