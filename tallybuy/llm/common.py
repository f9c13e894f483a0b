"""Small helpers shared by the text operators."""

from __future__ import annotations

import ctypes

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Ids that are null stand behind all others.
LAST_ID = 9223372036854775807


def text_of(column: str = "text") -> Column:
    """The text, null as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def id_key(column: str = "doc_id") -> Column:
    """The id as a join key that is never null: null ids are one key, behind all others."""
    return F.coalesce(F.col(column).cast("bigint"), F.lit(LAST_ID))


def _libc():
    try:
        return ctypes.CDLL("libc.so.6")
    except OSError:
        return None


def reuse_freed_memory() -> None:
    """Let the C allocator of this worker keep freed blocks of up to 8 MB, 32 MB in all.

    Arrays of a few MB otherwise come from fresh pages each time, and clearing
    those pages costs more than the arithmetic on them.
    """
    if libc := _libc():
        libc.mallopt(-3, 8 << 20)
        libc.mallopt(-1, 32 << 20)


def release_memory() -> None:
    """Give freed memory back before the worker waits for its next group, or for another task."""
    pa.default_memory_pool().release_unused()
    if libc := _libc():
        libc.malloc_trim(0)
