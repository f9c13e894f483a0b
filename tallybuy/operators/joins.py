"""Joins of many rows with a table that has one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_MARK = "_key_mark"
_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def _mark(df: DataFrame, keys: Sequence[str]) -> Column:
    """Hash of the keys; whole numbers of any width hash alike."""
    parts = [
        F.col(k).cast("bigint") if isinstance(df.schema[k].dataType, _INTEGRAL) else F.col(k)
        for k in keys
    ]
    return F.xxhash64(*parts)


def lookup(
    rows: DataFrame, table: DataFrame, keys: Sequence[str], how: str = "left", grows: bool = False
) -> DataFrame:
    """Join ``table`` onto ``rows``; a hot key of ``rows`` is split at run time.

    A small table is broadcast by Spark on its measured size, and nothing else
    happens. Otherwise adaptive execution splits hot keys, but only where both
    sides of a join come straight from a shuffle made for it. A table that is
    an aggregate on the same keys would skip that shuffle. The hash of the keys
    as a further join column asks for it again, and it also makes an aggregate
    on the keys afterwards combine before it shuffles, so the hot key is not
    brought together by the join.

    ``grows`` is for a table that is far smaller in its files than in memory
    (rising ids, factors that are mostly zero): its size there would let it be
    broadcast, and the driver would hold it whole. Such a table is shuffled.
    """
    keys = list(keys)
    if grows:
        table = table.hint("merge")
    marked = rows.withColumn(_MARK, _mark(rows, keys))
    joined = marked.join(table.withColumn(_MARK, _mark(table, keys)), [*keys, _MARK], how)
    added = [c for c in joined.columns if c not in rows.columns and c != _MARK]
    return joined.select(*[F.col(f"`{c}`") for c in [*rows.columns, *added]])
