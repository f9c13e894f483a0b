"""Line deduplication over an index that takes insertions and deletions of documents.

The index has three tables. ``postings`` holds each line key of each document,
``counts`` the exact number of documents of each key and the smallest of them,
and ``filters`` one cuckoo filter for each shard of the keys that at least two
documents hold. Lines and filters meet in the executors, by shard; only hits are
joined with the exact counts. Shards grow in number with the keys, and a shard
with many lines is dealt out further, each part with a copy of its filter. A cuckoo filter can forget a key, so documents can be
taken out again and lines come back.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybuy.llm.common import id_key, text_of
from tallybuy.operators.joins import lookup
from tallybuy.session import write_out

_BLANKS = " \t\n\x0b\x0c\r"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_SLOTS = 4
#: Keys in the filter of a shard, about (1 MB), and the least number of shards.
_SHARD_KEYS, _LEAST_SHARDS = 1 << 18, 64
#: Lines that probe one copy of a filter, at most about.
_PROBE_ROWS = 1 << 19
#: Text that is taken apart at once, about.
_SLICE_BYTES = 1 << 22


# --- cuckoo filters -----------------------------------------------------------------------


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def _places(keys: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Fingerprint (never 0) and both buckets of each key; ``buckets`` is a power of two."""
    mixed = _mix(keys)
    prints = ((mixed >> np.uint64(48)) | np.uint64(1)).astype(np.uint16)
    first = (mixed & np.uint64(buckets - 1)).astype(np.int64)
    return prints, first, _other(first, prints, buckets)


def _other(bucket: np.ndarray, prints: np.ndarray, buckets: int) -> np.ndarray:
    return bucket ^ (_mix(prints.astype(np.uint64)) & np.uint64(buckets - 1)).astype(np.int64)


def _insert(table: np.ndarray, prints: np.ndarray, at: np.ndarray, rounds: int = 200) -> bool:
    """Put fingerprints into their buckets, one per bucket and round; False if the table is too full."""
    rng = np.random.default_rng(len(table))
    buckets = len(table)
    for _ in range(rounds):
        if not len(prints):
            return True
        _, chosen = np.unique(at, return_index=True)
        rest = np.ones(len(prints), bool)
        rest[chosen] = False
        where, what = at[chosen], prints[chosen]
        free = table[where] == 0
        slot = np.where(free.any(1), free.argmax(1), rng.integers(0, _SLOTS, len(where)))
        out = table[where, slot]
        table[where, slot] = what
        moved = out != 0
        # A print that waits goes on to its other bucket, as one that was pushed out does.
        prints = np.concatenate([out[moved], prints[rest]])
        at = np.concatenate(
            [_other(where[moved], out[moved], buckets), _other(at[rest], prints[moved.sum() :], buckets)]
        )
    return not len(prints)


def cuckoo_filter(keys: np.ndarray) -> np.ndarray:
    """Filter of distinct uint64 keys: a table of 16-bit fingerprints, buckets by slots."""
    buckets = 1 << max(4, int(np.ceil(np.log2(max(1, len(keys)) / (0.8 * _SLOTS)))))
    while True:
        table = np.zeros((buckets, _SLOTS), np.uint16)
        prints, first, _ = _places(keys, buckets)
        if _insert(table, prints, first):
            return table
        buckets *= 2


def cuckoo_has(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    prints, first, second = _places(keys, len(table))
    mine = prints[:, None]
    return (table[first] == mine).any(1) | (table[second] == mine).any(1)


def cuckoo_add(table: np.ndarray, keys: np.ndarray) -> np.ndarray | None:
    """A filter with further keys; None if they don't fit."""
    table = table.copy()
    prints, first, _ = _places(keys, len(table))
    return table if _insert(table, prints, first) else None


def cuckoo_remove(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """A filter without keys that it holds; each takes one fingerprint with it."""
    table = table.copy()
    prints, first, second = _places(keys, len(table))
    for p, a, b in zip(prints.tolist(), first.tolist(), second.tolist()):
        for bucket in (a, b):
            slots = np.flatnonzero(table[bucket] == p)
            if len(slots):
                table[bucket, slots[0]] = 0
                break
    return table


# --- the index ----------------------------------------------------------------------------


@dataclass(frozen=True)
class LineIndex:
    """``postings (key, did)``, ``counts (key, n_docs, first)``, ``filters (shard, cells)``.

    The tables are written and never changed; an update makes a new index.
    """

    postings: DataFrame
    counts: DataFrame
    filters: DataFrame
    shards: int
    least_points: int


def _shard(shards: int) -> Column:
    return F.pmod(F.xxhash64("key"), F.lit(shards)).cast("int").alias("shard")


def _postings(docs: DataFrame, least_points: int) -> DataFrame:
    lines = docs.select(
        id_key().alias("did"), F.explode(F.split(text_of(), "\n", -1)).alias("line")
    ).select(
        "did",
        F.translate(F.btrim("line", F.lit(_BLANKS)), _UPPER, _LOWER).alias("line"),
    )
    keyed = lines.where(F.length("line") >= least_points).select(
        F.unhex(F.md5("line")).alias("key"), "did"
    )
    return keyed.distinct()


def _counts(postings: DataFrame) -> DataFrame:
    return postings.groupBy("key").agg(
        F.count("*").alias("n_docs"), F.min("did").alias("first")
    )


def _short(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """The first eight bytes of each 16-byte key."""
    return np.frombuffer(b"".join(column.to_pylist()), np.uint64)[::2]


_FILTER_SCHEMA = "shard int, cells binary"


def _build(key: tuple, table: pa.Table) -> pa.Table:
    cells = cuckoo_filter(np.unique(_short(table["key"])))
    return pa.table({"shard": pa.array([key[0].as_py()], pa.int32()), "cells": [cells.tobytes()]})


def _rebuilt(key: tuple, filters: pa.Table, changes: pa.Table) -> pa.Table:
    """Filter of a shard after ``changes`` (key, step): step 1 adds a key, -1 removes it, 0 is there already.

    Keys of step 0 are the ones that stay; they are read only if the filter has to grow.
    """
    step = changes["step"].to_numpy()
    keys = _short(changes["key"]) if len(changes) else np.empty(0, np.uint64)
    if filters.num_rows:
        table = np.frombuffer(filters["cells"][0].as_py(), np.uint16).reshape(-1, _SLOTS)
        table = cuckoo_add(cuckoo_remove(table, keys[step < 0]), keys[step > 0])
    else:
        table = None
    if table is None:
        table = cuckoo_filter(np.unique(keys[step >= 0]))
    return pa.table({"shard": pa.array([key[0].as_py()], pa.int32()), "cells": [table.tobytes()]})


def _shared(counts: DataFrame) -> DataFrame:
    return counts.where("n_docs > 1")


def _enough_shards(counts: DataFrame) -> int:
    """Shards for the shared keys of ``counts``."""
    return max(_LEAST_SHARDS, -(-_shared(counts).count() // _SHARD_KEYS))


def _filters(counts: DataFrame, shards: int) -> DataFrame:
    keys = _shared(counts).select(_shard(shards), "key")
    return write_out(keys.groupBy("shard").applyInArrow(_build, _FILTER_SCHEMA), "line-filters")


def build_index(docs: DataFrame, shards: int | None = None, least_points: int = 10) -> LineIndex:
    """Index of all lines of ``docs`` with keys of at least ``least_points`` code points.

    A key is the line without blanks at its ends, A-Z in lower case, as its MD5.
    Rows that share a ``doc_id`` are one document; null ids are one document
    behind all others. ``shards`` only sets how the filters are cut;
    None for as many as the shared keys need.
    """
    postings = write_out(_postings(docs, least_points), "postings")
    counts = write_out(_counts(postings), "line-counts")
    shards = shards or _enough_shards(counts)
    return LineIndex(postings, counts, _filters(counts, shards), shards, least_points)


def _updated(index: LineIndex, postings: DataFrame, touched: DataFrame) -> LineIndex:
    """Index with new postings; only the counts of ``touched`` keys are computed anew.

    Where the keys have outgrown the shards, all filters are built anew.
    """
    fresh = _counts(postings.join(touched, "key", "left_semi"))
    counts = write_out(index.counts.join(touched, "key", "left_anti").unionByName(fresh), "line-counts")
    shards = _enough_shards(counts)
    if shards > max(_LEAST_SHARDS, 2 * index.shards):
        return LineIndex(postings, counts, _filters(counts, shards), shards, index.least_points)
    before = _shared(index.counts).select("key", F.lit(1).alias("was"))
    after = _shared(counts).select("key", F.lit(1).alias("is"))
    changes = before.join(after, "key", "full").select(
        _shard(index.shards), "key", (F.coalesce("is", F.lit(0)) - F.coalesce("was", F.lit(0))).alias("step")
    )
    filters = write_out(
        index.filters.groupBy("shard")
        .cogroup(changes.groupBy("shard"))
        .applyInArrow(_rebuilt, _FILTER_SCHEMA),
        "line-filters",
    )
    return LineIndex(postings, counts, filters, index.shards, index.least_points)


def insert_documents(index: LineIndex, docs: DataFrame) -> LineIndex:
    """Index with further documents."""
    added = write_out(_postings(docs, index.least_points), "postings")
    postings = write_out(index.postings.unionByName(added).distinct(), "postings")
    return _updated(index, postings, added.select("key").distinct())


def delete_documents(index: LineIndex, ids: DataFrame) -> LineIndex:
    """Index without the documents whose ``doc_id`` is in ``ids``; other lines may come back for it."""
    gone = ids.select(id_key().alias("did")).distinct()
    postings = write_out(index.postings.join(gone, "did", "left_anti").select("key", "did"), "postings")
    touched = index.postings.join(gone, "did", "left_semi").select("key").distinct()
    return _updated(index, postings, touched)


# --- deduplication ------------------------------------------------------------------------


def _copies(index: LineIndex, most: int) -> DataFrame:
    """``shard, copies``: of its filter, one for about ``most`` lines, or fewer where all lines are few."""
    lines = index.counts.groupBy(_shard(index.shards)).agg(F.sum("n_docs").alias("n"))
    held = write_out(lines, "shard-lines")  # a row for each shard
    total = held.agg(F.sum("n")).first()[0] or 0
    # A shard with a hot line has more copies than others; all together are at most three for each shard.
    part = max(1, min(most, -(-total // (2 * index.shards))))
    return held.select("shard", F.ceil(F.col("n") / part).cast("int").alias("copies"))


def _probe(key: tuple, postings: pa.Table, filters: pa.Table) -> pa.Table:
    """The lines of one part of a shard that its filter may hold."""
    rows = postings.select(["key", "did"])
    if not filters.num_rows or not rows.num_rows:
        return rows.slice(0, 0)
    table = np.frombuffer(filters["cells"][0].as_py(), np.uint16).reshape(-1, _SLOTS)
    return rows.filter(pa.array(cuckoo_has(table, _short(rows["key"]))))


def _probed(index: LineIndex, most: int = _PROBE_ROWS) -> DataFrame:
    """Postings whose key the filter of its shard may hold."""
    copies = _copies(index, most)
    sharded = lookup(index.postings.withColumn("shard", _shard(index.shards)), copies, ["shard"], "inner")
    lines = sharded.select("shard", F.pmod(F.xxhash64("did", "key"), F.col("copies")).cast("int").alias("part"), "key", "did")
    filters = index.filters.join(copies, "shard").select(
        "shard", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("part"), "cells"
    )
    met = lines.groupBy("shard", "part").cogroup(filters.groupBy("shard", "part"))
    return met.applyInArrow(_probe, "key binary, did bigint")


def _in_slices(batches, most: int = _SLICE_BYTES):
    """The batches in slices of about ``most`` bytes of text, a row at least."""
    for batch in batches:
        sizes = np.asarray(pc.binary_length(batch["text"]), np.int64)
        at = np.cumsum(sizes) // most
        edges = [0, *(np.flatnonzero(np.diff(at)) + 1).tolist(), batch.num_rows]
        for low, high in zip(edges, edges[1:]):
            yield batch.slice(low, high - low)


def _rebuild(batches):
    """Texts without the lines whose key is among ``drops``; as objects, only those of a slice are held."""
    for batch in _in_slices(batches):
        kept, before, dropped = [], [], []
        for text, drops in zip(batch["text"].to_pylist(), batch["drops"].to_pylist()):
            if not drops:
                kept.append(text)
                before.append(text.count("\n") + 1)
                dropped.append(0)
                continue
            drops, lines = set(drops), text.encode().split(b"\n")
            stay = [
                x for x in lines if hashlib.md5(x.strip(_BLANKS.encode()).lower()).digest() not in drops
            ]
            kept.append(b"\n".join(stay).decode())
            before.append(len(lines))
            dropped.append(len(lines) - len(stay))
        yield pa.RecordBatch.from_arrays(
            [
                *(batch[c] for c in batch.schema.names if c not in ("text", "drops")),
                pa.array(kept, pa.string()),
                pa.array(before, pa.int64()),
                pa.array(dropped, pa.int64()),
            ],
            names=[*(c for c in batch.schema.names if c not in ("text", "drops")), "text", "n_lines", "n_dropped"],
        )


def drop_lines(index: LineIndex, docs: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """Documents without the lines that an earlier document of the index holds.

    Columns: ``doc_id``, those named in ``carry``, ``text`` (the lines that stay,
    joined by a line feed), ``n_lines`` (before), ``n_dropped``. A line goes if
    its key is in at least two documents of the index and this isn't the one
    with the smallest id; all its copies in the document go. Null and empty
    texts have one empty line. A text whose lines all go is empty. One row comes
    out for each row of ``docs``, repeated rows too.
    """
    hits = lookup(_probed(index), _shared(index.counts).select("key", "first"), ["key"], "inner")
    drops = hits.where("did <> first").groupBy("did").agg(F.collect_list("key").alias("drops"))
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        *[F.col(f"`{c}`") for c in carry],
        text_of().alias("text"),
        id_key().alias("did"),
    )
    joined = lookup(rows, drops, ["did"]).drop("did")
    kinds = dict(joined.dtypes)
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in ("doc_id", *carry))
    return joined.mapInArrow(_rebuild, f"{schema}, text string, n_lines bigint, n_dropped bigint")


def line_dedup(docs: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """All of ``docs`` against themselves; see ``drop_lines``."""
    return drop_lines(build_index(docs), docs, carry)
