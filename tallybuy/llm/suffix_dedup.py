"""Removal of long byte strings that an earlier document holds, by a family of suffix arrays.

Texts are cut into blocks. Every string of ``length`` bytes has one anchor, the
smallest hash among its shorter substrings, so equal strings have equal anchors
wherever they stand; the strings of one anchor stand side by side as a segment.

Texts longer than a block are cut into parts with ``length - 1`` bytes of overlap, so a
block has a bounded size; what a shard gets is taken in turns by hash.

1. Blocks send the distinct anchor hashes they hold to shards, which tell each
   block the anchors that another block has, too.
2. Blocks send the segments of such anchors to shards. Of equal segments in one
   block only that of the smallest document goes; the others are repeats.
3. A shard takes segments in batches, in the order of documents. A batch gets its
   suffix array, is scanned against those of the levels so far, and becomes a
   level; levels of about one size are merged, so there are only logarithmically
   many, each about twice as large as the next.
4. Blocks get back the strings that repeat and remove the bytes they cover.

A hot passage that stands alike in many documents costs a block one anchor hash
and one segment. A phrase shorter than ``length``, or the edge of a passage, has
other neighbours in each document and so a segment in each. Segments are counted
for each anchor in step 1; those of hot anchors are dealt to shards string by
string, by a hash of the whole string, and a block sends each of their strings
only for its smallest document. So no anchor brings more than ``hot`` segments
into one shard.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybuy.llm.common import id_key, release_memory, reuse_freed_memory, text_of
from tallybuy.llm.words import text_bytes
from tallybuy.session import write_out

#: Anchors are hashes of so many bytes.
_GRAM = 24
#: Bytes of text in a block, about; a longer text is cut.
_BLOCK_BYTES = 4 << 20
#: Bytes of text for each shard of segments, about, and shards of segments for one of anchors.
_SHARD_BYTES, _FINE = 4 << 20, 3
#: Segments in a batch.
_BATCH = 1 << 14
_CHUNK = 1 << 16
#: Segments of one anchor in all blocks, from which on their strings are dealt out one by one.
_HOT = 1 << 13
#: Strings of a shard, and hot strings of a block, are taken in so many turns (as bits).
_TURN_BITS = 3
_INDEX_BITS = np.uint64((1 << 18) - 1)


# --- blocks -------------------------------------------------------------------------------


def _squeeze(*arrays: np.ndarray) -> bytes:
    """Arrays as one compressed binary."""
    raw = b"".join(np.int64(len(a)).tobytes() + a.tobytes() for a in arrays)
    return len(raw).to_bytes(8, "little") + bytes(pa.Codec("zstd", compression_level=3).compress(raw))


def _expand(data, *kinds: str) -> list[np.ndarray]:
    view = memoryview(data)
    raw = pa.Codec("zstd").decompress(view[8:], int.from_bytes(view[:8], "little"))
    view, at, out = memoryview(raw), 0, []
    for kind in kinds:
        n = int(np.frombuffer(view[at : at + 8], np.int64)[0])
        size = n * np.dtype(kind).itemsize
        out.append(np.frombuffer(view[at + 8 : at + 8 + size], kind))
        at += 8 + size
    return out


def _blocks(docs: DataFrame, length: int, block_bytes: int) -> DataFrame:
    """``block, n_bytes, body, text, part``: ids, order keys and texts of some documents, compressed.

    A text of more than ``block_bytes`` is cut into parts, each a block: the strings that
    start in so many bytes, and so the first bytes of the next part, too. ``text`` is
    the first block of such a text, and null for others.
    """
    names = ["block", "n_bytes", "body", "text", "part"]
    kinds = [pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64()]

    def run(batches):
        block, held, size = TaskContext.get().partitionId() << 32, [], 0

        def row(rows, text=None, part=None):
            body = _squeeze(
                np.array([d for d, _, _ in rows], np.int64),
                np.array([i for _, i, _ in rows], np.uint8),
                np.array([len(t) for _, _, t in rows], np.int64),
                np.concatenate([t for _, _, t in rows]),
            )
            cells = (block, sum(len(t) for _, _, t in rows), body, text, part)
            return pa.RecordBatch.from_arrays([pa.array([c], k) for c, k in zip(cells, kinds)], names=names)

        for batch in batches:
            data, offsets = text_bytes(batch["text"])
            edges, nulls = offsets.tolist(), batch["doc_id"].is_null().to_pylist()
            for k, did in enumerate(batch["did"].to_pylist()):
                text = data[edges[k] : edges[k + 1]]
                if len(text) > block_bytes:
                    if held:
                        yield row(held)
                        block, held, size = block + 1, [], 0
                    first = block
                    for part, at in enumerate(range(0, len(text), block_bytes)):
                        yield row([(did, nulls[k], text[at : at + block_bytes + length - 1])], first, part)
                        block += 1
                    continue
                # A copy, as the batch goes while its texts wait for a block.
                held.append((did, nulls[k], text.copy()))
                size += len(text)
                if size >= block_bytes:
                    yield row(held)
                    block, held, size = block + 1, [], 0
        if held:
            yield row(held)

    rows = docs.select(id_key().alias("did"), F.col("doc_id").cast("bigint").alias("doc_id"), text_of().alias("text"))
    return rows.mapInArrow(run, "block bigint, n_bytes bigint, body binary, text bigint, part bigint")


class _Block:
    """Texts of a block, laid end to end."""

    def __init__(self, body):
        self.dids, self.null, self.sizes, self.data = _expand(body, "i8", "u1", "i8", "u1")
        self.ends = np.cumsum(self.sizes)
        self.starts = self.ends - self.sizes


def _anchors(block: _Block, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash of each segment's anchor, start of its first string, number of its strings, its document.

    The anchor of a string is the leftmost of its smallest gram hashes.
    """
    data, width = block.data, length - _GRAM + 1
    n = len(data) - length + 1
    hashes, firsts, counts = [], [], []
    words = np.ndarray((max(len(data) - 7, 0),), "<u8", data, 0, (1,))
    whole = np.zeros(max(n, 0) + 1, np.int32)  # strings that start here and end in the same text
    begins, ends = block.starts[block.sizes >= length], block.ends[block.sizes >= length] - length + 1
    np.add.at(whole, begins, 1)
    np.add.at(whole, ends, -1)
    inside = np.cumsum(whole[:-1]) > 0
    for at in range(0, max(n, 0), _CHUNK):
        strings = min(_CHUNK, n - at)
        grams = strings + width - 1
        y = words[at : at + grams + 16].astype(np.uint64)
        h = y[:-16] * np.uint64(0x9E3779B97F4A7C15)
        h += y[8:-8] * np.uint64(0xC2B2AE3D27D4EB4F)
        h += y[16:] * np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(32)
        low = (h & ~_INDEX_BITS) | np.arange(grams, dtype=np.uint64)
        span = 1
        while span * 2 <= width:
            low = np.minimum(low[: len(low) - span], low[span:])
            span *= 2
        if span < width:
            low = np.minimum(low[:strings], low[width - span : width - span + strings])
        anchor = (low[:strings] & _INDEX_BITS).astype(np.int64) + at
        start = np.flatnonzero(inside[at : at + strings])
        if not len(start):
            continue
        anchor, start = anchor[start], start + at
        # Segments also end with a chunk; their strings have the same anchor all the same.
        head = np.flatnonzero(
            np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (start[1:] != start[:-1] + 1)])
        )
        hashes.append(h[anchor[head] - at])
        firsts.append(start[head])
        counts.append(np.diff(np.append(head, len(start))))
    if not hashes:
        none = np.empty(0, np.int64)
        return none.astype(np.uint64), none, none, none
    first = np.concatenate(firsts)
    document = np.searchsorted(block.ends, first, side="right")
    # The smallest hashes of many are small; mixed once more they spread over all shards.
    mixed = np.concatenate(hashes) * np.uint64(0x94D049BB133111EB)
    mixed ^= mixed >> np.uint64(32)
    return mixed * np.uint64(0xFF51AFD7ED558CCD), first, np.concatenate(counts), document


#: Blocks are dealt out by these columns each time they meet something, so that Spark shuffles them once.
_BLOCK = ("block", "text", "part", "body")


# --- step 1: anchors of several blocks ----------------------------------------------------


def _shard_bits(total_bytes: int) -> int:
    return max(3 + _FINE, (total_bytes // _SHARD_BYTES).bit_length())


def _tasks(bits: int) -> int:
    return min(1 << bits, 8192)


def _split(keys: np.ndarray, bits: int):
    """Slices of sorted 64-bit keys by their top bits: (shard, slice)."""
    shard = (keys >> np.uint64(64 - bits)).astype(np.int64)
    edges = np.concatenate([[0], np.flatnonzero(np.diff(shard)) + 1, [len(keys)]])
    for a, b in zip(edges[:-1], edges[1:]):
        if b > a:
            yield int(shard[a]), slice(int(a), int(b))


def _rows(columns: dict[str, list], kinds: dict[str, pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[c], kinds[c]) for c in kinds], names=list(kinds))


def _shared_anchors(blocks: DataFrame, length: int, bits: int, hot: int) -> DataFrame:
    """``block, shard, hashes, hot``: anchors of a block, the middle 32 bits of each, that other blocks have as well.

    ``hot`` has a byte for each, whether all blocks together have more than ``hot`` segments of it.
    """
    sent = {"shard": pa.int64(), "block": pa.int64(), "hashes": pa.binary(), "segments": pa.binary()}
    kinds = {"shard": pa.int64(), "block": pa.int64(), "hashes": pa.binary(), "hot": pa.binary()}

    def send(batches):
        reuse_freed_memory()
        for batch in batches:
            for name, body in zip(batch["block"].to_pylist(), batch["body"].to_pylist()):
                hashes, segments = np.unique(_anchors(_Block(body), length)[0], return_counts=True)
                out = {c: [] for c in sent}
                for shard, part in _split(hashes, bits):
                    out["shard"].append(shard)
                    out["block"].append(name)
                    out["hashes"].append((hashes[part] >> np.uint64(32 - bits)).astype("<u4").tobytes())
                    # Two bytes do where the sum only has to pass a limit below.
                    out["segments"].append(np.minimum(segments[part], 65_535).astype("<u2").tobytes())
                yield _rows(out, sent)

    def meet(key, table):
        reuse_freed_memory()
        names = table["block"].to_numpy()
        arrays = [np.frombuffer(x, "<u4") for x in table["hashes"].to_pylist()]
        segments = np.concatenate([np.frombuffer(x, "<u2") for x in table["segments"].to_pylist()])
        owner = np.repeat(np.arange(len(arrays), dtype=np.uint64), [len(a) for a in arrays])
        keys = (np.concatenate(arrays).astype(np.uint64) << np.uint64(32)) | owner
        order = np.argsort(keys, kind="stable")
        keys, segments = keys[order], segments[order]
        # Anchors of a block that are alike in these bits are one.
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        keys, segments = keys[first], np.add.reduceat(segments, first, dtype=np.int64)
        value = keys >> np.uint64(32)
        first = np.flatnonzero(np.concatenate([[True], value[1:] != value[:-1]]))
        is_hot = np.repeat(np.add.reduceat(segments, first) > hot, np.diff(np.append(first, len(value)))).astype(np.uint8)
        same = value[1:] == value[:-1]
        shared = np.zeros(len(keys), bool)
        shared[1:] |= same
        shared[:-1] |= same
        keys, is_hot = keys[shared], is_hot[shared]
        owner = (keys & np.uint64(0xFFFFFFFF)).astype(np.int64)
        order = np.argsort(owner, kind="stable")
        values, owner, is_hot = (keys[order] >> np.uint64(32)).astype("<u4"), owner[order], is_hot[order]
        edges = np.concatenate([[0], np.flatnonzero(np.diff(owner)) + 1, [len(owner)]]) if len(owner) else [0]
        out = {c: [] for c in kinds}
        for a, b in zip(edges[:-1], edges[1:]):
            out["shard"].append(key[0].as_py())
            out["block"].append(int(names[owner[a]]))
            out["hashes"].append(values[a:b].tobytes())
            out["hot"].append(is_hot[a:b].tobytes())
        return pa.Table.from_batches([_rows(out, kinds)])

    schema = "shard bigint, block bigint, hashes binary, "
    # A shard is work enough for a task; small as its rows are, they aren't to be put together with others.
    dealt = blocks.mapInArrow(send, schema + "segments binary").repartition(_tasks(bits), "shard")
    return dealt.groupBy("shard").applyInArrow(meet, schema + "hot binary")


# --- step 2: segments ---------------------------------------------------------------------


def _gathered(data: np.ndarray, first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Bytes of slices, end to end."""
    at = np.cumsum(sizes)
    return data[np.repeat(first - (at - sizes), sizes) + np.arange(at[-1] if len(at) else 0)]


def _alike(data: np.ndarray, one: np.ndarray, two: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Whether slices that begin in two places are equal."""
    out = np.empty(len(one), bool)
    for at in range(0, len(one), _CHUNK):
        k = slice(at, at + _CHUNK)
        differ = _gathered(data, one[k], sizes[k]) != _gathered(data, two[k], sizes[k])
        out[k] = ~np.logical_or.reduceat(differ, np.cumsum(sizes[k]) - sizes[k])
    return out


def _segment_hash(data: np.ndarray, first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Hash of each slice of at least 8 bytes: of its overlapping words, and its size."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    words = np.ndarray((len(padded) - 7,), "<u8", padded, 0, (1,))
    out = sizes.astype(np.uint64)
    for k in range(0, int(sizes.max()) if len(sizes) else 0, 8):
        word = words[first + np.minimum(k, sizes - 8)]
        out = (out ^ word) * np.uint64(0x9FB21C651E98DF25)
        out ^= out >> np.uint64(32)
    return out


def _string_hash(data: np.ndarray, first: np.ndarray, length: int) -> np.ndarray:
    """Hash of the string of ``length`` bytes that begins in each place."""
    out = np.empty(len(first), np.uint64)
    for at in range(0, len(first), _CHUNK):
        k = slice(at, at + _CHUNK)
        begin = first[k].astype(np.int64)
        out[k] = _segment_hash(data, begin, np.full(len(begin), length, np.int64))
    return out


def _repeated(data: np.ndarray, first: np.ndarray, sizes: np.ndarray, dids: np.ndarray, digest: np.ndarray) -> np.ndarray:
    """Whether a slice equals one of a smaller document, of those with its ``digest`` the smallest."""
    order = np.lexsort((dids, digest))
    new = np.concatenate([[True], digest[order][1:] != digest[order][:-1]])
    leader = order[np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))]
    later = np.zeros(len(first), bool)
    later[order] = dids[order] > dids[leader]
    if later.any():  # equal hashes of unequal slices aren't repeats
        of = np.empty(len(first), np.int64)
        of[order] = leader
        rows = np.flatnonzero(later)
        lead = of[rows]
        alike = sizes[rows] == sizes[lead]
        rows, lead = rows[alike], lead[alike]
        later[:] = False
        later[rows[_alike(data, first[rows], first[lead], sizes[rows])]] = True
    return later


def _segments(blocks: DataFrame, shared: DataFrame, length: int, bits: int, coarse: int) -> DataFrame:
    """``shard, block, body``: segments to look up, by shard, or strings known to repeat, with a negative shard."""
    kinds = {"shard": pa.int64(), "block": pa.int64(), "body": pa.binary()}

    def select(key, block_rows, shared_rows):
        reuse_freed_memory()
        block = _Block(block_rows["body"][0].as_py())
        hashes, first, strings, document = _anchors(block, length)
        sent = [
            (np.uint64(s) << np.uint64(32)) | np.frombuffer(x, "<u4").astype(np.uint64)
            for s, x in zip(shared_rows["shard"].to_pylist(), shared_rows["hashes"].to_pylist())
        ]
        known = np.concatenate(sent) if sent else np.empty(0, np.uint64)
        order = np.argsort(known)
        known = known[order]
        heat = np.frombuffer(b"".join(shared_rows["hot"].to_pylist()), np.uint8)[order] > 0
        mine = hashes >> np.uint64(32 - coarse)
        _, inverse, counts = np.unique(hashes, return_inverse=True, return_counts=True)
        wanted, is_hot = counts[inverse] > 1, np.zeros(len(hashes), bool)
        if len(known):
            at = np.minimum(np.searchsorted(known, mine), len(known) - 1)
            here = known[at] == mine
            wanted |= here
            is_hot = here & heat[at]
        hashes, first, strings, dids = hashes[wanted], first[wanted], strings[wanted], block.dids[document[wanted]]
        is_hot = is_hot[wanted]
        out = {c: [] for c in kinds}

        def unrepeated(first, strings, dids, digest):
            """What no smaller document of the block holds; the rest goes out as known to repeat."""
            later = _repeated(block.data, first, strings + length - 1, dids, digest)
            if later.any():
                out["shard"].append(-1 - key[0].as_py())
                out["block"].append(key[0].as_py())
                out["body"].append(_squeeze(first[later].astype("<u4"), strings[later].astype("<u4")))
            return ~later

        def deal(hashes, first, strings, dids):
            go = np.argsort(hashes, kind="stable")
            for shard, part in _split(hashes[go], bits):
                k = go[part]
                out["shard"].append(shard)
                out["block"].append(key[0].as_py())
                # The bits behind those of the shard part its strings again.
                turn = ((hashes[k] << np.uint64(bits)) >> np.uint64(64 - _TURN_BITS)).astype("u1")
                out["body"].append(
                    _squeeze(
                        dids[k], first[k].astype("<u4"), strings[k].astype("u1"), turn,
                        _gathered(block.data, first[k], strings[k] + length - 1),
                    )
                )

        if len(first):
            go = unrepeated(first, strings, dids, _segment_hash(block.data, first, strings + length - 1))
            cold, hot = go & ~is_hot, go & is_hot
            deal(hashes[cold], first[cold], strings[cold], dids[cold])
            if hot.any():
                n = strings[hot]
                start = np.repeat((first[hot] - (np.cumsum(n) - n)).astype(np.int32), n) + np.arange(n.sum(), dtype=np.int32)
                digest = _string_hash(block.data, start, length)
                # Equal strings have equal digests, so they can be taken a part of the digests at a time.
                turns = (digest & np.uint64((1 << _TURN_BITS) - 1)).astype(np.uint8)
                for turn in range(1 << _TURN_BITS):
                    at, mixed = start[turns == turn].astype(np.int64), digest[turns == turn]
                    one = np.ones(len(at), np.int64)
                    owner = block.dids[np.searchsorted(block.ends, at, side="right")]
                    go = unrepeated(at, one, owner, mixed)
                    deal(mixed[go] * np.uint64(0xFF51AFD7ED558CCD), at[go], one[go], owner[go])
        release_memory()
        return pa.Table.from_batches([_rows(out, kinds)])

    return (
        blocks.select(*_BLOCK).groupBy("block")
        .cogroup(shared.groupBy("block"))
        .applyInArrow(select, "shard bigint, block bigint, body binary")
    )


# --- step 3: the index --------------------------------------------------------------------


class SuffixIndex:
    """Suffix arrays of strings of one length, in levels that shrink by half or more.

    A level is the sorted distinct strings of some batches, with the smallest
    document that holds each.
    """

    def __init__(self):
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []

    @staticmethod
    def _array(strings: np.ndarray, documents: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sorted distinct strings, their smallest documents, and the place of each string in them."""
        order = np.argsort(strings, kind="stable")
        held = strings[order]
        new = np.concatenate([[True], held[1:] != held[:-1]]) if len(held) else np.empty(0, bool)
        first = np.flatnonzero(new)
        place = np.empty(len(strings), np.int64)
        place[order] = np.cumsum(new) - 1
        return held[first], np.minimum.reduceat(documents[order], first) if len(first) else documents[:0], place

    def scan(self, strings: np.ndarray, documents: np.ndarray) -> np.ndarray:
        """Whether a smaller document, of this batch or before, holds each string; the batch joins the index."""
        if not len(strings):
            return np.empty(0, bool)
        array, smallest, place = self._array(strings, documents)
        least = smallest.copy()
        for held, owners in self.levels:
            at = np.minimum(np.searchsorted(held, array), len(held) - 1)
            hit = held[at] == array
            least[hit] = np.minimum(least[hit], owners[at[hit]])
        self.levels.append((array, smallest))
        while len(self.levels) > 1 and len(self.levels[-2][0]) < 2 * len(self.levels[-1][0]):
            (a, x), (b, y) = self.levels.pop(), self.levels.pop()
            merged, owners, _ = self._array(np.concatenate([b, a]), np.concatenate([y, x]))
            self.levels.append((merged, owners))
        return least[place] < documents


def _found(segments: DataFrame, length: int, bits: int) -> DataFrame:
    """``block, body``: strings that repeat, as starts and numbers of neighbours."""
    kinds = {"block": pa.int64(), "body": pa.binary()}

    def look_up(key, table):
        if key[0].as_py() < 0:
            return table.select(["block", "body"])
        reuse_freed_memory()
        names = table["block"].to_numpy()
        parts = [_expand(x.as_buffer(), "i8", "<u4", "u1", "u1", "u1") for x in table["body"]]
        dids, first, strings, turns, data = (np.concatenate([p[k] for p in parts]) for k in range(5))
        owner = np.repeat(np.arange(len(parts), dtype=np.int32), [len(p[0]) for p in parts])
        del parts
        sizes = strings + np.int64(length - 1)
        begin = np.cumsum(sizes) - sizes
        del sizes
        slices = np.lib.stride_tricks.sliding_window_view(data, length)
        runs = []
        # Equal strings come in the same turn, so each turn has an index of its own.
        for turn in range(1 << _TURN_BITS):
            order = np.flatnonzero(turns == turn)
            order = order[np.argsort(dids[order], kind="stable")]
            index = SuffixIndex()
            for at in range(0, len(order), _BATCH):
                k = order[at : at + _BATCH]
                n = strings[k].astype(np.int64)
                of = np.repeat(np.arange(len(k)), n)
                step = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
                where = begin[k][of] + step
                texts = slices[where].view(f"S{length}").ravel()
                hit = index.scan(texts, dids[k][of])
                of, step = of[hit], step[hit]
                if len(of):
                    new = np.concatenate([[True], (of[1:] != of[:-1]) | (step[1:] != step[:-1] + 1)])
                    head = np.flatnonzero(new)
                    count = np.diff(np.append(head, len(of)))
                    runs.append((owner[k][of[head]], first[k][of[head]] + step[head], count))
        out = {c: [] for c in kinds}
        if runs:
            who, start, count = (np.concatenate(x) for x in zip(*runs))
            by = np.argsort(who, kind="stable")
            edges = np.concatenate([[0], np.flatnonzero(np.diff(who[by])) + 1, [len(by)]])
            for a, b in zip(edges[:-1], edges[1:]):
                out["block"].append(int(names[who[by[a]]]))
                out["body"].append(_squeeze(start[by[a:b]].astype("<u4"), count[by[a:b]].astype("<u4")))
        release_memory()
        return pa.Table.from_batches([_rows(out, kinds)])

    sent = segments.repartition(_tasks(bits), "shard")
    return sent.groupBy("shard").applyInArrow(look_up, "block bigint, body binary")


# --- step 4: removal ----------------------------------------------------------------------


_RESULT = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary"


def _gone(block: _Block, found_rows: pa.Table, length: int) -> np.ndarray:
    """Whether each byte of a block is covered by a string that repeats."""
    change = np.zeros(len(block.data) + 1, np.int32)
    for body in found_rows["body"]:
        start, count = (x.astype(np.int64) for x in _expand(body.as_buffer(), "<u4", "<u4"))
        np.add.at(change, start, 1)
        np.add.at(change, start + count + length - 1, -1)
    return np.cumsum(change[:-1], dtype=np.int32) > 0


def _removed(blocks: DataFrame, found: DataFrame, length: int) -> DataFrame:
    """Results of texts that lie in one block."""

    def cut(key, block_rows, found_rows):
        if not block_rows.num_rows or block_rows["text"][0].is_valid:  # a part of a long text
            return pa.schema(_RESULT_KINDS).empty_table()
        reuse_freed_memory()
        block = _Block(block_rows["body"][0].as_py())
        gone = _gone(block, found_rows, length)
        edge = gone.copy()
        edge[1:] &= ~gone[:-1]
        at = block.starts[block.sizes > 0]
        edge[at] = gone[at]  # a run ends with its document
        removed, spans, kept = [], [], []
        for a, b in zip(block.starts.tolist(), block.ends.tolist()):
            mine = gone[a:b]
            n = int(np.count_nonzero(mine))
            removed.append(n)
            spans.append(int(np.count_nonzero(edge[a:b])) if n else 0)
            kept.append((block.data[a:b][~mine] if n else block.data[a:b]).tobytes())
        ids = pa.array(block.dids, pa.int64(), mask=block.null.astype(bool))
        out = [ids, pa.array(block.sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, pa.int64())]
        release_memory()
        return pa.table([*out, pa.array(kept, pa.binary())], schema=pa.schema(_RESULT_KINDS))

    return (
        blocks.select(*_BLOCK).groupBy("block")
        .cogroup(found.groupBy("block"))
        .applyInArrow(cut, _RESULT)
    )


_RESULT_KINDS = [(n, pa.binary() if n == "kept" else pa.int64()) for n in ("doc_id", "n_bytes", "n_removed", "n_spans", "kept")]


def _removed_long(blocks: DataFrame, found: DataFrame, length: int, block_bytes: int) -> DataFrame:
    """Results of texts that were cut into parts, put together again part by part."""
    schema = "text bigint, part bigint, doc_id bigint, data binary, gone binary"

    def mark(key, block_rows, found_rows):
        if not block_rows.num_rows or not block_rows["text"][0].is_valid:
            columns = [("text", pa.int64()), ("part", pa.int64()), ("doc_id", pa.int64()), ("data", pa.binary()), ("gone", pa.binary())]
            return pa.schema(columns).empty_table()
        block = _Block(block_rows["body"][0].as_py())
        gone = _gone(block, found_rows, length)
        out = pa.table(
            {
                "text": block_rows["text"],
                "part": block_rows["part"],
                "doc_id": pa.array(block.dids, pa.int64(), mask=block.null.astype(bool)),
                "data": pa.array([block.data[:block_bytes].tobytes()], pa.binary()),
                "gone": pa.array([np.packbits(gone).tobytes()], pa.binary()),
            }
        )
        release_memory()
        return out

    def join(key, table):
        kept, n_bytes, n_removed, n_spans = [], 0, 0, 0
        before, over = False, np.empty(0, bool)  # whether the byte before is gone; what the last part covers of this one
        for k in np.argsort(table["part"].to_numpy()).tolist():
            data = np.frombuffer(table["data"][k].as_buffer(), np.uint8)
            gone = np.unpackbits(np.frombuffer(table["gone"][k].as_buffer(), np.uint8)).astype(bool)
            gone[: len(over)] |= over[: len(gone)]
            mine, over = gone[: len(data)], gone[len(data) : len(data) + length - 1]
            n_bytes += len(data)
            n_removed += int(np.count_nonzero(mine))
            n_spans += int(np.count_nonzero(mine[1:] & ~mine[:-1])) + bool(mine[0] and not before)
            before = bool(mine[-1])
            kept.append(data[~mine].tobytes())
        cells = [table["doc_id"][0].as_py(), n_bytes, n_removed, n_spans, b"".join(kept)]
        return pa.table([pa.array([c], k) for c, (_, k) in zip(cells, _RESULT_KINDS)], schema=pa.schema(_RESULT_KINDS))

    parts = (
        blocks.select(*_BLOCK).groupBy("block")
        .cogroup(found.groupBy("block"))
        .applyInArrow(mark, schema)
    )
    return parts.groupBy("text").applyInArrow(join, _RESULT)


def remove_repeats(docs: DataFrame, length: int = 50, hot: int = _HOT, block_bytes: int = _BLOCK_BYTES) -> DataFrame:
    """Texts without the bytes covered by a ``length``-byte string that starts in an earlier document, too.

    One row for each row of ``docs``: ``doc_id, n_bytes, n_removed, n_spans``
    (maximal removed runs)``, kept`` (the other bytes, binary, as a removal may
    end within a character). Strings are those of the input, not of what is
    left, overlap, and don't cross documents. Rows that share an id are one
    document to each other; null ids are one document behind all others. Null
    and empty texts and texts shorter than ``length`` lose nothing. Other columns aren't
    read; an empty table gives no rows. ``hot`` and ``block_bytes`` only set how the work
    is dealt: segments of an anchor that one shard takes, and bytes of text in a block.
    """
    if not 2 * _GRAM <= length <= 256:
        raise ValueError(f"length must be from {2 * _GRAM} to 256")
    blocks = write_out(_blocks(docs, length, block_bytes), "text-blocks")
    total, long = blocks.agg(F.sum("n_bytes"), F.count("text")).first()
    total = total or 0
    bits = _shard_bits(total)
    coarse = bits - _FINE
    shared = _shared_anchors(blocks, length, coarse, hot)
    segments = _segments(blocks, shared, length, bits, coarse)
    found = _found(segments, length, bits)
    if not long:
        return _removed(blocks, found, length)
    found = write_out(found, "repeats")
    return _removed(blocks, found, length).unionByName(_removed_long(blocks, found, length, block_bytes))
