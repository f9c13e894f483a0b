"""SimHash near-duplicates: fingerprints, a binary trie joined with itself, and linked groups."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybuy.llm.common import reuse_freed_memory, text_of
from tallybuy.operators.joins import lookup
from tallybuy.session import write_out

#: Fingerprints in one group of the join, about; groups of so many are split.
_GROUP_ROWS, _HEAVY_ROWS = 1 << 11, 1 << 15
#: Most levels by which a heavy group is split.
_MOST_DEPTH = 12
#: Most node or fingerprint pairs that are expanded at once.
_PAIRS_AT_ONCE = 1 << 18


# --- fingerprints -------------------------------------------------------------------------


def _majority(hashes: np.ndarray) -> int:
    """Bits that are set in over half of the hashes, the lowest bit first in each byte."""
    votes = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at : at + (1 << 16)]
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        whole = len(bits) // 255 * 255  # sums of 255 bits fit into a byte
        votes += bits[:whole].reshape(-1, 255, 64).sum(1, dtype=np.uint8).sum(0, dtype=np.int64)
        votes += bits[whole:].sum(0, dtype=np.int64)
    return int(np.packbits(votes * 2 > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprint(text: str, words: int = 4) -> int:
    """SimHash of a text; 0 if it has no word."""
    found = text.encode().lower().split()  # on bytes: A-Z and ASCII blanks only
    if not found:
        return 0
    digest = xxhash.xxh64_intdigest
    if len(found) <= words:
        return digest(b" ".join(found), 42)
    joined = b" ".join(found)
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    pairs = zip(starts[: len(found) - words + 1].tolist(), ends[words - 1 :].tolist())
    hashes = np.fromiter((digest(joined[a:b], 42) for a, b in pairs), np.uint64, len(found) - words + 1)
    return _majority(hashes)


def fingerprints(docs: DataFrame, words: int = 4) -> DataFrame:
    """``doc_id`` and ``bits``, the fingerprint as a signed 64-bit number, for each row."""

    def run(batches):
        for batch in batches:
            bits = np.array([fingerprint(x, words) for x in batch["text"].to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(bits.view(np.int64))], names=["doc_id", "bits"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_of().alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, bits bigint")


# --- the trie join ------------------------------------------------------------------------


def forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of n things the smallest one that it is linked with through pairs (a, b)."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        before = root.copy()
        np.minimum.at(root, root[a], low)
        np.minimum.at(root, root[b], low)
        while not np.array_equal(root, up := root[root]):
            root = up
        if np.array_equal(root, before):
            return root


class _Trie:
    """Nodes of a binary trie over sorted distinct fingerprints: at each depth a node is a range."""

    def __init__(self, values: np.ndarray):
        self.values = values
        self._levels: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def level(self, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """Prefixes of the nodes and where each begins, with the end of the last."""
        if depth not in self._levels:
            prefix = self.values >> np.uint64(64 - depth) if depth else np.zeros_like(self.values)
            first = np.flatnonzero(np.concatenate([[True], prefix[1:] != prefix[:-1]])) if len(prefix) else np.empty(0, np.int64)
            self._levels[depth] = prefix[first], np.concatenate([first, [len(prefix)]])
        return self._levels[depth]

    def children(self, nodes: np.ndarray, depth: int, below: int) -> tuple[np.ndarray, np.ndarray]:
        """First and one past the last node at depth ``below`` under nodes at ``depth``."""
        _, here = self.level(depth)
        _, there = self.level(below)
        return np.searchsorted(there, here[nodes]), np.searchsorted(there, here[nodes + 1])


def _products(a0, a1, b0, b1):
    """All pairs of [a0, a1) x [b0, b1) for each element, and the element that each pair is of."""
    sizes = (a1 - a0) * (b1 - b0)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    k = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    width = (b1 - b0)[owner]
    return a0[owner] + k // width, b0[owner] + k % width, owner


def _chunks(sizes: np.ndarray):
    """Slices of a list whose sizes add up to about ``_PAIRS_AT_ONCE``, or of one element."""
    group = (np.cumsum(sizes) - sizes) // _PAIRS_AT_ONCE
    edges = np.flatnonzero(np.diff(group)) + 1
    return [slice(a, b) for a, b in zip([0, *edges], [*edges, len(sizes)])]


def trie_pairs(left: np.ndarray, right: np.ndarray, most_bits: int, start: int = 0, stride: int = 4, linked=None):
    """Batches of index pairs (into sorted ``left`` and ``right``) that differ in few bits.

    Both tries are walked together from depth ``start``. Going down ``stride``
    levels, the differing bits of the two prefixes are counted; a pair of nodes
    over the budget is left with all that is below it. Small pairs of nodes end
    in a comparison of whole fingerprints. Where both sides are one trie, each
    pair of nodes is walked once. ``linked()`` gives the group that each fingerprint of the left and the
    right is known to be in; node pairs all of one group are left.
    """
    if not len(left) or not len(right):
        return
    one = left is right
    a, b = _Trie(left), _Trie(right) if not one else None
    b = a if one else b
    n, m = len(a.level(start)[0]), len(b.level(start)[0])
    x, y, _ = _products(np.array([0]), np.array([n]), np.array([0]), np.array([m]))
    differ = np.bitwise_count(a.level(start)[0][x] ^ b.level(start)[0][y]).astype(np.int64)
    keep = (differ <= most_bits) & ((x <= y) if one else True)
    stack = [(start, x[keep], y[keep])]
    while stack:
        depth, x, y = stack.pop()
        if linked is not None and len(x):
            open_ = _still_open(linked, a.level(depth)[1], b.level(depth)[1], x, y)
            x, y = x[open_], y[open_]
        if not len(x):
            continue
        sizes = (np.diff(a.level(depth)[1])[x]) * (np.diff(b.level(depth)[1])[y])
        small = (sizes <= 64) | (depth + stride > 64)
        below = min(64, depth + stride)
        for bottom in (True, False):
            chosen = small if bottom else ~small
            if not chosen.any():
                continue
            u, v = x[chosen], y[chosen]
            if bottom:
                ranges = a.level(depth)[1][u], a.level(depth)[1][u + 1], b.level(depth)[1][v], b.level(depth)[1][v + 1]
            else:
                ranges = *a.children(u, depth, below), *b.children(v, depth, below)
            for part in _chunks((ranges[1] - ranges[0]) * (ranges[3] - ranges[2])):
                i, j, _ = _products(*(r[part] for r in ranges))
                if bottom:
                    near = np.bitwise_count(left[i] ^ right[j]) <= most_bits
                    near &= (i < j) if one else True
                    if near.any():
                        yield i[near], j[near]
                else:
                    pa_, pb_ = a.level(below)[0], b.level(below)[0]
                    near = np.bitwise_count(pa_[i] ^ pb_[j]) <= most_bits
                    near &= (i <= j) if one else True
                    stack.append((below, i[near], j[near]))


def _still_open(linked, a_starts: np.ndarray, b_starts: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Node pairs with fingerprints of more than one group."""
    of_left, of_right = linked()
    low, high = (f.reduceat(of_left, a_starts[:-1])[x] for f in (np.minimum, np.maximum))
    low_, high_ = (f.reduceat(of_right, b_starts[:-1])[y] for f in (np.minimum, np.maximum))
    return (low != high) | (low_ != high_) | (low != low_)


def _neighbours(values: np.ndarray, most_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Some links: of fingerprints that stand side by side in order, with the bits turned in five ways."""
    a, b = [], []
    for turn in range(0, 64, 13):
        order = np.argsort((values << np.uint64(turn)) | (values >> np.uint64((64 - turn) % 64)), kind="stable")
        near = np.bitwise_count(values[order[1:]] ^ values[order[:-1]]) <= most_bits
        a.append(order[:-1][near])
        b.append(order[1:][near])
    return np.concatenate(a), np.concatenate(b)


def _linked(left: np.ndarray, right: np.ndarray, most_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """A forest over the links of two sorted arrays: as many edges as there are linked fingerprints, at most.

    Links that are cheap to find come first, and what they join isn't compared again.
    """
    one = left is right
    values = left if one else np.concatenate([left, right])
    n = len(left)
    root = forest(len(values), *_neighbours(values, most_bits))

    def linked():
        return root[:n], root if one else root[n:]

    for i, j in trie_pairs(left, right, most_bits, linked=linked):
        a, b = root[i], root[j if one else j + n]
        new = a != b
        if new.any():
            root = forest(len(root), np.concatenate([np.arange(len(root)), a[new]]), np.concatenate([root, b[new]]))
    moved = np.flatnonzero(root != np.arange(len(root)))
    return values[moved], values[root[moved]]


def _blocks(rows: int, most_bits: int) -> list[list[tuple[int, int]]]:
    """Ways to choose bits that must be equal: for each, the (first bit, width) of some blocks.

    Fingerprints are cut into ``most_bits + s`` blocks. Two within the budget differ in at most
    ``most_bits`` of them, so s are equal, and the pair meets under one choice of s
    blocks. One block does up to some hundred million rows; the number of choices doesn't
    grow below that.
    """
    wanted = max(0, (max(rows, 1) // _GROUP_ROWS).bit_length())
    s = 1
    while (64 // (most_bits + s)) * s < wanted - 4 and s < 6:
        s += 1
    edges = [64 * k // (most_bits + s) for k in range(most_bits + s + 1)]
    width = min(-(-wanted // s), min(b - a for a, b in zip(edges, edges[1:])))
    return [[(edges[k], width) for k in chosen] for chosen in combinations(range(most_bits + s), s)]


def keyed(classes: DataFrame, most_bits: int, rows: int) -> DataFrame:
    """``choice, key, bits``: each fingerprint once for each choice of blocks, with the bits of these blocks."""
    choices = []
    for c, blocks in enumerate(_blocks(rows, most_bits)):
        key = F.lit(0).cast("bigint")
        for first, width in blocks:
            part = F.shiftrightunsigned(F.shiftleft("bits", first), 64 - width) if width else F.lit(0).cast("bigint")
            key = F.shiftleft(key, width).bitwiseOR(part)
        # Bits to split a heavy group by: those behind its last block.
        turn = (blocks[-1][0] + blocks[-1][1]) % 64
        rest = F.shiftleft("bits", turn).bitwiseOR(F.shiftrightunsigned("bits", 64 - turn)) if turn else F.col("bits")
        choices.append(F.struct(F.lit(c).alias("choice"), key.alias("key"), F.shiftrightunsigned(rest, 64 - _MOST_DEPTH).alias("top")))
    return classes.select("bits", F.explode(F.array(*choices)).alias("_c")).select("_c.*", "bits")


def linked_fingerprints(classes: DataFrame, most_bits: int, heavy_rows: int = _HEAVY_ROWS) -> DataFrame:
    """Edges ``a, b`` that connect what is connected by links of at most ``most_bits`` differing bits.

    ``classes`` has each fingerprint once, as ``bits``. Fingerprints that share a block
    of bits are a group, so each goes to as many groups as there are blocks, however many rows there are
    (:func:`_blocks`). In a group the trie is joined with itself. A group of more than ``heavy_rows``,
    as of a template with very many variants, is split by the next bits: each pair of
    its nodes within the budget is a group. A group returns a forest over its
    links instead of all its pairs.
    """
    rows = write_out(keyed(classes, most_bits, classes.count()), "keyed")
    sizes = rows.groupBy("choice", "key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > heavy_rows)
    depth = F.least(F.lit(_MOST_DEPTH), F.greatest(F.lit(1), F.ceil(F.log2(F.col("n") / F.lit(heavy_rows / 4.0))).cast("int")))
    heavy = write_out(sizes.select("choice", "key", depth.alias("depth")), "heavy")
    whole = rows
    split = None
    if not heavy.isEmpty():
        masks = F.array(*[F.lit(m) for m in range(1 << _MOST_DEPTH) if m.bit_count() <= most_bits])
        node = F.expr(f"shiftrightunsigned(top, {_MOST_DEPTH} - depth)").cast("int")
        near = F.transform(F.filter(masks, lambda m: m < F.expr("shiftleft(1, depth)")), lambda m: m.bitwiseXOR(F.col("u")))
        split = lookup(rows, heavy, ["choice", "key"], "inner").withColumn("u", node).withColumn("v", F.explode(near))
        split = split.select("choice", "key", F.least("u", "v").alias("low"), F.greatest("u", "v").alias("high"), "u", "bits")
        whole = lookup(rows, heavy, ["choice", "key"], "left_anti")
    zero = F.lit(0)
    placed = whole.select("choice", "key", zero.alias("low"), zero.alias("high"), zero.alias("u"), "bits")
    placed = placed if split is None else placed.unionByName(split)

    def join(key, table):
        reuse_freed_memory()
        low, high = (k.as_py() for k in key[2:])
        u = table["u"].to_numpy()
        bits = table["bits"].to_numpy().view(np.uint64)
        left = np.sort(bits[u == low])
        right = left if low == high else np.sort(bits[u == high])
        a, b = _linked(left, right, most_bits)
        return pa.table({"a": a.view(np.int64), "b": b.view(np.int64)})

    return placed.groupBy("choice", "key", "low", "high").applyInArrow(join, "a bigint, b bigint")


# --- groups -------------------------------------------------------------------------------


def components(edges: DataFrame) -> DataFrame:
    """``bits`` and ``root``, the smallest member of its group, for each end of an edge.

    Each round hangs every node on its smallest neighbour and follows the link of
    that one, and ends when nothing moves; the edges are rewritten between roots,
    so chains shorten by half or more. Tables are written in each round.
    """
    links = write_out(edges.select("a", "b").where("a <> b").distinct(), "links")
    parents = None
    while not links.isEmpty():
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = write_out(
            both.groupBy("a").agg(F.min("b").alias("low")).select(
                F.col("a").alias("node"), F.least("a", "low").alias("parent")
            ),
            "lowest",
        )
        # The parent of a parent; a parent is always smaller, so no cycles.
        above = lowest.select(F.col("node").alias("parent"), F.col("parent").alias("grand"))
        hung = write_out(lookup(lowest, above, ["parent"]).select("node", F.coalesce("grand", "parent").alias("parent")), "hung")
        if parents is None:
            parents = hung
        else:
            up = hung.select(F.col("node").alias("parent"), F.col("parent").alias("grand"))
            parents = write_out(
                lookup(parents, up, ["parent"]).select("node", F.coalesce("grand", "parent").alias("parent")), "parents"
            )
        at_a = hung.select(F.col("node").alias("a"), F.col("parent").alias("pa"))
        at_b = hung.select(F.col("node").alias("b"), F.col("parent").alias("pb"))
        links = write_out(
            lookup(lookup(links, at_a, ["a"]), at_b, ["b"])
            .where("pa <> pb")
            .select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b"))
            .distinct(),
            "links",
        )
    if parents is None:
        return links.select(F.col("a").alias("bits"), F.col("b").alias("root"))
    return parents.select(F.col("node").alias("bits"), F.col("parent").alias("root"))


def near_duplicates(docs: DataFrame, words: int = 4, most_bits: int = 4) -> DataFrame:
    """Groups of documents that are linked by fingerprints of at most ``most_bits`` differing bits.

    One row for each row of ``docs``: ``doc_id``, ``fingerprint`` (16 hex
    digits), ``component_id`` (the smallest id that can be reached). Null and
    blank texts have the fingerprint zero and are linked like others; texts of
    fewer words than a shingle are one shingle. Equal fingerprints are one class
    and are joined with others once. A null id counts only where a group has no
    other. An empty table gives no rows; other columns aren't read.
    """
    prints = write_out(fingerprints(docs, words), "fingerprints")
    classes = write_out(prints.groupBy("bits").agg(F.min("doc_id").alias("first")), "classes")
    roots = components(linked_fingerprints(classes, most_bits))
    placed = write_out(
        lookup(classes, roots, ["bits"]).select("bits", "first", F.coalesce("root", "bits").alias("root")), "placed"
    )
    smallest = placed.groupBy("root").agg(F.min("first").alias("component_id"))
    named = write_out(lookup(placed.select("bits", "root"), smallest, ["root"]).select("bits", "component_id"), "named")
    return lookup(prints, named, ["bits"]).select(
        "doc_id", F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"), "component_id"
    )
