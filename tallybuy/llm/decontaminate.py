"""Removal of benchmark passages from documents by a suffix automaton of the benchmark.

The words of all items go into one generalised suffix automaton. The words of a
document are streamed through it; the length of the longest match that ends at
each word tells whether a window ends there. Only stretches in which each two
neighbours are also neighbours in an item are streamed, as no other word can be
part of a match of two words or more.

Items are cut into pieces that overlap by one word less than a window, and pieces are
dealt to blocks of about ``block_words`` words. Each block's automaton is built in a
task and goes to the executors by itself: its size is bounded, and documents
pass one block after the other. A benchmark of one block takes one pass without a shuffle.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybuy.llm.common import text_of
from tallybuy.llm.words import Words, byte_table, groups, text_bytes, words_of
from tallybuy.operators.joins import lookup
from tallybuy.session import write_out

#: Bytes that aren't part of words once A-Z are lower case.
_SEPARATORS = (*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80))
# Upper-case letters are separators by the pattern, but they are lower-cased first.
_TABLE = byte_table([b for b in _SEPARATORS if not 0x41 <= b <= 0x5A], lower=True)
#: Words of benchmark items in one automaton, and in one piece of a long item.
_BLOCK_WORDS, _PIECE_WORDS = 1 << 17, 1 << 12


class SuffixAutomaton:
    """Generalised suffix automaton over lists of numbers.

    ``step`` has the transitions by ``state * symbols + symbol``. A state
    stands for the substrings that end at the same places; ``length`` is that of the longest,
    ``link`` the state of the longest proper suffix that ends elsewhere, too.
    """

    def __init__(self, symbols: int):
        self.symbols = symbols
        self.step: dict[int, int] = {}
        self.length, self.link = [0], [-1]
        self._out: list[list[int]] = [[]]  # symbols of the transitions of each state

    def _state(self, length: int) -> int:
        self.length.append(length)
        self.link.append(-1)
        self._out.append([])
        return len(self.length) - 1

    def _connect(self, state: int, symbol: int, to: int) -> None:
        key = state * self.symbols + symbol
        if key not in self.step:
            self._out[state].append(symbol)
        self.step[key] = to

    def _split(self, state: int, symbol: int, to: int) -> int:
        """The state of the longest string that leads over ``state`` and ``symbol`` into ``to``; ``to`` is split for it."""
        if self.length[to] == self.length[state] + 1:
            return to
        copy = self._state(self.length[state] + 1)
        for s in self._out[to]:
            self._connect(copy, s, self.step[to * self.symbols + s])
        self.link[copy] = self.link[to]
        self.link[to] = copy
        while state >= 0 and self.step.get(state * self.symbols + symbol) == to:
            self._connect(state, symbol, copy)
            state = self.link[state]
        return copy

    def add(self, word: list[int]) -> None:
        """All substrings of one more list."""
        last = 0
        for symbol in word:
            to = self.step.get(last * self.symbols + symbol)
            if to is not None:
                last = self._split(last, symbol, to)
                continue
            new = self._state(self.length[last] + 1)
            state = last
            while state >= 0 and state * self.symbols + symbol not in self.step:
                self._connect(state, symbol, new)
                state = self.link[state]
            if state < 0:
                self.link[new] = 0
            else:
                self.link[new] = self._split(state, symbol, self.step[state * self.symbols + symbol])
            last = new

    def stream(self, symbols: list[int]) -> Iterator[tuple[int, int]]:
        """(state, length) of the longest match that ends at each symbol."""
        step, link, length, n = self.step, self.link, self.length, self.symbols
        state = matched = 0
        for symbol in symbols:
            to = step.get(state * n + symbol)
            while to is None and state:
                state = link[state]
                matched = length[state]
                to = step.get(state * n + symbol)
            if to is None:
                matched = 0
            else:
                state, matched = to, matched + 1
            yield state, matched


class Matcher:
    """Automaton of some items with the windows that end in each state."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int):
        self.window = window
        vocabulary = sorted({w for _, words in items for w in words})
        number = {w: k for k, w in enumerate(vocabulary)}
        self.vocabulary = pa.array(vocabulary, pa.binary())
        coded = [(item, [number[w] for w in words]) for item, words in items if words]
        n = max(len(vocabulary), 1)
        self.automaton = SuffixAutomaton(n)
        for _, words in coded:
            self.automaton.add(words)
        self.pairs = np.unique(np.array([a * n + b for _, w in coded for a, b in zip(w, w[1:])], np.int64))
        self.least = min((min(len(w), window) for _, w in coded), default=window)
        link, length = self.automaton.link, self.automaton.length
        #: For a state with strings of a window or more, the state of their last ``window`` words.
        self.tail = [-1] * len(link)
        for state in sorted(range(len(link)), key=length.__getitem__):
            if length[state] >= window:
                self.tail[state] = state if length[link[state]] < window else self.tail[link[state]]
        self.windows: dict[int, set[str]] = {}  # items by the state of a whole window
        self.whole: dict[int, set[str]] = {}  # items shorter than a window, by the state of the item
        for item, words in coded:
            for state, matched in self.automaton.stream(words):
                if matched >= window:
                    self.windows.setdefault(self.tail[state], set()).add(item)
            if len(words) < window:
                self.whole.setdefault(state, set()).add(item)
        #: The nearest state above with a whole item.
        self.above = [-1] * len(link)
        for state in sorted(range(1, len(link)), key=length.__getitem__):
            up = link[state]
            self.above[state] = up if up in self.whole else self.above[up]

    def stretches(self, words: Words) -> Iterator[tuple[int, int, list[int]]]:
        """(text, first word, symbols) of stretches that may hold a window."""
        symbols = pc.index_in(words.values, value_set=self.vocabulary).fill_null(-1).to_numpy().astype(np.int64)
        known = symbols >= 0
        follows = np.zeros(len(symbols), bool)  # goes on with the word before
        if len(symbols) > 1 and len(self.pairs):
            both = np.flatnonzero(known[1:] & known[:-1]) + 1
            pair = symbols[both - 1] * self.automaton.symbols + symbols[both]
            at = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
            follows[both] = self.pairs[at] == pair
        border = words.edges[1:-1]
        follows[border[border < len(follows)]] = False
        start = np.flatnonzero(known & ~follows)
        go_on = np.append(follows, False)
        stop = np.flatnonzero(known & ~go_on[1:]) + 1
        long = stop - start >= self.least
        start, stop = start[long], stop[long]
        text = np.searchsorted(words.edges, start, side="right") - 1
        for t, a, b in zip(text.tolist(), start.tolist(), stop.tolist()):
            yield t, a, symbols[a:b].tolist()

    def hits(self, words: Words) -> dict[int, tuple[list[tuple[int, int]], set[str]]]:
        """By text: (first word, end) of matches that cover windows, counted in the text, and the items."""
        out: dict[int, tuple[list, set]] = {}
        length, window = self.automaton.length, self.window
        for text, at, symbols in self.stretches(words):
            base = at - int(words.edges[text])
            for k, (state, matched) in enumerate(self.automaton.stream(symbols), 1):
                covered = matched if matched >= window else 0
                found = [self.windows[self.tail[state]]] if covered else []
                if self.whole:
                    whole = state if state in self.whole and length[state] <= matched else self.above[state]
                    while whole >= 0:
                        covered = max(covered, length[whole])
                        found.append(self.whole[whole])
                        whole = self.above[whole]
                if covered:
                    spans, items = out.setdefault(text, ([], set()))
                    span = (base + k - covered, base + k)
                    while spans and spans[-1][1] >= span[0]:
                        span = (min(span[0], spans[-1][0]), max(span[1], spans.pop()[1]))
                    spans.append(span)
                    items.update(*found)
        return out


def _pieces(benchmark: DataFrame, window: int, block_words: int) -> DataFrame:
    """``block, item, words``: items cut into overlapping pieces, dealt to blocks."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    words = F.regexp_extract_all(
        F.translate(text_of(), upper, lower), F.lit(r"([^\x00-\x2F\x3A-\x60\x7B-\x7F]+)"), F.lit(1)
    )
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), words.alias("all"))
    step = _PIECE_WORDS - window + 1
    last = F.greatest(F.size("all") - window, F.lit(0))
    cut = (
        items.where(F.size("all") > 0)
        .withColumn("first", F.explode(F.sequence(F.lit(0), last, F.lit(step))))
        .select("item", F.slice("all", F.col("first") + 1, F.lit(_PIECE_WORDS)).alias("words"))
    )
    cut = write_out(cut.distinct(), "benchmark-pieces")
    total = cut.agg(F.sum(F.size("words"))).first()[0] or 0
    blocks = -(-total // block_words) or 1
    return cut.withColumn("block", F.pmod(F.xxhash64("item", "words"), F.lit(blocks)))


def matchers(benchmark: DataFrame, window: int, block_words: int = _BLOCK_WORDS) -> Iterator[bytes]:
    """The automaton of each block, pickled, one at a time."""

    def build(key, table):
        items = list(zip(table["item"].to_pylist(), ([w.encode() for w in x] for x in table["words"].to_pylist())))
        body = pickle.dumps(Matcher(items, window), protocol=pickle.HIGHEST_PROTOCOL)
        return pa.table({"body": pa.array([body], pa.binary())})

    built = _pieces(benchmark, window, block_words).groupBy("block").applyInArrow(build, "body binary")
    for row in write_out(built, "benchmark-automata").toLocalIterator():
        yield bytes(row["body"])


_HITS = "n_words bigint, spans array<struct<start: bigint, stop: bigint>>, items array<string>"


def _pass(rows: DataFrame, body: bytes, id_column: str, window: int, most_share: float, finish: bool) -> DataFrame:
    """Hits of one automaton in each text; the final columns, or only rows with hits for a later merge."""
    shared = rows.sparkSession.sparkContext.broadcast(body)
    schema = f"{id_column} bigint, {_FINAL if finish else _HITS}"

    def run(batches):
        matcher = pickle.loads(shared.value)
        for batch in batches:
            for part in groups(batch):
                words = words_of(part["text"], _TABLE)
                hits = matcher.hits(words)
                if finish:
                    found = [hits.get(t, ([], set())) for t in range(part.num_rows)]
                    yield _finished(part, words, [f[0] for f in found], [sorted(f[1]) for f in found], id_column, most_share)
                else:
                    rows = sorted(hits)
                    n = np.diff(words.edges)
                    yield pa.RecordBatch.from_arrays(
                        [
                            part[id_column].take(pa.array(rows, pa.int64())),
                            pa.array(n[rows], pa.int64()),
                            _spans([hits[t][0] for t in rows]),
                            pa.array([sorted(hits[t][1]) for t in rows], pa.list_(pa.string())),
                        ],
                        names=[id_column, "n_words", "spans", "items"],
                    )

    return rows.select(id_column, "text").mapInArrow(run, schema)


_SPAN = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
_FINAL = _HITS + ", n_hit bigint, contaminated boolean, dropped boolean, kept string"


def _spans(lists: list[list[tuple[int, int]]]) -> pa.Array:
    return pa.array([[{"start": a, "stop": b} for a, b in spans] for spans in lists], _SPAN)


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _finished(part, words: Words, spans: list, items: list, id_column: str, most_share: float) -> pa.RecordBatch:
    """Final rows: texts without their hit spans, nothing of a text whose hit share passes the limit."""
    data, offsets = text_bytes(part["text"])
    n_words = np.diff(words.edges)
    n_hit = [sum(b - a for a, b in s) for s in spans]
    kept, dropped = [], []
    for t, own in enumerate(spans):
        a, b = int(offsets[t]), int(offsets[t + 1])
        gone = n_hit[t] > 0 and n_hit[t] > most_share * int(n_words[t])
        dropped.append(gone)
        if gone or not own:
            kept.append(b"" if gone else data[a:b].tobytes())
            continue
        first, parts = int(words.edges[t]), []
        for x, y in own:
            parts.append(data[a : words.starts[first + x]].tobytes())
            a = int(words.ends[first + y - 1])
        kept.append(b"".join([*parts, data[a:b].tobytes()]))
    columns = {
        id_column: part[id_column],
        "n_words": pa.array(n_words, pa.int64()),
        "spans": _spans(spans),
        "items": pa.array(items, pa.list_(pa.string())),
        "n_hit": pa.array(n_hit, pa.int64()),
        "contaminated": pa.array([n > 0 for n in n_hit], pa.bool_()),
        "dropped": pa.array(dropped, pa.bool_()),
        "kept": pa.array(kept, pa.binary()).cast(pa.string()),
    }
    return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, window: int = 10, most_share: float = 0.5, block_words: int = _BLOCK_WORDS
) -> DataFrame:
    """Texts without the words that benchmark items hold in windows of ``window`` words.

    Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after A-Z are lower-cased. An item of fewer
    words than a window, but not of none, is a window as a whole. One row for each row of ``docs``:
    ``doc_id, n_words, spans`` (maximal stretches of hit words: number of the first, and of
    the one behind the last)``, items`` (ids as sorted strings, of items with a
    window here)``, n_hit, contaminated, dropped`` (more than ``most_share`` of the words are hit)``,
    kept`` (the text without its spans, from the first character of a span's first word to the last of its last;
    empty if dropped).

    Null texts, of documents or items, have no words; null item ids are one item
    with an empty id. Repeated rows are treated on their own, items that share an id are one item;
    other columns aren't read. Empty tables: no rows, or no hits. ``block_words``
    only sets how the work is dealt: a benchmark of more words takes several passes, and
    their hits meet by row.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_of().alias("text"))
    bodies = matchers(benchmark, window, block_words)
    body, following = next(bodies, None), next(bodies, None)
    if body is None:
        body = pickle.dumps(Matcher([], window))
    if following is None:
        return _pass(rows, body, "doc_id", window, most_share, finish=True)
    numbered = write_out(rows.withColumn("_row", F.monotonically_increasing_id()), "decontaminate-rows")
    found = None
    for body in _chained([body, following], bodies):
        part = write_out(_pass(numbered, body, "_row", window, most_share, finish=False), "decontaminate-hits")
        found = part if found is None else found.unionByName(part)
    hits = found.groupBy("_row").agg(
        F.flatten(F.collect_list("spans")).alias("spans"), F.array_distinct(F.flatten(F.collect_list("items"))).alias("items")
    )

    def finish(batches):
        for batch in batches:
            for part in groups(batch):
                spans = [_merged([(s["start"], s["stop"]) for s in x or []]) for x in part["spans"].to_pylist()]
                items = [sorted(x or []) for x in part["items"].to_pylist()]
                yield _finished(part, words_of(part["text"], _TABLE), spans, items, "doc_id", most_share)

    return lookup(numbered, hits, ["_row"]).mapInArrow(finish, f"doc_id bigint, {_FINAL}")


def _chained(first: list[bytes], rest: Iterator[bytes]) -> Iterator[bytes]:
    yield from first
    yield from rest
