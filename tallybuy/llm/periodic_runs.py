"""Periodic runs of words: seeds on diagonals, each extended once.

A run with smallest period q has at least 4 q words, so words q apart agree for
3 q places or more. Lags are taken in tiers [m, 2 m). In a tier the k-grams
of 3 m words, the least overlap of its lags, are indexed for each document, and
an occurrence is paired with the next one of the same k-gram. As 3 m is
more than any lag of the tier, the next occurrence inside a run stands exactly
one period further, so these pairs miss no run, and there are never more of them
than words: a word repeated a million times gives a million pairs, not their
square. Pairs one behind the other on a diagonal are one seed. A seed is extended to
both sides, and a table with the furthest covered word of each lag keeps later
seeds from extending the same stretch again.

The index is exact: k-grams are numbered by doubling, from pairs of numbers of
grams of half the length. Places whose gram occurs once are left out of the
longer ones.
"""

from __future__ import annotations

import hashlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybuy.llm.common import text_of
from tallybuy.llm.words import byte_table, groups, words_of

_BLANKS = (32, *range(9, 14))
_TABLE = byte_table(_BLANKS, lower=False)
#: Words that are compared at once when a stretch is extended; doubled as it goes on.
_FIRST_STEP = 32


def _numbered(keys: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places (ascending for each key) whose key occurs again, and the number of that key."""
    order = np.argsort(keys, kind="stable")
    held = keys[order]
    new = np.empty(len(held), bool)
    new[:1] = True
    np.not_equal(held[1:], held[:-1], out=new[1:])
    number = np.cumsum(new) - 1
    again = np.bincount(number)[number] > 1 if len(number) else new
    return places[order[again]], number[again]


class _Grams(NamedTuple):
    """Numbers of the grams of one length by their first word, -1 where a gram occurs once."""

    places: np.ndarray
    number: np.ndarray

    @staticmethod
    def made(keys: np.ndarray, places: np.ndarray, n: int) -> _Grams:
        places, number = _numbered(keys, places)
        full = np.full(n, -1, np.int64)
        full[places] = number
        return _Grams(np.sort(places), full)


def _pair_keys(left: _Grams, right: _Grams, shift: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys of a gram of ``left`` and the gram of ``right`` that begins ``shift`` words later, and their places."""
    n = len(left.number)
    places = left.places[left.places + shift < n]
    after = right.number[places + shift]
    places, after = places[after >= 0], after[after >= 0]
    return left.number[places] * np.int64(n + 1) + after, places


def _seeds(left: _Grams, right: _Grams, shift: int, least: int, most: int) -> list[tuple[int, int]]:
    """(lag, place) of grams whose next occurrence is ``least`` to ``most`` words later; the first of each row of neighbours."""
    places, number = _numbered(*_pair_keys(left, right, shift))
    lag = places[1:] - places[:-1]
    near = (number[1:] == number[:-1]) & (lag >= least) & (lag <= most)
    at, lag = places[:-1][near], lag[near]
    order = np.lexsort((at, lag))
    at, lag = at[order], lag[order]
    head = np.ones(len(at), bool)
    head[1:] = (lag[1:] != lag[:-1]) | (at[1:] != at[:-1] + 1)
    return list(zip(lag[head].tolist(), at[head].tolist()))


def _agreeing(words: np.ndarray, at: int, lag: int, step: int) -> int:
    """How many places from ``at`` on (``step`` 1) or before it (-1) hold the word that stands ``lag`` later."""
    n, size, done = len(words) - lag, _FIRST_STEP, 0
    while True:
        room = min(size, n - at - done if step > 0 else at - done)
        if room <= 0:
            return done
        a = at + done if step > 0 else at - done - room
        same = words[a : a + room] == words[a + lag : a + lag + room]
        if step < 0:
            same = same[::-1]
        if not same.all():
            return done + int(np.argmin(same))
        done, size = done + room, size * 2


def find_runs(words: np.ndarray, least: int = 6, exponent: int = 4) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs, by start and period.

    ``words`` are numbers; those of different documents must differ, so that no
    run crosses documents.
    """
    n = len(words)
    one = _Grams.made(words, np.arange(n), n)
    two = _Grams.made(*_pair_keys(one, one, 1), n)
    four = _Grams.made(*_pair_keys(two, two, 2), n)
    covered: dict[int, int] = {}
    runs = []

    def extend(seeds):
        for lag, at in seeds:
            if at < covered.get(lag, 0):
                continue
            start = at - _agreeing(words, at, lag, -1)
            end = at + _agreeing(words, at, lag, 1)
            covered[lag] = end
            length = end - start + lag
            if length >= max(least, exponent * lag):
                runs.append((start, length, lag))

    extend(_seeds(four, one, 4, 1, 1))
    half, whole, m = two, four, 2
    while len(whole.places):
        extend(_seeds(whole, half, 2 * m, m, 2 * m - 1))
        half, whole, m = whole, _Grams.made(*_pair_keys(whole, whole, 2 * m), n), 2 * m
    return sorted(runs, key=lambda r: (r[0], r[2]))


def _looped(edges: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """For each word the word that takes its place where a document's seed makes it loop."""
    take = np.arange(edges[-1])
    for t in np.flatnonzero((seeds >= 0) & (seeds % 10 == 0) & (np.diff(edges) > 0)):
        n, g = int(edges[t + 1] - edges[t]), int(seeds[t]) // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        take[edges[t] + a : edges[t + 1]] = edges[t] + a + np.arange(n - a) % p
    return take


_SCHEMA = (
    "doc_id bigint, n_words bigint, runs array<struct<start: bigint, length: bigint, period: bigint>>, "
    "runs_sha256 string, collapsed string, collapsed_sha256 string"
)
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def periodic_runs(
    docs: DataFrame, least: int = 6, exponent: int = 4, loop_seed: Column | None = None, with_text: bool = True
) -> DataFrame:
    """Runs of words that repeat with a period, and the texts without the repeats.

    One row for each row of ``docs``: ``doc_id, n_words, runs`` (start, length,
    period, by start and period)``, runs_sha256`` (of ``start,length,period`` lines)``,
    collapsed`` (words that no run holds after its first period, joined by one
    space; null without ``with_text``)``, collapsed_sha256``. Words are
    stretches of bytes other than ``[\\x20\\x09-\\x0D]``. A run has ``least`` words and ``exponent``
    periods at least and ends where its smallest period does.

    ``loop_seed`` (a number, or null for none) damages texts first: with a seed
    s divisible by 10 and n words, g = s // 10, words from a = g % n on repeat
    the first 1 + (n - a) // (3 + g % 8) of them.

    Nothing is shuffled; each document is read where it lies. Null and empty texts
    have no words. Repeated rows and rows that share an id are treated on their
    own; other columns aren't read. An empty table gives no rows.
    """
    if least < 6 or exponent < 4:
        raise ValueError("runs must have at least 6 words and 4 periods")

    def run(batches):
        for batch in batches:
            for part in groups(batch):
                yield _found(part, least, exponent, with_text)

    seed = F.lit(None) if loop_seed is None else loop_seed
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        text_of().alias("text"),
        F.coalesce(seed.cast("bigint"), F.lit(-1)).alias("seed"),
    )
    return rows.mapInArrow(run, _SCHEMA)


def _found(part: pa.RecordBatch, least: int, exponent: int, with_text: bool) -> pa.RecordBatch:
    words = words_of(part["text"], _TABLE)
    edges = words.edges
    take = _looped(edges, part["seed"].to_numpy())
    coded = words.values.dictionary_encode()
    document = np.repeat(np.arange(len(edges) - 1), np.diff(edges))
    codes = coded.indices.to_numpy()[take] + document * np.int64(len(coded.dictionary) + 1)
    runs = find_runs(codes, least, exponent)
    change = np.zeros(len(codes) + 1, np.int32)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    stay = np.flatnonzero(np.cumsum(change[:-1]) == 0)
    lists = pa.ListArray.from_arrays(
        pa.array(np.searchsorted(stay, edges), pa.int32()), words.values.take(pa.array(take[stay]))
    )
    collapsed = pc.binary_join(lists, b" ")
    of = np.searchsorted(edges, [r[0] for r in runs], side="right") - 1 if runs else np.empty(0, np.int64)
    first = np.searchsorted(of, np.arange(len(edges)))
    own = [(s - int(edges[t]), length, period) for t, (s, length, period) in zip(of.tolist(), runs)]
    listed = pa.ListArray.from_arrays(
        pa.array(first, pa.int32()),
        pa.StructArray.from_arrays([pa.array([r[k] for r in own], pa.int64()) for k in range(3)], fields=list(_RUN)),
    )
    lines = [b"%d,%d,%d\n" % r for r in own]
    digests = [hashlib.sha256(b"".join(lines[a:b])).hexdigest() for a, b in zip(first[:-1], first[1:])]
    texts = collapsed.cast(pa.string()) if with_text else pa.nulls(len(digests), pa.string())
    return pa.RecordBatch.from_arrays(
        [
            part["doc_id"],
            pa.array(np.diff(edges), pa.int64()),
            listed,
            pa.array(digests),
            texts,
            pa.array([hashlib.sha256(x.as_buffer()).hexdigest() for x in collapsed]),
        ],
        names=["doc_id", "n_words", "runs", "runs_sha256", "collapsed", "collapsed_sha256"],
    )
