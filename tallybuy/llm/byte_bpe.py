"""Byte-level BPE over Arrow batches: cutting texts into pieces, encoding, decoding, offsets.

Texts of a batch are cut at once, with arrays over their code points. Each
distinct piece goes to the tokenizers library once; ids are then laid out for
all texts.
"""

from __future__ import annotations

import base64
import os
import re
import unicodedata
from functools import lru_cache

import numpy as np
import pandas as pd
from tokenizers import Tokenizer, models

from tallybuy.llm.common import reuse_freed_memory

#: Pieces that a worker remembers; it starts anew beyond that.
_MOST_PIECES = 400_000
#: Texts are taken in groups of about so many characters.
_GROUP_POINTS = 1 << 18

_OTHER, _LETTER, _NUMBER, _SPACE = 0, 1, 2, 3
# White space of the Unicode standard.
_WHITE = [*range(0x9, 0xE), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]


@lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    """Class of each code point: letter, number, white space or other."""
    out = np.zeros(0x110000, np.uint8)
    for c in range(0x110000):
        major = unicodedata.category(chr(c))[0]
        if major == "L":
            out[c] = _LETTER
        elif major == "N":
            out[c] = _NUMBER
    out[_WHITE] = _SPACE
    return out


def _contractions(points: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where an apostrophe begins 's 't 're 've 'm 'll 'd, and the length of each; ``ends``: end of its text."""
    at = np.flatnonzero(points == 0x27)
    room = ends[at] - at

    def follows(k: int) -> np.ndarray:
        return np.where(room > k, points[np.minimum(at + k, len(points) - 1)], 0)

    one, two = follows(1), follows(2)
    long = np.zeros(len(at), bool)
    for a, b in ("re", "ve", "ll"):
        long |= (one == ord(a)) & (two == ord(b))
    short = np.isin(one, [ord(c) for c in "stmd"])
    found = long | short
    return at[found], np.where(short, 2, 3)[found]


def cut_pieces(points: np.ndarray, text_ends: np.ndarray) -> np.ndarray:
    """Starts of the pieces of joined texts, as code points; a piece never crosses the end of a text.

    Pieces are contractions, runs of letters, of numbers and of other
    characters, each with one blank before it, and runs of white space; of such
    a run before something else the last character is left over.
    """
    n = len(points)
    if not n:
        return np.empty(0, np.int64)
    kind = _classes()[points]
    new_text = np.zeros(n, bool)
    begins = np.concatenate([[0], text_ends[:-1]])
    begins = begins[begins < text_ends]  # not the empty texts
    new_text[begins] = True
    end_of = np.repeat(text_ends, np.diff(np.concatenate([[0], text_ends])))

    start = new_text.copy()
    start[1:] |= kind[1:] != kind[:-1]
    # A contraction counts where a piece can begin: not inside a run of other
    # characters, and not after a blank that the apostrophe takes.
    at, size = _contractions(points, end_of)
    if len(at):
        before = np.where(at > 0, at - 1, 0)
        good = new_text[at] | ((kind[before] != _OTHER) & (points[before] != 0x20))
        at, size = at[good], size[good]
        start[at] = True
        start[at + 1] = False
        start[(at + 2)[size > 2]] = False
        ends = at + size
        start[ends[ends < n]] = True
    # White space: the last character of a run is cut off if something of the same text follows; a
    # blank there joins what follows.
    space = kind == _SPACE
    last = np.zeros(n, bool)
    last[:-1] = space[:-1] & ~space[1:] & ~new_text[1:]
    where = np.flatnonzero(last)
    start[where] = True
    joins = where[points[where] == 0x20]
    start[joins + 1] = False
    return np.flatnonzero(start)


def _prefix_hash(units: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray]:
    power = np.empty(len(units) + 1, np.uint64)
    power[0] = 1
    power[1:] = base
    np.multiply.accumulate(power, out=power)
    total = np.zeros(len(units) + 1, np.uint64)
    np.cumsum((units + np.uint64(0x9E3779B9)) * power[:-1], out=total[1:])
    return total, power


def _piece_hash(units: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each piece from sums of ``unit * base ** position``, with the position divided out."""
    base = 0xD1342543DE82EF95
    total, _ = _prefix_hash(units, base)
    inverse = pow(base, -1, 1 << 64)
    back = np.empty(len(units) + 1, np.uint64)
    back[0] = 1
    back[1:] = inverse
    np.multiply.accumulate(back, out=back)
    mixed = (total[ends] - total[starts]) * back[starts]
    mixed ^= mixed >> np.uint64(32)
    return mixed * np.uint64(0x9E3779B97F4A7C15) + (ends - starts).astype(np.uint64)


@lru_cache(maxsize=1)
def byte_characters() -> tuple[str, ...]:
    """The character that stands for each byte: itself where it is printable, else one from 256 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return tuple(chr(b) if b in shown else chr(next(spare)) for b in range(256))


class TokenTable:
    """The bytes of each id."""

    def __init__(self, token_bytes: list[bytes]):
        self.sizes = np.array([len(x) for x in token_bytes], np.int64)
        self.begins = np.cumsum(self.sizes) - self.sizes
        self.table = np.frombuffer(b"".join(token_bytes), np.uint8)
        reuse_freed_memory()

    def decode(self, ids: np.ndarray) -> bytes:
        """Bytes of the ids, by the reversed byte table."""
        sizes = self.sizes[ids]
        at = np.cumsum(sizes)
        spread = np.repeat(self.begins[ids] - (at - sizes), sizes)
        return self.table[spread + np.arange(len(spread))].tobytes()

    def offsets(self, text: str, ids: np.ndarray) -> list[tuple[int, int]]:
        """Code points that each id covers; a character that ids split is covered by all of them."""
        data = np.frombuffer(text.encode(), np.uint8)
        lead = (data & 0xC0) != 0x80
        point = np.cumsum(lead) - 1  # the character of each byte
        ends = np.cumsum(self.sizes[ids])
        starts = ends - self.sizes[ids]
        return [(int(point[a]), int(point[b - 1]) + 1) for a, b in zip(starts, ends)]


class PieceEncoder(TokenTable):
    """Ids of texts by a BPE model whose symbols are byte characters."""

    def __init__(self, model, token_bytes: list[bytes], added: dict[str, int] | None = None):
        super().__init__(token_bytes)
        self._model = model
        self._added = added or {}
        # Of several that begin in one place the longest counts.
        whole = "|".join(re.escape(t) for t in sorted(self._added, key=len, reverse=True))
        self._added_pattern = re.compile(f"({whole})") if whole else None
        self._forget()
        self._to_chars = {b: c for b, c in enumerate(byte_characters())}

    def _forget(self) -> None:
        """No piece is known: sorted hashes, and where the ids of each begin and how many there are."""
        self._known = np.empty(0, np.uint64)
        self._at = np.empty(0, np.int64)
        self._many = np.empty(0, np.int64)
        self._flat = np.empty(0, np.uint32)

    def _learn(self, hashes: np.ndarray, pieces: list[str]) -> None:
        """Remember the ids of new pieces."""
        ids = [self.piece_ids(p) for p in pieces]
        many = np.fromiter(map(len, ids), np.int64, len(ids))
        at = len(self._flat) + np.cumsum(many) - many
        self._flat = np.concatenate([self._flat, np.array([i for x in ids for i in x], np.uint32)])
        known = np.concatenate([self._known, hashes])
        order = np.argsort(known)
        self._known = known[order]
        self._at = np.concatenate([self._at, at])[order]
        self._many = np.concatenate([self._many, many])[order]

    def piece_ids(self, piece: str) -> list[int]:
        chars = piece.encode().decode("latin-1").translate(self._to_chars)
        return [t.id for t in self._model.tokenize(chars)]

    def _group(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        joined = "".join(texts)
        points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        text_ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)))
        starts = cut_pieces(points, text_ends)
        ends = np.append(starts[1:], len(points))[: len(starts)]
        codes, distinct = pd.factorize(_piece_hash(points.astype(np.uint64), starts, ends))
        first = np.empty(len(distinct), np.int64)
        first[codes[::-1]] = np.arange(len(codes))[::-1]
        if len(self._known) + len(distinct) > _MOST_PIECES:
            self._forget()
        place = np.searchsorted(self._known, distinct)
        new = np.ones(len(distinct), bool)
        if len(self._known):
            new = self._known[np.minimum(place, len(self._known) - 1)] != distinct
        if new.any():
            spans = zip(starts[first[new]].tolist(), ends[first[new]].tolist())
            self._learn(distinct[new], [joined[a:b] for a, b in spans])
            place = np.searchsorted(self._known, distinct)
        slots = place[codes]
        counts = self._many[slots]
        total = np.concatenate([[0], np.cumsum(counts)])
        ids = self._flat[np.repeat(self._at[slots] - total[:-1], counts) + np.arange(total[-1])]
        # Ids before each text: those of the pieces before it.
        return ids, total[np.searchsorted(starts, np.concatenate([[0], text_ends]))]

    def encode(self, texts: list[str]):
        """Ids of each text, in order, as uint32 arrays.

        Added tokens are cut out first, and what stands between them is encoded piece by piece.
        """
        if self._added_pattern is None:
            yield from self._plainly(texts)
            return
        parts = [self._added_pattern.split(t) for t in texts]
        between = self._plainly([p for own in parts for p in own[::2]])
        for own in parts:
            ids = [np.array([self._added[p]], np.uint32) if k % 2 else next(between) for k, p in enumerate(own)]
            yield ids[0] if len(ids) == 1 else np.concatenate(ids)

    def _plainly(self, texts: list[str]):
        group, points = [], 0
        for k, text in enumerate(texts):
            group.append(text)
            points += len(text)
            if points >= _GROUP_POINTS or k == len(texts) - 1:
                ids, at = self._group(group)
                # The bytes of the ids are those of the texts, or two pieces had one hash.
                sound = self.decode(ids) == "".join(group).encode()
                for i, text in enumerate(group):
                    yield ids[at[i] : at[i + 1]] if sound else self._slowly(text)
                group, points = [], 0

    def _slowly(self, text: str) -> np.ndarray:
        points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        starts = cut_pieces(points, np.array([len(points)])).tolist()
        ids = [i for a, b in zip(starts, [*starts[1:], len(text)]) for i in self.piece_ids(text[a:b])]
        return np.array(ids, np.uint32)


def _bytes_of(chars: str, back: dict[str, int]) -> bytes:
    return bytes(back[c] for c in chars)


def _json_bytes(tokenizer: Tokenizer) -> list[bytes]:
    back = {c: b for b, c in enumerate(byte_characters())}
    special = {t.content for t in tokenizer.get_added_tokens_decoder().values()}
    vocabulary = tokenizer.get_vocab(with_added_tokens=True)
    token_bytes = [b""] * (max(vocabulary.values()) + 1)
    for token, i in vocabulary.items():
        token_bytes[i] = token.encode() if token in special else _bytes_of(token, back)
    return token_bytes


def _ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines if x.strip())}


def _rank_bytes(ranks: dict[bytes, int]) -> list[bytes]:
    token_bytes = [b""] * (max(ranks.values()) + 1)
    for token, i in ranks.items():
        token_bytes[i] = token
    return token_bytes


@lru_cache(maxsize=2)
def encoder(path: str) -> PieceEncoder:
    """Encoder of a byte-level BPE tokenizer: a ``.json`` file, or ranks."""
    return from_json(path) if path.endswith(".json") else from_ranks(path)


@lru_cache(maxsize=2)
def table(path: str) -> TokenTable:
    """Only what decoding needs of a tokenizer file."""
    return TokenTable(_json_bytes(Tokenizer.from_file(path)) if path.endswith(".json") else _rank_bytes(_ranks(path)))


def from_json(path: str) -> PieceEncoder:
    """Encoder of a tokenizer file with a byte-level BPE model; as in the library, added tokens in a text are tokens."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    tokenizer = Tokenizer.from_file(path)
    added = tokenizer.get_added_tokens_decoder()
    if any(t.single_word or t.lstrip or t.rstrip for t in added.values()):
        raise ValueError("added tokens that depend on what stands around them aren't supported")
    return PieceEncoder(tokenizer.model, _json_bytes(tokenizer), {t.content: i for i, t in added.items()})


def from_ranks(path: str) -> PieceEncoder:
    """Encoder of a rank file: merges are all ways to put a token together from two others, by its rank."""
    ranks = _ranks(path)
    chars = byte_characters()

    def shown(token: bytes) -> str:
        return "".join(chars[b] for b in token)

    merges = []
    for token in sorted(ranks, key=ranks.get):
        ways = [(token[:k], token[k:]) for k in range(1, len(token))]
        ways = [(a, b) for a, b in ways if a in ranks and b in ranks]
        merges += [(shown(a), shown(b)) for a, b in sorted(ways, key=lambda w: (ranks[w[0]], ranks[w[1]]))]
    model = models.BPE(vocab={shown(t): i for t, i in ranks.items()}, merges=merges, ignore_merges=True)
    return PieceEncoder(model, _rank_bytes(ranks))
