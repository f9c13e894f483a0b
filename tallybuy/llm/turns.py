"""Repair of conversations whose turns don't alternate, by aligning them to the alternating grammar.

A conversation should be empty or ``s?(ua)+`` in the initials of its roles. Turns
are kept, given another role, deleted or inserted at a cost, and the cheapest edits
win; of equals those whose initials (D, I, K, R) are least as a string.

Turns lie in a written table in the order of conversations, cut into pieces of
at most ``PIECE`` turns, so a conversation of any length is spread over tasks:

1. Each piece becomes a short string of codes, one for a turn's role and fault.
2. ``align`` edits a piece from each state of the grammar it may begin in to each it
   may end in: Wagner-Fischer tables against every string of the grammar of a
   feasible length, inside the Ukkonen band that the cheapest alignment so far leaves.
3. ``fold`` puts the pieces of a conversation together. Edits of a piece end with
   its last turn, so none is the beginning of another, and the least
   string is made of least parts.
4. The turns pass once more, in order, and are edited as they go by.

Steps 1 to 3 move codes and edits, not texts. The digest of a repaired
conversation is a hash of all of its text, so in step 4 each conversation
passes through one task, turn by turn, with nothing held but the hash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybuy.operators.joins import lookup
from tallybuy.session import write_out

#: Turns in a piece.
PIECE = 64
KEEP, REROLE, DELETE, INSERT = 0, 2, 3, 2
_FAR = 1 << 30
_BLANKS = " \t\n\x0b\x0c\r"

# --- one piece ----------------------------------------------------------------------------

# States of the grammar: 0 nothing yet, 1 after s, 2 after u, 3 after a. A conversation may end in 0 or 3.
_BEGINS = {0: ("s", "u"), 1: ("u",), 2: ("a",), 3: ("u",)}
_AFTER = {"s": 1, "u": 2, "a": 3}
#: Insertions behind the last turn that lead from each state to the end.
_END = {0: "", 1: "II", 2: "I", 3: ""}


def _target(state: int, first: str, length: int) -> str:
    """The string of the grammar of one length that goes on from a state with a symbol."""
    tail = "ua" if first in "sa" else "au"
    return (first + tail * length)[:length]


def _cheapest(codes: str, target: str, most: int) -> tuple[int, str] | None:
    """Cost and least edits that turn a piece into ``target``, if no more than ``most``; no insertion comes last."""
    n, m = len(codes), len(target)
    forced = [0]  # turns up to here that have to go
    for c in codes:
        forced.append(forced[-1] + (c in _GOES))
    slack = most - DELETE * forced[n]
    # Cost at least: three for each turn too many, two for each too few, before a cell and behind it.
    if slack < 0:
        return None
    wide, deep = slack // INSERT, slack // DELETE
    below = [_FAR] * (m + 2)
    below[m] = 0
    table = [below]
    for i in range(n - 1, -1, -1):
        code = codes[i]
        symbol, goes, cut = _ROLE[code], code in _GOES, code in _CUT
        before, behind = i - forced[i], (n - i) - (forced[n] - forced[i])
        low = max(0, before - deep, m - behind - wide)
        high = min(m, before + wide, m - behind + deep)
        row = [_FAR] * (m + 2)
        for j in range(high, low - 1, -1):
            best = below[j] + DELETE
            if j < m:
                if target[j] != "s" and row[j + 1] + INSERT < best:
                    best = row[j + 1] + INSERT
                if not goes:
                    if symbol == target[j]:
                        best = min(best, below[j + 1] + KEEP + cut)
                    elif target[j] != "s":
                        best = min(best, below[j + 1] + REROLE + cut)
            row[j] = best
        table.append(row)
        below = row
    table.reverse()
    total = table[0][0]
    if total > most:
        return None
    edits, i, j = [], 0, 0
    while i < n:
        here, code = table[i][j], codes[i]
        if table[i + 1][j] + DELETE == here:
            edits.append("D")
            i += 1
        elif j < m and target[j] != "s" and table[i][j + 1] + INSERT == here:
            edits.append("I")
            j += 1
        else:
            edits.append("K" if _ROLE[code] == target[j] else "R")
            i, j = i + 1, j + 1
    return total, "".join(edits)


# A code is a letter: four roles by four faults.
_FAULTS = ("fine", "blank", "duplicate", "truncated")
_CODES = {(r, f): chr(65 + 4 * i + k) for i, r in enumerate("sua?") for k, f in enumerate(_FAULTS)}
_ROLE = {c: r for (r, _), c in _CODES.items()}
_FAULT = {c: f for (_, f), c in _CODES.items()}
_GOES = frozenset(c for c, f in _FAULT.items() if f in ("blank", "duplicate"))
_CUT = frozenset(c for c, f in _FAULT.items() if f == "truncated")


@lru_cache(maxsize=1 << 16)
def align(codes: str, state: int) -> dict[int, tuple[int, str]]:
    """For each state a piece can end in: cost and least edits of the cheapest alignment from ``state``."""
    free = sum(c not in _GOES for c in codes)
    goes = DELETE * (len(codes) - free)
    best: dict[int, tuple[int, str]] = {}
    # Lengths next to the number of turns that may stay come first and make the bands narrow.
    for length in sorted(range(free + 3 * len(codes) // 2 + 4), key=lambda k: (abs(k - free), k)):
        least = goes + INSERT * max(0, length - free) + DELETE * max(0, free - length)
        for first in _BEGINS[state] if length else ("",):
            target = _target(state, first, length) if length else ""
            end = _AFTER[target[-1]] if target else state
            most = best[end][0] if end in best else DELETE * len(codes) + INSERT * length
            if least > most:
                continue
            found = _cheapest(codes, target, most)
            if found and (end not in best or found < best[end]):
                best[end] = found
    return best


def fold(pieces: list[dict[int, dict[int, tuple[int, str]]]]) -> tuple[int, list[str], str]:
    """Cost, edits of each piece and insertions at the end, of the cheapest edits over all pieces.

    A piece has its alignments by the state it begins and the state it ends in.
    Of each state only the cost and the rank of its edits among all states go on.
    """
    held, steps = {0: (0, 0)}, []
    for piece in pieces:
        new: dict[int, tuple[int, int, str, int]] = {}
        for state, (cost, rank) in held.items():
            for end, (more, edits) in piece[state].items():
                candidate = (cost + more, rank, edits, state)
                if end not in new or candidate < new[end]:
                    new[end] = candidate
        order = sorted(new, key=lambda end: new[end][1:3])
        held = {end: (new[end][0], order.index(end)) for end in new}
        steps.append({end: (x[3], x[2]) for end, x in new.items()})
    end = min(held, key=lambda s: (held[s][0] + INSERT * len(_END[s]), held[s][1]))
    cost, last = held[end][0] + INSERT * len(_END[end]), _END[end]
    parts = []
    for step in reversed(steps):
        end, edits = step[end]
        parts.append(edits)
    return cost, parts[::-1], last


# --- tables -------------------------------------------------------------------------------

_CONV = ("no_id", "conv")


def _ordered(turns: DataFrame) -> DataFrame:
    """Turns in the order of conversations, written out: ``no_id, conv, turn, role, text, mark, ord``.

    ``ord`` goes up with the order, and its upper bits are those of the range the turn lies in.
    """
    blank = F.lit(" ")
    rows = turns.select(
        F.col("conv_id").isNull().alias("no_id"),
        F.coalesce(F.col("conv_id").cast("bigint"), F.lit(0)).alias("conv"),
        F.col("turn").cast("bigint").alias("turn"),
        F.coalesce(F.col("role").cast("string"), blank).alias("role"),
        F.coalesce(F.col("text").cast("string"), blank).alias("text"),
        # Rows that are alike in all columns may be many; they are told apart so that ranges can split them.
        F.monotonically_increasing_id().alias("_own"),
    )
    order = [*_CONV, "turn", "role", "text", "_own"]
    sorted_rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).drop("_own")
    mark = F.sha2(F.to_json(F.struct("role", "text")), 256)
    return write_out(
        sorted_rows.select("*", mark.alias("mark"), F.monotonically_increasing_id().alias("ord")), "turns"
    )


def _code(first: Column) -> Column:
    """The code of a turn; ``first`` is whether no earlier turn of the conversation has its role and text."""
    solid = F.rtrim("text", F.lit(_BLANKS))
    initial = F.substring("role", 1, 1)
    role = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    fault = (
        F.when(solid == "", 1).when(~first, 2).when(F.substring(solid, -1, 1).isin(".", "!", "?"), 0).otherwise(3)
    )
    return F.char(65 + 4 * role + fault)


def _pieces(rows: DataFrame) -> DataFrame:
    """``no_id, conv, piece, codes, low, high, n_turns, begins``: pieces with their codes and distinct turns."""
    # Few marks occur twice in a conversation; only the others' first places meet the rows again.
    firsts = (
        rows.groupBy(*_CONV, "mark").agg(F.min("ord").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    )
    slim = rows.select(*_CONV, "turn", "ord", "mark", _code(F.lit(True)).alias("alone"), _code(F.lit(False)).alias("again"))
    marked = lookup(slim, firsts, [*_CONV, "mark"])
    code = F.when(F.col("first") < F.col("ord"), F.col("again")).otherwise(F.col("alone"))
    piece = F.shiftright("ord", PIECE.bit_length() - 1)
    pieces = (
        marked.select(*_CONV, piece.alias("piece"), "ord", code.alias("code"), "turn")
        .groupBy(*_CONV, "piece")
        .agg(
            F.sort_array(F.collect_list(F.struct("ord", "code"))).alias("turns"),
            F.min("turn").alias("low"),
            F.max("turn").alias("high"),
            F.size(F.collect_set("turn")).cast("bigint").alias("n_turns"),
        )
        .withColumn("codes", F.array_join("turns.code", ""))
        .drop("turns")
    )
    begin = pieces.groupBy(*_CONV).agg(F.min("piece").alias("_least"))
    return lookup(pieces, begin, list(_CONV)).select(
        *_names(_PIECE_SCHEMA), (F.col("piece") == F.col("_least")).alias("begins")
    )


_PIECE_SCHEMA = "no_id boolean, conv bigint, piece bigint, codes string, low bigint, high bigint, n_turns bigint"
_TABLE = "table array<struct<state: int, end: int, cost: bigint, edits: string>>"


def _aligned(pieces: DataFrame) -> DataFrame:
    """Pieces with their alignments; a piece that begins a conversation needs only those from the first state."""
    kind = pa.list_(pa.struct([("state", pa.int32()), ("end", pa.int32()), ("cost", pa.int64()), ("edits", pa.string())]))

    def run(batches):
        for batch in batches:
            tables = []
            for codes, begins in zip(batch["codes"].to_pylist(), batch["begins"].to_pylist()):
                tables.append(
                    [
                        {"state": state, "end": end, "cost": cost, "edits": edits}
                        for state in ((0,) if begins else (0, 1, 2, 3))
                        for end, (cost, edits) in align(codes, state).items()
                    ]
                )
            kept = batch.drop_columns(["begins"])
            yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(tables, kind)], names=[*kept.schema.names, "table"])

    # Pieces are few bytes and much work, so they aren't to be put together into few tasks.
    tasks = int(pieces.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return pieces.repartition(tasks, *_CONV, "piece").mapInArrow(run, f"{_PIECE_SCHEMA}, {_TABLE}")


class _Audit:
    """What the pieces of one conversation add up to, as they come by."""

    def __init__(self):
        self.tables, self.pieces = [], []
        self.faults = dict.fromkeys(_FAULTS, 0)
        self.illegal, self.last = 0, ""
        self.low = self.high = None
        self.n_turns = 0

    def add(self, row: dict) -> None:
        codes = self.last + row["codes"]
        self.illegal += sum(_ROLE[a] + _ROLE[b] not in ("su", "ua", "au") for a, b in zip(codes, codes[1:]))
        self.last = codes[-1:]
        for c in row["codes"]:
            self.faults[_FAULT[c]] += 1
        if row["low"] is not None:
            self.n_turns += row["n_turns"] - (self.high == row["low"])
            self.low, self.high = row["low"] if self.low is None else self.low, row["high"]
        table: dict[int, dict] = {}
        for x in row["table"]:
            table.setdefault(x["state"], {})[x["end"]] = (x["cost"], x["edits"])
        self.tables.append(table)
        self.pieces.append(row["piece"])

    def rows(self, no_id: bool, conv: int) -> Iterator[tuple]:
        """A row with all figures, which sorts before the turns, and the edits of each piece."""
        cost, parts, last = fold(self.tables)
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.n_turns
        f = self.faults
        figures = (gaps, f["blank"], f["duplicate"], f["truncated"], self.illegal, cost, "".join(parts) + last)
        yield (no_id, conv, -1, *figures, last)
        for piece, edits in zip(self.pieces, parts):
            yield (no_id, conv, piece * PIECE, *[None] * 7, edits)


_AUDIT = (
    "no_id boolean, conv bigint, ord bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, "
    "illegal bigint, cost bigint, audit string, edits string"
)
_AUDIT_KINDS = [pa.bool_(), *[pa.int64()] * 8, pa.string(), pa.string()]
_FLUSH = 4096


def _record(rows: list[tuple], kinds: list, names: list[str]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def _names(schema: str) -> list[str]:
    return [x.split()[0] for x in schema.split(", ")]


def _audited(aligned: DataFrame) -> DataFrame:
    """One row of figures for each conversation (``ord`` -1), and one of edits for each piece (its first ``ord`` at most)."""

    def run(batches):
        held, out, key = None, [], None
        for batch in batches:
            for row in batch.to_pylist():
                if (row["no_id"], row["conv"]) != key:
                    if held:
                        out += held.rows(*key)
                    held, key = _Audit(), (row["no_id"], row["conv"])
                held.add(row)
                if len(out) >= _FLUSH:
                    yield _record(out, _AUDIT_KINDS, _names(_AUDIT))
                    out = []
        if held:
            out += held.rows(*key)
        yield _record(out, _AUDIT_KINDS, _names(_AUDIT))

    dealt = aligned.repartition(*_CONV).sortWithinPartitions(*_CONV, "piece")
    return dealt.mapInArrow(run, _AUDIT)


def _edited(rows: DataFrame, audits: DataFrame, consume, schema: str, kinds: list) -> DataFrame:
    """Turns of each conversation, edited, through ``consume(no_id, conv, figures)``.

    That gives (put, end): ``put(role, text)`` gets each repaired turn; both return rows of the result.
    """
    names = _names(schema)
    stream = (
        rows.select(*_CONV, "ord", F.lit(1).alias("kind"), "role", "text")
        .unionByName(audits.withColumn("kind", F.lit(0)), allowMissingColumns=True)
        .repartition(*_CONV)
        .sortWithinPartitions(*_CONV, "ord", "kind")
    )

    def run(batches):
        out: list[tuple] = []
        put = end = None
        edits, symbol, last = iter(()), "", ""

        def place(role, text):
            out.extend(put(role, text))

        def insertion(symbol):
            now = "a" if symbol == "u" else "u"
            place("user" if now == "u" else "assistant", "")
            return now

        def close():
            now = symbol
            for _ in last:
                now = insertion(now)
            out.extend(end())

        for batch in batches:
            for row in batch.to_pylist():
                if row["kind"] == 0 and row["ord"] < 0:
                    if end:
                        close()
                    put, end = consume(row["no_id"], row["conv"], row)
                    symbol, last = "", row["edits"]
                elif row["kind"] == 0:
                    edits = iter(row["edits"])
                else:
                    edit = next(edits)
                    while edit == "I":
                        symbol = insertion(symbol)
                        edit = next(edits)
                    if edit == "K":
                        symbol = row["role"][:1]
                        place(row["role"], row["text"])
                    elif edit == "R":
                        symbol = "a" if symbol == "u" else "u"
                        place("user" if symbol == "u" else "assistant", row["text"])
                if len(out) >= _FLUSH:
                    yield _record(out, kinds, names)
                    out.clear()
        if end:
            close()
        yield _record(out, kinds, names)

    return stream.mapInArrow(run, schema)


_DIGEST = (
    "conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, "
    "audit string, repaired_sha256 string"
)
_DIGEST_KINDS = [*[pa.int64()] * 7, pa.string(), pa.string()]


def _digest(no_id, conv, figures):
    digest, begun = hashlib.sha256(), []

    def put(role, text):
        digest.update(f"{chr(10) if begun else ''}{role}:{text}".encode())
        begun[:] = [True]
        return ()

    def end():
        parts = [figures[c] for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")]
        return [(None if no_id else conv, *parts, digest.hexdigest())]

    return put, end


_TURNS = "conv_id bigint, position bigint, role string, text string"
_TURNS_KINDS = [pa.int64(), pa.int64(), pa.string(), pa.string()]


def _repaired(no_id, conv, figures):
    count = iter(range(1 << 62))

    def put(role, text):
        return [(None if no_id else conv, next(count), role, text)]

    return put, lambda: ()


class Repair:
    """Cheapest repair of all conversations of a table ``conv_id, turn, role, text``.

    ``audits()`` has one row for each conversation: ``conv_id, gaps`` (turns missing between the
    smallest and the largest)``, blank, duplicate, truncated`` (turns by their first
    fault)``, illegal`` (neighbours other than su, ua, au)``, cost, audit, repaired_sha256``
    (of the repaired ``role:text``, newline-joined). ``turns()`` has the repaired turns:
    ``conv_id, position`` (from 0)``, role, text``.

    Turns are taken by ``turn``, null first, then by role and text. Null roles and texts
    are one space. A role whose first character isn't s, u or a, and an empty one, can't
    be kept. Null ids are one conversation. Repeated rows are duplicates. A duplicate
    has role and text of an earlier turn, of whatever fault. Other columns
    aren't read. An empty table gives no rows.
    """

    def __init__(self, turns: DataFrame):
        self._rows = _ordered(turns)
        self._audits = write_out(_audited(_aligned(_pieces(self._rows))), "turn-audits")

    def audits(self) -> DataFrame:
        return _edited(self._rows, self._audits, _digest, _DIGEST, _DIGEST_KINDS)

    def turns(self) -> DataFrame:
        return _edited(self._rows, self._audits, _repaired, _TURNS, _TURNS_KINDS)


def damaged(turns: DataFrame) -> DataFrame:
    """Turns with faults by crc32 of ``conv_id:turn``, modulo 20: 0 drops a row, 1 empties its text, 2 removes
    its ``.!?``, 3 repeats it, 4 gives it the role user. Null is one space."""
    space = F.lit(" ")

    def cell(name):
        return F.coalesce(F.col(name).cast("string"), space)

    kind = F.crc32(F.concat(cell("conv_id"), F.lit(":"), cell("turn")).cast("binary")) % 20
    return (
        turns.select("conv_id", "turn", cell("role").alias("role"), cell("text").alias("text"), kind.alias("_kind"))
        .where("_kind <> 0")
        .select(
            "conv_id",
            "turn",
            F.when(F.col("_kind") == 4, "user").otherwise(F.col("role")).alias("role"),
            F.when(F.col("_kind") == 1, "").when(F.col("_kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
            F.explode(F.when(F.col("_kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_copy"),
        )
        .drop("_copy")
    )


def with_all_ids(audits: DataFrame, turns: DataFrame) -> DataFrame:
    """Audits of all conversations of ``turns``; one without turns left has zeros, no edits and the hash of nothing."""
    ids = turns.select(F.col("conv_id").cast("bigint").alias("conv_id")).distinct().select("conv_id", F.lit(True).alias("_all"))
    figures = [c for c in audits.columns if c != "conv_id"]
    # A union and an aggregate, as a join would lose the null id.
    both = audits.withColumn("_all", F.lit(False)).unionByName(ids, allowMissingColumns=True)
    grouped = both.groupBy("conv_id").agg(*[F.max(c).alias(c) for c in figures])
    nothing = {"audit": "", "repaired_sha256": hashlib.sha256(b"").hexdigest()}
    return grouped.select("conv_id", *[F.coalesce(c, F.lit(nothing.get(c, 0))).alias(c) for c in figures])
