"""Repair of conversations."""

import hashlib
import itertools
import re
import zlib
from functools import lru_cache

import numpy as np
from pyspark.sql import functions as F

from tallybuy.llm import queries, turns
from tests.llm.helpers import SMALL

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
BLANK = " \t\n\x0b\x0c\r"


def _least(codes, state=0):
    """(cost, edits) over all edits of a whole conversation, by plain recursion."""

    @lru_cache(None)
    def go(i, state, inserted):
        options = [(0, "")] if i == len(codes) and state in (0, 3) else []
        step = {0: "u", 1: "u", 2: "a", 3: "u"}[state]
        if inserted < 3:
            c, e = go(i, {"u": 2, "a": 3}[step], inserted + 1)
            options.append((c + 2, "I" + e))
        if i < len(codes):
            role, fault = codes[i]
            c, e = go(i + 1, state, 0)
            options.append((c + 3, "D" + e))
            if fault not in ("blank", "duplicate"):
                cut = int(fault == "truncated")
                c, e = go(i + 1, {"u": 2, "a": 3}[step], 0)
                options.append((c + 2 + cut, "R" + e))
                if role == step or (state == 0 and role == "s"):
                    c, e = go(i + 1, {"s": 1, "u": 2, "a": 3}[role], 0)
                    options.append((c + cut, "K" + e))
        return min(options) if options else (10**9, "")

    for i in range(len(codes), 0, -1):  # from the end on, so that the recursion stays flat
        for s in range(4):
            go(i, s, 0)
    return go(0, state, 0)


def brute_force(rows):
    """The registered query's rows of a list of (conv_id, turn, role, text)."""
    out = {}
    for conv in {r[0] for r in rows}:
        left = []
        for _, turn, role, text in (r for r in rows if r[0] == conv):
            role, text = " " if role is None else role, " " if text is None else text
            key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
            kind = zlib.crc32(key.encode()) % 20
            if kind == 0:
                continue
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            role = "user" if kind == 4 else role
            left += [(turn, role, text)] * (2 if kind == 3 else 1)
        left.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        codes, seen = [], set()
        for _, role, text in left:
            solid = text.rstrip(BLANK)
            fault = "blank" if not solid else "duplicate" if (role, text) in seen else "fine" if solid[-1] in ".!?" else "truncated"
            seen.add((role, text))
            codes.append((role[:1], fault))
        known = [t for t, _, _ in left if t is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(codes, codes[1:]))
        cost, audit = _least(tuple(codes))
        now, done, at = "", [], iter(left)
        for e in audit:
            if e == "I":
                now = "a" if now == "u" else "u"
                done.append({"u": "user", "a": "assistant"}[now] + ":")
                continue
            _, role, text = next(at)
            if e == "K":
                now = role[:1]
            elif e == "R":
                now = "a" if now == "u" else "u"
                role = {"u": "user", "a": "assistant"}[now]
            if e != "D":
                done.append(f"{role}:{text}")
        faults = [sum(f == name for _, f in codes) for name in ("blank", "duplicate", "truncated")]
        digest = hashlib.sha256("\n".join(done).encode()).hexdigest()
        out[conv] = (gaps, *faults, illegal, cost, audit, digest)
    return out


def _query(spark, rows):
    table = spark.createDataFrame(rows, SCHEMA)
    got = turns.with_all_ids(turns.Repair(turns.damaged(table)).audits(), table).collect()
    assert len(got) == len({r.conv_id for r in got})
    return {r.conv_id: tuple(r)[1:] for r in got}


def test_whole_table_matches_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = {r.conv_id: tuple(r)[1:] for r in queries.QUERIES["op12_turns"](spark, SMALL).collect()}
    assert got == brute_force(rows)


def _random_rows(rng, n):
    roles = ["user", "assistant", "system", "tool", "", None, "u", "Assistant"]
    texts = ["Yes.", "no", "  ", "", None, "Why? ", "same!", "é…", "a ", "... "]
    return [
        (
            None if c == 0 else int(c),
            None if rng.random() < 0.1 else int(rng.integers(0, 12)),
            roles[min(int(rng.exponential(1.5)), 7)],
            texts[int(rng.integers(0, 10))],
        )
        for c in rng.integers(0, 40, n)
    ]


def test_odd_rows_match_brute_force(spark):
    """Null cells, odd roles, equal turns, repeated rows; one conversation of 700 turns over many pieces."""
    rng = np.random.default_rng(5)
    rows = _random_rows(rng, 400)
    rows += [(99, k, "user" if rng.random() < 0.7 else "assistant", f"text {k % 150}{'.' if k % 5 else ''}") for k in range(700)]
    rows += [(77, 3, "user", "again.")] * 150
    assert _query(spark, rows) == brute_force(rows)


def test_turns_and_clashing_columns(spark):
    rows = [(1, 0, "user", "Hi."), (1, 1, "user", "There"), (2, 0, "assistant", "x."), (None, None, None, None)]
    table = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("x") for c in ("ord", "conv", "no_id", "mark", "kind", "_own")})
    repair = turns.Repair(table)
    got = sorted((r.conv_id, r.position, r.role, r.text) for r in repair.turns().collect())
    assert got == [(1, 0, "user", "Hi."), (1, 1, "assistant", "There"), (2, 0, "user", ""), (2, 1, "assistant", "x.")]
    audits = {r.conv_id: (r.cost, r.audit) for r in repair.audits().collect()}
    assert audits == {1: (3, "KR"), 2: (2, "IK"), None: (3, "D")}
    assert turns.Repair(spark.createDataFrame([], SCHEMA)).audits().collect() == []


def test_alignment_of_all_short_pieces():
    """All pieces of three codes, as a whole and cut in every place."""
    named = {v: k for k, v in turns._CODES.items()}
    letters = [turns._CODES[r, f] for r in "sua?" for f in ("fine", "truncated")] + [turns._CODES["u", "duplicate"]]
    for n in range(4):
        for codes in itertools.product(letters, repeat=n):
            want = _least(tuple(named[c] for c in codes))
            whole = "".join(codes)
            for cut in range(n + 1):
                parts = [{s: turns.align(p, s) for s in range(4)} for p in (whole[:cut], whole[cut:]) if p]
                cost, edits, last = turns.fold(parts)
                assert (cost, "".join(edits) + last) == want


def test_alignment_of_long_pieces():
    rng = np.random.default_rng(2)
    named = {v: k for k, v in turns._CODES.items()}
    for _ in range(40):
        weights = rng.dirichlet(np.ones(16) * 0.4)
        codes = "".join(rng.choice(list(named), 60, p=weights))
        cost, edits, last = turns.fold([{s: turns.align(p, s) for s in range(4)} for p in (codes[:33], codes[33:])])
        assert (cost, "".join(edits) + last) == _least(tuple(named[c] for c in codes))
