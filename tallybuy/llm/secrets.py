"""Secrets in texts: fixed patterns, and strings that a battery of tests finds too random for prose.

Everything runs in DataFrame functions. Positions count code points.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass
from statistics import NormalDist

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybuy.llm.common import text_of
from tallybuy.session import write_out

# The three base kinds, as (name, pattern).
_ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
_ACCESS = r"AKIA[A-Z0-9]{16,}"  # the rest of a run from its first AKIA on: the same as + and a length check
_HEX = r"[0-9a-f]{24,}"  # whole runs: the same as + and a length check
KINDS = ("assign", "access", "hex", "random")

#: Strings that the battery looks at: runs of encoding characters that no other letter or digit touches.
_RUN = r"(?<![\p{L}\p{N}+/_-])[A-Za-z0-9+/_-]{16,}+=*(?![\p{L}\p{N}])"
_LOWER, _UPPER, _DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
#: Encodings in the order they are tried: pattern of the whole string, alphabet, and the
#: alphabet by which words are scored for the null distribution (an index into ``_WORD_ALPHABETS``).
_ENCODINGS = (
    ("^[0-9]+$", _DIGITS, 1),
    ("^[0-9a-f]+$", _DIGITS + "abcdef", 1),
    ("^[0-9A-F]+$", _DIGITS + "ABCDEF", 1),
    ("^[A-Z2-7]+$", _UPPER + "234567", 1),
    ("^[a-z]+$", _LOWER, 0),
    ("^[a-z0-9]+$", _DIGITS + _LOWER, 1),
    ("^[A-Za-z0-9+/]+$", _UPPER + _LOWER + _DIGITS + "+/", 2),
    ("", _UPPER + _LOWER + _DIGITS + "-_+/", 2),
)
_WORD_ALPHABETS = (_LOWER, _DIGITS + _LOWER, _UPPER + _LOWER + _DIGITS + "+/")
#: Lengths from which a new class begins; each class has its own null distribution and false-discovery rate.
_CLASSES = (16, 20, 24, 32, 48, 64)
#: Of each class, so many bins for its p-values, by tenths of a decimal logarithm.
_BINS = 200
_BLOCK = 256
_WORD = "^[A-Za-z]+$"
#: Words from which on their departures make a null distribution.
_LEAST_WORDS = 30
#: Departure of uniform random letters: of its three z-values two are absolute, so the sum has these mean and spread.
_UNIFORM_MEAN = 2 * (2 / math.pi) ** 0.5 / 3**0.5
_UNIFORM_SD = ((1 + 2 * (1 - 2 / math.pi)) / 3) ** 0.5


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _located(text: Column, pattern: str) -> Column:
    """All matches, leftmost and not overlapping, as structs of start, end and token.

    A match starts after the gaps and matches before it. These lengths are added
    up within blocks, and block by block, so long lists don't cost their square.
    """

    def place(found: Column) -> Column:
        return _let(F.split(text, pattern, -1), lambda gaps: _let(
            F.transform(
                found, lambda m, i: F.struct(F.length(F.get(gaps, i)).alias("gap"), F.length(m).alias("points"), m.alias("token"))
            ),
            by_block,
        ))

    def by_block(parts: Column) -> Column:
        last = F.floor((F.size(parts) - 1) / _BLOCK).cast("int")
        blocks = F.transform(F.sequence(F.lit(0), last), lambda b: F.slice(parts, b * _BLOCK + 1, F.lit(_BLOCK)))
        return _let(blocks, lambda bs: _let(
            F.transform(bs, lambda b: F.aggregate(b, F.lit(0), lambda s, x: s + x["gap"] + x["points"])),
            lambda totals: F.flatten(F.transform(bs, lambda b, k: within(b, F.aggregate(F.slice(totals, F.lit(1), k), F.lit(0), lambda s, x: s + x)))),
        ))

    def within(block: Column, base: Column) -> Column:
        start = F.struct(base.alias("at"), _none().alias("out"))

        def step(acc, x):
            begin = acc["at"] + x["gap"]
            end = begin + x["points"]
            one = F.struct(begin.alias("start"), end.alias("end"), x["token"].alias("token"))
            return F.struct(end.alias("at"), F.concat(acc["out"], F.array(one)).alias("out"))

        return F.aggregate(block, start, step, lambda acc: acc["out"])

    return _let(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
        lambda found: F.when(F.size(found) > 0, place(found)).otherwise(_none()),
    )


def _none() -> Column:
    return F.array().cast("array<struct<start:int,end:int,token:string>>")


def _of_kind(spans: Column, kind: int) -> Column:
    return F.transform(
        spans, lambda s: F.struct(s["start"].alias("start"), F.lit(kind).alias("kind"), s["end"].alias("end"))
    )


# --- the battery --------------------------------------------------------------------------


def _length_class(points: Column) -> Column:
    out = F.lit(_CLASSES[0])
    for least in _CLASSES[1:]:
        out = F.when(points >= least, least).otherwise(out)
    return out


def _body(token: Column) -> Column:
    return F.rtrim(token, F.lit("="))


def _by_encoding(token: Column, values: list) -> Column:
    """The value that belongs to the encoding of a string."""
    out = F.lit(values[-1])
    for (pattern, *_), value in reversed(list(zip(_ENCODINGS[:-1], values))):
        out = F.when(token.rlike(pattern), value).otherwise(out)
    return out


def _family(token: Column) -> Column:
    return _by_encoding(_body(token), [e[2] for e in _ENCODINGS])


def _departure(token: Column, letters: Column | None = None) -> Column:
    """How far a string is from uniform random letters of its encoding: three tests, as one z-value.

    Chi-squared of letter counts (by Wilson and Hilferty's cube root), the number
    of runs above and below the middle of the alphabet, and the correlation of
    neighbours. ``letters`` may name another alphabet than that of the encoding.
    """
    return _let(_body(token), lambda t: _let(
        _by_encoding(t, [e[1] for e in _ENCODINGS]) if letters is None else letters,
        lambda alphabet: _let(
            F.transform(F.split(t, ""), lambda c: F.instr(alphabet, c) - 1), lambda codes: _tests(codes, F.length(alphabet))
        ),
    ))


def _tests(codes: Column, letters: Column) -> Column:
    zero = F.struct(
        *[F.lit(0.0).alias(x) for x in ("n", "squares", "run", "before", "high", "runs", "sum", "products", "sum2")]
    )

    def count(acc, c):  # letters in sorted order: squares of their counts
        same = c == acc["before"]
        run = F.when(same, acc["run"] + 1).otherwise(F.lit(1.0))
        # (r + 1)^2 - r^2 = 2 r + 1, with r letters before this one
        return F.struct(
            acc["n"].alias("n"), (acc["squares"] + 2 * run - 1).alias("squares"), run.alias("run"), c.cast("double").alias("before"),
            *[acc[x].alias(x) for x in ("high", "runs", "sum", "products", "sum2")],
        )

    def walk(acc, c):
        x = c.cast("double") - (letters - 1) / 2
        up = F.when(x > 0, 1.0).otherwise(0.0)
        turn = F.when((acc["n"] == 0) | ((acc["before"] > 0) != (x > 0)), 1.0).otherwise(0.0)
        return F.struct(
            (acc["n"] + 1).alias("n"), acc["squares"].alias("squares"), acc["run"].alias("run"), x.alias("before"),
            (acc["high"] + up).alias("high"), (acc["runs"] + turn).alias("runs"), (acc["sum"] + x).alias("sum"),
            (acc["products"] + F.when(acc["n"] > 0, acc["before"] * x).otherwise(0.0)).alias("products"), (acc["sum2"] + x * x).alias("sum2"),
        )

    started = F.struct(*[(F.lit(-1.0) if x == "before" else F.lit(0.0)).alias(x) for x in ("n", "squares", "run", "before", "high", "runs", "sum", "products", "sum2")])

    def combine(s, w):
        n, high = w["n"], w["high"]
        low, free = n - high, (letters - 1).cast("double")
        chi = F.greatest(letters * s["squares"] / n - n, F.lit(0.0))
        z_chi = (F.pow(chi / free, F.lit(1 / 3)) - (1 - 2 / (9 * free))) / F.sqrt(2 / (9 * free))
        mean = 2 * high * low / n + 1
        spread = (mean - 1) * (mean - 2) / F.greatest(n - 1, F.lit(1.0))
        z_runs = F.when(spread > 0, F.abs(w["runs"] - mean) / F.sqrt(spread)).otherwise(F.sqrt(n))
        centre = w["sum"] * w["sum"] / n
        total = w["sum2"] - centre
        z_serial = F.when(total > 0, F.abs((w["products"] - centre) / total) * F.sqrt(n)).otherwise(F.sqrt(n))
        return (z_chi + z_runs + z_serial) / F.sqrt(F.lit(3.0))

    return _let(F.aggregate(F.array_sort(codes), started, count), lambda s: _let(F.aggregate(codes, zero, walk), lambda w: combine(s, w)))


def _normal(z: Column) -> Column:
    """Distribution function of the normal, by its logistic approximation."""
    return 1 / (1 + F.exp(-(1.5976 * z + 0.07056 * z * z * z)))


@dataclass(frozen=True)
class Battery:
    """For word alphabets and classes of lengths the departure up to which a string counts as a secret."""

    cuts: tuple[tuple[int, int, float], ...]
    #: Whether strings of letters alone are taken for words without a test.
    spares_words: bool = False

    def finds(self, token: Column, departure: Column) -> Column:
        if not self.cuts:
            return F.lit(False)
        chosen = F.coalesce(
            *[F.when((_family(token) == f) & (_length_class(F.length(token)) == k), cut) for f, k, cut in self.cuts]
        )
        found = F.coalesce(departure <= chosen, F.lit(False))
        return found & ~token.rlike(_WORD) if self.spares_words else found


def fit_battery(docs: DataFrame, false_rate: float = 0.01) -> Battery:
    """Fit the battery on all strings of all documents.

    Letters-only strings are taken for long words. Mean and spread of their
    departures, by alphabet and class of lengths, make the null distribution "a
    word of this length"; classes of few words take it from all words, whose
    departure grows with the root of the length. A string's p-value is the share
    of words that look at least as random. Within each alphabet and class the
    Benjamini-Hochberg rule at ``false_rate`` turns the counts of p-values, in
    bins, into a cut, so the power that a length gives decides how random a
    string has to look. Where there are no words to compare with (fewer than ``_LEAST_WORDS``), a string
    of more than letters is found if it departs from uniform random ones no more than all but
    ``false_rate`` of them do.
    """
    tokens = docs.select(F.explode(_located(text_of(), _RUN)).alias("span")).select(F.col("span.token").alias("token"))
    word = F.col("token").rlike(_WORD)
    scored = write_out(
        tokens.select(
            _length_class(F.length("token")).alias("class"),
            F.sqrt(F.length("token").cast("double")).alias("root"),
            _family(F.col("token")).alias("family"),
            _departure(F.col("token")).alias("departure"),
            *[
                F.when(word, _departure(F.lower("token") if k < 2 else F.col("token"), F.lit(x))).alias(f"as{k}")
                for k, x in enumerate(_WORD_ALPHABETS)
            ],
        ),
        "departures",
    )
    families = range(len(_WORD_ALPHABETS))
    sums = [F.count("as0").alias("n"), *[x for k in families for x in (F.avg(f"as{k}").alias(f"mean{k}"), F.stddev(f"as{k}").alias(f"sd{k}"))]]
    words = scored.where("as0 IS NOT NULL")
    every = words.agg(*sums, *[F.avg(F.col(f"as{k}") / F.col("root")).alias(f"slope{k}") for k in families]).first()
    if every["n"] < _LEAST_WORDS:
        cut = _UNIFORM_MEAN + NormalDist().inv_cdf(1 - false_rate) * _UNIFORM_SD
        return Battery(tuple((f, k, cut) for f in families for k in _CLASSES), spares_words=True)
    null = {(f, k): (every[f"slope{f}"] * k**0.5, every[f"sd{f}"]) for f in families for k in _CLASSES}
    for r in words.groupBy("class").agg(*sums).collect():  # a row for each class
        if r["n"] >= _LEAST_WORDS:
            null |= {(f, r["class"]): (r[f"mean{f}"], r[f"sd{f}"]) for f in families}
    mean, sd = (
        F.coalesce(*[F.when((F.col("family") == f) & (F.col("class") == k), float(v[i])) for (f, k), v in null.items()])
        for i in (0, 1)
    )
    p = _normal((F.col("departure") - mean) / F.greatest(sd, F.lit(1e-9)))
    bins = scored.groupBy(
        "family", "class", F.least(F.floor(-10 * F.log10(F.greatest(p, F.lit(1e-300)))), F.lit(_BINS)).cast("int").alias("bin")
    ).agg(F.count("*").alias("n"), F.max("departure").alias("most"))
    rows = bins.collect()  # at most _BINS for each alphabet and class
    cuts = {}
    for place in null:
        own = sorted(((r["bin"], r["n"], r["most"]) for r in rows if (r["family"], r["class"]) == place), reverse=True)
        total, so_far = sum(n for _, n, _ in own), 0
        for b, n, most in own:
            so_far += n
            if 10 ** (-b / 10) <= false_rate * so_far / total:
                cuts[place] = most
    return Battery(tuple((*place, cut) for place, cut in sorted(cuts.items())))


# --- the scan -----------------------------------------------------------------------------


def find_secrets(docs: DataFrame, battery: Battery | None = None, carry: tuple[str, ...] = ()) -> DataFrame:
    """Spans of secrets in each text: one row for each row of ``docs``.

    Columns: ``doc_id``, those named in ``carry``, ``base`` (spans of the three
    fixed kinds) and ``spans`` (these and those of the battery that overlap none
    of them), both arrays of ``start, kind, end`` in this order; ``kind`` is an
    index into ``KINDS``. Null and empty texts have no spans. Repeated rows are
    scanned like others; columns of ``docs`` that aren't named aren't read. ``carry`` can't name a column
    of the result.
    """
    if clash := {"doc_id", "base", "spans"} & {c.lower() for c in carry}:
        raise ValueError(f"columns of the result can't be carried along: {sorted(clash)}")
    battery = battery or fit_battery(docs)
    text = F.col("_text")
    assign = F.filter(
        _located(text, _ASSIGN), lambda s: F.length(F.regexp_extract(s["token"], _ASSIGN, 2)) >= 6
    )
    base = F.array_sort(
        F.concat(_of_kind(assign, 0), _of_kind(_located(text, _ACCESS), 1), _of_kind(_located(text, _HEX), 2))
    )
    # What is carried goes along in one column, so that no name clashes with those here.
    carried = [F.struct(*[F.col(f"`{c}`") for c in carry]).alias("_carried")] if carry else []
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), *carried, text_of().alias("_text"))

    def with_random(known: Column) -> Column:
        random = F.filter(
            _located(text, _RUN),
            lambda s: ~F.exists(known, lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))
            & battery.finds(s["token"], _departure(s["token"])),
        )
        return F.struct(known.alias("base"), F.array_sort(F.concat(known, _of_kind(random, 3))).alias("spans"))

    names = ["_carried"] if carry else []
    found = rows.select("doc_id", *names, _let(base, with_random).alias("_found"))
    return found.select("doc_id", *[f"{c}.*" for c in names], "_found.*")


def spans_text(spans: Column) -> Column:
    """Spans as ``kind:start:end``, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def mask_text(text: Column, spans: Column, mark: str = "[secret]") -> Column:
    """The text with each stretch that spans cover replaced by ``mark``."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))

    def step(acc, s):
        gap = F.substring(text, acc["at"] + 1, s["start"] - acc["at"])
        fresh = s["start"] >= acc["at"]
        return F.struct(
            F.greatest(acc["at"], s["end"]).alias("at"),
            F.when(fresh, F.concat(acc["out"], F.array(gap, F.lit(mark)))).otherwise(acc["out"]).alias("out"),
        )

    masked = F.aggregate(
        spans, start, step, lambda acc: F.concat(F.array_join(acc["out"], ""), F.substring(text, acc["at"] + 1, F.length(text)))
    )
    return F.when(F.size(spans) > 0, masked).otherwise(text)
