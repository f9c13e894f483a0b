"""Column expressions shared by the operators. All of them stay inside codegen."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LOGIT_EPS = 1e-15


@dataclass(frozen=True)
class PromoCalendar:
    """MMDD bounds of the promotion and of the stretch right before it.

    The promotion bounds are inclusive, the bounds of the stretch before it
    exclusive.
    """

    promo_from: int = 1111
    promo_to: int = 1111
    pre_after: int = 1101
    pre_before: int = 1111

    def is_promo(self, ts: Column) -> Column:
        return ts.between(self.promo_from, self.promo_to)

    def is_before_promo(self, ts: Column) -> Column:
        return (ts > self.pre_after) & (ts < self.pre_before)


def month_of(ts: Column) -> Column:
    """Month of an MMDD integer."""
    return F.floor(ts / 100).cast("int")


def date_of(ts: Column, year: int = 2016) -> Column:
    """Date of an MMDD integer in the given year."""
    return F.make_date(F.lit(year), month_of(ts), (ts % 100).cast("int"))


def composite_key(*parts: Column) -> Column:
    """``a_b`` label of several ids. For output only; joins use the parts."""
    return F.concat_ws("_", *[p.cast("string") for p in parts])


def count_when(condition: Column, value: Column) -> Column:
    """Non-null ``value`` in the rows that meet ``condition``."""
    return F.count(F.when(condition, value))


def ratio(numerator: Column, denominator: Column) -> Column:
    """Double quotient, NULL for a zero denominator."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def logit(p: Column, eps: float = LOGIT_EPS) -> Column:
    clipped = F.greatest(F.least(p, F.lit(1.0 - eps)), F.lit(eps))
    return F.ln(clipped / (F.lit(1.0) - clipped))


def sigmoid(x: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-x))


def epoch_micros(ts: Column) -> Column:
    """Microseconds since 1970 of a timestamp, read off its fields.

    Does not depend on the session time zone for zone-less timestamps.
    """
    days = F.datediff(ts.cast("date"), F.lit("1970-01-01").cast("date")).cast("bigint")
    whole = (days * 24 + F.hour(ts)) * 60 + F.minute(ts)
    micros = (F.extract(F.lit("SECOND"), ts) * 1_000_000).cast("bigint")
    return whole * 60_000_000 + micros


def epoch_days(d: Column) -> Column:
    return F.datediff(d, F.lit("1970-01-01").cast("date"))


def spread(total: Column, squares: Column, n: Column) -> Column:
    """Sample standard deviation from weighted sums; NULL below two rows."""
    m = n.cast("double")
    centred = F.greatest(squares - total * F.try_divide(total, m), F.lit(0.0))
    return F.when(n > 1, F.sqrt(F.try_divide(centred, m - 1.0)))


def cells(df: DataFrame, kept: Sequence[Column | str], columns: Sequence[str]) -> DataFrame:
    """One row per (row, column): ``kept``, then ``cell`` and ``value``.

    ``cell`` is the position of the column in ``columns``, ``value`` its id. A
    number rather than a name keeps grouping keys of fixed width.
    """
    entries = [
        F.struct(F.lit(i).alias("cell"), F.col(c).cast("bigint").alias("value"))
        for i, c in enumerate(columns)
    ]
    return df.select(*kept, F.inline(F.array(*entries)))
