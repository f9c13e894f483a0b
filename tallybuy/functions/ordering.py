"""Running totals and neighbours in a global order, without a one-task window.

A window without (or with a hot) partition key sends all of its rows to a
single task. Here the rows are range-partitioned into slices first and written
out; totals run inside each slice, and what a slice needs from the slices
before it is one row per slice and key that crosses the slice border.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallybuy.session import write_out

_SLICE = "_slice"


def into_slices(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """``df`` with a ``_slice`` number; slices follow each other in ``order``.

    The slice numbers are written out with the rows, so both readers of the
    result see the same ones.
    """
    sliced = df.repartitionByRange(*order).withColumn(_SLICE, F.spark_partition_id())
    return write_out(sliced, "slices")


def running_totals(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    totals: Mapping[str, Column],
) -> DataFrame:
    """Add per-``keys`` running sums (current row included) in ``order``.

    ``order`` must be unique within ``keys``. With no keys the totals run over
    the whole table.
    """
    keys = list(keys)
    sliced = into_slices(df, [*keys, *order])
    inside = (
        Window.partitionBy(_SLICE, *keys)
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    before = Window.partitionBy(*keys).orderBy(_SLICE).rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        sliced.groupBy(_SLICE, *keys)
        .agg(*[F.sum(e).alias(f"_carry_{n}") for n, e in totals.items()])
        .select(
            _SLICE,
            *keys,
            *[F.sum(f"_carry_{n}").over(before).alias(f"_carry_{n}") for n in totals],
        )
        .where(F.col(f"_carry_{next(iter(totals))}").isNotNull())
    )
    local = sliced.select("*", *[F.sum(e).over(inside).alias(n) for n, e in totals.items()])
    joined = local.join(carried, [_SLICE, *keys], "left")
    kept = [c for c in df.columns if c not in totals]
    return joined.select(
        *kept,
        *[(F.col(n) + F.coalesce(F.col(f"_carry_{n}"), F.lit(0))).alias(n) for n in totals],
    )


def previous_value(
    df: DataFrame, keys: Sequence[str], value: str, result: str, ties: Sequence[str] = ()
) -> DataFrame:
    """Add the preceding ``value`` within ``keys`` in ascending order of ``value``."""
    keys = list(keys)
    sliced = into_slices(df, [*keys, value, *ties])
    inside = Window.partitionBy(_SLICE, *keys).orderBy(value, *ties)
    earlier = Window.partitionBy(*keys).orderBy(_SLICE).rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        sliced.groupBy(_SLICE, *keys)
        .agg(F.max(value).alias("_top"))
        .select(_SLICE, *keys, F.max("_top").over(earlier).alias("_carry"))
        .where(F.col("_carry").isNotNull())
    )
    local = sliced.withColumn("_lag", F.lag(value).over(inside))
    joined = local.join(carried, [_SLICE, *keys], "left")
    return joined.select(*df.columns, F.coalesce("_lag", "_carry").alias(result))


def positions(df: DataFrame, order: Sequence[str], result: str = "position") -> DataFrame:
    """Number the rows 0, 1, … in the given order (which must be total)."""
    numbered = running_totals(df, [], order, {result: F.lit(1).cast("bigint")})
    return numbered.withColumn(result, F.col(result) - 1)


#: Ranks that a sketch may miss by, as a share of the rows, and columns that one pass narrows.
_SKETCH_ACCURACY = 4_000
_COLUMNS_A_PASS = 100


def exact_quantiles(
    df: DataFrame, columns: Sequence[str], probabilities: Sequence[float], accuracy: int = _SKETCH_ACCURACY
) -> dict[str, list[float | None]]:
    """Exact interpolated quantiles of each column, NULLs left out.

    Values are not sorted. A sketch of each column bounds each wanted rank from
    both sides; a pass counts the values below the bounds, and another keeps
    the values between them, as counts per value. Only these are put in order, and only the rows next
    to a requested rank reach the driver. Should a sketch have missed a rank, its bounds
    open to the least and largest value. ``df`` is read three times.
    """
    out: dict[str, list[float | None]] = {}
    for at in range(0, len(columns), _COLUMNS_A_PASS):
        out |= _narrowed_quantiles(df, list(columns[at : at + _COLUMNS_A_PASS]), list(probabilities), accuracy)
    return out


def _narrowed_quantiles(
    df: DataFrame, columns: list[str], probabilities: list[float], accuracy: int
) -> dict[str, list[float | None]]:
    # One row for each cell: an aggregate by column stays small for any number of columns.
    cells = F.posexplode(F.array(*[F.col(f"`{c}`").cast("double") for c in columns])).alias("i", "v")
    values = df.select(cells)
    # Twice the share that a sketch may be off, to each side; the outermost bounds are exact.
    reach = 2.0 / accuracy
    asked = [min(max(q, 0.0), 1.0) for p in probabilities for q in (p - reach, p + reach)]
    found = values.groupBy("i").agg(
        F.count("v").alias("n"), F.min("v").alias("low"), F.max("v").alias("high"),
        F.percentile_approx("v", asked, accuracy).alias("q"),
    ).collect()
    facts = {r["i"]: r for r in found if r["n"]}
    bands, targets = [], []
    for i in sorted(facts):
        fact = facts[i]
        for k, p in enumerate(probabilities):
            rank = p * (fact["n"] - 1)
            low, high = fact["q"][2 * k : 2 * k + 2]
            low = fact["low"] if asked[2 * k] == 0.0 else low
            high = fact["high"] if asked[2 * k + 1] == 1.0 else high
            bands.append((i, low, high))
            targets.append((int(rank), min(int(rank) + 1, fact["n"] - 1), rank - int(rank)))
    if bands:
        bands = _sound_bands(values, bands, targets, facts, len(probabilities))
    spans = _values_of_ranks(values, bands, targets, len(probabilities))
    out: dict[str, list[float | None]] = {c: [None] * len(probabilities) for c in columns}
    for b, ((i, *_), (lo, hi, share)) in enumerate(zip(bands, targets)):
        out[columns[i]][b % len(probabilities)] = spans[b, lo] * (1.0 - share) + spans[b, hi] * share
    return out


def _by_column(found: Sequence[tuple[int, float | int]], kind: str) -> Column:
    """The number that goes with the column of a cell; NULL for a column without one."""
    numbers = dict(found)
    return F.get(F.array(*[F.lit(numbers.get(i)).cast(kind) for i in range(max(numbers) + 1)]), F.col("i"))


def _sound_bands(
    values: DataFrame, bands: list, targets: list, facts: Mapping, width: int
) -> list[tuple[int, float, float, int]]:
    """Bands with the number of values below each; one that misses its ranks is opened.

    Each column has ``width`` bands, one after the other.
    """
    lows = [_by_column([(i, low) for i, low, _ in bands[k::width]], "double") for k in range(width)]
    highs = [_by_column([(i, high) for i, _, high in bands[k::width]], "double") for k in range(width)]
    below = F.array(*[F.count_if(F.col("v") < low) for low in lows]).alias("below")
    upto = F.array(*[F.count_if(F.col("v") <= high) for high in highs]).alias("upto")
    counts = {r["i"]: r for r in values.groupBy("i").agg(below, upto).collect()}
    out = []
    for b, ((i, low, high), (first, last, _)) in enumerate(zip(bands, targets)):
        less = counts[i]["below"][b % width]
        if not less <= first <= last < counts[i]["upto"][b % width]:
            low, high, less = facts[i]["low"], facts[i]["high"], 0
        out.append((i, low, high, less))
    return out


def _values_of_ranks(values: DataFrame, bands: list, targets: list, width: int) -> dict[tuple[int, int], float]:
    """The value of each target rank, by band and rank."""
    if not bands:
        return {}
    inside = []
    for k in range(width):
        low = _by_column([(i, low) for i, low, _, _ in bands[k::width]], "double")
        high = _by_column([(i, high) for i, _, high, _ in bands[k::width]], "double")
        inside.append((F.col("v").between(low, high), _by_column([(band[0], k + width * at) for at, band in enumerate(bands[k::width])], "int")))
    hits = [F.when(here, F.struct(band.alias("band"), F.col("v").alias("value"))) for here, band in inside]
    counts = (
        values.where(reduce(lambda a, b: a | b, [here for here, _ in inside]))
        .select(F.explode(F.array(*hits)).alias("cell"))
        .where(F.col("cell").isNotNull())
        .groupBy("cell.band", "cell.value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    cumulated = running_totals(counts, ["band"], ["value"], {"upto": F.col("n")})
    # At most two ranks for each column and probability.
    ranks = sorted({(b, k, k - bands[b][3]) for b, (lo, hi, _) in enumerate(targets) for k in (lo, hi)})
    wanted = values.sparkSession.createDataFrame(ranks, "band int, rank bigint, place bigint")
    found = cumulated.join(F.broadcast(wanted), "band").where(
        (F.col("place") >= F.col("upto") - F.col("n")) & (F.col("place") < F.col("upto"))
    )
    return {(r["band"], r["rank"]): r["value"] for r in found.select("band", "rank", "value").collect()}
