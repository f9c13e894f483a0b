"""Correlations of many columns: dense ones from tiles of sums, 0/1 columns of strings from counts."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybuy.operators.joins import lookup
from tallybuy.operators.sparse import feature_index, indexed
from tallybuy.session import write_out

#: Columns on a side of a tile, and bytes of sums that a task holds at a time.
TILE = 128
PASS_BYTES = 48 << 20
#: Sums of a pair of columns, over rows where both are present: n, x, y, xx, yy, xy.
_SUMS = 6


def _passes(p: int, tile: int, pass_bytes: int) -> list[list[tuple[int, int]]]:
    """Tiles (a <= b) of p columns, as many to a pass over the rows as fit into the bytes."""
    blocks = -(-p // tile)
    side = max(1, math.isqrt(pass_bytes // (_SUMS * 8 * tile * tile)))
    groups: dict[tuple[int, int], list[tuple[int, int]]] = {}
    for a in range(blocks):
        for b in range(a, blocks):
            groups.setdefault((a // side, b // side), []).append((a, b))
    return list(groups.values())


def tile_sums(values: DataFrame, centre: np.ndarray, tiles: Sequence[tuple[int, int]], tile: int = TILE) -> DataFrame:
    """``a, b, lane, sums``: one row for each task and tile.

    The lane is the root of the task's number, so there are about as many lanes as
    tasks in the largest of them.
    """
    p, chosen = len(centre), list(tiles)

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = sorted({k for pair in chosen for k in pair})
        width = {k: min(tile, p - k * tile) for k in blocks}
        sums = {(a, b): np.zeros((_SUMS, width[a], width[b])) for a, b in chosen}
        for batch in batches:
            x, there = {}, {}
            for k in blocks:
                raw = [
                    batch[f"c{c}"].to_numpy(zero_copy_only=False).astype(float) for c in range(k * tile, k * tile + width[k])
                ]
                m = np.column_stack(raw) - centre[k * tile : k * tile + width[k]]
                there[k] = (~np.isnan(m)).astype(float)
                x[k] = np.nan_to_num(m, nan=0.0)
            for (a, b), s in sums.items():
                s[0] += there[a].T @ there[b]
                s[1] += x[a].T @ there[b]
                s[2] += there[a].T @ x[b]
                s[3] += (x[a] * x[a]).T @ there[b]
                s[4] += there[a].T @ (x[b] * x[b])
                s[5] += x[a].T @ x[b]
        lane = math.isqrt(TaskContext.get().partitionId())
        for (a, b), s in sums.items():
            yield pa.RecordBatch.from_pydict(
                {"a": pa.array([a], pa.int32()), "b": pa.array([b], pa.int32()),
                 "lane": pa.array([lane], pa.int32()), "sums": pa.array([s.tobytes()], pa.binary())}
            )

    columns = sorted({c for pair in chosen for k in pair for c in range(k * tile, min(p, (k + 1) * tile))})
    return values.select(*[f"c{c}" for c in columns]).mapInArrow(fold, "a int, b int, lane int, sums binary")


def _added(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
    total = None
    for batch in batches:
        for body in batch["sums"]:
            one = np.frombuffer(body.as_buffer(), float)
            total = one.copy() if total is None else total + one
    return total


def folded(sums: DataFrame) -> DataFrame:
    """First level of the tree: one row for each lane and tile."""

    def add(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        body = pa.array([_added(batches).tobytes()], pa.binary())
        yield pa.RecordBatch.from_pydict({"a": pa.array([key[0].as_py()], pa.int32()), "b": pa.array([key[1].as_py()], pa.int32()), "sums": body})

    return sums.groupBy("a", "b", "lane").applyInArrow(add, "a int, b int, sums binary")


def correlation_pairs(
    df: DataFrame, columns: Sequence[str], threshold: float | None = None, tile: int = TILE, pass_bytes: int = PASS_BYTES
) -> DataFrame:
    """``(feature, earlier_feature, r)`` for pairs of columns, or those with abs(r) over the threshold.

    Pairwise complete: a pair uses the rows where both values are present. A
    pair that is constant on those rows has r NULL. Pairs form square tiles. Each task folds its
    rows into one array of sums for each tile; arrays are added in a tree of two levels, and
    only its root makes rows of pairs, those that pass the threshold.
    The tiles of many columns are dealt to several passes, each over its own columns.
    """
    names, p = list(columns), len(columns)
    values = df.select(*[F.col(f"`{c}`").cast("double").alias(f"c{k}") for k, c in enumerate(names)])
    if p < 2:
        return values.sparkSession.createDataFrame([], "feature string, earlier_feature string, r double")
    # Sums are taken around the column means, which keeps them accurate.
    centre_row = values.agg(*[F.avg(f"c{k}").alias(f"c{k}") for k in range(p)]).first()
    centre = np.array([v if v is not None else 0.0 for v in centre_row], dtype=float)

    def pairs(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = key[0].as_py(), key[1].as_py()
        rows, cols = min(tile, p - a * tile), min(tile, p - b * tile)
        r = _correlations(_added(batches).reshape(_SUMS, rows, cols))
        wanted = np.ones(r.shape, bool) if threshold is None else np.abs(np.nan_to_num(r)) > threshold
        i, j = np.nonzero(np.triu(wanted, 1) if a == b else wanted)
        found = r[i, j]
        yield pa.RecordBatch.from_pydict(
            {"feature": pa.array([names[b * tile + k] for k in j.tolist()], pa.string()),
             "earlier_feature": pa.array([names[a * tile + k] for k in i.tolist()], pa.string()),
             "r": pa.array(found, pa.float64(), mask=np.isnan(found))}
        )

    out = None
    for tiles in _passes(p, tile, pass_bytes):
        part = folded(tile_sums(values, centre, tiles, tile)).groupBy("a", "b")
        part = part.applyInArrow(pairs, "feature string, earlier_feature string, r double")
        out = part if out is None else out.unionByName(part)
    return out


def _correlations(sums: np.ndarray) -> np.ndarray:
    """r of each pair, NaN where a side is constant: variances at rounding-noise level belong to constants."""
    n, sx, sy, sxx, syy, sxy = sums
    with np.errstate(all="ignore"):
        var_x, var_y = sxx - sx * sx / n, syy - sy * sy / n
        good = (n > 1) & (var_x > 1e-14 * sxx) & (var_y > 1e-14 * syy)
        return np.where(good, (sxy - sx * sy / n) / (np.sqrt(var_x) * np.sqrt(var_y)), np.nan)


# --- 0/1 columns of strings ---------------------------------------------------------------


def _r(n: Column, sx: Column, sy: Column, sxx: Column, syy: Column, sxy: Column) -> Column:
    var_x, var_y = sxx - F.try_divide(sx * sx, n), syy - F.try_divide(sy * sy, n)
    good = (n > 1) & (var_x > F.lit(1e-14) * sxx) & (var_y > F.lit(1e-14) * syy)
    return F.when(good, F.try_divide(sxy - F.try_divide(sx * sy, n), F.sqrt(var_x) * F.sqrt(var_y)))


def sparse_correlations(
    df: DataFrame, numeric: Sequence[str], strings: Sequence[str], threshold: float, index: DataFrame | None = None
) -> DataFrame:
    """``(feature, earlier_feature, r)`` with abs(r) over the threshold, of numbers and 0/1 columns of strings.

    The rows of :func:`correlation_pairs` over the numeric columns and then a 0/1
    column for each value of each string column, without making those columns: nothing
    but counts per value, per pair of values of one row, and sums per value and number. A null string
    has 0 in all its columns.

    Two values that never stand in one row have r = -sqrt(odds * odds), so one of the
    two has odds over the threshold. A string column has at most (1 + t) / t such values; these few are set
    against all values, and no other absent pair can pass.
    """
    if not 0 < threshold < 1:
        raise ValueError("threshold must lie between 0 and 1")
    index = feature_index(df, strings) if index is None else index
    rows = write_out(indexed(df, numeric, strings, index), "indexed")
    p = len(numeric)
    total = rows.count()
    centre = rows.agg(*[F.avg(c).alias(c) for c in numeric]).first() if p else {}
    x = [F.col(f"`{c}`").cast("double") - F.lit(float(centre[c] or 0.0)) for c in numeric]
    held = F.array_compact(F.array(*[F.col(f"_i{k}") for k in range(len(strings))]))
    cell = rows.select(F.explode(held).alias("i"), *[e.alias(f"x{k}") for k, e in enumerate(x)])
    counts = write_out(
        cell.groupBy("i").agg(
            F.count(F.lit(1)).alias("c"),
            *[F.count(f"x{k}").alias(f"n{k}") for k in range(p)],
            *[F.sum(f"x{k}").alias(f"s{k}") for k in range(p)],
        ),
        "value-counts",
    )
    parts = [correlation_pairs(df, numeric, threshold).select("feature", "earlier_feature", "r")] if p > 1 else []
    named = index.select(F.col("index").alias("i"), "feature")
    if p:
        whole = rows.agg(*[F.count(F.lit(1)).alias("rows")], *[
            f.alias(n) for k, e in enumerate(x) for f, n in
            ((F.count(e), f"n{k}"), (F.sum(e), f"s{k}"), (F.sum(e * e), f"q{k}"))
        ]).first()
        mixed = [
            F.struct(
                F.lit(numeric[k]).alias("earlier_feature"),
                _r(
                    F.lit(float(whole[f"n{k}"])), F.lit(float(whole[f"s{k}"] or 0.0)), F.col(f"n{k}").cast("double"),
                    F.lit(float(whole[f"q{k}"] or 0.0)), F.col(f"n{k}").cast("double"), F.coalesce(f"s{k}", F.lit(0.0)),
                ).alias("r"),
            )
            for k in range(p)
        ]
        met = counts.select("i", F.explode(F.array(*mixed)).alias("m")).where(F.abs("m.r") > threshold)
        parts.append(lookup(met, named, ["i"], "inner").select("feature", "m.earlier_feature", "m.r"))
    both = F.transform(held, lambda a: F.transform(F.filter(held, lambda b: b > a), lambda b: F.struct(a.alias("i"), b.alias("j"))))
    together = write_out(
        rows.select(F.explode(F.flatten(both)).alias("p")).groupBy("p.i", "p.j").agg(F.count(F.lit(1)).alias("n")), "value-pairs"
    )
    one = counts.select("i", F.col("c").cast("double").alias("ci"))
    other = one.select(F.col("i").alias("j"), F.col("ci").alias("cj"))
    seen = lookup(lookup(together, one, ["i"], "inner"), other, ["j"], "inner")
    n, ci, cj = F.lit(float(total)), F.col("ci"), F.col("cj")
    seen = seen.select("i", "j", _r(n, ci, cj, ci, cj, F.col("n").cast("double")).alias("r")).where(F.abs("r") > threshold)
    odds = F.col("ci") / (n - F.col("ci"))
    common = counts.select("i", F.col("c").cast("double").alias("ci")).where((F.col("ci") < n) & (odds >= threshold)).collect()
    absent = None
    if common:
        heavy = F.array(*[F.struct(F.lit(r["i"]).alias("h"), F.lit(r["ci"]).alias("ch")) for r in common])
        reach = one.where(ci < n).select("i", "ci", F.explode(heavy).alias("w")).select("i", "ci", "w.h", "w.ch")
        # Of two common values the smaller one looks for the larger.
        names = [r["i"] for r in common]
        reach = reach.where((F.col("h") != F.col("i")) & (~F.col("i").isin(names) | (F.col("i") < F.col("h"))))
        r = -F.sqrt(odds * F.col("ch") / (n - F.col("ch")))
        reach = reach.select(F.least("i", "h").alias("i"), F.greatest("i", "h").alias("j"), r.alias("r")).where(F.abs("r") > threshold)
        absent = lookup(reach, together.select("i", "j"), ["i", "j"], "left_anti")
    pairs = seen if absent is None else seen.unionByName(absent)
    later = named.select(F.col("i").alias("j"), "feature")
    earlier = named.select("i", F.col("feature").alias("earlier_feature"))
    parts.append(lookup(lookup(pairs, later, ["j"], "inner"), earlier, ["i"], "inner").select("feature", "earlier_feature", "r"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
