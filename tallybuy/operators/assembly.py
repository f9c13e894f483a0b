"""Aligning feature frames and joining them onto a population."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybuy.operators.joins import lookup
from tallybuy.operators.selection import FeatureSelector
from tallybuy.session import write_out
from tallybuy.sources.tables import downcast_doubles


def prefix_columns(df: DataFrame, keys: Sequence[str], prefix: str) -> DataFrame:
    return df.select(
        *keys, *[F.col(f"`{c}`").alias(f"{prefix}_{c}") for c in df.columns if c not in keys]
    )


def outer_align(frames: Mapping[str, DataFrame], keys: Sequence[str]) -> DataFrame:
    """Full outer join of keyed frames; columns get the frame's name as prefix.

    Written as union plus one aggregate: a chain of outer joins would shuffle
    the growing result once per frame. Each frame has one row per key; a key
    that a frame holds twice raises an error when the result is read.
    """
    keys = list(keys)
    stacked: DataFrame | None = None
    for name, df in frames.items():
        part = prefix_columns(df.dropna(subset=keys), keys, name).withColumn("_frame", F.lit(name))
        stacked = part if stacked is None else stacked.unionByName(part, allowMissingColumns=True)
    if stacked is None:
        raise ValueError("no feature frames given")
    features = [c for c in stacked.columns if c not in (*keys, "_frame")]
    names = list(frames)
    merged = stacked.groupBy(*keys).agg(
        *[F.max(f"`{c}`").alias(c) for c in features],
        F.greatest(F.lit(0), *[F.count_if(F.col("_frame") == n) for n in names]).alias("_most"),
    )
    once = F.when(F.col("_most") > 1, F.raise_error(F.lit(f"a frame of {names} holds a key twice")).cast("boolean"))
    return merged.where(F.coalesce(once, F.lit(True))).drop("_most")


def fill_aligned(frames: Mapping[str, DataFrame], keys: Sequence[str], value=0) -> DataFrame:
    """:func:`outer_align` with missing entries filled."""
    return outer_align(frames, keys).na.fill(value)


def prune_unlabelled(
    features: DataFrame,
    keys: Sequence[str],
    missing: float = 0.99,
    correlation: float = 1.0,
) -> DataFrame:
    """Drop mostly missing, constant and (below 1) collinear columns."""
    selector = FeatureSelector(features, keys)
    selector.identify_missing(missing)
    selector.identify_single_unique()
    methods = ["missing", "single_unique"]
    if correlation < 1:
        selector.identify_collinear(correlation)
        methods.append("collinear")
    return selector.remove(methods)


def assemble(
    frames: Mapping[str, DataFrame],
    keys: Sequence[str],
    missing: float = 0.99,
    correlation: float = 1.0,
    downcast: bool = True,
) -> DataFrame:
    """Prune each frame, align them, prune the result, optionally to floats."""
    # Which columns stay is known only after a look at the data, so every frame
    # is read more than once and written out before.
    kept = {
        n: prune_unlabelled(write_out(df, f"frame-{n}"), keys, missing, correlation)
        for n, df in frames.items()
    }
    aligned = write_out(outer_align(kept, keys), "aligned")
    joined = prune_unlabelled(aligned, keys, missing, correlation)
    return downcast_doubles(joined) if downcast else joined


def attach_features(
    rows: DataFrame, stores: Sequence[tuple[str, Sequence[str], DataFrame]]
) -> DataFrame:
    """Left-join feature tables, each ``(suffix, keys, frame)``, one after another.

    Joins run on the id columns. Frames hold one row per key, so the row count
    stays.
    """
    out = rows
    for suffix, keys, frame in stores:
        keys = list(keys)
        named = frame.select(
            *keys, *[F.col(f"`{c}`").alias(f"{c}_{suffix}") for c in frame.columns if c not in keys]
        )
        out = lookup(out, named, keys)
    return out


def write_bucketed(df: DataFrame, keys: Sequence[str], name: str, buckets: int) -> DataFrame:
    """A feature table in buckets by its keys, sorted inside, as a table of the catalog.

    Joins on the keys read it as it lies, without a shuffle, each time.
    """
    df.write.bucketBy(buckets, *keys).sortBy(*keys).mode("overwrite").format("parquet").saveAsTable(name)
    return df.sparkSession.table(name)


def attach_bucketed(
    rows: DataFrame, stores: Sequence[tuple[str, Sequence[str], DataFrame]]
) -> DataFrame:
    """:func:`attach_features` with stores from :func:`write_bucketed`: only the rows move.

    For stores that are joined again and again. A hot key of the rows isn't split here, as its bucket can't be; where one
    key may hold a large part of the rows, :func:`attach_features` does that.
    """
    out = rows
    for suffix, keys, frame in stores:
        keys = list(keys)
        named = frame.select(
            *keys, *[F.col(f"`{c}`").alias(f"{c}_{suffix}") for c in frame.columns if c not in keys]
        )
        out = out.join(named, keys, "left").select(*out.columns, *[c for c in named.columns if c not in keys])
    return out


def attach_parent(log: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Aggregates of a parent entity next to each of its log rows."""
    return lookup(log, parent, [key])
