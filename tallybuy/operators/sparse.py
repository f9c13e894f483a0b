"""0/1 columns of strings kept as numbers: no value becomes a column of the schema or reaches the driver."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybuy.functions.ordering import positions
from tallybuy.operators.joins import lookup
from tallybuy.session import write_out


def _cells(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    held = F.array(*[F.struct(F.lit(k).alias("place"), F.col(f"`{c}`").cast("string").alias("value")) for k, c in enumerate(columns)])
    return df.select(F.explode(held).alias("c")).select("c.place", "c.value").where(F.col("value").isNotNull())


def feature_index(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(place, value, feature, index)``: values of the named columns, numbered from 0 by column and value.

    ``place`` is the position of the column in ``columns``, ``feature`` is ``<column>_<value>``.
    """
    values = _cells(df, columns).distinct()
    numbered = write_out(positions(values, ["place", "value"], "index"), "feature-index")
    names = F.array(*[F.lit(c) for c in columns])
    return numbered.select("place", "value", F.concat_ws("_", F.get(names, F.col("place")), "value").alias("feature"), "index")


def indexed(df: DataFrame, kept: Sequence[str], columns: Sequence[str], index: DataFrame) -> DataFrame:
    """``kept`` and, for each named column k, ``_ik``: the index of its value, null for null."""
    out = df.select(*[F.col(f"`{c}`") for c in kept], *[F.col(f"`{c}`").cast("string").alias(f"_v{k}") for k, c in enumerate(columns)])
    for k in range(len(columns)):
        own = index.where(F.col("place") == k).select(F.col("value").alias(f"_v{k}"), F.col("index").alias(f"_i{k}"))
        out = lookup(out, own, [f"_v{k}"]).drop(f"_v{k}")
    return out


def one_hot_cells(df: DataFrame, keys: Sequence[str], columns: Sequence[str], index: DataFrame | None = None) -> DataFrame:
    """``keys`` and ``(feature, index)`` of each 1 of the rows: the one-hot matrix in long form."""
    index = feature_index(df, columns) if index is None else index
    held = F.array(*[F.struct(F.lit(k).alias("place"), F.col(f"`{c}`").cast("string").alias("value")) for k, c in enumerate(columns)])
    long = df.select(*keys, F.explode(held).alias("_c")).select(*keys, "_c.place", "_c.value").where(F.col("value").isNotNull())
    return lookup(long, index, ["place", "value"], "inner").select(*keys, "feature", "index")


def one_hot_vectors(
    df: DataFrame, kept: Sequence[str], numeric: Sequence[str], columns: Sequence[str], index: DataFrame | None = None,
    result: str = "features",
) -> DataFrame:
    """``kept`` and one sparse vector of the numeric columns (null is 0) and the one-hot positions, in index order by column.

    The position of a value is the number of numeric columns plus its index.
    """
    if not columns:
        return VectorAssembler(inputCols=list(numeric), outputCol=result).transform(df.fillna(0, list(numeric))).select(*kept, result)
    index = feature_index(df, columns) if index is None else index
    rows = indexed(df, [*kept, *[c for c in numeric if c not in kept]], columns, index)
    first = {r["place"]: (r["low"], r["n"]) for r in index.groupBy("place").agg(F.min("index").alias("low"), F.count(F.lit(1)).alias("n")).collect()}
    used = sorted(first)
    for k in used:
        # Values of a column are numbered in one stretch; null is the place behind it, which the encoder drops.
        low, n = first[k]
        rows = rows.withColumn(f"_i{k}", F.coalesce(F.col(f"_i{k}") - low, F.lit(n)).cast("double"))
    rows = rows.fillna(0, list(numeric))
    if used:
        # The largest place of each column has to be in the fitted rows; these say so without a pass over the data.
        sizes = rows.sparkSession.createDataFrame([tuple(float(first[k][1]) for k in used)], ", ".join(f"_i{k} double" for k in used))
        encoder = OneHotEncoder(inputCols=[f"_i{k}" for k in used], outputCols=[f"_h{k}" for k in used], dropLast=True)
        rows = encoder.fit(sizes).transform(rows)
    assembler = VectorAssembler(inputCols=[*numeric, *[f"_h{k}" for k in used]], outputCol=result)
    return assembler.transform(rows).select(*kept, result)
