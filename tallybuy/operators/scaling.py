"""Robust scaling, principal components, random rotation."""

from __future__ import annotations

import math
import random
from collections.abc import Sequence

from pyspark.ml.feature import PCA, RobustScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybuy.functions.ordering import exact_quantiles
from tallybuy.session import write_out

# Columns that are carried along unscaled.
KEPT = ("user_id", "seller_id", "user_seller", "label")


def _features(df: DataFrame, kept: Sequence[str]) -> list[str]:
    return [c for c in df.columns if c not in kept]


def _filled(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    rest = [c for c in df.columns if c not in columns]
    return df.select(
        *rest, *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in columns]
    )


def robust_scale(
    df: DataFrame, lower: float = 0.001, upper: float = 0.999, kept: Sequence[str] = KEPT
) -> DataFrame:
    """(x − median) / (q_upper − q_lower) with exact quantiles, NULL read as 0.

    A quantile range of zero counts as one.
    """
    columns = _features(df, kept)
    # Read by each pass behind the quantiles and again below.
    filled = write_out(_filled(df, columns), "filled")
    quantiles = exact_quantiles(filled, columns, [lower, 0.5, upper])
    scaled = []
    for c in columns:
        low, middle, high = (q if q is not None else 0.0 for q in quantiles[c])
        width = (high - low) or 1.0
        scaled.append(((F.col(c) - F.lit(middle)) / F.lit(width)).alias(c))
    return filled.select(*[c for c in df.columns if c in kept], *scaled)


def robust_scale_sketch(
    df: DataFrame, lower: float = 0.001, upper: float = 0.999, kept: Sequence[str] = KEPT
) -> DataFrame:
    """The same from quantile sketches: one pass, ranks right to a hundredth of the outer shares."""
    columns = _features(df, kept)
    vectors = VectorAssembler(inputCols=columns, outputCol="_raw").transform(_filled(df, columns))
    scaler = RobustScaler(
        lower=lower, upper=upper, withCentering=True, inputCol="_raw", outputCol="_scaled",
        relativeError=min(lower, 1.0 - upper) / 100.0,
    )
    scaled = scaler.fit(vectors).transform(vectors).withColumn("_a", vector_to_array("_scaled"))
    return scaled.select(
        *[c for c in df.columns if c in kept],
        *[F.col("_a")[i].alias(c) for i, c in enumerate(columns)],
    )


def reduce_dimension(df: DataFrame, kept: Sequence[str] = KEPT, share: float = 0.5) -> DataFrame:
    """Principal components of the robustly scaled features, keys kept.

    Keeps ``share`` of all columns, keys included, rounded down. MLlib does not
    centre when it transforms, so the features are centred here.
    """
    columns = _features(df, kept)
    k = min(int(len(df.columns) * share), len(columns))
    scaled = robust_scale(df, kept=kept)
    means = scaled.agg(*[F.avg(c).alias(c) for c in columns]).first()
    centred = scaled.select(
        *[c for c in df.columns if c in kept],
        *[(F.col(c) - F.lit(means[c] if means[c] is not None else 0.0)).alias(c) for c in columns],
    )
    vectors = VectorAssembler(inputCols=columns, outputCol="_raw").transform(centred)
    model = PCA(k=k, inputCol="_raw", outputCol="_pc").fit(vectors)
    reduced = model.transform(vectors).withColumn("_a", vector_to_array("_pc"))
    return reduced.select(
        *[c for c in df.columns if c in kept], *[F.col("_a")[i].alias(f"pc{i}") for i in range(k)]
    )


def plane_angles(width: int, seed: int = 0, rounds: int = 2) -> list[list[float]]:
    """Angles of the plane rotations of each round, one for each pair of positions."""
    rng = random.Random(seed)
    return [[rng.uniform(0.0, 2.0 * math.pi) for _ in range(width // 2)] for _ in range(rounds)]


def rotate_vectors(df: DataFrame, vector: str, angles: Sequence[Sequence[float]]) -> DataFrame:
    """Rotate every vector: each round turns pairs of positions by its angles.

    A round pairs position i with i + width // 2, then moves all positions on by
    one, so the next round pairs others. Lengths and angles between vectors stay.
    NULL vectors stay NULL; positions without a partner are only moved.
    """
    out = df.withColumn(vector, F.col(vector).cast("array<double>"))
    for planes in angles:
        cosines = F.array(*[F.lit(math.cos(a)) for a in planes])
        sines = F.array(*[F.lit(math.sin(a)) for a in planes])
        # A column for each round: its cells refer to the vector of the round before.
        out = out.withColumn(vector, _turned(F.col(vector), cosines, sines, len(planes)))
        out = out.withColumn(vector, F.concat(F.slice(vector, 2, F.greatest(F.size(vector) - 1, F.lit(0))), F.slice(vector, 1, 1)))
    return out


def _turned(v: Column, cosines: Column, sines: Column, half: int) -> Column:
    def cell(x: Column, i: Column) -> Column:
        low = x * F.get(cosines, i) - F.get(v, i + half) * F.get(sines, i)
        high = F.get(v, i - half) * F.get(sines, i - half) + x * F.get(cosines, i - half)
        return F.when(i < half, low).when(i < 2 * half, high).otherwise(x)

    return F.transform(v, cell)
