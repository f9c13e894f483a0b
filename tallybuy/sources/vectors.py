"""Readers and shapers for embedding tables and feature dictionaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybuy.operators.joins import lookup


def parse_vector_lines(lines: DataFrame) -> DataFrame:
    """``X<id> v1 … vn `` lines to ``(id, vector)``.

    The first token loses its leading letter; the empty token after the
    trailing blank is dropped.
    """
    tokens = F.split("value", " ")
    return lines.where(F.col("value") != "").select(
        F.expr("cast(substr(element_at(split(value, ' '), 1), 2) as bigint)").alias("id"),
        F.transform(F.slice(tokens, 2, F.size(tokens) - 2), lambda t: t.cast("double")).alias(
            "vector"
        ),
    )


def read_vector_text(spark: SparkSession, path: str) -> DataFrame:
    return parse_vector_lines(spark.read.text(path))


def spread_vector(
    df: DataFrame, key: str, vector: str, width: int, prefix: str, suffix: str = ""
) -> DataFrame:
    """One double column per vector position: ``<prefix>0 … <prefix>n``."""
    return df.select(
        key,
        *[F.col(vector)[i].cast("double").alias(f"{prefix}{i}{suffix}") for i in range(width)],
    )


def vector_width(df: DataFrame, vector: str) -> int:
    """Length of the vectors, from one row."""
    row = df.select(F.size(vector).alias("w")).first()
    return row["w"] if row else 0


def entity_columns(
    bundle: DataFrame, entity: str, width: int | None = None, prefix: str = "DHNE"
) -> DataFrame:
    """Vectors of one entity type of a bundle as a keyed wide frame."""
    own = bundle.where(F.col("entity") == entity)
    n = vector_width(own, "embedding") if width is None else width
    return spread_vector(own, "id", "embedding", n, prefix).withColumnRenamed("id", entity)


def attribute_columns(profile: DataFrame, bundle: DataFrame, width: int | None = None) -> DataFrame:
    """Profile rows with the vectors of the user, the age range and the gender."""
    n = vector_width(bundle, "embedding") if width is None else width
    user = entity_columns(bundle, "user_id", n, "DHNE_id")
    age = entity_columns(bundle, "age_range", n, "DHNE_age")
    gender = entity_columns(bundle, "gender", n, "DHNE_gender")
    named = lookup(profile, user, ["user_id"])
    return lookup(lookup(named, age, ["age_range"]), gender, ["gender"])


def dictionary_columns(features: DataFrame, key: str, width: int | None = None) -> DataFrame:
    """``(key, array)`` dictionary to columns ``0_dic … n_dic``."""
    n = vector_width(features, "vector") if width is None else width
    return spread_vector(features, key, "vector", n, "", "_dic")


def resolve_vectors(mapping: DataFrame, vectors: DataFrame, key: str) -> DataFrame:
    """``raw_id → dense_id`` joined with ``dense_id → vector``, keyed by raw id."""
    return lookup(mapping, vectors, ["dense_id"], "inner").select(F.col("raw_id").alias(key), "vector")
