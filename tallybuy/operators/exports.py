"""Exports for embedding training: re-indexed sequences and id triples."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybuy.operators.keys import dense_id_table, map_ids
from tallybuy.operators.profiles import cardinalities
from tallybuy.session import write_out

SEQUENCE_IDS = ("user_id", "seller_id", "brand_id", "cat_id")
TRIPLE = ("user_id", "seller_id", "brand_id")


@dataclass(frozen=True)
class SequenceExport:
    log: DataFrame
    profile: DataFrame
    mappings: dict[str, DataFrame]


def reindex(
    df: DataFrame, columns: Sequence[str]
) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Replace ids by dense ids; also returns the mapping of each column."""
    table = write_out(dense_id_table(df, columns), "dense-ids")
    mappings = {c: table.where(F.col("column") == c).drop("column") for c in columns}
    widened = df.select(*[F.col(c).cast("bigint").alias(c) if c in columns else c for c in df.columns])
    return map_ids(widened, mappings), mappings


def sequences(log: DataFrame, profile: DataFrame) -> SequenceExport:
    """Log and profile with dense ids, ordered by user and time.

    Profile users the log does not know have no dense id and get 0.
    """
    dense, mappings = reindex(log.na.fill(0), SEQUENCE_IDS)
    rest = [c for c in dense.columns if c not in ("user_id", "time_stamp")]
    # Range partitions over (user, time, …) keep the order across files and
    # cut a very active user into several of them.
    ordered = dense.orderBy("user_id", "time_stamp", *rest)
    people = map_ids(profile.na.fill(0), {"user_id": mappings["user_id"]})
    people = people.withColumn("user_id", F.coalesce("user_id", F.lit(0).cast("bigint")))
    return SequenceExport(ordered, people.orderBy(*people.columns), mappings)


def triples(rows: DataFrame, dense: bool = False) -> tuple[DataFrame, DataFrame]:
    """(user, seller, brand) rows, raw or dense, and the size of each id set."""
    ids = rows.select(*[F.col(c).cast("bigint").alias(c) for c in TRIPLE]).na.fill(0)
    sizes = cardinalities(ids, TRIPLE)
    return (reindex(ids, TRIPLE)[0] if dense else ids), sizes
