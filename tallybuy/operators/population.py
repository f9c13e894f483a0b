"""Populations of (user, seller) pairs: restriction, labels, profile, splits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybuy.functions.columns import PromoCalendar
from tallybuy.operators.joins import lookup
from tallybuy.operators.keys import add_composite_keys, promo_buys

PAIR = ("user_id", "seller_id")

ENTITY_KEYS = {
    "user_id": ["user_id"],
    "seller_id": ["seller_id"],
    "user_seller": ["user_id", "seller_id"],
}


def all_pairs(labelled: DataFrame, unlabelled: DataFrame) -> DataFrame:
    """Both pair tables below each other, keys only."""
    return labelled.select(*PAIR).unionByName(unlabelled.select(*PAIR))


def distinct_pairs(labelled: DataFrame, unlabelled: DataFrame) -> DataFrame:
    return all_pairs(labelled, unlabelled).distinct()


def restrict_to(log: DataFrame, pairs: DataFrame, entity: str = "user_seller") -> DataFrame:
    """Log rows whose entity occurs in ``pairs``.

    ``pairs`` need not be distinct.
    """
    keys = ENTITY_KEYS[entity]
    return lookup(log, pairs.select(*keys), keys, "left_semi")


def with_labels(rows: DataFrame, labelled: DataFrame) -> DataFrame:
    return lookup(rows, labelled.select(*PAIR, "label"), PAIR)


def with_profile(rows: DataFrame, profile: DataFrame, how: str = "left") -> DataFrame:
    return lookup(rows, profile, ["user_id"], how)


def population(
    log: DataFrame,
    labelled: DataFrame,
    unlabelled: DataFrame,
    profile: DataFrame,
    calendar: PromoCalendar,
) -> DataFrame:
    """One row per promotion buy of a known pair, with label and profile."""
    buys = promo_buys(log, calendar).drop("time_stamp", "action_type").na.fill(0)
    known = restrict_to(buys, all_pairs(labelled, unlabelled))
    return with_profile(with_labels(add_composite_keys(known), labelled), profile)


def first_per_pair(
    rows: DataFrame,
    order: Sequence[str] = ("item_id", "brand_id", "cat_id"),
    keys: Sequence[str] = PAIR,
) -> DataFrame:
    """First row of each pair in ``order``; the other columns break ties.

    An aggregate over a struct instead of a ranked window: it combines before
    the shuffle, so a pair with very many rows costs one row per task.
    """
    rest = [c for c in rows.columns if c not in keys]
    ranked = [*[c for c in order if c in rest], *[c for c in rest if c not in order]]
    first = rows.groupBy(*keys).agg(F.min(F.struct(*ranked)).alias("_first"))
    return first.select(*keys, *[F.col(f"_first.{c}").alias(c) for c in rest]).select(*rows.columns)


def rows_of(rows: DataFrame, pairs: DataFrame) -> DataFrame:
    return lookup(rows, pairs.select(*PAIR), PAIR, "left_semi")


def rows_outside(rows: DataFrame, pairs: DataFrame) -> DataFrame:
    return lookup(rows, pairs.select(*PAIR), PAIR, "left_anti")


def split_share(salt: str | int = 0, keys: Sequence[str] = PAIR):
    """Number in [0, 1) that depends on the key and the salt alone."""
    text = F.concat_ws("|", *[F.col(k).cast("bigint").cast("string") for k in keys], F.lit(str(salt)))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double") / float(1 << 32)


def mark_split(
    rows: DataFrame, share: float = 0.85, salt: str | int = 0, keep: float | None = None
) -> DataFrame:
    """Add ``part``: train or valid, or train, valid and test.

    ``share`` of the pairs go to train. With ``keep`` the rest is split again,
    by a second hash, into valid and test.
    """
    held_out = F.lit("valid")
    if keep is not None:
        held_out = F.when(split_share(f"{salt}/held-out") < keep, "valid").otherwise("test")
    return rows.withColumn("part", F.when(split_share(salt) < share, "train").otherwise(held_out))


def training_rows(
    features: DataFrame, labelled: DataFrame, share: float = 0.85, salt: str | int = 0,
    keep: float | None = None,
) -> DataFrame:
    """Rows of labelled pairs, one per pair, marked with their part."""
    return mark_split(first_per_pair(rows_of(features, labelled)), share, salt, keep)


def rows_to_score(features: DataFrame, unlabelled: DataFrame) -> DataFrame:
    return first_per_pair(rows_of(features, unlabelled))
