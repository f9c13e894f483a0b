"""Counts, ratios, promotion loyalty and repeat buying per entity."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybuy import schemas
from tallybuy.functions.columns import PromoCalendar, count_when, ratio

COUNTS = (
    "all_count",
    "un_de_all_count",
    "cart_count",
    "click_count",
    "buy_count",
    "like_count",
    "de_buy_count",
    "0_un_de_count",
    "1_un_de_count",
    "2_un_de_count",
)


def count_expressions(calendar: PromoCalendar, strict_names: bool = True) -> dict[str, Column]:
    """The ten conditional counts, all for one pass over the log.

    ``strict_names`` keeps promotion rows out of the ``*_un_de_count`` columns,
    as the name says; without it they count every row of the action.
    """
    action, item = F.col("action_type"), F.col("item_id")
    promo = calendar.is_promo(F.col("time_stamp"))
    out = {
        "all_count": F.count(item),
        "un_de_all_count": count_when(~promo, item),
        "cart_count": count_when(action == schemas.CART, item),
        "click_count": count_when(action == schemas.CLICK, item),
        "buy_count": count_when(action == schemas.BUY, item),
        "like_count": count_when(action == schemas.LIKE, item),
        "de_buy_count": count_when((action == schemas.BUY) & promo, item),
    }
    for a in (schemas.CLICK, schemas.CART, schemas.BUY):
        rows = (action == a) & ~promo if strict_names else action == a
        out[f"{a}_un_de_count"] = count_when(rows, item)
    return out


def ratio_expressions() -> dict[str, Column]:
    whole = F.col("all_count")
    out = {
        f"{name}_ratio": ratio(F.col(f"{name}_count"), whole)
        for name in ("buy", "click", "cart", "like", "de_buy")
    }
    for a in (schemas.CLICK, schemas.CART, schemas.BUY):
        out[f"{a}_un_de_ratio"] = ratio(F.col(f"{a}_un_de_count"), F.col("un_de_all_count"))
    return out


def _named(expressions: dict[str, Column]) -> list[Column]:
    return [e.alias(n) for n, e in expressions.items()]


def action_counts(
    log: DataFrame, keys: Sequence[str], calendar: PromoCalendar, strict_names: bool = True
) -> DataFrame:
    return log.groupBy(*keys).agg(*_named(count_expressions(calendar, strict_names)))


def with_ratios(counts: DataFrame) -> DataFrame:
    return counts.select("*", *_named(ratio_expressions()))


def key_ratios(
    log: DataFrame, keys: Sequence[str], calendar: PromoCalendar, strict_names: bool = True
) -> DataFrame:
    """Counts and ratios per key, e.g. per (user, seller)."""
    return with_ratios(action_counts(log, keys, calendar, strict_names))


def promo_loyalty(buys: DataFrame, key: str, other: str, calendar: PromoCalendar) -> DataFrame:
    """Counterparties bought from on promotion, and those also bought from off it."""
    promo = calendar.is_promo(F.col("time_stamp"))
    seen = buys.groupBy(key, other).agg(
        F.max(promo).alias("on_promo"), F.max(~promo).alias("off_promo")
    )
    return seen.groupBy(key).agg(
        F.count_if(F.col("on_promo") & F.col("off_promo")).alias("old_buy_count_on_de"),
        F.count_if("on_promo").alias("all_x_on_de"),
    )


def repeat_counts(buys: DataFrame, key: str, other: str) -> DataFrame:
    """Counterparties bought from more than once, and all counterparties."""
    seen = buys.groupBy(key, other).agg(F.count("item_id").alias("n"))
    return seen.groupBy(key).agg(
        F.count_if(F.col("n") > 1).alias("more_than_once_number"),
        F.count(F.lit(1)).alias("all_x_count"),
    )


def counts_met(
    log: DataFrame, key: str, other: str, calendar: PromoCalendar, strict_names: bool = True
) -> DataFrame:
    """Counts per entity and counterparty bought from; the entity's other actions in one row.

    Only buys tell counterparties apart. Most pairs meet once, so counts of all of
    them would be as many rows as the log has.
    """
    promo = calendar.is_promo(F.col("time_stamp"))
    buy = F.col("action_type") == schemas.BUY
    return log.groupBy(key, buy.alias("_buy"), F.when(buy, F.col(other)).alias("_other")).agg(
        *_named(count_expressions(calendar, strict_names)),
        F.count_if(buy & promo).alias("_promo_buys"),
        F.count_if(buy & ~promo).alias("_other_buys"),
    )


def entity_ratios(
    log: DataFrame, key: str, other: str, calendar: PromoCalendar, strict_names: bool = True
) -> DataFrame:
    """Ratio table of an entity with its loyalty and repeat features.

    The log is read once: see :func:`counts_met` for its first step; then both
    the plain sums and the counterparty features come from those counts.
    """
    met = counts_met(log, key, other, calendar, strict_names)
    on_promo, off = F.col("_promo_buys") > 0, F.col("_other_buys") > 0
    totals = met.groupBy(key).agg(
        *[F.sum(c).alias(c) for c in COUNTS],
        F.count_if(on_promo & off).alias("old_buy_count_on_de"),
        F.count_if(on_promo).alias("all_x_on_de"),
        F.count_if(F.col("buy_count") > 1).alias("more_than_once_number"),
        F.count_if(on_promo | off).alias("all_x_count"),
    )
    return with_ratios(totals).select(
        "*",
        ratio(F.col("old_buy_count_on_de"), F.col("all_x_on_de")).alias("old_x_buy_on_de"),
        ratio(F.col("more_than_once_number"), F.col("all_x_count")).alias("more_than_once_ratio"),
    )
