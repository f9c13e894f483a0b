"""Ratio tables and their parts."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallybuy import schemas
from tallybuy.operators import ratios
from tallybuy.operators.keys import with_action
from tallybuy.operators.population import restrict_to
from tallybuy.plans.catalogue import query
from tallybuy.plans.sql import over
from tallybuy.sources.files import rounded_matrix
from tallybuy.sources.fixtures import CALENDAR

_PROMO = "time_stamp BETWEEN 1101 AND 1130"


def _count_sql(strict: bool = True) -> str:
    off = f"AND NOT {_PROMO}" if strict else ""
    lines = [
        "count(item_id) AS all_count",
        f"count(item_id) FILTER (WHERE NOT {_PROMO}) AS un_de_all_count",
        "count(item_id) FILTER (WHERE action_type = 1) AS cart_count",
        "count(item_id) FILTER (WHERE action_type = 0) AS click_count",
        "count(item_id) FILTER (WHERE action_type = 2) AS buy_count",
        "count(item_id) FILTER (WHERE action_type = 3) AS like_count",
        f"count(item_id) FILTER (WHERE action_type = 2 AND {_PROMO}) AS de_buy_count",
    ]
    lines += [
        f'count(item_id) FILTER (WHERE action_type = {a} {off}) AS "{a}_un_de_count"' for a in (0, 1, 2)
    ]
    return ", ".join(lines)


def _ratio_sql(places: bool = True) -> str:
    def r(a: str, b: str, name: str) -> str:
        return f'round({a} / CAST(nullif({b}, 0) AS DOUBLE), 4) AS "{name}"'

    lines = [r(f"{n}_count", "all_count", f"{n}_ratio") for n in ("buy", "click", "cart", "like", "de_buy")]
    lines += [r(f'"{a}_un_de_count"', "un_de_all_count", f"{a}_un_de_ratio") for a in (0, 1, 2)]
    return ", ".join(lines)


def _plain_sql(keys: str, strict: bool = True) -> str:
    using = " AND ".join(f"l.{k} = p.{k}" for k in keys.split(", "))
    return over(
        "acts", "pairs",
        kept=f"SELECT * FROM acts l WHERE EXISTS (SELECT 1 FROM pairs p WHERE {using})",
        counts=f"SELECT {keys}, {_count_sql(strict)} FROM kept GROUP BY {keys}",
        body=f"SELECT *, {_ratio_sql()} FROM counts",
    )


def _entity_sql(key: str, other: str, strict: bool = True) -> str:
    return over(
        "acts", "pairs",
        kept=f"SELECT * FROM acts WHERE {key} IN (SELECT {key} FROM pairs)",
        counts=f"SELECT {key}, {_count_sql(strict)} FROM kept GROUP BY {key}",
        met=f"""SELECT {key}, {other}, count(item_id) AS n, bool_or({_PROMO}) AS on_promo,
                bool_or(NOT {_PROMO}) AS off_promo FROM kept WHERE action_type = 2 GROUP BY {key}, {other}""",
        extra=f"""SELECT {key}, count(*) FILTER (WHERE on_promo AND off_promo) AS old_buy_count_on_de,
                  count(*) FILTER (WHERE on_promo) AS all_x_on_de,
                  count(*) FILTER (WHERE n > 1) AS more_than_once_number,
                  count(*) AS all_x_count FROM met GROUP BY {key}""",
        body=f"""
            SELECT c.*, {_ratio_sql()},
                   coalesce(old_buy_count_on_de, 0) AS old_buy_count_on_de,
                   coalesce(all_x_on_de, 0) AS all_x_on_de,
                   coalesce(more_than_once_number, 0) AS more_than_once_number,
                   coalesce(all_x_count, 0) AS all_x_count,
                   round(old_buy_count_on_de / CAST(nullif(all_x_on_de, 0) AS DOUBLE), 4) AS old_x_buy_on_de,
                   round(more_than_once_number / CAST(nullif(all_x_count, 0) AS DOUBLE), 4) AS more_than_once_ratio
            FROM counts c LEFT JOIN extra e ON c.{key} = e.{key}""",
    )


def user_ratio(fx, strict: bool = True):
    kept = restrict_to(fx.log(), fx.any_pairs(), "user_id")
    return ratios.entity_ratios(kept, "user_id", "seller_id", CALENDAR, strict)


def seller_ratio(fx):
    kept = restrict_to(fx.log(), fx.any_pairs(), "seller_id")
    return ratios.entity_ratios(kept, "seller_id", "user_id", CALENDAR)


def user_seller_ratio(fx):
    kept = restrict_to(fx.log(), fx.any_pairs())
    return ratios.key_ratios(kept, ["user_id", "seller_id"], CALENDAR)


@query("user_ratio", _entity_sql("user_id", "seller_id"))
def _user_ratio(fx):
    return rounded_matrix(user_ratio(fx), ["user_id"])


@query("user_ratio_literal", _entity_sql("user_id", "seller_id", strict=False))
def _user_ratio_literal(fx):
    return rounded_matrix(user_ratio(fx, strict=False), ["user_id"])


@query("seller_ratio", _entity_sql("seller_id", "user_id"))
def _seller_ratio(fx):
    return rounded_matrix(seller_ratio(fx), ["seller_id"])


@query("user_seller_ratio", _plain_sql("user_id, seller_id"))
def _user_seller_ratio(fx):
    return rounded_matrix(user_seller_ratio(fx), ["user_id", "seller_id"])


@query(
    "action_counts",
    over("acts", body=f"SELECT user_id, {_count_sql()} FROM acts GROUP BY user_id"),
)
def _action_counts(fx):
    return ratios.action_counts(fx.log(), ["user_id"], CALENDAR)


@query(
    "promo_loyalty",
    over(
        "acts",
        met=f"""SELECT seller_id, user_id, bool_or({_PROMO}) AS on_promo, bool_or(NOT {_PROMO}) AS off_promo
                FROM acts WHERE action_type = 2 GROUP BY ALL""",
        body="""SELECT seller_id, count(*) FILTER (WHERE on_promo AND off_promo) AS old_buy_count_on_de,
                count(*) FILTER (WHERE on_promo) AS all_x_on_de FROM met GROUP BY seller_id""",
    ),
)
def _promo_loyalty(fx):
    return ratios.promo_loyalty(with_action(fx.log(), schemas.BUY), "seller_id", "user_id", CALENDAR)


@query(
    "repeat_counts",
    over(
        "acts",
        met="SELECT seller_id, user_id, count(item_id) AS n FROM acts WHERE action_type = 2 GROUP BY ALL",
        body="""SELECT seller_id, count(*) FILTER (WHERE n > 1) AS more_than_once_number,
                count(*) AS all_x_count FROM met GROUP BY seller_id""",
    ),
)
def _repeat_counts(fx):
    return ratios.repeat_counts(with_action(fx.log(), schemas.BUY), "seller_id", "user_id")


@query(
    "item_count",
    over("acts", body="SELECT brand_id, count(item_id) AS all_count FROM acts GROUP BY brand_id"),
)
def _item_count(fx):
    return fx.log().groupBy("brand_id").agg(F.count("item_id").alias("all_count"))
