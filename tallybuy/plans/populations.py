"""Pair sets, restrictions, labels, profile joins, splits."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallybuy.operators import population as pop
from tallybuy.operators.profiles import rows_of_light_users
from tallybuy.plans.catalogue import query
from tallybuy.plans.sql import over
from tallybuy.sources.fixtures import CALENDAR

_PROMO_BUYS = """SELECT user_id, item_id, cat_id, seller_id, brand_id FROM acts
                 WHERE action_type = 2 AND time_stamp BETWEEN 1101 AND 1130"""


@query(
    "pair_union_all",
    over(
        "labelled", "unlabelled",
        body="SELECT user_id, seller_id FROM labelled UNION ALL SELECT user_id, seller_id FROM unlabelled",
    ),
)
def _pair_union_all(fx):
    return pop.all_pairs(fx.labelled(), fx.unlabelled())


@query(
    "pair_union",
    over(
        "labelled", "unlabelled",
        body="SELECT user_id, seller_id FROM labelled UNION SELECT user_id, seller_id FROM unlabelled",
    ),
)
def _pair_union(fx):
    return pop.distinct_pairs(fx.labelled(), fx.unlabelled())


@query(
    "log_semi_user",
    over("acts", "pairs", body="SELECT * FROM acts WHERE user_id IN (SELECT user_id FROM pairs)"),
)
def _log_semi_user(fx):
    return pop.restrict_to(fx.log(), fx.any_pairs(), "user_id").select(*fx.log().columns)


@query(
    "log_semi_seller",
    over("acts", "pairs", body="SELECT * FROM acts WHERE seller_id IN (SELECT seller_id FROM pairs)"),
)
def _log_semi_seller(fx):
    return pop.restrict_to(fx.log(), fx.any_pairs(), "seller_id").select(*fx.log().columns)


_SEMI_PAIR = "EXISTS (SELECT 1 FROM pairs p WHERE p.user_id = a.user_id AND p.seller_id = a.seller_id)"


@query("log_semi_pair", over("acts", "pairs", body=f"SELECT * FROM acts a WHERE {_SEMI_PAIR}"))
def _log_semi_pair(fx):
    return pop.restrict_to(fx.log(), fx.any_pairs()).select(*fx.log().columns)


@query(
    "labelled_buys",
    over(
        "acts", "labelled", buys=_PROMO_BUYS,
        body="""SELECT b.*, label FROM buys b LEFT JOIN labelled l
                ON b.user_id = l.user_id AND b.seller_id = l.seller_id""",
    ),
)
def _labelled_buys(fx):
    buys = pop.promo_buys(fx.log(), CALENDAR).drop("time_stamp", "action_type")
    return pop.with_labels(buys, fx.labelled())


@query(
    "profile_left_join",
    over(
        "acts", "profile",
        known="SELECT * FROM profile WHERE user_id % 7 <> 0",
        body="SELECT a.*, age_range, gender FROM acts a LEFT JOIN known k ON a.user_id = k.user_id",
    ),
)
def _profile_left_join(fx):
    known = fx.user_info().where(F.col("user_id") % 7 != 0)
    return pop.with_profile(fx.log(), known)


@query(
    "profile_inner_join",
    over(
        "acts", "profile",
        known="SELECT * FROM profile WHERE user_id % 7 <> 0",
        body="SELECT a.*, age_range, gender FROM acts a JOIN known k ON a.user_id = k.user_id",
    ),
)
def _profile_inner_join(fx):
    known = fx.user_info().where(F.col("user_id") % 7 != 0)
    return pop.with_profile(fx.log(), known, "inner")


@query(
    "light_users_log",
    over(
        "acts",
        body="""SELECT user_id, seller_id, time_stamp, action_type FROM acts WHERE user_id IN
                (SELECT user_id FROM acts GROUP BY user_id HAVING count(*) < 30)""",
    ),
)
def _light_users_log(fx):
    return rows_of_light_users(fx.log().select("user_id", "seller_id", "time_stamp", "action_type"), 30)


@query(
    "population",
    over(
        "acts", "labelled", "pairs", "profile", buys=_PROMO_BUYS,
        body="""
        SELECT b.user_id, b.seller_id, item_id, cat_id, brand_id,
               concat_ws('_', b.user_id, b.seller_id) AS user_seller,
               concat_ws('_', b.seller_id, brand_id) AS seller_brand,
               concat_ws('_', b.seller_id, cat_id) AS seller_catalog, label, age_range, gender
        FROM buys b JOIN pairs p ON b.user_id = p.user_id AND b.seller_id = p.seller_id
        LEFT JOIN labelled l ON b.user_id = l.user_id AND b.seller_id = l.seller_id
        LEFT JOIN profile i ON b.user_id = i.user_id""",
    ),
)
def _population(fx):
    # The log is joined once, for the rows and for the pairs.
    return population(fx.stored())


def population(fx):
    return pop.population(fx.log(), fx.labelled(), fx.unlabelled(), fx.user_info(), CALENDAR)


@query(
    "first_per_pair",
    over(
        "acts", buys=_PROMO_BUYS,
        body="""SELECT user_id, item_id, cat_id, seller_id, brand_id FROM (
                  SELECT *, row_number() OVER (PARTITION BY user_id, seller_id
                                               ORDER BY item_id, brand_id, cat_id) AS rn FROM buys)
                WHERE rn = 1""",
    ),
)
def _first_per_pair(fx):
    return pop.first_per_pair(pop.promo_buys(fx.log(), CALENDAR).drop("time_stamp", "action_type"))


@query(
    "rows_of_unlabelled",
    over(
        "acts", "unlabelled",
        body="""SELECT * FROM acts a WHERE EXISTS (SELECT 1 FROM unlabelled p
                WHERE p.user_id = a.user_id AND p.seller_id = a.seller_id)""",
    ),
)
def _rows_of_unlabelled(fx):
    return pop.rows_of(fx.log(), fx.unlabelled()).select(*fx.log().columns)


@query(
    "rows_outside_unlabelled",
    over(
        "acts", "unlabelled",
        body="""SELECT * FROM acts a WHERE NOT EXISTS (SELECT 1 FROM unlabelled p
                WHERE p.user_id = a.user_id AND p.seller_id = a.seller_id)""",
    ),
)
def _rows_outside_unlabelled(fx):
    return pop.rows_outside(fx.log(), fx.unlabelled()).select(*fx.log().columns)


def _split_sql(salt: str) -> str:
    return f"""('0x' || substr(md5(concat_ws('|', user_id, seller_id, '{salt}')), 1, 8))::BIGINT / 4294967296.0"""


PART_SQL = f"""CASE WHEN {_split_sql('0')} < 0.85 THEN 'train'
               WHEN {_split_sql('0/held-out')} < 0.5 THEN 'valid' ELSE 'test' END"""


@query("split_by_pair", over("labelled", body=f"SELECT *, {PART_SQL} AS part FROM labelled"))
def _split_by_pair(fx):
    return pop.mark_split(fx.labelled(), 0.85, salt=0, keep=0.5)
