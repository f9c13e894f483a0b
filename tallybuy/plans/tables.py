"""Scans, fills, casts, filters, derived columns and exports of tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tallybuy import schemas
from tallybuy.functions.columns import PromoCalendar, date_of, month_of
from tallybuy.operators import exports, keys
from tallybuy.plans.catalogue import query
from tallybuy.plans.sql import over
from tallybuy.sources import tables
from tallybuy.sources.files import edge_lines
from tallybuy.session import workspace
from tallybuy.sources.fixtures import CALENDAR
from tallybuy.operators.profiles import rows_per

_CAP = 5000


def _csv(fx, df, name: str) -> str:
    """A CSV file of a frame: a column too many, and the others in another order."""
    path = f"{workspace(fx.spark)}/{name}-{uuid.uuid4().hex}.csv"
    df.select(F.lit("x").alias("extra"), *reversed(df.columns)).write.option("header", True).csv(path)
    return path


_ALL = "user_id, item_id, cat_id, seller_id, brand_id, time_stamp, action_type"


@query(
    "log_scan",
    over("raw_log", body="SELECT * REPLACE (coalesce(brand_id, 1) AS brand_id) FROM raw_log"),
)
def _log_scan(fx):
    return tables.read_log(fx.spark, _csv(fx, fx.log_raw(), "log"))


@query(
    "log_scan_capped",
    over(
        "raw_log",
        capped=f"SELECT * FROM raw_log ORDER BY {', '.join(c + ' NULLS FIRST' for c in _ALL.split(', '))} LIMIT {_CAP}",
        body="SELECT * REPLACE (coalesce(brand_id, 1) AS brand_id) FROM capped",
    ),
)
def _log_scan_capped(fx):
    return tables.clean_log(tables.row_cap(fx.log_raw(), _CAP))


@query("user_info_scan", over("profile", body="SELECT * FROM profile"))
def _user_info_scan(fx):
    return tables.read_user_info(fx.spark, _csv(fx, fx.user_info_raw(), "user-info"))


@query(
    "profile_repair",
    over(
        "raw_profile",
        body="""SELECT user_id, coalesce(age_range, 2) AS age_range, coalesce(gender, 2) AS gender
                FROM raw_profile""",
    ),
)
def _profile_repair(fx):
    return tables.repair_profile(fx.user_info_raw())


@query("labelled_pair_scan", over("labelled", body="SELECT * FROM labelled"))
def _labelled_pair_scan(fx):
    pairs = fx.labelled().withColumnRenamed("seller_id", "merchant_id")
    return tables.read_labelled_pairs(fx.spark, _csv(fx, pairs, "labelled"))


@query("unlabelled_pair_scan", over("unlabelled", body="SELECT * FROM unlabelled"))
def _unlabelled_pair_scan(fx):
    pairs = fx.unlabelled().withColumnRenamed("seller_id", "merchant_id")
    return tables.read_unlabelled_pairs(fx.spark, _csv(fx, pairs, "unlabelled"))


@query("format2_scan", over("format2", body="SELECT user_id, merchant_id, label FROM format2"))
def _format2_scan(fx):
    profile = fx.user_info_raw().select("user_id", "age_range", "gender")
    return tables.read_format2(fx.spark, _csv(fx, fx.format2().join(profile, "user_id", "left"), "format2"))


@query(
    "constant_fill",
    over(
        "raw_log",
        body="SELECT user_id, item_id, coalesce(brand_id, 0) AS brand_id FROM raw_log",
    ),
)
def _constant_fill(fx):
    return tables.fill_constant(fx.log_raw().select("user_id", "item_id", "brand_id"), 0)


@query(
    "downcast",
    """SELECT c_custkey, CAST(c_acctbal AS FLOAT) AS c_acctbal, CAST(c_nationkey AS BIGINT) AS c_nationkey
       FROM customer""",
)
def _downcast(fx):
    df = fx.table("customer").select("c_custkey", "c_acctbal", "c_nationkey")
    return tables.cast_columns(tables.downcast_doubles(df), {"c_nationkey": "bigint"})


@query(
    "dropped_columns",
    over("acts", body="SELECT * EXCLUDE (item_id, time_stamp) FROM acts"),
)
def _dropped_columns(fx):
    return fx.log().drop("item_id", "time_stamp")


@query("kept_columns", over("acts", body="SELECT user_id, seller_id, brand_id FROM acts"))
def _kept_columns(fx):
    log = fx.log()
    return log.drop(*keys.columns_except(log, exports.TRIPLE))


@query("clicks", over("acts", body="SELECT * FROM acts WHERE action_type = 0"))
def _clicks(fx):
    return keys.with_action(fx.log(), schemas.CLICK)


@query("carts_and_likes", over("acts", body="SELECT * FROM acts WHERE action_type IN (1, 3)"))
def _carts_and_likes(fx):
    return keys.with_actions(fx.log(), [schemas.CART, schemas.LIKE])


@query(
    "promo_buys",
    over("acts", body="SELECT * FROM acts WHERE action_type = 2 AND time_stamp BETWEEN 1101 AND 1130"),
)
def _promo_buys(fx):
    return keys.promo_buys(fx.log(), CALENDAR)


@query(
    "promo_day_buys",
    over("acts", body="SELECT * FROM acts WHERE action_type = 2 AND time_stamp = 1111"),
)
def _promo_day_buys(fx):
    return keys.promo_buys(fx.log(), PromoCalendar())


@query(
    "off_promo_rows",
    over("acts", body="SELECT * FROM acts WHERE time_stamp NOT BETWEEN 1101 AND 1130"),
)
def _off_promo_rows(fx):
    return keys.off_promo(fx.log(), CALENDAR)


@query(
    "calendar_columns",
    over(
        "acts",
        body="""SELECT user_id, item_id, time_stamp, CAST(time_stamp // 100 AS INTEGER) AS month,
                make_date(2016, time_stamp // 100, time_stamp % 100) AS date,
                time_stamp > 1001 AND time_stamp < 1101 AS before_pro FROM acts""",
    ),
)
def _calendar_columns(fx):
    rows = fx.log().select("user_id", "item_id", "time_stamp")
    return keys.add_calendar(rows, CALENDAR)


@query(
    "rows_per_date",
    over(
        "acts",
        body="""SELECT make_date(2016, time_stamp // 100, time_stamp % 100) AS date,
                CAST(time_stamp // 100 AS INTEGER) AS month, count(*) AS n FROM acts GROUP BY ALL""",
    ),
)
def _rows_per_date(fx):
    ts = F.col("time_stamp")
    return (
        fx.log()
        .groupBy(date_of(ts).alias("date"), month_of(ts).alias("month"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


@query(
    "composite_keys",
    over(
        "acts",
        body="""SELECT user_id, seller_id, concat_ws('_', user_id, seller_id) AS user_seller,
                concat_ws('_', seller_id, brand_id) AS seller_brand,
                concat_ws('_', seller_id, cat_id) AS seller_catalog FROM acts""",
    ),
)
def _composite_keys(fx):
    return keys.add_composite_keys(fx.log()).select(
        "user_id", "seller_id", "user_seller", "seller_brand", "seller_catalog"
    )


@query(
    "dense_ids",
    over(
        "acts",
        body="""SELECT seller_id AS raw_id, row_number() OVER (ORDER BY seller_id) - 1 AS dense_id
                FROM (SELECT DISTINCT seller_id FROM acts)""",
    ),
)
def _dense_ids(fx):
    return keys.dense_ids(fx.log(), "seller_id")


@query(
    "mapped_ids",
    over(
        "acts",
        known="SELECT DISTINCT seller_id FROM acts WHERE action_type = 2 AND time_stamp = 1111",
        ids="SELECT seller_id, row_number() OVER (ORDER BY seller_id) - 1 AS dense_id FROM known",
        body="""SELECT user_id, i.dense_id AS seller_id, action_type
                FROM acts a LEFT JOIN ids i ON a.seller_id = i.seller_id""",
    ),
)
def _mapped_ids(fx):
    log = fx.log()
    mapping = keys.dense_ids(keys.promo_buys(log, PromoCalendar()), "seller_id")
    return keys.map_ids(log.select("user_id", "seller_id", "action_type"), {"seller_id": mapping})


@query("numbered_rows", "SELECT event_id, row_number() OVER (ORDER BY ts, event_id) - 1 AS index FROM events")
def _numbered_rows(fx):
    return keys.numbered_rows(fx.table("events").select("ts", "event_id"), ["ts", "event_id"]).drop("ts")


_ONE_HOT_SQL = ", ".join(
    [f"CAST(age_range = {v} AS INTEGER) AS age_range_{v}" for v in range(9)]
    + [f"CAST(gender = {v} AS INTEGER) AS gender_{v}" for v in range(3)]
)


@query("profile_onehot", over("profile", body=f"SELECT user_id, {_ONE_HOT_SQL} FROM profile"))
def _profile_onehot(fx):
    return keys.one_hot(fx.user_info(), {"age_range": range(9), "gender": range(3)})


@query(
    "string_onehot",
    "SELECT p_partkey, p_type, "
    + ", ".join(
        f"CAST(p_type = '{v}' AS INTEGER) AS p_type_{v}"
        for v in ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")
    )
    + " FROM part",
)
def _string_onehot(fx):
    return keys.one_hot_strings(fx.table("part").select("p_partkey", "p_type"))


@query(
    "ordered_log",
    over(
        "acts",
        body="SELECT user_id, time_stamp, seller_id, action_type FROM acts ORDER BY user_id, time_stamp",
    ),
)
def _ordered_log(fx):
    return fx.log().select("user_id", "time_stamp", "seller_id", "action_type").orderBy(
        "user_id", "time_stamp"
    )


@query(
    "users_by_count",
    over(
        "acts",
        body="""SELECT user_id, count(*) AS count FROM acts WHERE action_type = 2
                GROUP BY user_id ORDER BY count, user_id""",
    ),
)
def _users_by_count(fx):
    return rows_per(keys.with_action(fx.log(), schemas.BUY), ["user_id"]).orderBy("count", "user_id")


@query(
    "edge_lines",
    over(
        "acts",
        body="""SELECT concat('u', brand_id, chr(9), 'i', seller_id, chr(9), count(*)) AS value
                FROM acts WHERE action_type = 0 GROUP BY brand_id, seller_id""",
    ),
)
def _edge_lines(fx):
    clicks = keys.with_action(fx.log(), schemas.CLICK)
    return edge_lines(rows_per(clicks, ["brand_id", "seller_id"], "weight"), "brand_id", "seller_id")


def _dense_sql(source: str, column: str) -> str:
    return f"""SELECT {column}, row_number() OVER (ORDER BY {column}) - 1 AS d
               FROM (SELECT DISTINCT {column} FROM {source})"""


@query(
    "sequence_log",
    over(
        "acts",
        u=_dense_sql("acts", "user_id"), s=_dense_sql("acts", "seller_id"),
        b=_dense_sql("acts", "brand_id"), c=_dense_sql("acts", "cat_id"),
        body="""SELECT u.d AS user_id, item_id, c.d AS cat_id, s.d AS seller_id, b.d AS brand_id,
                time_stamp, action_type
                FROM acts a JOIN u USING (user_id) JOIN s USING (seller_id) JOIN b USING (brand_id)
                JOIN c USING (cat_id)""",
    ),
)
def _sequence_log(fx):
    return exports.sequences(fx.log(), fx.user_info()).log


@query(
    "sequence_profile",
    over(
        "acts", "profile",
        u=_dense_sql("acts", "user_id"),
        body="""SELECT coalesce(u.d, 0) AS user_id, age_range, gender
                FROM profile p LEFT JOIN u ON p.user_id = u.user_id""",
    ),
)
def _sequence_profile(fx):
    return exports.sequences(fx.log(), fx.user_info()).profile


@query(
    "triples_raw",
    over("acts", body="SELECT user_id, seller_id, CAST(brand_id AS BIGINT) AS brand_id FROM acts"),
)
def _triples_raw(fx):
    return exports.triples(fx.log())[0]


@query(
    "triples_reindexed",
    over(
        "acts",
        buys="SELECT * FROM acts WHERE action_type = 2",
        u=_dense_sql("buys", "user_id"), s=_dense_sql("buys", "seller_id"), b=_dense_sql("buys", "brand_id"),
        body="""SELECT u.d AS user_id, s.d AS seller_id, b.d AS brand_id FROM buys
                JOIN u USING (user_id) JOIN s USING (seller_id) JOIN b USING (brand_id)""",
    ),
)
def _triples_reindexed(fx):
    return exports.triples(keys.with_action(fx.log(), schemas.BUY), dense=True)[0]


@query(
    "triple_sizes",
    over(
        "acts",
        body="""SELECT 'user_id' AS "column", count(DISTINCT user_id) AS n_distinct FROM acts WHERE action_type = 2
                UNION ALL SELECT 'seller_id', count(DISTINCT seller_id) FROM acts WHERE action_type = 2
                UNION ALL SELECT 'brand_id', count(DISTINCT brand_id) FROM acts WHERE action_type = 2""",
    ),
)
def _triple_sizes(fx):
    return exports.triples(keys.with_action(fx.log(), schemas.BUY))[1]
