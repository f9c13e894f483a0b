"""Aligned feature frames and the feature store joins."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tallybuy.operators import assembly
from tallybuy.operators.profiles import rows_per
from tallybuy.plans.catalogue import CHECK_SQL, query
from tallybuy.plans.populations import population
from tallybuy.plans.ratios import seller_ratio, user_ratio, user_seller_ratio
from tallybuy.plans.sql import over
from tallybuy.sources.files import rounded_matrix
from tallybuy.sources.vectors import dictionary_columns


_WIDTH = 64


def _buyer_stats(fx):
    return (
        fx.log().where("action_type = 2").groupBy("seller_id")
        .agg(F.count(F.lit(1)).alias("buys"), F.max("time_stamp").alias("last_buy"))
    )


def _clicker_stats(fx):
    return (
        fx.log().where("action_type = 0 AND seller_id % 3 <> 0").groupBy("seller_id")
        .agg(F.count(F.lit(1)).alias("clicks"))
    )


_STATS_SQL = {
    "b": """SELECT seller_id, count(*) AS b_buys, max(time_stamp) AS b_last_buy FROM acts
            WHERE action_type = 2 GROUP BY seller_id""",
    "c": """SELECT seller_id, count(*) AS c_clicks FROM acts
            WHERE action_type = 0 AND seller_id % 3 <> 0 GROUP BY seller_id""",
    "e": "SELECT vec_id AS seller_id, "
    + ", ".join(f"round(CAST(embedding[{i + 1}] AS DOUBLE), 4) AS e_{i}_dic" for i in range(_WIDTH))
    + " FROM embeddings",
}


@query(
    "feature_outer_join",
    over(
        "acts", **_STATS_SQL,
        body="SELECT * FROM b FULL JOIN c USING (seller_id) FULL JOIN e USING (seller_id)",
    ),
)
def _feature_outer_join(fx):
    frames = {
        "b": _buyer_stats(fx),
        "c": _clicker_stats(fx),
        "e": dictionary_columns(fx.seller_vectors(), "seller_id", _WIDTH),
    }
    return rounded_matrix(assembly.outer_align(frames, ["seller_id"]), ["seller_id"])


@query(
    "outer_join_filled",
    over(
        "acts", b=_STATS_SQL["b"], c=_STATS_SQL["c"],
        body="""SELECT seller_id, coalesce(b_buys, 0) AS b_buys, coalesce(b_last_buy, 0) AS b_last_buy,
                coalesce(c_clicks, 0) AS c_clicks FROM b FULL JOIN c USING (seller_id)""",
    ),
)
def _outer_join_filled(fx):
    frames = {"b": _buyer_stats(fx), "c": _clicker_stats(fx)}
    return assembly.fill_aligned(frames, ["seller_id"])


@query(
    "assembled_features",
    over(
        "acts", **_STATS_SQL,
        body="SELECT seller_id, b_buys, b_last_buy, c_clicks, "
        + ", ".join(f"CAST(e_{i}_dic AS FLOAT) AS e_{i}_dic" for i in range(_WIDTH))
        + " FROM b FULL JOIN c USING (seller_id) FULL JOIN e USING (seller_id)",
    ),
)
def _assembled_features(fx):
    vectors = rounded_matrix(dictionary_columns(fx.seller_vectors(), "seller_id", _WIDTH), ["seller_id"])
    frames = {
        "b": _buyer_stats(fx).withColumn("constant", F.lit(1)),
        "c": _clicker_stats(fx).withColumn("empty", F.lit(None).cast("double")),
        "e": vectors,
    }
    return assembly.assemble(frames, ["seller_id"])


# (suffix, keys) of the seven feature tables a population row can join.
_STORES = [
    ("c", ["cat_id"]),
    ("m", ["seller_id"]),
    ("b", ["brand_id"]),
    ("u", ["user_id"]),
    ("mu", ["user_id", "seller_id"]),
    ("mc", ["seller_id", "cat_id"]),
    ("md", ["seller_id", "brand_id"]),
]


def _store_sql() -> str:
    joins = []
    for suffix, keys in _STORES:
        k = ", ".join(keys)
        on = " AND ".join(f"p.{c} = {suffix}.{c}" for c in keys)
        joins.append(
            f"LEFT JOIN (SELECT {k}, count(*) AS rows_{suffix} FROM acts GROUP BY {k}) {suffix} ON {on}"
        )
    picked = ", ".join(f"rows_{suffix}" for suffix, _ in _STORES)
    return over(
        "acts", pop=CHECK_SQL["population"], body=f"SELECT p.*, {picked} FROM pop p {' '.join(joins)}"
    )


@query("feature_store_join", _store_sql())
def _feature_store_join(fx):
    fx = fx.stored()
    log = fx.log()
    stores = [(suffix, keys, rows_per(log, keys, "rows")) for suffix, keys in _STORES]
    return assembly.attach_features(population(fx), stores)


@query("bucketed_store_join", _store_sql())
def _bucketed_store_join(fx):
    """The same join from stores in buckets by their keys."""
    fx = fx.stored()
    log, mark = fx.log(), uuid.uuid4().hex
    buckets = int(fx.spark.conf.get("spark.sql.shuffle.partitions"))
    stores = [
        (suffix, keys, assembly.write_bucketed(rows_per(log, keys, "rows"), keys, f"store_{suffix}_{mark}", buckets))
        for suffix, keys in _STORES
    ]
    return assembly.attach_bucketed(population(fx), stores)


def training_frame(fx):
    """Population rows with user, seller and pair ratios.

    ``fx`` should be stored: eight scans of the log come together here.
    """
    stores = [
        ("m", ["seller_id"], seller_ratio(fx)),
        ("u", ["user_id"], user_ratio(fx)),
        ("mu", ["user_id", "seller_id"], user_seller_ratio(fx)),
    ]
    return assembly.attach_features(population(fx), stores)


def _renamed(store: str, *keys: str) -> str:
    """All columns of a feature table, named as they are in the joined frame."""
    return f"SELECT {', '.join(keys)}, COLUMNS(* EXCLUDE ({', '.join(keys)})) AS '\\0_{store}' FROM {store}"


@query(
    "training_frame",
    over(
        pop=CHECK_SQL["population"],
        m=CHECK_SQL["seller_ratio"],
        u=CHECK_SQL["user_ratio"],
        mu=CHECK_SQL["user_seller_ratio"],
        ms=_renamed("m", "seller_id"),
        us=_renamed("u", "user_id"),
        mus=_renamed("mu", "user_id", "seller_id"),
        body="""SELECT pop.*, ms.* EXCLUDE (seller_id), us.* EXCLUDE (user_id), mus.* EXCLUDE (user_id, seller_id)
                FROM pop LEFT JOIN ms ON pop.seller_id = ms.seller_id LEFT JOIN us ON pop.user_id = us.user_id
                LEFT JOIN mus ON pop.user_id = mus.user_id AND pop.seller_id = mus.seller_id""",
    ),
)
def _training_frame(fx):
    frame = training_frame(fx.stored())
    return rounded_matrix(frame, population(fx).columns)
