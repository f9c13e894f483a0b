"""Counts, summaries, shares and per-key profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallybuy import schemas
from tallybuy.functions.columns import epoch_micros
from tallybuy.operators import profiles
from tallybuy.operators.assembly import attach_parent
from tallybuy.operators.keys import with_action
from tallybuy.plans.catalogue import query
from tallybuy.plans.sql import over
from tallybuy.sources.files import rounded_matrix

_EXTREME = (0.25, 0.5, 0.75, 0.99, 0.999, 0.9999, 0.99999, 0.999999)


def _buys(fx):
    return with_action(fx.log(), schemas.BUY)


@query(
    "buy_counts",
    over(
        "acts",
        body="SELECT user_id, seller_id, count(*) AS counts FROM acts WHERE action_type = 2 GROUP BY ALL",
    ),
)
def _buy_counts(fx):
    return profiles.rows_per(_buys(fx), ["user_id", "seller_id"], "counts")


@query(
    "edge_weights",
    over(
        "acts",
        body="SELECT brand_id, seller_id, count(*) AS weight FROM acts WHERE action_type = 0 GROUP BY ALL",
    ),
)
def _edge_weights(fx):
    clicks = with_action(fx.log(), schemas.CLICK)
    return profiles.rows_per(clicks, ["brand_id", "seller_id"], "weight")


@query("actions_per_user", "SELECT user_id, count(*) AS count FROM events GROUP BY user_id")
def _actions_per_user(fx):
    return profiles.rows_per(fx.table("events"), ["user_id"])


_COLUMNS = ["user_id", "item_id", "cat_id", "seller_id", "brand_id"]


@query(
    "cardinalities",
    over(
        "acts",
        body=" UNION ALL ".join(
            f"""SELECT '{c}' AS "column", count(DISTINCT {c}) AS n_distinct FROM acts""" for c in _COLUMNS
        ),
    ),
)
def _cardinalities(fx):
    return profiles.cardinalities(fx.log(), _COLUMNS)


def _summary_sql(where: str = "") -> str:
    names = ["p25", "p50", "p75", "p99", "p99_9", "p99_99", "p99_999", "p99_9999"]
    at = ", ".join(
        f"round(quantile_cont(count, {p}), 4) AS {n}" for p, n in zip(_EXTREME, names)
    )
    return over(
        "acts",
        per_user=f"""SELECT user_id, count(*) AS count FROM acts WHERE action_type = 2
                     GROUP BY user_id {where}""",
        body=f"""SELECT count(*) AS n, round(avg(count), 4) AS mean, round(stddev_samp(count), 4) AS std,
                 min(count) AS min, {at}, max(count) AS max FROM per_user""",
    )


@query("count_summary", _summary_sql())
def _count_summary(fx):
    per_user = profiles.rows_per(_buys(fx), ["user_id"])
    return rounded_matrix(profiles.count_summary(per_user, percentiles=_EXTREME), [])


@query("count_summary_light", _summary_sql("HAVING count(*) < 4"))
def _count_summary_light(fx):
    per_user = profiles.rows_per(_buys(fx), ["user_id"]).where(F.col("count") < 4)
    return rounded_matrix(profiles.count_summary(per_user, percentiles=_EXTREME), [])


@query(
    "count_kde",
    over(
        "acts",
        per_user="SELECT user_id, count(*) AS count FROM acts WHERE action_type = 2 GROUP BY user_id",
        size="""SELECT count(*)::DOUBLE AS total, pow(count(*), -0.2) * stddev_samp(count) AS h
                FROM per_user""",
        grid="SELECT CAST(unnest(range(2, 5002, 50)) AS INTEGER) AS x",
        body="""SELECT x, round(sum(exp(-0.5 * ((x - count) / h) * ((x - count) / h)))
                       / any_value(total * h * sqrt(2 * pi())), 4) AS density
                FROM per_user, size, grid GROUP BY x""",
    ),
)
def _count_kde(fx):
    per_user = profiles.rows_per(_buys(fx), ["user_id"])
    return rounded_matrix(profiles.count_density(per_user), ["x"])


@query(
    "buy_matrix_pivot",
    over(
        "acts",
        buys="SELECT user_id, seller_id, count(*) AS counts FROM acts WHERE action_type = 2 GROUP BY ALL",
        users="SELECT user_id, row_number() OVER (ORDER BY user_id) - 1 AS user_index FROM (SELECT DISTINCT user_id FROM buys)",
        sellers="""SELECT seller_id, row_number() OVER (ORDER BY seller_id) - 1 AS seller_index
                   FROM (SELECT DISTINCT seller_id FROM buys)""",
        body="SELECT user_index, seller_index, counts FROM buys JOIN users USING (user_id) JOIN sellers USING (seller_id)",
    ),
)
def _buy_matrix_pivot(fx):
    return profiles.buy_matrix(_buys(fx))


@query(
    "implicit_matrix",
    over(
        "format2",
        body="""SELECT user_id, merchant_id, CAST(max(CASE WHEN label = -1 THEN 1 ELSE 0 END) AS INTEGER) AS value
                FROM format2 GROUP BY ALL""",
    ),
)
def _implicit_matrix(fx):
    return profiles.implicit_matrix(fx.format2())


@query(
    "active_days",
    over(
        "dated_log",
        body="""SELECT user_id, count(DISTINCT event_date) AS operate_days,
                count(DISTINCT event_date) FILTER (WHERE action_type = 2) AS purchase_days
                FROM dated_log GROUP BY user_id""",
    ),
)
def _active_days(fx):
    return profiles.active_days(fx.dated_log(), "user_id", "event_date")


@query(
    "first_seen",
    over("dated_log", body="SELECT seller_id, min(event_date) AS first_seen FROM dated_log GROUP BY seller_id"),
)
def _first_seen(fx):
    return profiles.first_seen(fx.dated_log(), "seller_id", "event_date")


@query(
    "repeat_share",
    over(
        "acts",
        n="SELECT user_id, item_id, count(*) AS n FROM acts GROUP BY ALL",
        body="""SELECT user_id, round(avg(CASE WHEN n > 1 THEN 1.0::DOUBLE ELSE 0.0 END), 4) AS repeat_share
                FROM n GROUP BY user_id""",
    ),
)
def _repeat_share(fx):
    return rounded_matrix(profiles.repeat_share(fx.log(), ["user_id"], "item_id"), ["user_id"])


@query(
    "distinct_share",
    over(
        "acts",
        body="""SELECT user_id, seller_id, count(DISTINCT brand_id) AS n_distinct,
                round(count(DISTINCT brand_id) / count(brand_id)::DOUBLE, 4) AS distinct_share
                FROM acts GROUP BY ALL""",
    ),
)
def _distinct_share(fx):
    keys = ["user_id", "seller_id"]
    return rounded_matrix(profiles.distinct_share(fx.log(), keys, "brand_id"), keys)


@query(
    "user_sequences",
    over(
        "acts",
        n="""SELECT user_id, time_stamp, seller_id, count(*) AS copies FROM acts
             WHERE action_type = 2 GROUP BY ALL""",
        body="""SELECT *, CAST(sum(copies) OVER (PARTITION BY user_id ORDER BY time_stamp, seller_id) AS BIGINT)
                AS last_position FROM n""",
    ),
)
def _user_sequences(fx):
    return profiles.ordered_buys(_buys(fx))


@query(
    "time_since_previous",
    """SELECT user_id, epoch_us(ts) AS at,
       (epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts)) / 1000000.0::DOUBLE AS gap
       FROM events""",
)
def _time_since_previous(fx):
    return profiles.time_since_previous(fx.table("events"), "user_id", epoch_micros(F.col("ts")))


@query(
    "parent_direct",
    over(
        "acts",
        parent="SELECT brand_id, count(*) AS brand_count, count(DISTINCT item_id) AS brand_items FROM acts GROUP BY 1",
        body="""SELECT user_id, seller_id, a.brand_id, brand_count, brand_items
                FROM acts a JOIN parent p ON a.brand_id = p.brand_id""",
    ),
)
def _parent_direct(fx):
    log = fx.log().select("user_id", "seller_id", "brand_id", "item_id")
    items = profiles.rows_per(log, ["brand_id", "item_id"], "n")
    parent = items.groupBy("brand_id").agg(
        F.sum("n").alias("brand_count"), F.count(F.lit(1)).alias("brand_items")
    )
    return attach_parent(log.drop("item_id"), parent, "brand_id")


def _profile_sql(keys: list[str]) -> str:
    k = ", ".join(keys)
    ids = [c for c in ("user_id", "item_id", "cat_id", "seller_id", "brand_id") if c not in keys]
    ctes = {
        "base": f"""SELECT *, date_diff('day', DATE '1970-01-01', event_date) AS d,
                    year(event_date) * 12 + month(event_date) AS m FROM dated_log""",
        "per_day": f"SELECT {k}, d, count(*) AS n FROM base GROUP BY {k}, d",
        "per_month": f"SELECT {k}, m, count(*) AS n FROM base GROUP BY {k}, m",
        "gaps": f"SELECT {k}, d - lag(d) OVER (PARTITION BY {k} ORDER BY d) AS gap FROM base",
        "gap_stats": f"""SELECT {k}, round(avg(gap) * 86400, 4) AS gap_mean,
                         round(stddev_samp(gap) * 86400, 4) AS gap_std FROM gaps GROUP BY {k}""",
    }
    stats = [f'SELECT {k}, count(*) AS "rows" FROM base GROUP BY {k}']
    for name in ("day", "month"):
        out = "daily" if name == "day" else "monthly"
        trend = (
            ", round(CASE WHEN count(DISTINCT d) > 1 THEN regr_slope(n, d) END, 4) AS daily_trend"
            if name == "day" else ""
        )
        stats.append(
            f"""SELECT {k}, count(*) AS {out}_active, round(avg(n), 4) AS {out}_mean, max(n) AS {out}_max,
                min(n) AS {out}_min, round(stddev_samp(n), 4) AS {out}_std,
                round(median(n), 4) AS {out}_median{trend} FROM per_{name} GROUP BY {k}"""
        )
    for c in ids:
        ctes[f"per_{c}"] = f"SELECT {k}, {c}, count(*) AS n FROM base GROUP BY {k}, {c}"
        stats.append(
            f"""SELECT {k}, count(*) AS {c}_unique,
                round(avg(CASE WHEN n > 1 THEN 1.0::DOUBLE ELSE 0.0 END), 4) AS {c}_repeat,
                round(count(*) / sum(n)::DOUBLE, 4) AS {c}_share FROM per_{c} GROUP BY {k}"""
        )
    joined = " ".join(f"JOIN ({s}) USING ({k})" for s in stats)
    return over("dated_log", **ctes, body=f"SELECT * FROM gap_stats {joined}")


def _register_profiles() -> None:
    for name, keys in profiles.PROFILE_KEYS.items():

        def build(fx, keys=keys):
            return rounded_matrix(profiles.key_profile(fx.dated_log(), keys), keys)

        query(f"key_profile_{name}", _profile_sql(keys))(build)


_register_profiles()
