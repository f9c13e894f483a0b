"""The named feature sets and their row-level SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallybuy.operators import synthesis as syn
from tallybuy.plans.catalogue import query
from tallybuy.plans.sql import over
from tallybuy.sources.files import rounded_matrix
from tallybuy.sources.fixtures import CALENDAR

_UNRESTRICTED = {"user_seller_buy"}


def _conditions(spec: syn.FeatureSpec) -> dict[str, str]:
    return {
        f"{c}_{str(v).lower()}": f"{c} = {str(v).lower() if isinstance(v, bool) else v}"
        for c, values in spec.conditions.items()
        for v in values
    }


def _filter(condition: str | None) -> str:
    return f" FILTER (WHERE {condition})" if condition else ""


def _sql(spec: syn.FeatureSpec) -> str:
    k = ", ".join(spec.keys)
    same = " AND ".join(f"a.{c} = p.{c}" for c in spec.keys)
    kept = "" if spec.name in _UNRESTRICTED else f"AND EXISTS (SELECT 1 FROM pairs p WHERE {same})"
    cases: dict[str, str | None] = {"": None}
    cases.update({f"_where_{n}": c for n, c in _conditions(spec).items()})
    ctes = {
        "picked": f"""
            SELECT a.*, CAST(a.time_stamp // 100 AS INTEGER) AS month, age_range, gender,
                   make_date(2016, a.time_stamp // 100, a.time_stamp % 100) AS date,
                   a.time_stamp > 1001 AND a.time_stamp < 1101 AS before_pro
            FROM acts a JOIN profile i ON a.user_id = i.user_id
            WHERE action_type IN ({', '.join(map(str, spec.actions))}) {kept}""",
        "rows0": """SELECT *, date_diff('day', DATE '1970-01-01', date) AS d FROM picked""",
    }
    pieces: list[str] = []

    plain = []
    for suffix, c in cases.items():
        if "count" in spec.primitives:
            plain.append(f"count(*){_filter(c)} AS count{suffix}")
        if "nunique" in spec.primitives:
            plain += [
                f"count(DISTINCT {col}){_filter(c)} AS nunique_{col}{suffix}" for col in spec.categoricals
            ]
    pieces.append(f"SELECT {', '.join([k, *plain])} FROM rows0 GROUP BY {k}")

    if "mode" in spec.primitives:
        for col in spec.categoricals:
            for suffix, c in cases.items():
                pieces.append(f"""
                    SELECT {k}, CAST({col} AS BIGINT) AS mode_{col}{suffix} FROM (
                      SELECT {k}, {col}, row_number() OVER (
                        PARTITION BY {k} ORDER BY count(*) DESC, {col}) AS place
                      FROM rows0 WHERE {c or 'true'} GROUP BY {k}, {col}) WHERE place = 1""")

    if "trend" in spec.primitives:
        for suffix, c in cases.items():
            pieces.append(f"""
                SELECT {k}, round(CASE WHEN count(*) > 1 THEN regr_slope(n, d) END, 4) AS daily_trend{suffix}
                FROM (SELECT {k}, d, count(*) AS n FROM rows0 WHERE {c or 'true'} GROUP BY {k}, d)
                GROUP BY {k}""")

    if "time_since_previous" in spec.transforms:
        ctes["gaps"] = f"""SELECT {k}, month, before_pro, time_stamp,
            (d - lag(d) OVER (PARTITION BY {k} ORDER BY d)) * 86400 AS gap FROM rows0"""
        folds = []
        for suffix, c in cases.items():
            if "mean" in spec.primitives:
                folds.append(f"round(avg(gap){_filter(c)}, 4) AS mean_time_since_previous{suffix}")
            if "std" in spec.primitives:
                folds.append(f"round(stddev_samp(gap){_filter(c)}, 4) AS std_time_since_previous{suffix}")
        pieces.append(f"SELECT {k}, {', '.join(folds)} FROM gaps GROUP BY {k}")

    names = {
        "mean": "round(avg({v}){f}, 4)", "std": "round(stddev_samp({v}){f}, 4)", "max": "max({v}){f}",
        "min": "min({v}){f}", "median": "round(median({v}){f}, 4)",
        "trend": "round(CASE WHEN count(DISTINCT d){f} > 1 THEN regr_slope({v}, d){f} END, 4)",
    }
    for p in spec.parents if spec.depth >= 3 else []:
        about, folds = [], []
        if "count" in spec.primitives:
            about.append(f"count(*) AS {p}_count")
            for n, c in _conditions(spec).items():
                about.append(f"count(*){_filter(c)} AS {p}_count_if_{n}")
        if "nunique" in spec.primitives:
            about += [
                f"count(DISTINCT {col}) AS {p}_nunique_{col}" for col in spec.categoricals if col != p
            ]
        if not about:
            continue
        ctes[f"about_{p}"] = f"SELECT {p} AS parent, {', '.join(about)} FROM rows0 GROUP BY {p}"
        for line in about:
            value = line.rsplit(" AS ", 1)[1]
            for suffix, c in cases.items() if value == f"{p}_count" else [("", None)]:
                folds += [
                    text.format(v=value, f=_filter(c)) + f" AS {fold}_{value}{suffix}"
                    for fold, text in names.items()
                    if fold in spec.primitives
                ]
        pieces.append(
            f"""SELECT {k}, {', '.join(folds)} FROM rows0 JOIN about_{p} ON rows0.{p} = about_{p}.parent
                GROUP BY {k}"""
        )
    joined = " ".join(
        f"({text})" if i == 0 else f"LEFT JOIN ({text}) USING ({k})" for i, text in enumerate(pieces)
    )
    return over("acts", "pairs", "profile", **ctes, body=f"SELECT * FROM {joined}")


def prepared(fx, spec: syn.FeatureSpec):
    pairs = None if spec.name in _UNRESTRICTED else fx.any_pairs()
    return syn.prepare(spec, fx.log(), pairs, fx.user_info(), CALENDAR)


def synthesized(fx, name: str):
    spec = syn.SPECS[name]
    return rounded_matrix(syn.synthesize(spec, prepared(fx, spec)), spec.keys)


def _register() -> None:
    for name, spec in syn.SPECS.items():

        def build(fx, name=name):
            return synthesized(fx, name)

        query(f"synth_{name}", _sql(spec))(build)


_register()



def _long_sql(spec: syn.FeatureSpec) -> str:
    """Rows of one spec as cells, values as doubles and without nulls."""
    keys = [c if c in spec.keys else "CAST(NULL AS BIGINT)" for c in ("user_id", "seller_id")]
    features = f"COLUMNS(* EXCLUDE ({', '.join(spec.keys)}))"
    return f"""
        SELECT '{spec.name}' AS spec, {keys[0]} AS user_id, {keys[1]} AS seller_id, feature, value
        FROM (UNPIVOT (SELECT {', '.join(spec.keys)}, CAST({features} AS DOUBLE) FROM ({_sql(spec)}))
              ON COLUMNS(* EXCLUDE ({', '.join(spec.keys)})) INTO NAME feature VALUE value)"""


@query("synth_batch", " UNION ALL ".join(_long_sql(s) for s in syn.SPECS.values()))
def _synth_batch(fx):
    """All named specs at once, as (spec, target, feature, value)."""
    found = syn.synthesize_all(
        list(syn.SPECS.values()), fx.log(), fx.any_pairs(), fx.user_info(), CALENDAR, unrestricted=_UNRESTRICTED
    )
    out = None
    for name, frame in found.items():
        keys = syn.SPECS[name].keys
        doubles = rounded_matrix(frame, keys)
        columns = [c for c in doubles.columns if c not in keys]
        ids = [(F.col(c) if c in keys else F.lit(None)).cast("bigint").alias(c) for c in ("user_id", "seller_id")]
        long = (
            doubles.select(*ids, *[F.col(f"`{c}`").cast("double").alias(c) for c in columns])
            .unpivot(["user_id", "seller_id"], columns, "feature", "value")
            .where(F.col("value").isNotNull())
            .select(F.lit(name).alias("spec"), "user_id", "seller_id", "feature", "value")
        )
        out = long if out is None else out.unionByName(long)
    return out


def _filled_sql(spec: syn.FeatureSpec) -> str:
    counts = f"SELECT count(COLUMNS(* EXCLUDE ({', '.join(spec.keys)}))) FROM ({_sql(spec)})"
    return f"SELECT '{spec.name}' AS spec, feature, n FROM (UNPIVOT ({counts}) ON COLUMNS(*) INTO NAME feature VALUE n)"


@query("feature_listing", " UNION ALL ".join(_filled_sql(s) for s in syn.SPECS.values()))
def _feature_listing(fx):
    """The columns each spec lists before anything is computed, and how many targets have a value there."""
    found = syn.synthesize_all(
        list(syn.SPECS.values()), fx.log(), fx.any_pairs(), fx.user_info(), CALENDAR, unrestricted=_UNRESTRICTED
    )
    out = None
    for name, frame in found.items():
        listed = syn.plan_features(syn.SPECS[name])
        counts = frame.agg(*[F.count(f"`{c}`").alias(c) for c in listed]).unpivot([], listed, "feature", "n")
        counts = counts.select(F.lit(name).alias("spec"), "feature", "n")
        out = counts if out is None else out.unionByName(counts)
    return out


_PREPARED = syn.SPECS["seller_buy_pro_count"]


@query(
    "prepared_log",
    over(
        "acts", "pairs", "profile",
        body="""
        SELECT a.*, CAST(a.time_stamp // 100 AS INTEGER) AS month, age_range, gender,
               make_date(2016, a.time_stamp // 100, a.time_stamp % 100) AS date,
               a.time_stamp > 1001 AND a.time_stamp < 1101 AS before_pro
        FROM acts a JOIN profile i ON a.user_id = i.user_id
        WHERE action_type = 2 AND a.seller_id IN (SELECT seller_id FROM pairs)""",
    ),
)
def _prepared_log(fx):
    return prepared(fx, _PREPARED)


_DEEP = syn.SPECS["seller_fav_count"]


@query(
    "synth_depth4_direct",
    over(
        "acts", "pairs", "profile",
        picked="""SELECT a.user_id, a.seller_id, item_id, action_type,
                         time_stamp > 1001 AND time_stamp < 1101 AS before_pro
                  FROM acts a JOIN profile i ON a.user_id = i.user_id
                  WHERE action_type IN (1, 3) AND a.seller_id IN (SELECT seller_id FROM pairs)""",
        about="""SELECT user_id, count(*) AS user_id_count,
                 count(*) FILTER (WHERE before_pro) AS user_id_count_if_before_pro_true,
                 count(*) FILTER (WHERE NOT before_pro) AS user_id_count_if_before_pro_false,
                 count(*) FILTER (WHERE action_type = 1) AS user_id_count_if_action_type_1,
                 count(*) FILTER (WHERE action_type = 3) AS user_id_count_if_action_type_3
                 FROM picked GROUP BY user_id""",
        body="SELECT p.seller_id, p.item_id, a.* FROM picked p JOIN about a ON p.user_id = a.user_id",
    ),
)
def _synth_depth4_direct(fx):
    rows = prepared(fx, _DEEP).select("user_id", "seller_id", "item_id", "action_type", "before_pro")
    return syn.direct_features(_DEEP, rows, "user_id").drop("action_type", "before_pro")


_MODES = syn.SPECS["seller_buy_mode"]


def _top_sql(column: str, n: int) -> str:
    return f"""SELECT {column} AS v, row_number() OVER (ORDER BY count(*) DESC, {column}) AS place
               FROM modes WHERE {column} IS NOT NULL GROUP BY {column}
               QUALIFY place <= {n}"""


def _mode_cte(column: str) -> str:
    return f"""SELECT seller_id, {column}, row_number() OVER (
                 PARTITION BY seller_id ORDER BY count(*) DESC, {column}) AS place
               FROM acts a JOIN profile i ON a.user_id = i.user_id WHERE action_type = 2
               AND a.seller_id IN (SELECT seller_id FROM pairs) GROUP BY seller_id, {column}"""


@query(
    "mode_topn_encoded",
    over(
        "acts", "pairs", "profile",
        ages=_mode_cte("age_range"),
        genders=_mode_cte("gender"),
        modes="""SELECT a.seller_id, a.age_range AS mode_age_range, g.gender AS mode_gender
                 FROM ages a JOIN genders g ON a.seller_id = g.seller_id
                 WHERE a.place = 1 AND g.place = 1""",
        top_age=_top_sql("mode_age_range", 3),
        top_gender=_top_sql("mode_gender", 3),
        body="SELECT seller_id, "
        + ", ".join(
            f"""CAST(coalesce(mode_{c} = (SELECT v FROM {t} WHERE place = {i}), false) AS INTEGER)
                AS mode_{c}_top{i}"""
            for c, t in (("age_range", "top_age"), ("gender", "top_gender"))
            for i in (1, 2, 3)
        )
        + """, CAST(mode_age_range NOT IN (SELECT v FROM top_age) AS INTEGER) AS mode_age_range_unknown,
               CAST(mode_gender NOT IN (SELECT v FROM top_gender) AS INTEGER) AS mode_gender_unknown
            FROM modes""",
    ),
)
def _mode_topn_encoded(fx):
    narrow = syn.FeatureSpec(
        "seller_modes", "seller_id", (2,), ("mode",), 1, columns=("age_range", "gender")
    )
    features = syn.synthesize(narrow, prepared(fx, narrow))
    return syn.encoded(narrow, features, n=3, by_rank=True)


_SHARES = syn.FeatureSpec(
    "user_seller_buy_shares", "user_seller", (2,), ("count", "nunique", "repeat_share", "distinct_share"),
    1, columns=("cat_id", "brand_id", "time_stamp"),
)


def _share_sql(column: str) -> str:
    return f"""SELECT user_id, seller_id, count(*) AS nunique_{column},
               round(avg(CASE WHEN n > 1 THEN 1.0::DOUBLE ELSE 0.0 END), 4) AS repeat_share_{column},
               round(count(*) / sum(n)::DOUBLE, 4) AS distinct_share_{column}
               FROM (SELECT user_id, seller_id, {column}, count(*) AS n FROM buys GROUP BY ALL)
               GROUP BY user_id, seller_id"""


@query(
    "synth_user_seller_buy_shares",
    over(
        "acts", "profile",
        buys="SELECT a.* FROM acts a JOIN profile p ON a.user_id = p.user_id WHERE action_type = 2",
        body="SELECT * FROM (SELECT user_id, seller_id, count(*) AS count FROM buys GROUP BY ALL) "
        + " ".join(f"JOIN ({_share_sql(c)}) USING (user_id, seller_id)" for c in _SHARES.columns),
    ),
)
def _synth_shares(fx):
    rows = syn.prepare(_SHARES, fx.log(), None, fx.user_info(), CALENDAR)
    return rounded_matrix(syn.synthesize(_SHARES, rows), _SHARES.keys)


@query(
    "top_categories",
    over(
        "acts",
        body="""SELECT brand_id, count(*) AS n FROM acts GROUP BY brand_id
                ORDER BY n DESC, brand_id LIMIT 10""",
    ),
)
def _top_categories(fx):
    counts = fx.log().groupBy("brand_id").agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), "brand_id").limit(10)
