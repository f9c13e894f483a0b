"""Feature selection statistics and decisions over the user ratio frame."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallybuy.operators import correlation, sparse
from tallybuy.operators import selection as sel
from tallybuy.operators.scaling import robust_scale, robust_scale_sketch
from tallybuy.plans.catalogue import CHECK_SQL, query
from tallybuy.plans.ratios import user_ratio
from tallybuy.plans.sql import over
from tallybuy.session import write_out
from tallybuy.sources.files import rounded_matrix

_RATIO_SQL = CHECK_SQL["user_ratio"]

# Columns of the frame in their order; "earlier" in collinear pairs refers to it.
FEATURES = [
    "all_count", "un_de_all_count", "cart_count", "click_count", "buy_count", "like_count",
    "de_buy_count", "0_un_de_count", "1_un_de_count", "2_un_de_count", "old_buy_count_on_de",
    "all_x_on_de", "more_than_once_number", "all_x_count", "buy_ratio", "click_ratio", "cart_ratio",
    "like_ratio", "de_buy_ratio", "0_un_de_ratio", "1_un_de_ratio", "2_un_de_ratio",
    "old_x_buy_on_de", "more_than_once_ratio", "const", "all_null", "mostly_null", "twin", "neg",
]


def selection_frame(fx):
    """User ratios with columns that each selection rule should catch."""
    base = rounded_matrix(user_ratio(fx), ["user_id"])
    buys = F.col("buy_count")
    return base.select(
        "user_id",
        *[F.col(f"`{c}`") for c in FEATURES[:24]],
        F.lit(5).alias("const"),
        F.lit(None).cast("double").alias("all_null"),
        F.when(F.col("user_id") % 200 == 0, buys).alias("mostly_null"),
        (buys * 2 + 1).alias("twin"),
        (-buys).alias("neg"),
    )


_FRAME_SQL = f"""
    SELECT *, CAST(5 AS INTEGER) AS const, CAST(NULL AS DOUBLE) AS all_null,
           CASE WHEN user_id % 200 = 0 THEN buy_count END AS mostly_null,
           buy_count * 2 + 1 AS twin, -buy_count AS neg FROM ({_RATIO_SQL})"""


def _frame(fx):
    # Several passes read it, so it is computed once.
    return write_out(selection_frame(fx), "selection")


def _each(template: str) -> str:
    return " UNION ALL ".join(template.format(c=c) for c in FEATURES)


@query(
    "missing_stats",
    over(
        frame=_FRAME_SQL,
        body=_each(
            """SELECT '{c}' AS feature, round(1 - count("{c}") / count(*)::DOUBLE, 4) AS missing_fraction FROM frame"""
        ),
    ),
)
def _missing_stats(fx):
    return rounded_matrix(sel.missing_fractions(selection_frame(fx), FEATURES), ["feature"])


@query(
    "unique_stats",
    over(
        frame=_FRAME_SQL,
        body=_each("""SELECT '{c}' AS feature, count(DISTINCT "{c}") AS nunique FROM frame"""),
    ),
)
def _unique_stats(fx):
    return sel.distinct_counts(selection_frame(fx), FEATURES)


@query(
    "unique_sketch",
    over(
        "acts",
        body=" UNION ALL ".join(
            f"SELECT '{c}' AS feature, count(DISTINCT {c}) AS nunique, true AS close FROM acts"
            for c in ("user_id", "item_id", "seller_id", "brand_id", "time_stamp")
        ),
    ),
)
def _unique_sketch(fx):
    """Distinct values from sketches kept for each month and merged: within 4 % of the exact counts, five times their error."""
    columns = ["user_id", "item_id", "seller_id", "brand_id", "time_stamp"]
    log = fx.log().withColumn("month", F.floor(F.col("time_stamp") / 100))
    stored = write_out(sel.distinct_sketches(log, columns, ["month"]), "sketches")
    both = sel.merged_distinct(stored).join(sel.distinct_counts(log, columns), "feature")
    close = F.abs(F.col("estimate") - F.col("nunique")) <= 0.04 * F.col("nunique")
    return both.select("feature", "nunique", close.alias("close"))


def _pairs_sql(names: list[str]) -> str:
    """Pairwise complete correlations, written out pair by pair."""
    lines = []
    for j, b in enumerate(names):
        for a in names[:j]:
            lines.append(
                f"""SELECT '{b}' AS feature, '{a}' AS earlier_feature,
                    CASE WHEN stddev_pop(CASE WHEN "{b}" IS NOT NULL THEN "{a}" END) > 0
                          AND stddev_pop(CASE WHEN "{a}" IS NOT NULL THEN "{b}" END) > 0
                         THEN corr(CAST("{a}" AS DOUBLE), CAST("{b}" AS DOUBLE)) END AS r FROM frame"""
            )
    return " UNION ALL ".join(lines)


@query(
    "correlation_pairs",
    over(
        frame=f"SELECT * FROM ({_FRAME_SQL})",
        r=_pairs_sql(FEATURES),
        body="SELECT feature, earlier_feature, round(r, 4) + 0 AS r FROM r",
    ),
)
def _correlation_pairs(fx):
    return rounded_matrix(sel.correlation_pairs(_frame(fx), FEATURES), ["feature", "earlier_feature"])


@query(
    "collinear_pairs",
    over(
        frame=f"SELECT * FROM ({_FRAME_SQL})",
        r=_pairs_sql(FEATURES),
        body="""SELECT feature AS drop_feature, earlier_feature AS corr_feature, round(r, 4) AS corr_value
                FROM r WHERE abs(r) > 0.95""",
    ),
)
def _collinear_pairs(fx):
    pairs = sel.collinear_pairs(_frame(fx), FEATURES, 0.95)
    return rounded_matrix(pairs, ["drop_feature", "corr_feature"])


@query(
    "collinear_drop",
    over(
        frame=f"SELECT * FROM ({_FRAME_SQL})",
        r=_pairs_sql(FEATURES),
        body="SELECT DISTINCT feature AS drop_feature FROM r WHERE abs(r) > 0.95",
    ),
)
def _collinear_drop(fx):
    return sel.collinear_pairs(_frame(fx), FEATURES, 0.95).select("drop_feature").distinct()


_TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]


@query(
    "collinear_onehot",
    over(
        frame="SELECT p_size, p_retailprice, "
        + ", ".join(f"CAST(p_type = '{v}' AS INTEGER) AS p_type_{v}" for v in _TYPES)
        + " FROM part",
        r=_pairs_sql(["p_size", "p_retailprice", *[f"p_type_{v}" for v in _TYPES]]),
        body="SELECT feature, earlier_feature, round(r, 4) + 0 AS r FROM r",
    ),
)
def _collinear_onehot(fx):
    from tallybuy.operators.keys import one_hot_strings

    wide = one_hot_strings(fx.table("part").select("p_size", "p_retailprice", "p_type"))
    names = ["p_size", "p_retailprice", *[f"p_type_{v}" for v in _TYPES]]
    return rounded_matrix(sel.correlation_pairs(wide, names), ["feature", "earlier_feature"])


_STRINGS = ["p_name", "p_brand", "p_type", "size"]
_NUMBERS = ["p_retailprice", "p_size", "price_or_null"]
_SPARSE_OVER = 0.04


def _sparse_sql() -> str:
    """Every pair of values and numbers, from counts of all values."""
    cells = " UNION ALL ".join(
        f"SELECT row, {k} AS place, {c} AS value, '{c}_' || {c} AS feature FROM f WHERE {c} IS NOT NULL" for k, c in enumerate(_STRINGS)
    )
    number = """
        SELECT feature, '{x}' AS earlier_feature,
          (sxy - (SELECT sum({x}) FROM f) * c / (SELECT count({x}) FROM f))
          / (sqrt((SELECT var_pop({x}) * count({x}) FROM f)) * sqrt(c - c * c / (SELECT count({x}) FROM f)::DOUBLE)) AS r
        FROM (SELECT feature, count({x}) AS c, coalesce(sum({x}), 0) AS sxy FROM cells JOIN f USING (row) GROUP BY feature)
        WHERE c > 0 AND c < (SELECT count({x}) FROM f)"""
    dense = f"""SELECT feature, earlier_feature, r FROM ({_pairs_sql(_NUMBERS).replace("FROM frame", "FROM f")})"""
    return f"""
        WITH f AS (SELECT row_number() OVER () AS row, p_name, p_brand, p_type, {_SIZE_SQL} AS size,
                          p_retailprice::DOUBLE AS p_retailprice, p_size::DOUBLE AS p_size,
                          CASE WHEN p_partkey % 3 <> 0 THEN p_retailprice::DOUBLE END AS price_or_null FROM part),
        cells AS ({cells}),
        v AS (SELECT place, value, feature, count(*) AS c FROM cells GROUP BY ALL),
        t AS (SELECT a.feature AS x, b.feature AS y, count(*) AS n FROM cells a JOIN cells b ON a.row = b.row AND a.place < b.place GROUP BY ALL),
        m AS (SELECT count(*)::DOUBLE AS n FROM f),
        p AS (
          SELECT b.feature AS feature, a.feature AS earlier_feature,
            (coalesce(t.n, 0) - a.c * b.c / m.n) / (sqrt(a.c - a.c * a.c / m.n) * sqrt(b.c - b.c * b.c / m.n)) AS r
          FROM v a JOIN v b ON (a.place, a.value) < (b.place, b.value) CROSS JOIN m
          LEFT JOIN t ON t.x = a.feature AND t.y = b.feature WHERE a.c < m.n AND b.c < m.n)
        SELECT feature, earlier_feature, round(r, 4) + 0 AS r
        FROM (SELECT * FROM p UNION ALL {" UNION ALL ".join(number.format(x=x) for x in _NUMBERS)} UNION ALL {dense})
        WHERE abs(r) > {_SPARSE_OVER}"""


_SIZE_SQL = "CASE WHEN p_size > 25 THEN 'large' ELSE 'small' END"


@query("collinear_onehot_sparse", _sparse_sql())
def _collinear_onehot_sparse(fx):
    """0/1 columns of all strings of a table, names among them, against each other and its numbers."""
    rows = fx.table("part").select(
        "p_name", "p_brand", "p_type", F.when(F.col("p_size") > 25, "large").otherwise("small").alias("size"),
        F.col("p_retailprice").cast("double").alias("p_retailprice"), F.col("p_size").cast("double").alias("p_size"),
        F.when(F.col("p_partkey") % 3 != 0, F.col("p_retailprice").cast("double")).alias("price_or_null"),
    )
    return rounded_matrix(
        correlation.sparse_correlations(rows, _NUMBERS, _STRINGS, _SPARSE_OVER), ["feature", "earlier_feature"]
    )


@query(
    "onehot_cells",
    """SELECT p_partkey, 'p_brand_' || p_brand AS feature FROM part WHERE p_brand IS NOT NULL
       UNION ALL SELECT p_partkey, 'p_name_' || p_name FROM part WHERE p_name IS NOT NULL""",
)
def _onehot_cells(fx):
    """The one-hot matrix of two strings in long form, any number of values."""
    return sparse.one_hot_cells(fx.table("part"), ["p_partkey"], ["p_brand", "p_name"]).select("p_partkey", "feature")


@query(
    "removable_one_hot",
    """SELECT (SELECT count(DISTINCT p_brand) + count(DISTINCT p_name) FROM part) AS values,
              (SELECT count(DISTINCT p_brand) + count(DISTINCT p_name) FROM part) AS removable,
              (SELECT 1) AS identified""",
)
def _removable_one_hot(fx):
    """How many 0/1 columns would go over those that were identified as constant."""
    rows = fx.table("part").select("p_partkey", "p_brand", "p_name", F.lit(1).alias("one"))
    selector = sel.FeatureSelector(rows, ["p_partkey"])
    selector.identify_single_unique()
    found = (selector.value_index().count(), selector.removable_one_hot(), len(selector.check_removal()))
    return fx.spark.createDataFrame([found], "values bigint, removable bigint, identified int")


@query(
    "low_importance",
    """WITH i AS (SELECT concat('user_', user_id) AS feature, count(*)::DOUBLE AS importance
                  FROM events GROUP BY user_id),
            s AS (SELECT *, importance / sum(importance) OVER () AS normalized_importance FROM i),
            c AS (SELECT *, sum(normalized_importance) OVER (ORDER BY importance DESC, feature
                            ROWS UNBOUNDED PRECEDING) AS cumulative_importance FROM s)
       SELECT feature, importance, round(normalized_importance, 6) AS normalized_importance,
              round(cumulative_importance, 6) AS cumulative_importance
       FROM c WHERE cumulative_importance > 0.95001""",
)
def _low_importance(fx):
    importances = (
        fx.table("events")
        .groupBy(F.concat(F.lit("user_"), F.col("user_id").cast("string")).alias("feature"))
        .agg(F.count(F.lit(1)).cast("double").alias("importance"))
    )
    shares = ("normalized_importance", "cumulative_importance")
    return sel.low_importance(importances, 0.95001).select(
        "feature", "importance", *[F.round(c, 6).alias(c) for c in shares]
    )


_KEPT_AFTER_REMOVAL = [c for c in FEATURES if c not in ("const", "all_null", "mostly_null")]


@query(
    "removed_columns",
    over(
        frame=_FRAME_SQL,
        body="SELECT user_id, " + ", ".join(f'"{c}"' for c in _KEPT_AFTER_REMOVAL) + " FROM frame",
    ),
)
def _removed_columns(fx):
    selector = sel.FeatureSelector(_frame(fx), ["user_id"])
    selector.identify_missing(0.9)
    selector.identify_single_unique()
    return selector.remove(["missing", "single_unique"])


_SCALED = [c for c in FEATURES if c not in ("all_null", "mostly_null")]


def _scaled_sql() -> str:
    filled = ", ".join(f'coalesce(CAST("{c}" AS DOUBLE), 0) AS "{c}"' for c in _SCALED)
    stats = ", ".join(
        f"""quantile_cont("{c}", 0.001) AS "lo_{c}", quantile_cont("{c}", 0.5) AS "mid_{c}",
            quantile_cont("{c}", 0.999) AS "hi_{c}" """
        for c in _SCALED
    )
    out = ", ".join(
        f"""round(("{c}" - "mid_{c}") / coalesce(nullif("hi_{c}" - "lo_{c}", 0), 1), 4) + 0 AS "{c}" """
        for c in _SCALED
    )
    return over(
        frame=_FRAME_SQL,
        filled=f"SELECT user_id, {filled} FROM frame",
        stats=f"SELECT {stats} FROM filled",
        body=f"SELECT user_id, {out} FROM filled, stats",
    )


@query("robust_scaled", _scaled_sql())
def _robust_scaled(fx):
    frame = _frame(fx).select("user_id", *[F.col(f"`{c}`") for c in _SCALED])
    return rounded_matrix(robust_scale(frame), ["user_id"])


@query("robust_scaled_sketch")
def _robust_scaled_sketch(fx):
    return robust_scale_sketch(_frame(fx).select("user_id", *[F.col(f"`{c}`") for c in _SCALED]))
