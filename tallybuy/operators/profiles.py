"""Counts, summaries and per-key profiles of the log."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybuy import schemas
from tallybuy.functions.columns import cells, epoch_days, ratio, spread
from tallybuy.functions.ordering import previous_value, running_totals
from tallybuy.operators.joins import lookup
from tallybuy.operators.keys import dense_ids
from tallybuy.session import write_out

SECONDS_PER_DAY = 86400.0


def rows_per(df: DataFrame, keys: Sequence[str], name: str = "count") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def rows_of_light_users(log: DataFrame, below: int, key: str = "user_id") -> DataFrame:
    """Log rows of users with fewer than ``below`` actions."""
    light = rows_per(log, [key]).where(F.col("count") < below)
    return lookup(log, light.select(key), [key], "left_semi")


def cardinalities(df: DataFrame, columns: Sequence[str], approximate: bool = False) -> DataFrame:
    """``(column, n_distinct)`` for integer columns.

    The exact form counts distinct (column, value) pairs in two steps, so no
    row is multiplied after the first combine.
    """
    if approximate:
        wide = df.agg(*[F.approx_count_distinct(c).alias(c) for c in columns])
        return wide.unpivot([], list(columns), "column", "n_distinct")
    long = df.select(*[F.col(c).cast("bigint").alias(c) for c in columns])
    values = long.unpivot([], list(columns), "column", "value").where(F.col("value").isNotNull())
    return values.distinct().groupBy("column").agg(F.count("value").alias("n_distinct"))


def count_summary(
    counts: DataFrame, column: str = "count", percentiles: Sequence[float] = (0.25, 0.5, 0.75)
) -> DataFrame:
    """One row: count, mean, std, min, percentiles, max of a column of counts.

    ``percentile`` keeps one entry per distinct count. Counts that add up to N
    rows have at most sqrt(2N) distinct values, so its state stays small.
    """
    at = F.percentile(column, F.array(*[F.lit(float(p)) for p in percentiles]))
    names = [f"p{p * 100:.10g}".replace(".", "_") for p in percentiles]
    return counts.agg(
        F.count(column).alias("n"),
        F.avg(column).alias("mean"),
        F.stddev_samp(column).alias("std"),
        F.min(column).alias("min"),
        at.alias("_at"),
        F.max(column).alias("max"),
    ).select("n", "mean", "std", "min", *[F.col("_at")[i].alias(n) for i, n in enumerate(names)], "max")


def count_density(
    counts: DataFrame, column: str = "count", start: int = 2, stop: int = 5002, step: int = 50
) -> DataFrame:
    """Gaussian kernel density of a column of counts on a fixed grid.

    Bandwidth is n^(-1/5) standard deviations. The kernel sum runs over the
    histogram of the counts, not over the users.
    """
    histogram = counts.groupBy(F.col(column).cast("double").alias("v")).agg(
        F.count(F.lit(1)).alias("n")
    )
    # Everything else comes from the histogram, a row for each distinct count; read three times, made once.
    histogram = write_out(histogram, "histogram")
    n, mean = F.sum("n"), F.try_divide(F.sum(F.col("n") * F.col("v")), F.sum("n"))
    total = histogram.where("v IS NOT NULL").agg(n.cast("double").alias("total"), mean.alias("mean"))
    row = total.first()
    spread = histogram.agg(F.sum(F.col("n") * F.pow(F.col("v") - F.lit(row["mean"]), 2.0)).alias("s")).first()["s"]
    enough = row["total"] and row["total"] > 1
    width = row["total"] ** -0.2 * math.sqrt(spread / (row["total"] - 1)) if enough else None
    bandwidth, total = F.lit(width).cast("double"), F.lit(row["total"]).cast("double")
    grid = F.explode(F.sequence(F.lit(start), F.lit(stop - 1), F.lit(step))).alias("x")
    lines = histogram.select("v", "n", bandwidth.alias("h"), total.alias("total"), grid)
    z = (F.col("x") - F.col("v")) / F.col("h")
    scale = F.col("total") * F.col("h") * math.sqrt(2.0 * math.pi)
    return lines.groupBy("x").agg(
        F.sum(F.try_divide(F.col("n") * F.exp(-0.5 * z * z), scale)).alias("density")
    )


def buy_matrix(buys: DataFrame) -> DataFrame:
    """Users × sellers count matrix over dense indices, as (row, column, count); zeros are left out.

    The long form holds any number of sellers.
    """
    counts = rows_per(buys, ["user_id", "seller_id"], "counts")
    for key, index in (("user_id", "user_index"), ("seller_id", "seller_index")):
        ids = dense_ids(counts, key).select(F.col("raw_id").alias(key), F.col("dense_id").alias(index))
        counts = lookup(counts, ids, [key], "inner")
    return counts.select("user_index", "seller_index", "counts")


def implicit_matrix(format2: DataFrame) -> DataFrame:
    """1 for pairs marked -1, 0 for the others."""
    marked = F.when(F.col("label") == -1, 1).otherwise(0)
    return format2.groupBy("user_id", "merchant_id").agg(F.max(marked).alias("value"))


def active_days(log: DataFrame, key: str, day: str) -> DataFrame:
    """Days with any action and days with a buy, per key."""
    buy = F.col("action_type") == schemas.BUY
    days = log.groupBy(key, day).agg(F.max(buy).alias("bought"))
    return days.groupBy(key).agg(
        F.count(F.lit(1)).alias("operate_days"), F.count_if("bought").alias("purchase_days")
    )


def first_seen(log: DataFrame, key: str, day: str) -> DataFrame:
    return log.groupBy(key).agg(F.min(day).alias("first_seen"))


def repeat_share(df: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """Share of the distinct values that occur at least twice."""
    n = rows_per(df.where(F.col(column).isNotNull()), [*keys, column], "n")
    return n.groupBy(*keys).agg(F.avg((F.col("n") > 1).cast("double")).alias("repeat_share"))


def distinct_share(df: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """Distinct values and their share in the non-null rows."""
    n = rows_per(df.where(F.col(column).isNotNull()), [*keys, column], "n")
    return n.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_distinct"),
        ratio(F.count(F.lit(1)), F.sum("n")).alias("distinct_share"),
    )


def ordered_buys(buys: DataFrame) -> DataFrame:
    """Each user's buys numbered in time order.

    Equal rows are merged with their number of copies first, so a rank is the
    position of the row's last copy.
    """
    order = ["time_stamp", "seller_id"]
    merged = rows_per(buys.select("user_id", *order), ["user_id", *order], "copies")
    return running_totals(merged, ["user_id"], order, {"last_position": F.col("copies")})


def time_since_previous(df: DataFrame, key: str, micros: Column) -> DataFrame:
    """Seconds since the previous row of the key, NULL for its first row."""
    timed = df.select(key, micros.alias("at")).withColumn("_row", F.monotonically_increasing_id())
    lagged = previous_value(timed, [key], "at", "_before", ties=["_row"])
    return lagged.select(key, "at", ((F.col("at") - F.col("_before")) / 1_000_000.0).alias("gap"))


def _middle(sorted_values: Column) -> Column:
    """Median of a sorted, non-empty array."""
    size = F.size(sorted_values)
    low = F.element_at(sorted_values, F.floor((size + 1) / 2).cast("int"))
    high = F.element_at(sorted_values, F.floor((size + 2) / 2).cast("int"))
    return (low + high) / 2.0


def _squared_gaps(sorted_days: Column) -> Column:
    """Sum of squared distances between neighbours of a sorted array."""
    later = F.slice(sorted_days, 2, F.size(sorted_days))
    squares = F.zip_with(
        later,
        F.slice(sorted_days, 1, F.size(sorted_days) - 1),
        lambda b, a: (b - a).cast("double") * (b - a).cast("double"),
    )
    return F.aggregate(squares, F.lit(0.0), lambda total, x: total + x)


def _spread_over_time(name: str, n: Column) -> list[Column]:
    return [
        F.count(n).alias(f"{name}_active"),
        F.avg(n).alias(f"{name}_mean"),
        F.max(n).alias(f"{name}_max"),
        F.min(n).alias(f"{name}_min"),
        F.stddev_samp(n).alias(f"{name}_std"),
    ]


def time_profile(log: DataFrame, keys: Sequence[str], date: str = "event_date") -> DataFrame:
    """Daily, monthly, trend and gap features of a key.

    Rows are counted per key and day first. What is then brought together per
    key is one row per day, a number the calendar bounds, so days and months
    share one exchange on the key and the medians can look at whole lists.
    """
    keys = list(keys)
    day, month = epoch_days(F.col(date)), F.year(date) * 12 + F.month(date)
    counted = log.where(F.col(date).isNotNull()).groupBy(*keys, date).agg(
        F.count(F.lit(1)).alias("n")
    )
    days = counted.select(*keys, "n", day.alias("day"), month.alias("month")).repartition(*keys)
    n = F.col("n")
    daily = days.groupBy(*keys).agg(
        F.sum(n).alias("rows"),
        *_spread_over_time("daily", n),
        F.regr_slope(n, F.col("day")).alias("daily_trend"),
        F.collect_list("n").alias("_ns"),
        F.collect_list("day").alias("_days"),
    )
    monthly = (
        days.groupBy(*keys, "month")
        .agg(F.sum(n).alias("n"))
        .groupBy(*keys)
        .agg(*_spread_over_time("monthly", n), F.collect_list("n").alias("_months"))
    )
    days_sorted = F.array_sort("_days")
    span = (F.array_max("_days") - F.array_min("_days")).cast("double")
    gaps = F.col("rows") - 1
    joined = daily.join(monthly, keys)
    return joined.select(
        *[c for c in joined.columns if not c.startswith("_")],
        _middle(F.array_sort("_ns")).alias("daily_median"),
        _middle(F.array_sort("_months")).alias("monthly_median"),
        (ratio(span, gaps) * SECONDS_PER_DAY).alias("gap_mean"),
        (spread(span, _squared_gaps(days_sorted), gaps) * SECONDS_PER_DAY).alias("gap_std"),
    )


def id_profile(log: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct values, repeat share and distinct share of the other id columns.

    One pass: every row becomes (column, value) cells, the cells are counted
    per key, and the counts are folded. Both steps combine before the shuffle.
    """
    keys = list(keys)
    ids = [c for c in ("user_id", "item_id", "cat_id", "seller_id", "brand_id") if c not in keys]
    long = cells(log, keys, ids).where(F.col("value").isNotNull())
    counted = rows_per(long, [*keys, "cell", "value"], "n")
    out = []
    for i, c in enumerate(ids):
        here = F.col("cell") == i
        distinct = F.count_if(here)
        out += [
            distinct.alias(f"{c}_unique"),
            F.avg(F.when(here, (F.col("n") > 1).cast("double"))).alias(f"{c}_repeat"),
            ratio(distinct, F.sum(F.when(here, F.col("n")))).alias(f"{c}_share"),
        ]
    return counted.groupBy(*keys).agg(*out)


#: Rows that one task turns into cells, about: it holds a count for each distinct one.
_PROFILE_ROWS = 1 << 20
#: Logs of so many tasks are read as they lie.
_FEW_TASKS = 1


def key_profile(log: DataFrame, keys: Sequence[str], date: str = "event_date") -> DataFrame:
    """Time and id features of a key; the two halves meet on the key's partitions.

    The log is written once for both. Where it is large its rows are dealt out for the id half, so
    that the counts a task holds don't grow with the log, whatever cuts its files have.
    """
    ids = ("user_id", "item_id", "cat_id", "seller_id", "brand_id")
    log = write_out(log.select(*dict.fromkeys([*keys, *ids, date])), "profile-log")
    tasks = -(-log.count() // _PROFILE_ROWS)
    dealt = log.repartition(tasks) if tasks > _FEW_TASKS else log
    return time_profile(log, keys, date).join(id_profile(dealt, keys), list(keys), "left")


# The seven key sets feature tables are kept for.
PROFILE_KEYS: Mapping[str, list[str]] = {
    "cat": ["cat_id"],
    "seller": ["seller_id"],
    "brand": ["brand_id"],
    "user": ["user_id"],
    "user_seller": ["user_id", "seller_id"],
    "seller_cat": ["seller_id", "cat_id"],
    "seller_brand": ["seller_id", "brand_id"],
}
