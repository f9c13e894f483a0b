"""Row filters, derived columns, dense ids and one-hot columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybuy import schemas
from tallybuy.functions.columns import PromoCalendar, composite_key, date_of, month_of
from tallybuy.functions.ordering import positions, running_totals
from tallybuy.operators.joins import lookup


def with_action(log: DataFrame, action: int) -> DataFrame:
    return log.where(F.col("action_type") == action)


def with_actions(log: DataFrame, actions: Sequence[int]) -> DataFrame:
    return log.where(F.col("action_type").isin(list(actions)))


def promo_buys(log: DataFrame, calendar: PromoCalendar) -> DataFrame:
    return log.where(calendar.is_promo(F.col("time_stamp")) & (F.col("action_type") == schemas.BUY))


def off_promo(log: DataFrame, calendar: PromoCalendar) -> DataFrame:
    return log.where(~calendar.is_promo(F.col("time_stamp")))


def add_calendar(log: DataFrame, calendar: PromoCalendar, year: int = 2016) -> DataFrame:
    """Month, date and the flag of the stretch before the promotion."""
    ts = F.col("time_stamp")
    return log.select(
        "*",
        month_of(ts).alias("month"),
        date_of(ts, year).alias("date"),
        calendar.is_before_promo(ts).alias("before_pro"),
    )


def add_composite_keys(df: DataFrame) -> DataFrame:
    return df.select(
        "*",
        composite_key(F.col("user_id"), F.col("seller_id")).alias("user_seller"),
        composite_key(F.col("seller_id"), F.col("brand_id")).alias("seller_brand"),
        composite_key(F.col("seller_id"), F.col("cat_id")).alias("seller_catalog"),
    )


def columns_except(df: DataFrame, kept: Sequence[str]) -> list[str]:
    return [c for c in df.columns if c not in kept]


def dense_id_table(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(column, raw_id, dense_id)`` for several id columns from one pass.

    Ids of a column are numbered from 0 in ascending order.
    """
    cells = df.select(*[F.col(c).cast("bigint").alias(c) for c in columns]).unpivot(
        [], list(columns), "column", "raw_id"
    )
    ids = cells.where(F.col("raw_id").isNotNull()).distinct()
    numbered = running_totals(ids, ["column"], ["raw_id"], {"dense_id": F.lit(1).cast("bigint")})
    return numbered.withColumn("dense_id", F.col("dense_id") - 1)


def dense_ids(df: DataFrame, column: str) -> DataFrame:
    """``(raw_id, dense_id)`` of one id column."""
    return dense_id_table(df, [column]).drop("column")


def map_ids(df: DataFrame, mappings: Mapping[str, DataFrame]) -> DataFrame:
    """Replace ids by their dense ids; ids without an entry become NULL."""
    out = df
    for column, mapping in mappings.items():
        pairs = mapping.select(F.col("raw_id").alias(column), F.col("dense_id").alias("_dense"))
        out = lookup(out, pairs, [column]).drop(column).withColumnRenamed("_dense", column)
    return out.select(*df.columns)


def numbered_rows(df: DataFrame, order: Sequence[str] | None = None) -> DataFrame:
    """Unique row ids; consecutive ones if a total order is given."""
    if order is None:
        return df.withColumn("index", F.monotonically_increasing_id())
    return positions(df, order, "index")


def indicator_columns(column: str, domain: Sequence) -> list[Column]:
    return [
        F.coalesce((F.col(column) == F.lit(v)).cast("int"), F.lit(0)).alias(f"{column}_{v}")
        for v in domain
    ]


def one_hot(df: DataFrame, domains: Mapping[str, Sequence]) -> DataFrame:
    """Replace the named columns by 0/1 columns over their domains."""
    rest = [c for c in df.columns if c not in domains]
    flags = [flag for c, values in domains.items() for flag in indicator_columns(c, values)]
    return df.select(*rest, *flags)


def string_domains(df: DataFrame) -> dict[str, list[str]]:
    """Distinct values of every string column; each becomes a column of the encoded frame.

    For columns known to have few values; :mod:`.sparse` takes any number.
    """
    names = [c for c, kind in df.dtypes if kind == "string"]
    return {
        c: [r[0] for r in df.select(c).where(F.col(c).isNotNull()).distinct().orderBy(c).collect()]
        for c in names
    }


def one_hot_strings(df: DataFrame, domains: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """0/1 columns for every string column, next to the original columns."""
    found = string_domains(df) if domains is None else domains
    flags = [flag for c, values in found.items() for flag in indicator_columns(c, values)]
    return df.select("*", *flags)


def top_values(df: DataFrame, column: str, n: int) -> list:
    """The ``n`` most frequent values; equal counts go to the lower value."""
    rows = (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("_n"))
        .orderBy(F.desc("_n"), column)
        .limit(n)
        .collect()
    )
    return [r[column] for r in rows]


def encode_top_values(
    df: DataFrame, columns: Sequence[str], n: int = 10, by_rank: bool = False
) -> DataFrame:
    """Replace categoricals by 0/1 columns of their top values and an unknown flag.

    Columns are named after the value, or after its rank for a schema that does
    not depend on the data.
    """
    out: list[Column | str] = [c for c in df.columns if c not in columns]
    for c in columns:
        values = top_values(df, c, n)
        for rank in range(n if by_rank else len(values)):
            name = f"{c}_top{rank + 1}" if by_rank else f"{c}_is_{values[rank]}"
            flag = (
                F.coalesce((F.col(c) == F.lit(values[rank])).cast("int"), F.lit(0))
                if rank < len(values)
                else F.lit(0)
            )
            out.append(flag.alias(name))
        known = F.col(c).isin(values) if values else F.lit(False)
        out.append((~F.coalesce(known, F.lit(False))).cast("int").alias(f"{c}_unknown"))
    return df.select(*out)
