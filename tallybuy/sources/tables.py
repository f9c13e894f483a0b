"""Readers for the log, the profile and the pair tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallybuy import schemas
from tallybuy.functions.ordering import positions

# What a missing entry stands for.
LOG_FILL = 1
PROFILE_FILL = {"gender": 2, "age_range": 0}

def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with a header or parquet, by the path's ending; columns go by their names.

    Other columns of the file are dropped; a missing one is an error.
    """
    if ".csv" in path.rsplit("/", 1)[-1]:
        found = spark.read.option("header", True).csv(path)
    else:
        found = spark.read.parquet(path)
    missing = [f.name for f in schema.fields if f.name not in found.columns]
    if missing:
        raise ValueError(f"{path} lacks the columns {missing}")
    return found.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def fill_constant(df: DataFrame, value=LOG_FILL, columns: list[str] | None = None) -> DataFrame:
    """Replace NULL (and NaN) by one constant, in all or in some columns."""
    return df.na.fill(value, subset=columns) if columns else df.na.fill(value)


def cast_columns(df: DataFrame, kinds: Mapping[str, str]) -> DataFrame:
    return df.select(*[F.col(c).cast(kinds[c]).alias(c) if c in kinds else c for c in df.columns])


def downcast_doubles(df: DataFrame) -> DataFrame:
    return cast_columns(df, {c: "float" for c, kind in df.dtypes if kind == "double"})


def clean_log(raw: DataFrame) -> DataFrame:
    filled = fill_constant(raw, LOG_FILL)
    return cast_columns(filled, {"brand_id": "int", "time_stamp": "int"})


def row_cap(df: DataFrame, n: int | None) -> DataFrame:
    """First ``n`` rows in the order of all columns; everything for ``None``."""
    if n is None:
        return df
    # Equal rows are told apart by an arbitrary id, which spreads them over slices.
    told_apart = df.withColumn("_tie", F.monotonically_increasing_id())
    ranked = positions(told_apart, [*df.columns, "_tie"], "_position")
    return ranked.where(F.col("_position") < n).select(*df.columns)


def read_log(spark: SparkSession, path: str, rows: int | None = None) -> DataFrame:
    return clean_log(row_cap(read_table(spark, path, schemas.LOG), rows))


def clean_profile(raw: DataFrame) -> DataFrame:
    return cast_columns(raw.na.fill(PROFILE_FILL), {"age_range": "int", "gender": "int"})


def read_user_info(spark: SparkSession, path: str) -> DataFrame:
    return clean_profile(read_table(spark, path, schemas.USER_INFO))


def repair_profile(raw: DataFrame, value: int = 2) -> DataFrame:
    """Clean-up job for profile files: every missing entry becomes ``value``."""
    return fill_constant(raw, value)


def name_seller(pairs: DataFrame) -> DataFrame:
    return pairs.withColumnRenamed("merchant_id", "seller_id")


def read_labelled_pairs(spark: SparkSession, path: str) -> DataFrame:
    return name_seller(read_table(spark, path, schemas.LABELLED_PAIRS))


def read_unlabelled_pairs(spark: SparkSession, path: str) -> DataFrame:
    return name_seller(read_table(spark, path, schemas.UNLABELLED_PAIRS))


def read_format2(spark: SparkSession, path: str, rows: int | None = None) -> DataFrame:
    return row_cap(
        read_table(spark, path, schemas.FORMAT2).select("user_id", "merchant_id", "label"), rows
    )
