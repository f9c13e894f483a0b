"""Feature files, id dictionaries, score files, exports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybuy import schemas

_MATRIX_DIGITS = 4


def suffix_columns(df: DataFrame, keys: Sequence[str], suffix: str) -> DataFrame:
    return df.select(*keys, *[F.col(f"`{c}`").alias(c + suffix) for c in df.columns if c not in keys])


def read_features(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """Feature matrix whose columns carry the file name as suffix."""
    name = path.rstrip("/").rsplit("/", 1)[-1]
    if ".csv" in name:
        df = spark.read.option("header", True).option("inferSchema", True).csv(path)
    else:
        df = spark.read.parquet(path)
    return suffix_columns(df, keys, "_" + name.split(".")[0])


def read_many_features(
    spark: SparkSession, paths: Sequence[str], keys: Sequence[str]
) -> list[DataFrame]:
    return [read_features(spark, p, keys) for p in paths]


def column_statistics(frames: Mapping[str, DataFrame], keys: Sequence[str]) -> DataFrame:
    """``(file, feature, missing_fraction, single)`` of all columns of all frames, in one job.

    ``single``: the column has one distinct value. NaN counts as missing.
    """
    out: DataFrame | None = None
    for name, df in frames.items():
        kinds = dict(df.dtypes)
        columns = [c for c in df.columns if c not in keys]
        there = {c: F.nanvl(F.col(f"`{c}`"), F.lit(None)) if kinds[c] in ("float", "double") else F.col(f"`{c}`") for c in columns}
        facts = df.agg(
            F.count(F.lit(1)).alias("rows"),
            *[
                F.struct(F.count(e).alias("n"), F.coalesce(F.min(e) == F.max(e), F.lit(False)).alias("single")).alias(f"c{k}")
                for k, e in enumerate(there.values())
            ],
        )
        cells = F.array(
            *[
                F.struct(
                    F.lit(name).alias("file"), F.lit(c).alias("feature"),
                    (1.0 - F.try_divide(F.col(f"c{k}.n"), F.col("rows"))).alias("missing_fraction"), F.col(f"c{k}.single").alias("single"),
                )
                for k, c in enumerate(columns)
            ]
        )
        part = facts.select(F.explode(cells).alias("_c")).select("_c.*") if columns else None
        out = part if out is None else out if part is None else out.unionByName(part)
    return out


def read_pruned_features(
    spark: SparkSession, paths: Sequence[str], keys: Sequence[str], missing: float = 0.99
) -> list[DataFrame]:
    """Feature files without the columns that are mostly missing or have one value in their own file.

    Statistics of all files come from one job, two numbers for each column. The frames then read only the
    columns that are left; parquet files don't open the others again.
    """
    frames = {p: read_features(spark, p, keys) for p in paths}
    facts = column_statistics(frames, keys) if frames else None
    gone: dict[str, set[str]] = {p: set() for p in paths}
    # A file without rows has no fraction and keeps its columns.
    unfit = F.coalesce(F.col("missing_fraction") > missing, F.lit(False)) | F.col("single")
    for r in facts.where(unfit).collect() if facts is not None else ():
        gone[r["file"]].add(r["feature"])
    return [
        df.select(*[F.col(f"`{c}`") for c in df.columns if c not in gone[p]]) for p, df in frames.items()
    ]


def rounded_matrix(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Doubles at four decimals, the precision feature matrices are stored with."""
    kinds = dict(df.dtypes)
    return df.select(
        *[
            F.round(c, _MATRIX_DIGITS).alias(c)
            if c not in keys and kinds[c] in ("double", "float")
            else c
            for c in df.columns
        ]
    )


def write_features(df: DataFrame, path: str, keys: Sequence[str], fmt: str = "parquet") -> None:
    out = rounded_matrix(df, keys).write.mode("overwrite")
    if fmt == "csv":
        out.option("header", True).csv(path)
    else:
        out.parquet(path)


def write_id_mapping(mapping: DataFrame, path: str) -> None:
    mapping.select("raw_id", "dense_id").write.mode("overwrite").parquet(path)


def read_id_mapping(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.ID_MAPPING).parquet(path)


def write_scores(scores: DataFrame, path: str) -> None:
    """One partition per run or model, so a directory holds an ensemble."""
    scores.write.mode("overwrite").partitionBy("run_id").parquet(path)


def _directory() -> Column:
    """Name of the directory a row's file lies in, e.g. ``run_id=3``."""
    return F.element_at(F.split("_metadata.file_path", "/"), -2)


def read_score_files(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Score files of an explicit list, each row with the directory it came from."""
    scores = spark.read.schema(schemas.SCORES).parquet(*paths)
    return scores.select(_directory().alias("source"), "user_id", "seller_id", "prob")


def list_score_files(spark: SparkSession, pattern: str) -> DataFrame:
    """Score directories behind a glob pattern with their row counts."""
    scores = spark.read.schema(schemas.SCORES).parquet(pattern)
    return scores.groupBy(_directory().alias("source")).agg(F.count(F.lit(1)).alias("n_rows"))


def write_blend(blended: DataFrame, path: str) -> None:
    """Blended scores as CSV with sixteen decimals."""
    text = F.format_string("%.16f", F.col("prob"))
    blended.select("user_id", "seller_id", text.alias("prob")).write.mode("overwrite").option(
        "header", True
    ).csv(path)


def edge_lines(edges: DataFrame, src: str, dst: str, weight: str = "weight") -> DataFrame:
    """``u<src> TAB i<dst> TAB <weight>`` lines."""
    return edges.select(
        F.concat_ws(
            "\t",
            F.concat(F.lit("u"), F.col(src).cast("string")),
            F.concat(F.lit("i"), F.col(dst).cast("string")),
            F.col(weight).cast("string"),
        ).alias("value")
    )


def write_edges(edges: DataFrame, src: str, dst: str, path: str) -> None:
    edge_lines(edges, src, dst).write.mode("overwrite").text(path)


def write_snapshot(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
