"""Session settings and the one place where intermediate results are written out."""

from __future__ import annotations

import os
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_ROOT = str(Path(__file__).resolve().parents[1])

# Runtime settings only; everything the cluster decides (shuffle partitions,
# memory, broadcast threshold) is left as it is found.
_RUNTIME_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even if the split costs one more exchange.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

def tune(spark: SparkSession) -> SparkSession:
    """Switch on the adaptive skew handling that the join plans rely on.

    Python workers also get this package on their path, wherever the driver was
    started; where executors don't have its folder, ship it with ``--py-files``.
    """
    for key, value in _RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if _ROOT not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([_ROOT, *paths])
    return spark


def build_session(
    cores: str = "*", shuffle_partitions: int = 8, checkpoint_dir: str | None = None
) -> SparkSession:
    """Local session for tests and the benchmark; one machine, so a relative folder will do."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tallybuy")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.checkpoint.dir", checkpoint_dir or "spark-warehouse/_intermediate")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


def workspace(spark: SparkSession) -> str:
    """Folder for intermediate tables that driver and executors share.

    It is ``spark.checkpoint.dir`` of the session. Where that is unset, a folder
    in the session's warehouse stands in; both lie on a file system that Spark
    itself opens.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_intermediate"


def intermediate_path(spark: SparkSession, name: str) -> str:
    """A new path in the workspace."""
    return f"{workspace(spark)}/{name}-{uuid.uuid4().hex}"


def write_out(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as parquet into the workspace and return the table read back.

    Cuts the lineage at a point several plans start from. The copy is columnar,
    survives lost executors and carries its size, so later joins can decide on
    a broadcast from facts.
    """
    spark = df.sparkSession
    path = intermediate_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_written(df: DataFrame) -> None:
    """Delete the files of a table from :func:`write_out` that nothing will read again."""
    spark = df.sparkSession
    jvm = spark._jvm
    for folder in {name.rsplit("/", 1)[0] for name in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
