"""Registry of queries: a function of the fixtures, and its check SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallybuy.session import tune
from tallybuy.sources.fixtures import Fixtures

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
CHECK_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``build(fixtures)`` under ``name``, with SQL where SQL can say it."""

    def wrap(build: Callable[[Fixtures], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")

        def run(spark: SparkSession, directory: str) -> DataFrame:
            return build(Fixtures(tune(spark), directory))

        QUERIES[name] = run
        if sql is not None:
            CHECK_SQL[name] = sql
        return build

    return wrap


def load_all() -> None:
    """Import every module that registers queries."""
    from tallybuy.plans import (  # noqa: F401
        assembly,
        files,
        models,
        populations,
        profiles,
        ratios,
        scores,
        selection,
        synthesis,
        tables,
        vectors,
    )
