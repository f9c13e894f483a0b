"""Run a registered query and its check SQL and compare the results."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(directory: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        path = Path(directory) / f"{t}.parquet"
        if path.exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _cell(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, float):
        return ("f", v + 0.0)
    if isinstance(v, (list, tuple)):
        return tuple(_cell(x) for x in v)
    return (type(v).__name__, v)


def _rows(table):
    names = sorted(table.column_names)
    columns = [table.column(n).to_pylist() for n in names]
    rows = [tuple(_cell(v) for v in row) for row in zip(*columns)]
    return names, sorted(rows, key=repr)


def compare(spark_df, con, sql: str) -> str | None:
    """None if equal, else a short description of the difference."""
    got = spark_df.toArrow()
    want = con.sql(sql).to_arrow_table()
    got_names, got_rows = _rows(got)
    want_names, want_rows = _rows(want)
    if got_names != want_names:
        return f"columns differ: {sorted(set(got_names) ^ set(want_names))}"
    kinds = {
        n: (str(got.schema.field(n).type), str(want.schema.field(n).type))
        for n in got_names
        if str(got.schema.field(n).type).replace("large_", "") != str(want.schema.field(n).type).replace("large_", "")
    }
    if kinds:
        return f"types differ: {kinds}"
    if len(got_rows) != len(want_rows):
        return f"{len(got_rows)} rows, expected {len(want_rows)}"
    bad = [(g, w) for g, w in zip(got_rows, want_rows) if g != w]
    if bad:
        g, w = bad[0]
        cells = [(n, a, b) for n, a, b in zip(got_names, g, w) if a != b]
        return f"{len(bad)} of {len(got_rows)} rows differ, first: {cells[:6]}"
    return None
