"""Run a registered query in Spark and its SQL in DuckDB, and compare the rows."""

from __future__ import annotations

import glob
import os
from collections import Counter

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"create view {name} as select * from read_parquet('{path}')")
    return con


def _kind(arrow_type) -> str:
    text = str(arrow_type)
    return {"large_string": "string", "string_view": "string"}.get(text, text)


def _rows(table) -> Counter:
    names = sorted(table.column_names)
    columns = [table.column(n).to_pylist() for n in names]
    return Counter(zip(*columns))


def compare(df, con, sql: str) -> list[str]:
    """Differences in column names, types and rows; empty when equal."""
    ours, theirs = df.toArrow(), con.sql(sql).to_arrow_table()
    out = []
    if sorted(ours.column_names) != sorted(theirs.column_names):
        return [f"columns {ours.column_names} vs {theirs.column_names}"]
    for name in ours.column_names:
        a, b = _kind(ours.schema.field(name).type), _kind(theirs.schema.field(name).type)
        if a != b:
            out.append(f"type of {name}: {a} vs {b}")
    a, b = _rows(ours), _rows(theirs)
    if a != b:
        out.append(
            f"rows {a.total()} vs {b.total()}; only ours {list((a - b).items())[:3]}; "
            f"only theirs {list((b - a).items())[:3]}"
        )
    return out
