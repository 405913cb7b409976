"""Run a registered query and its SQL side by side and compare whole results."""

from __future__ import annotations

import glob
import os

import duckdb
import pandas as pd


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _rows(frame: pd.DataFrame) -> list[tuple]:
    def cell(value):
        if value is None or value is pd.NaT or value is pd.NA or (isinstance(value, float) and value != value):
            return ("",)
        if isinstance(value, bool) or type(value).__name__ == "bool_":
            return ("b", bool(value))
        if isinstance(value, (int, float)) or type(value).__module__ == "numpy":
            return ("n", float(value))
        return (type(value).__name__.replace("Timestamp", "datetime"), str(value))

    ordered = frame[sorted(frame.columns)]
    return sorted(tuple(cell(v) for v in row) for row in ordered.itertuples(index=False, name=None))


def differences(spark_frame: pd.DataFrame, sql_frame: pd.DataFrame) -> str | None:
    if sorted(spark_frame.columns) != sorted(sql_frame.columns):
        return f"columns {sorted(spark_frame.columns)} against {sorted(sql_frame.columns)}"
    left, right = _rows(spark_frame), _rows(sql_frame)
    if len(left) != len(right):
        return f"{len(left)} rows against {len(right)}"
    wrong = [(a, b) for a, b in zip(left, right) if a != b]
    return f"{len(wrong)} rows differ, first {wrong[0]}" if wrong else None
