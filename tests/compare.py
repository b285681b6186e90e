"""Run a registered query and its SQL on the same tables and compare all values."""

from __future__ import annotations

import glob
import math
import os

import duckdb


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def cell(v):
        return "NaN" if isinstance(v, float) and math.isnan(v) else v

    values = [tuple(cell(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(values, key=repr)


def differences(spark, con, build, sql, folder) -> list[str]:
    df = build(spark, folder)
    left_columns, left = _rows(df.columns, [tuple(r) for r in df.collect()])
    relation = con.sql(sql)
    right_columns, right = _rows(list(relation.columns), relation.fetchall())
    found = []
    if left_columns != right_columns:
        found.append(f"columns {left_columns} / {right_columns}")
    if len(left) != len(right):
        found.append(f"{len(left)} rows / {len(right)} rows")
    for a, b in zip(left, right):
        if a != b:
            found.append(f"{a} / {b}")
            break
    if not left:
        found.append("no rows")
    return found
