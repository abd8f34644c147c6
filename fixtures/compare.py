"""Run a registered query and its SQL side by side."""

from __future__ import annotations

import glob
import math
import os

import duckdb


def connect(d: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(glob.glob(f"{d}/*.parquet")):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _cell(x):
    if isinstance(x, float):
        return "nan" if math.isnan(x) else f"{x:.9g}"
    return "null" if x is None else str(x)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


KINDS = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}


def differences(df, con, sql: str) -> list[str]:
    """What differs between a DataFrame and a SQL result; empty when they agree."""
    relation = con.execute(sql)
    names = [c[0] for c in relation.description]
    kinds = {c[0]: str(c[1]) for c in relation.description}
    theirs = relation.fetchall()
    ours = df.collect()
    found = []
    if sorted(df.columns) != sorted(names):
        return [f"columns {sorted(df.columns)} and {sorted(names)}"]
    for name, kind in df.dtypes:
        if KINDS.get(kind, kind) != kinds[name]:
            found.append(f"type of {name}: {kind} and {kinds[name]}")
    a, b = _rows(df.columns, ours), _rows(names, theirs)
    if len(a) != len(b):
        found.append(f"{len(a)} rows and {len(b)}")
    if a != b:
        extra, lacking = sorted(set(a) - set(b))[:2], sorted(set(b) - set(a))[:2]
        found.append(f"only here {extra}, only there {lacking}")
    return found
