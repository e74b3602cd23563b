"""Compare a Spark result with DuckDB over the same parquet files."""

from __future__ import annotations

import math
import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


def connect(folder: str = DATA):
    con = duckdb.connect()
    con.execute("set timezone='UTC'")
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{folder}/{t}.parquet'")
    return con


def _cell(v):
    if isinstance(v, bool) or v is None:
        return str(v)
    if hasattr(v, "item"):
        v = v.item()
    if isinstance(v, (int, float)):
        v = float(v)
        if math.isnan(v):
            return "nan"
        return f"{v + 0.0:.9g}" if v else "0"
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_cell(x) for x in v) + "]"
    if isinstance(v, dict):
        return "{" + ",".join(_cell(x) for x in v.values()) + "}"
    return str(v)


def normal_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def _family(type_name: str) -> str:
    """Coarse type, so that a count stays a whole number on both sides."""
    name = type_name.lower()
    if name.endswith("[]") or name.startswith("array"):
        return "array"
    for family, words in {
        "whole": ("bigint", "int", "smallint", "tinyint", "integer"),
        "real": ("double", "float", "real"),
        "text": ("string", "varchar"),
        "flag": ("boolean",),
        "time": ("timestamp", "timestamp_ntz", "date", "timestamp_ns"),
    }.items():
        if name in words:
            return family
    return name


def spark_rows(df):
    types = {c: _family(t) for c, t in df.dtypes}
    return sorted(types.items()), normal_rows(df.columns, [tuple(r) for r in df.collect()])


def duck_rows(con, sql):
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    types = {d[0]: _family(str(d[1])) for d in cur.description}
    return sorted(types.items()), normal_rows(names, cur.fetchall())
