"""Strict comparison of a Spark result with the SQL oracle: names, types, row multiset, exact values."""

from __future__ import annotations

import math
import os

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        path = f"{folder}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


_DUCK = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "TIMESTAMP": "timestamp"}


def _row(values) -> tuple:
    return tuple("NaN" if isinstance(v, float) and math.isnan(v) else v for v in values)


def _key(row: tuple):
    return tuple((v is None, str(type(v)), v if v is not None else 0) for v in row)


def compare(df, con, sql: str) -> str | None:
    """None when equal, else a short text saying what differs."""
    cols = sorted(df.columns)
    spark_types = {f.name: f.dataType.simpleString() for f in df.schema}
    rel = con.sql(sql)
    duck_types = {n: _DUCK.get(str(t), str(t)) for n, t in zip(rel.columns, rel.types)}
    if sorted(duck_types) != cols:
        return f"columns: only spark {set(cols) - set(duck_types)}, only oracle {set(duck_types) - set(cols)}"
    bad = {c: (spark_types[c], duck_types[c]) for c in cols if spark_types[c] != duck_types[c]}
    if bad:
        return f"types (spark, oracle): {bad}"
    left = sorted((_row(r) for r in df.select(*[f"`{c}`" for c in cols]).collect()), key=_key)
    quoted = ", ".join(f'"{c}"' for c in cols)
    right = sorted((_row(r) for r in con.sql(f"SELECT {quoted} FROM ({sql})").fetchall()), key=_key)
    if len(left) != len(right):
        return f"rows: spark {len(left)}, oracle {len(right)}"
    for a, b in zip(left, right):
        if a != b:
            return f"values: {[(c, x, y) for c, x, y in zip(cols, a, b) if x != y]}"
    return None
