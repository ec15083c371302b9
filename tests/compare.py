"""Spark result against DuckDB result: same columns, same types by family, same rows in any order."""

from __future__ import annotations

import datetime
import decimal
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def _plain(v: object) -> object:
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, float):
        return float(f"{v:.9g}") + 0.0
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None)
    if isinstance(v, dict):
        return tuple(sorted((k, _plain(x)) for k, x in v.items()))
    if isinstance(v, (list, tuple)):
        return tuple(_plain(x) for x in v)
    return v


def _rows(columns: list[str], rows: list) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


_FAMILY = {
    "tinyint": "int", "smallint": "int", "int": "int", "integer": "int", "bigint": "long", "hugeint": "HUGE", "string": "text",
    "varchar": "text", "float": "float", "double": "double", "boolean": "bool", "timestamp": "time", "date": "date",
}


def difference(df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None if both agree, else what differs first."""
    want = con.sql(sql)
    names, types = want.columns, [str(t).lower() for t in want.types]
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    theirs = dict(zip(names, types))
    for name, kind in df.dtypes:
        a, b = _FAMILY.get(kind, kind), _FAMILY.get(theirs[name], theirs[name])
        if a != b and not ({a, b} <= {"int", "long"}):
            return f"type of {name}: {kind} != {theirs[name]}"
    got = _rows(df.columns, df.collect())
    expected = _rows(names, want.fetchall())
    if len(got) != len(expected):
        return f"{len(got)} rows != {len(expected)}"
    for g, e in zip(got, expected):
        if g != e:
            return f"{sorted(df.columns)}: {g} != {e}"
    return None
