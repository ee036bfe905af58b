"""Compare a query with its SQL twin: columns by name, rows in any order."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def database(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def _cell(value):
    if value is None:
        return "~"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, (int, float)) or type(value).__name__ == "Decimal":
        number = float(value)
        return "nan" if math.isnan(number) else repr(round(number, 6) + 0.0)
    return str(value)


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def differences(df, con, sql: str) -> str | None:
    """None when equal, else what differs."""
    relation = con.sql(sql)
    if sorted(df.columns) != sorted(relation.columns):
        return f"columns {sorted(df.columns)} and {sorted(relation.columns)}"
    mine, theirs = _rows(df.columns, df.collect()), _rows(relation.columns, relation.fetchall())
    if len(mine) != len(theirs):
        return f"{len(mine)} rows and {len(theirs)}"
    if mine != theirs:
        off = [(a, b) for a, b in zip(mine, theirs) if a != b]
        return f"{len(off)} of {len(mine)} rows differ, first {off[0]}"
    return None
