"""Compare a Spark result with DuckDB's, as sets of rows with named, typed columns."""

from __future__ import annotations

import math
from collections import Counter

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return value


def bag(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_cell(row[i]) for i in order) for row in rows)


def _kind(type_name: str) -> str:
    t = type_name.lower()
    return {"bigint": "int64", "long": "int64", "integer": "int32", "int": "int32",
            "varchar": "string", "timestamp_ntz": "timestamp"}.get(t, t)


def compare(con, sql: str, df) -> str | None:
    """None when equal, else what differs."""
    relation = con.sql(sql)
    want_columns = list(relation.columns)
    if sorted(want_columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} want {sorted(want_columns)}"
    want_types = {c: _kind(str(t)) for c, t in zip(want_columns, relation.types)}
    have_types = {f.name: _kind(f.dataType.simpleString()) for f in df.schema}
    if want_types != have_types:
        return f"types {have_types} want {want_types}"
    want = bag(want_columns, relation.fetchall())
    have = bag(df.columns, df.collect())
    if want != have:
        return (f"rows: {sum(have.values())} want {sum(want.values())}; "
                f"extra {list((have - want).items())[:2]} missing {list((want - have).items())[:2]}")
    return None
