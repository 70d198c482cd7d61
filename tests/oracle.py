"""Compare a query with its SQL in DuckDB, as exact multisets of rows."""

from __future__ import annotations

import datetime as dt
import math
from collections import Counter
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for name in TABLES:
        path = Path(sf_dir) / f"{name}.parquet"
        if path.exists():
            con.execute(f"create view {name} as select * from read_parquet('{path}')")
    return con


def _cell(value):
    if isinstance(value, float):
        return 0.0 if value == 0 else ("nan" if math.isnan(value) else value)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    return value


def _bag(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_cell(row[i]) for i in order) for row in rows)


_KINDS = {
    "BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string",
    "BOOLEAN": "boolean", "TIMESTAMP": "timestamp_ntz", "DATE": "date",
}


def differences(df, sql: str, con) -> list[str]:
    """What distinguishes the two results; empty when they are equal."""
    found = []
    oracle = con.execute(sql)
    types = {d[0]: str(d[1]) for d in oracle.description}
    expected = _bag(oracle.fetchall(), list(types))
    if sorted(df.columns) != sorted(types):
        return [f"columns {sorted(df.columns)} against {sorted(types)}"]
    for name, kind in df.dtypes:
        if _KINDS.get(types[name], types[name]) != kind:
            found.append(f"type of {name}: {kind} against {types[name]}")
    actual = _bag(df.collect(), df.columns)
    if actual != expected:
        found.append(
            f"{sum(actual.values())} rows against {sum(expected.values())}; "
            f"only here {list((actual - expected).items())[:3]}; "
            f"only there {list((expected - actual).items())[:3]}"
        )
    if not actual:
        found.append("no rows")
    return found
