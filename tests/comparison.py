"""Compare a registered query with its SQL: columns by name, rows in any order."""

from __future__ import annotations

import math
from collections import Counter
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return db


def _plain(value):
    if isinstance(value, (Decimal, int, float)) and not isinstance(value, bool):
        value = float(value)
        return None if math.isnan(value) else value
    return value if value is None or isinstance(value, str) else str(value)


def as_bag(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def differences(df, db: duckdb.DuckDBPyConnection, sql: str) -> str:
    """'' if both sides agree, else a short description."""
    result = db.execute(sql)
    columns = [d[0] for d in result.description]
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} and {sorted(columns)}"
    ours, theirs = as_bag(df.columns, df.collect()), as_bag(columns, result.fetchall())
    if ours == theirs:
        return ""
    return (
        f"rows {sum(ours.values())} and {sum(theirs.values())}; "
        f"only ours {list((ours - theirs).items())[:3]}; only theirs {list((theirs - ours).items())[:3]}"
    )
