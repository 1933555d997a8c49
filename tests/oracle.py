"""Run a registered query and its SQL side by side."""

from __future__ import annotations

import datetime as dt
import decimal
import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, decimal.Decimal):
        return format(value.normalize(), "f") if value else "0"
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if isinstance(value, int):
        return str(value)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, dt.date):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    return value


def as_multiset(names: list[str], rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def spark_side(df):
    return sorted(df.columns), as_multiset(df.columns, df.collect())


def duck_side(con, sql):
    cursor = con.execute(sql)
    names = [c[0] for c in cursor.description]
    return sorted(names), as_multiset(names, cursor.fetchall())


def difference(df, con, sql) -> str | None:
    """None when both sides agree, else a short description."""
    names, mine = spark_side(df)
    other_names, other = duck_side(con, sql)
    if names != other_names:
        return f"columns differ: {names} / {other_names}"
    if mine == other:
        return None
    a, b = mine - other, other - mine
    return (
        f"rows {sum(mine.values())} / {sum(other.values())}; only spark {sum(a.values())}: "
        f"{list(a.items())[:2]}; only sql {sum(b.values())}: {list(b.items())[:2]}; columns {names}"
    )
