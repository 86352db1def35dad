"""Spark results against DuckDB: same columns, same types of value, same rows."""

from __future__ import annotations

import datetime as dt
import decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def duck(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def plain(value):
    if isinstance(value, decimal.Decimal):
        return f"dec {value}"
    if isinstance(value, float):
        return f"float {value!r}"
    if isinstance(value, dt.datetime):
        return f"ts {value.replace(tzinfo=None).isoformat()}"
    return f"{type(value).__name__} {value}"


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(plain(row[i]) for i in order) for row in rows)


def spark_rows(df):
    return rows_of(df.columns, [tuple(r) for r in df.collect()])


def duck_rows(con, sql):
    cursor = con.execute(sql)
    return rows_of([c[0] for c in cursor.description], cursor.fetchall())
