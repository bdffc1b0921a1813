"""Compares a Spark result with a DuckDB result by column names, row count, types and values."""

from __future__ import annotations

import datetime as dt
import decimal
import math
from collections import Counter

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def _value(value):
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 5) + 0.0
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    return value


def normal(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_value(row[i]) for i in order) for row in rows)


_FAMILY = {
    "tinyint": "int", "smallint": "int", "int": "int", "integer": "int", "bigint": "bigint", "hugeint": "hugeint",
    "double": "double", "string": "string", "varchar": "string", "json": "string", "date": "date", "boolean": "boolean",
}


def differences(df, con, sql: str) -> str | None:
    """None when equal, else a short description."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    oracle_rows = result.fetchall()
    if sorted(df.columns) != sorted(names):
        return f"columns differ: {sorted(set(df.columns) ^ set(names))}"
    described = con.execute("DESCRIBE " + sql).fetchall()
    types = {row[0]: _FAMILY.get(row[1].lower(), row[1]) for row in described}
    ours = {n: _FAMILY.get(t, t) for n, t in df.dtypes}
    wrong = {n: (ours[n], types[n]) for n in ours if ours[n] != types[n]}
    spark_rows = [tuple(r) for r in df.collect()]
    if len(spark_rows) != len(oracle_rows):
        return f"{len(spark_rows)} rows, oracle has {len(oracle_rows)}"
    left, right = normal(df.columns, spark_rows), normal(names, oracle_rows)
    if left != right:
        only_left, only_right = list((left - right).items())[:2], list((right - left).items())[:2]
        return f"values differ in {sum((left - right).values())} rows ({sorted(df.columns)}): {only_left} vs {only_right}"
    return f"types differ: {wrong}" if wrong else None
