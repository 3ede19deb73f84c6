"""Compare a Spark result with the stating SQL run by DuckDB: columns, types, rows."""

from __future__ import annotations

import math
from collections import Counter
from datetime import date, datetime
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()

# DuckDB type -> Spark type.
SAME = {
    "BIGINT": "bigint",
    "INTEGER": "int",
    "DOUBLE": "double",
    "VARCHAR": "string",
    "BOOLEAN": "boolean",
    "DATE": "date",
    "TIMESTAMP": "timestamp_ntz",
}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def canonical(value):
    if value is None:
        return None
    if isinstance(value, bool):
        return value
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9) + 0.0
    if isinstance(value, datetime):
        return value.isoformat()
    if isinstance(value, date):
        return value.isoformat()
    return value


def rows(columns: list[str], found) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(canonical(row[i]) for i in order) for row in found)


def differences(df, sql: str, connection) -> list[str]:
    result = connection.execute(sql)
    names = [d[0] for d in result.description]
    expected = result.fetchall()
    relation = connection.sql(sql)
    types = {n: str(t) for n, t in zip(relation.columns, relation.types)}
    problems = []
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} expected {sorted(names)}"]
    for name, kind in df.dtypes:
        if SAME.get(types[name], types[name]) != kind:
            problems.append(f"type of {name}: {kind} expected {types[name]}")
    got, want = rows(df.columns, [tuple(r) for r in df.collect()]), rows(names, expected)
    if got != want:
        extra, missing = got - want, want - got
        problems.append(
            f"rows {sum(got.values())} expected {sum(want.values())}; extra {list(extra)[:2]} missing {list(missing)[:2]}"
        )
    if not want:
        problems.append("the expected result is empty")
    return problems
