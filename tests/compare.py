"""Order-insensitive comparison of a Spark result with an SQL result."""

import math
from collections import Counter
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
KINDS = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean"}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        if Path(f"{sf_dir}/{table}.parquet").exists():
            connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return connection


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value + 0.0:.6f}"
    if isinstance(value, (list, tuple)):
        return str([_cell(v) for v in value])
    return str(value)


def rows_of(rows, order):
    return sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def differences(df, connection, sql: str) -> list[str]:
    cursor = connection.execute(sql)
    names = [d[0] for d in cursor.description]
    kinds = {d[0]: KINDS.get(str(d[1]), str(d[1]).lower()) for d in cursor.description}
    found = []
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} != {sorted(names)}"]
    for name, kind in df.dtypes:
        if kinds[name] != kind and not kind.startswith("array"):
            found.append(f"{name}: {kind} != {kinds[name]}")
    expected = rows_of(cursor.fetchall(), [names.index(n) for n in sorted(names)])
    actual = rows_of(df.collect(), [df.columns.index(n) for n in sorted(names)])
    if len(expected) != len(actual):
        found.append(f"rows {len(actual)} != {len(expected)}")
    if expected != actual:
        missing, extra = Counter(expected) - Counter(actual), Counter(actual) - Counter(expected)
        found.append(f"values differ: spark has {list(extra)[:3]}, sql has {list(missing)[:3]}")
    if not actual:
        found.append("empty result")
    return found
