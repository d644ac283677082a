"""Compare a registered query with its SQL, run by DuckDB on the same files."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for name in TABLES:
        if Path(f"{sf}/{name}.parquet").exists():
            db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    return db


def _cell(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    return value


def _bag(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_cell(row[i]) for i in order) for row in rows)


def differences(spark_df, db: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """Empty if both give the same columns, types' values and rows."""
    relation = db.execute(sql)
    columns = [d[0] for d in relation.description]
    expected = _bag(columns, relation.fetchall())
    rows = spark_df.collect()
    if sorted(columns) != sorted(spark_df.columns):
        return [f"columns {sorted(spark_df.columns)} != {sorted(columns)}"]
    actual = _bag(spark_df.columns, rows)
    missing, extra = expected - actual, actual - expected
    found = []
    if missing or extra:
        found.append(f"{sum(actual.values())} rows, expected {sum(expected.values())}")
        found += [f"missing {row}" for row in list(missing)[:3]]
        found += [f"extra {row}" for row in list(extra)[:3]]
    return found
