"""Row-by-row comparison of a Spark result with the SQL oracle."""

from __future__ import annotations

import math
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, Decimal):
        return float(value)
    return value


def normal_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def differences(spark_df, con, sql: str) -> str | None:
    """None when both sides hold the same columns and the same rows."""
    relation = con.execute(sql)
    names = [c[0] for c in relation.description]
    expected = relation.fetchall()
    if sorted(names) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} != {sorted(names)}"
    actual = normal_rows(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    wanted = normal_rows(names, expected)
    if len(actual) != len(wanted):
        return f"{len(actual)} rows != {len(wanted)}"
    for got, want in zip(actual, wanted):
        if got != want or [type(v) for v in got] != [type(v) for v in want]:
            return f"spark {got}\noracle {want}"
    return None
