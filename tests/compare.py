"""Row-exact comparison of a Spark result with DuckDB's result of the same query."""

from __future__ import annotations

import datetime as dt
import decimal
import math
from collections import Counter
from pathlib import Path

import duckdb

SMALLEST = Path("/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        if Path(f"{folder}/{name}.parquet").exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9)
    if isinstance(value, dt.datetime) and value.tzinfo is not None:
        return value.astimezone(dt.UTC).replace(tzinfo=None)
    if isinstance(value, decimal.Decimal):
        return ("decimal", value.as_tuple().exponent, value)
    return value


def rows_of(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


_KINDS = {"BOOLEAN": "boolean", "BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "DOUBLE": "double", "DATE": "date", "TIMESTAMP": "timestamp"}


def kind(duck_type: str) -> str:
    text = str(duck_type)
    return text.lower() if text.startswith("DECIMAL") else _KINDS.get(text, text)


def differences(df, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """What differs between the two results; empty if they are equal."""
    relation = con.sql(sql)
    out = []
    if sorted(df.columns) != sorted(relation.columns):
        return [f"columns {sorted(df.columns)} != {sorted(relation.columns)}"]
    spark_types = dict(df.dtypes)
    for name, duck_type in zip(relation.columns, relation.types):
        if kind(duck_type) != spark_types[name]:
            out.append(f"type of {name}: {spark_types[name]} != {kind(duck_type)}")
    mine = rows_of(df.columns, df.collect())
    theirs = rows_of(relation.columns, relation.fetchall())
    if mine != theirs:
        extra, missing = mine - theirs, theirs - mine
        out.append(
            f"{sum(mine.values())} rows, expected {sum(theirs.values())}; {sum(extra.values())} only here "
            f"{list(extra)[:3]}, {sum(missing.values())} only there {list(missing)[:3]}"
        )
    return out
