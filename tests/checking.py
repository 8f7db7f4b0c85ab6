"""Run a registered query next to its SQL and compare the two row sets."""

from __future__ import annotations

import datetime
import decimal
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, decimal.Decimal):
        return ("decimal", str(value))
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    return value


def _kind(value) -> str:
    return type(value).__name__ if value is not None else "none"


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    flat = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(names), sorted(flat, key=lambda r: tuple((v is None, str(v)) for v in r))


# Spark type -> the DuckDB type a matching column must have
TYPE_NAMES = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "timestamp_ntz": "TIMESTAMP",
    "boolean": "BOOLEAN",
    "date": "DATE",
}


def compare(df, con, sql: str) -> str | None:
    """None when equal, else what differs."""
    relation = con.execute(sql)
    columns = [d[0] for d in relation.description]
    kinds = {d[0]: str(d[1]) for d in relation.description}
    expected_names, expected = rows_of(columns, relation.fetchall())
    actual_names, actual = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if actual_names != expected_names:
        return f"columns {actual_names} != {expected_names}"
    types = {n: (TYPE_NAMES.get(t, t), kinds[n]) for n, t in df.dtypes}
    wrong = {n: pair for n, pair in types.items() if pair[0] != pair[1]}
    if wrong:
        return f"types (spark, sql) {wrong}"
    if len(actual) != len(expected):
        return f"rows {len(actual)} != {len(expected)}"
    if not actual:
        return "no rows on either side"
    bad = [(a, e) for a, e in zip(actual, expected) if a != e]
    if bad:
        return f"{len(bad)} of {len(actual)} rows differ in {actual_names}; first: {bad[0]}"
    return None
