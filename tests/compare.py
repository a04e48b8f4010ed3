"""Order-insensitive comparison of a Spark result with the SQL result."""

from __future__ import annotations

import datetime as dt
import decimal

import duckdb
from pyspark.sql import DataFrame

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


_KINDS = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
    "timestamp": "TIMESTAMP",
}


def _plain(value):
    if isinstance(value, float):
        return round(value, 9)
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    return value


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(plain, key=repr)


def assert_same(result: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> int:
    expected = con.sql(sql)
    kinds = {f.name: _KINDS[f.dataType.simpleString()] for f in result.schema.fields}
    assert kinds == dict(zip(expected.columns, map(str, expected.types), strict=True))
    mine = _rows(result.columns, result.collect())
    theirs = _rows(expected.columns, expected.fetchall())
    assert len(mine) == len(theirs), (len(mine), len(theirs))
    different = [(a, b) for a, b in zip(mine, theirs, strict=True) if a != b]
    assert not different, different[:3]
    return len(mine)
