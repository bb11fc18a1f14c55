"""Order-insensitive comparison of a Spark result with its SQL twin."""

from __future__ import annotations

import math
from collections import Counter
from datetime import date, datetime

import duckdb

TABLES = "region nation customer supplier part orders lineitem events".split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return None
    if isinstance(value, datetime):
        return value.replace(tzinfo=None)
    if isinstance(value, date):
        return datetime(value.year, value.month, value.day)
    if isinstance(value, float) and value == 0:
        return 0.0
    return value


def _type_of(spark_type: str) -> str:
    return {
        "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
        "date": "DATE", "timestamp": "TIMESTAMP", "timestamp_ntz": "TIMESTAMP",
    }.get(spark_type, spark_type)


def differences(df, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """What differs in names, types and rows; empty when all agree."""
    theirs = con.sql(sql)
    spark_types = {n: _type_of(t) for n, t in df.dtypes}
    duck_types = {n: str(t) for n, t in zip(theirs.columns, theirs.types)}
    if spark_types != duck_types:
        return [f"schema: {set(spark_types.items()) ^ set(duck_types.items())}"]
    names = sorted(spark_types)
    mine = Counter(tuple(_plain(row[n]) for n in names) for row in df.select(*names).collect())
    order = [theirs.columns.index(n) for n in names]
    other = Counter(tuple(_plain(row[i]) for i in order) for row in theirs.fetchall())
    if not mine:
        return ["no rows"]
    left, right = mine - other, other - mine
    if left or right:
        found = [f"rows: {sum(mine.values())} against {sum(other.values())}, names {names}"]
        found += [f"only Spark {row}" for row in sorted(left, key=str)[:3]]
        found += [f"only SQL   {row}" for row in sorted(right, key=str)[:3]]
        return found
    return []
