"""Row-for-row comparison of a DataFrame with the result of SQL text in DuckDB, for tests."""

from __future__ import annotations

import datetime as dt
import decimal
import math
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame


def oracle_connection(folder: str):
    connection = duckdb.connect()
    connection.execute("set timezone = 'UTC'")
    for file in sorted(Path(folder).glob("*.parquet")):
        connection.execute(f"create view {file.stem} as select * from read_parquet('{file}')")
    return connection


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    if isinstance(value, decimal.Decimal):
        return ("decimal", str(value.normalize()))
    if isinstance(value, (dt.datetime, dt.date)):
        return value.isoformat()
    if isinstance(value, (bytes, bytearray)):
        return bytes(value).hex()
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    if isinstance(value, dict):
        return tuple((k, _plain(v)) for k, v in value.items())
    if isinstance(value, bool) or value is None:
        return value
    return (type(value).__name__, value)


def compare(df: DataFrame, oracle, sql: str | None) -> str | None:
    """None if equal, else what differs. Without SQL only checks that the query runs."""
    names = sorted(df.columns)
    mine = [tuple(_plain(r[n]) for n in names) for r in df.collect()]
    if sql is None:
        return None if mine else "no rows"
    cursor = oracle.execute(sql)
    titles = [d[0] for d in cursor.description]
    if sorted(titles) != names:
        return f"columns {names} against {sorted(titles)}"
    order = [titles.index(n) for n in names]
    theirs = [tuple(_plain(r[i]) for i in order) for r in cursor.fetchall()]
    if len(mine) != len(theirs):
        return f"{len(mine)} rows against {len(theirs)}"
    for a, b in zip(sorted(mine, key=repr), sorted(theirs, key=repr)):
        if a != b:
            return f"{dict(zip(names, a))} against {dict(zip(names, b))}"
    return None
