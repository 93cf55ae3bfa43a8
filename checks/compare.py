"""Run a query and its check SQL side by side."""

from __future__ import annotations

import datetime
import decimal
import glob
import os

import duckdb
from pyspark.sql import DataFrame

_TYPES = {
    "string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE",
    "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    return con


def _plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    return value


def _sorted(rows) -> list[tuple]:
    return sorted((tuple(_plain(v) for v in row) for row in rows), key=repr)


def differences(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """What differs: names, types, row count or the first rows; empty when equal."""
    answer = con.execute(sql)
    theirs = {d[0]: str(d[1]) for d in answer.description}
    rows = answer.fetchall()
    ours = dict(df.dtypes)
    if set(ours) != set(theirs):
        return [f"columns {sorted(ours)} / {sorted(theirs)}"]
    names, found = sorted(ours), []
    for name in names:
        if _TYPES.get(ours[name]) != theirs[name]:
            found.append(f"type of {name}: {ours[name]} / {theirs[name]}")
    places = {name: i for i, name in enumerate(theirs)}
    expected = _sorted([row[places[n]] for n in names] for row in rows)
    got = _sorted(df.select(*names).collect())
    if len(got) != len(expected):
        found.append(f"rows {len(got)} / {len(expected)}")
    if got != expected:
        wrong = [(g, e) for g, e in zip(got, expected) if g != e][:3]
        found += [f"{names}"] + [f"{g}\n   {e}" for g, e in wrong]
    return found
