"""Runs a registered query and its SQL side by side and reports the first difference."""

from __future__ import annotations

import datetime
import decimal
import math
import os

import duckdb

from readloom.plans import registry
from readloom.plans.fixtures import TABLES

TYPES = {"BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "DOUBLE": "double", "BOOLEAN": "boolean",
         "TIMESTAMP": "timestamp", "FLOAT": "float", "SMALLINT": "smallint", "TINYINT": "tinyint", "DATE": "date"}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = os.path.join(sf_dir, f"{name}.parquet")
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if value is None:
        return ""
    if isinstance(value, bool):
        return str(value).lower()
    if isinstance(value, (float, decimal.Decimal)):
        return "nan" if math.isnan(value) else f"{float(value):.9g}"
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    return str(value)


def _bag(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(row[i]) for i in order) for row in rows)


def compare(spark, con, name: str, sf_dir: str, may_be_empty: bool = False) -> str | None:
    df = registry.QUERIES[name](spark, sf_dir)
    rows = df.collect()
    if name not in registry.ORACLE:
        return None if rows else "no rows"
    result = con.execute(registry.ORACLE[name])
    want_cols = [d[0] for d in result.description]
    want_types = {d[0]: TYPES.get(str(d[1]), str(d[1])) for d in result.description}
    want = result.fetchall()
    if sorted(df.columns) != sorted(want_cols):
        return f"columns {sorted(df.columns)} != {sorted(want_cols)}"
    got_types = {c: t.replace("timestamp_ntz", "timestamp") for c, t in df.dtypes}
    bag, want_bag = _bag(rows, df.columns), _bag(want, want_cols)
    if len(bag) != len(want_bag):
        return f"rows {len(bag)} != {len(want_bag)}"
    if bag != want_bag:
        diffs = [(a, b) for a, b in zip(bag, want_bag) if a != b]
        return f"{len(diffs)} rows differ, e.g. spark={diffs[0][0]} sql={diffs[0][1]}"
    if got_types != want_types:
        off = {c: (got_types[c], want_types[c]) for c in got_types if got_types[c] != want_types[c]}
        return f"types differ: {off}"
    if not bag and not may_be_empty:
        return "no rows on either side"
    return None
