"""Compare a registered query with its SQL twin: columns, types, row count and exact values."""

from __future__ import annotations

import glob
import os
from decimal import Decimal

import duckdb

# Families that count as the same type on both sides.
_FAMILY = {
    "bigint": "long",
    "integer": "int",
    "varchar": "string",
    "timestamp": "timestamp",
    "timestamp_ntz": "timestamp",
    "tinyint": "int",
    "smallint": "int",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def _family(name: str) -> str:
    name = name.lower()
    return _FAMILY.get(name, name)


def _cell(value):
    if isinstance(value, float) and value == 0:
        return 0.0
    if isinstance(value, Decimal):
        return Decimal(value).normalize()
    return value


def _sorted(rows):
    return sorted(rows, key=lambda r: tuple((v is None, str(v)) for v in r))


def compare(spark, connection, query, sql: str, sf_dir: str) -> str | None:
    """None when equal, else a short description of the difference."""
    df = query(spark, sf_dir)
    relation = connection.sql(sql)
    ours = dict((f.name, _family(f.dataType.simpleString())) for f in df.schema.fields)
    theirs = dict(zip(relation.columns, [_family(str(t)) for t in relation.types]))
    names = sorted(ours)
    if names != sorted(theirs):
        return f"columns {names} != {sorted(theirs)}"
    mapped = {k: ("long" if v == "bigint" else v) for k, v in ours.items()}
    if mapped != theirs:
        return "types " + str({k: (mapped[k], theirs[k]) for k in names if mapped[k] != theirs[k]})
    left = _sorted([tuple(_cell(r[c]) for c in names) for r in df.collect()])
    place = [relation.columns.index(c) for c in names]
    right = _sorted([tuple(_cell(r[i]) for i in place) for r in relation.fetchall()])
    if len(left) != len(right):
        return f"rows {len(left)} != {len(right)}"
    different = [(a, b) for a, b in zip(left, right) if a != b]
    return f"{len(different)} of {len(left)} rows differ, first {different[0]}" if different else None
