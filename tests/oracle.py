"""Runs a registered query and its SQL side by side."""

from __future__ import annotations

import math
from decimal import Decimal
from pathlib import Path

import duckdb

from starflat.plans.catalog import QUERIES
from starflat.plans.oracles import ORACLES


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def compare(spark, sf_dir: str, name: str) -> str | None:
    """None if both give the same rows, else what differs."""
    df = QUERIES[name](spark, sf_dir)
    found = [tuple(row) for row in df.collect()]
    cursor = duck(sf_dir).execute(ORACLES[name])
    columns = [d[0] for d in cursor.description]
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}"
    types = {d[0]: str(d[1]) for d in cursor.description}
    mine = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    other = {c: (mine[c], t) for c, t in types.items() if _spark_type(t) != mine[c]}
    if other:
        return f"types {other}"
    order = [columns.index(c) for c in df.columns]
    wanted = [tuple(row[i] for i in order) for row in cursor.fetchall()]
    mine = sorted(map(_text, found))
    theirs = sorted(map(_text, wanted))
    if len(mine) != len(theirs):
        return f"{len(mine)} rows != {len(theirs)} rows"
    for a, b in zip(mine, theirs):
        if a != b:
            return f"{a} != {b}"
    return None


# Names of the same type.
_TYPES = {
    "INTEGER": "int",
    "VARCHAR": "string",
    "TIMESTAMP": "timestamp_ntz",
}


def _spark_type(duck_type: str) -> str:
    return _TYPES.get(duck_type, duck_type.lower())


def _text(row: tuple) -> tuple[str, ...]:
    return tuple(_value(v) for v in row)


def _value(value) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if isinstance(value, Decimal):
        return f"{value:.2f}"
    if isinstance(value, int):
        return str(value)
    return str(value)
