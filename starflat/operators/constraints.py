"""Declared keys and rules that Spark does not enforce, counted as violations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class NotNull:
    table: str
    column: str


@dataclass(frozen=True)
class Rule:
    """CHECK: broken where the SQL predicate is false; NULL passes."""

    table: str
    name: str
    predicate: str


@dataclass(frozen=True)
class Domain:
    """ENUM: the values a column may take; NULL passes."""

    table: str
    column: str
    values: tuple[str, ...]


@dataclass(frozen=True)
class Unique:
    """UNIQUE: rows beyond the first of each key; keys with NULL pass."""

    table: str
    columns: tuple[str, ...]


@dataclass(frozen=True)
class ForeignKey:
    table: str
    column: str
    parent: str
    key: str


@dataclass(frozen=True)
class Agreement:
    """``table.column`` equals ``parent.value`` of the row ``table.via`` refers to."""

    table: str
    column: str
    via: str
    parent: str
    key: str
    value: str


Constraint = NotNull | Rule | Domain | Unique | ForeignKey | Agreement


def constraint_report(
    frames: Mapping[str, DataFrame], constraints: Sequence[Constraint]
) -> DataFrame:
    """``(table_name, constraint_name, violations)``, one row per constraint.

    Row-wise constraints of a table share one scan. Unique and foreign keys are
    counted per value before they are compared, so a value that holds most rows
    arrives as one row per task.
    """
    scanned: dict[str, list[Constraint]] = {}
    branches = []
    for c in constraints:
        if isinstance(c, (NotNull, Rule, Domain)):
            scanned.setdefault(c.table, []).append(c)
        elif isinstance(c, Unique):
            branches.append(_unique(frames, c))
        elif isinstance(c, ForeignKey):
            missing = orphans(frames[c.table], c.column, frames[c.parent], c.key)
            branches.append(_report(missing, "orphans", c.table, f"foreign_key({c.column})"))
        else:
            branches.append(_agreement(frames, c))
    branches = [_scan(frames[t], t, cs) for t, cs in scanned.items()] + branches
    return reduce(DataFrame.unionByName, branches)


def orphans(child: DataFrame, foreign_key: str, parent: DataFrame, key: str) -> DataFrame:
    """Key values of ``child`` that ``parent`` lacks, with their row counts."""
    used = (
        child.filter(F.col(foreign_key).isNotNull())
        .groupBy(F.col(foreign_key).alias("missing_key"))
        .agg(F.count(F.lit(1)).alias("orphans"))
    )
    known = parent.select(F.col(key).alias("_known_key"))
    return used.join(known, used["missing_key"] == known["_known_key"], "left_anti")


def _scan(df: DataFrame, table: str, constraints: Sequence[Constraint]) -> DataFrame:
    rows = []
    for c in constraints:
        if isinstance(c, NotNull):
            name, broken = f"not_null({c.column})", F.col(c.column).isNull()
        elif isinstance(c, Rule):
            name, broken = f"check({c.name})", ~F.expr(c.predicate)
        else:
            name, broken = f"domain({c.column})", ~F.col(c.column).isin(*c.values)
        rows.append(_row(table, name, F.count_if(broken)))
    return df.agg(F.array(*rows).alias("r")).select(F.inline("r"))


def _unique(frames: Mapping[str, DataFrame], c: Unique) -> DataFrame:
    groups = frames[c.table].dropna(subset=list(c.columns)).groupBy(*c.columns)
    extra = groups.agg((F.count(F.lit(1)) - 1).alias("extra"))
    return _report(extra, "extra", c.table, f"unique({','.join(c.columns)})")


def _agreement(frames: Mapping[str, DataFrame], c: Agreement) -> DataFrame:
    # Equal pairs are counted before the join: a hot key is a few rows when it is shuffled.
    child = (
        frames[c.table]
        .groupBy(F.col(c.via).alias("_via"), F.col(c.column).alias("_direct"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    parent = frames[c.parent].select(F.col(c.key).alias("_key"), F.col(c.value).alias("_reached"))
    differ = child.join(parent, F.col("_via") == F.col("_key")).filter("_direct <> _reached")
    return _report(differ, "n", c.table, f"agreement({c.column},{c.parent}.{c.value})")


def _report(df: DataFrame, column: str, table: str, name: str) -> DataFrame:
    row = _row(table, name, F.coalesce(F.sum(column), F.lit(0)))
    return df.agg(F.array(row).alias("r")).select(F.inline("r"))


def _row(table: str, name: str, violations: Column) -> Column:
    return F.struct(
        F.lit(table).alias("table_name"),
        F.lit(name).alias("constraint_name"),
        violations.cast("bigint").alias("violations"),
    )
