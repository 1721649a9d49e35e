"""Constraints of a growing fact table from what each period keeps of them.

A period keeps counts of what its constraints compare: rows that break a row-wise rule,
rows per foreign key value, per pair of an agreement, per unique key. A load replaces its
periods; the report joins the stored counts with the dimensions as they are now. So a
late dimension row heals the old facts that waited for it and a removed one breaks them,
and no fact is read again.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, types as T
from pyspark.sql import functions as F

from starflat.operators.constraints import (
    Agreement,
    Constraint,
    Domain,
    ForeignKey,
    NotNull,
    Rule,
    Unique,
    constraint_report,
)
from starflat.operators.partials import PERIOD, PeriodStore

COUNT_SCHEMA = T.StructType(
    [
        T.StructField("constraint_name", T.StringType()),
        T.StructField("key", T.StringType()),
        T.StructField("direct", T.StringType()),
        T.StructField("n", T.LongType()),
        T.StructField(PERIOD, T.StringType()),
    ]
)


def count_store(base: str, source: str) -> PeriodStore:
    return PeriodStore(base, source, COUNT_SCHEMA)


def period_counts(fact: DataFrame, constraints: Sequence[Constraint], period: Column) -> DataFrame:
    """What every period of ``fact`` keeps for ``constraints``, all of them on that table.

    Row-wise constraints share one scan. Keys are counted per value and period before
    they are shuffled, in their own types. They are kept as text, so a reference must have
    the type of what it refers to.
    """
    rows = fact.withColumn(PERIOD, period)
    scanned = [c for c in constraints if isinstance(c, (NotNull, Rule, Domain))]
    n = "_rows_of_key"  # a key may be a column n
    branches = []
    if scanned:
        none = F.lit(None).cast("string")
        broken = [
            F.struct(F.lit(_name(c)).alias("constraint_name"), F.count_if(_broken(c)).alias("n")) for c in scanned
        ]
        counted = rows.groupBy(PERIOD).agg(F.array(*broken).alias("r")).select(PERIOD, F.inline("r"))
        branches.append(counted.select("constraint_name", none.alias("key"), none.alias("direct"), "n", PERIOD))
    for c in constraints:
        if isinstance(c, (NotNull, Rule, Domain)):
            continue
        if isinstance(c, Unique):
            columns, key, direct = c.columns, F.to_json(F.struct(*c.columns)), F.lit(None)
        elif isinstance(c, ForeignKey):
            columns, key, direct = (c.column,), F.col(c.column), F.lit(None)
        else:
            columns, key, direct = (c.via, c.column), F.col(c.via), F.col(c.column)
        branches.append(
            rows.dropna(subset=list(columns))
            .groupBy(*dict.fromkeys((PERIOD, *columns)))
            .agg(F.count(F.lit(1)).alias(n))
            .select(
                F.lit(_name(c)).alias("constraint_name"),
                key.cast("string").alias("key"),
                direct.cast("string").alias("direct"),
                F.col(n).alias("n"),
                PERIOD,
            )
        )
    return reduce(DataFrame.unionByName, branches).select(*COUNT_SCHEMA.fieldNames())


def report_of(
    counts: DataFrame, frames: Mapping[str, DataFrame], table: str, constraints: Sequence[Constraint]
) -> DataFrame:
    """:func:`constraint_report` of all constraints: those of ``table`` from its stored counts,
    the others from ``frames``, which need not hold ``table``."""
    mine = [c for c in constraints if c.table == table]
    others = [c for c in constraints if c.table != table]
    branches = [_stored(counts, frames, c) for c in mine]
    if others:
        branches.append(constraint_report(frames, others))
    return reduce(DataFrame.unionByName, branches)


def _stored(counts: DataFrame, frames: Mapping[str, DataFrame], c: Constraint) -> DataFrame:
    kept = counts.filter(F.col("constraint_name") == _name(c))
    if isinstance(c, (NotNull, Rule, Domain)):
        violations = F.sum("n")
    elif isinstance(c, Unique):
        kept, violations = kept.groupBy("key").agg(F.sum("n").alias("n")), F.sum(F.col("n") - 1)
    else:
        kept = kept.groupBy("key", "direct").agg(F.sum("n").alias("n"))
        parent = frames[c.parent]
        known = parent.select(F.col(c.key).cast("string").alias("key"))
        if isinstance(c, ForeignKey):
            kept = kept.join(known, "key", "left_anti")
        else:
            reached = parent.select(F.col(c.key).cast("string").alias("key"), F.col(c.value).cast("string").alias("reached"))
            kept = kept.join(reached, "key").filter("direct <> reached")
        violations = F.sum("n")
    return kept.agg(
        F.lit(c.table).alias("table_name"),
        F.lit(_name(c)).alias("constraint_name"),
        F.coalesce(violations, F.lit(0)).cast("bigint").alias("violations"),
    )


def _broken(c: NotNull | Rule | Domain) -> Column:
    if isinstance(c, NotNull):
        return F.col(c.column).isNull()
    return ~F.expr(c.predicate) if isinstance(c, Rule) else ~F.col(c.column).isin(*c.values)


def _name(c: Constraint) -> str:
    if isinstance(c, NotNull):
        return f"not_null({c.column})"
    if isinstance(c, Rule):
        return f"check({c.name})"
    if isinstance(c, Domain):
        return f"domain({c.column})"
    if isinstance(c, Unique):
        return f"unique({','.join(c.columns)})"
    if isinstance(c, ForeignKey):
        return f"foreign_key({c.column})"
    return f"agreement({c.column},{c.parent}.{c.value})"
