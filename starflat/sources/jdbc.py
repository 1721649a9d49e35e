"""Tables of a relational database over JDBC, read in parallel by key range.

Filters and column selections on the returned frames are pushed to the database
by Spark; a slice by time needs no SQL text of its own.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from starflat.sources.partitioning import PartitionPolicy, partition_plan

_NAME = re.compile(r"^[A-Za-z_][A-Za-z0-9_]*(\.[A-Za-z_][A-Za-z0-9_]*)?$")


@dataclass(frozen=True)
class JdbcSource:
    url: str
    user: str
    password: str = field(repr=False)
    driver: str
    fetch_size: int = 10_000

    def options(self, table: str) -> dict[str, str]:
        return {
            "url": self.url,
            "user": self.user,
            "password": self.password,
            "driver": self.driver,
            "fetchsize": str(self.fetch_size),
            "dbtable": table,
        }


def read_table(spark: SparkSession, source: JdbcSource, table: str) -> DataFrame:
    """The whole table over one connection."""
    return spark.read.format("jdbc").options(**source.options(_checked(table))).load()


def read_partitioned(
    spark: SparkSession,
    source: JdbcSource,
    table: str,
    column: str,
    policy: PartitionPolicy,
    since: tuple[str, datetime] | None = None,
) -> DataFrame:
    """The table in key ranges; an empty table is read in one partition.

    ``since`` (time column, first time) gives the ranges to the keys of a slice: over
    the whole table growing keys would put all new rows into the last range. Filter
    the result by the same predicate; Spark pushes it down.
    """
    query = bounds_query(table, column, since)
    bounds = spark.read.format("jdbc").options(**source.options(query)).load()
    plan = partition_plan(bounds.toDF("lower_bound", "upper_bound"), policy).first()
    options = {**source.options(_checked(table)), **range_options(column, *plan)}
    return spark.read.format("jdbc").options(**options).load()


def probe(spark: SparkSession, source: JdbcSource) -> None:
    """Raises unless the database answers a one-row query."""
    query = source.options("(SELECT 1 AS probe) probe_row")
    if spark.read.format("jdbc").options(**query).load().count() != 1:
        raise ConnectionError("the database did not answer the probe with one row")


def bounds_query(table: str, column: str, since: tuple[str, datetime] | None = None) -> str:
    """The one-row subquery that the database evaluates for the key range."""
    table, column = _checked(table), _checked(column)
    where = ""
    if since is not None:
        where = f" WHERE {_checked(since[0])} >= TIMESTAMP '{since[1]:%Y-%m-%d %H:%M:%S}'"
    return (
        f"(SELECT MIN({column}) AS lower_bound, MAX({column}) AS upper_bound"
        f" FROM {table}{where}) key_bounds"
    )


def range_options(
    column: str, lower: int | None, upper: int | None, partitions: int | None
) -> dict[str, str]:
    if partitions is None:
        return {}
    return {
        "partitionColumn": _checked(column),
        "lowerBound": str(lower),
        # Spark's upper bound only shapes the stride; one more covers the last key.
        "upperBound": str(upper + 1),
        "numPartitions": str(partitions),
    }


def _checked(name: str) -> str:
    if not _NAME.match(name):
        raise ValueError(f"not a plain table or column name: {name!r}")
    return name
