"""Data-quality checks compiled to few aggregates, and the reject gate.

All checks of a table that look at single rows share one aggregate over one
scan. A duplicate check groups by its keys in a branch of its own: in the
shared aggregate every partial state would be shuffled once per distinct key.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from starflat.functions import as_double, ratio

RESULT_COLUMNS = (
    "table_name",
    "check_name",
    "column_name",
    "status",
    "value",
    "threshold",
    "bad_rows",
    "total_rows",
    "message",
)


@dataclass(frozen=True)
class Check:
    """``kind`` on ``columns``; above ``threshold`` the status is ``level``."""

    kind: str
    columns: tuple[str, ...]
    threshold: float
    level: str
    low: float | None = None
    high: float | None = None
    pattern: str | None = None
    previous: int | None = None


def null_check(column: str, threshold: float = 0.01) -> Check:
    return Check("null", (column,), threshold, "FAIL")


def negative_check(column: str, threshold: float = 0.0) -> Check:
    return Check("negative", (column,), threshold, "WARN")


def extreme_check(column: str, low: float | None = None, high: float | None = None) -> Check:
    return Check("extreme", (column,), 0.0, "WARN", low=low, high=high)


def format_check(column: str, pattern: str | None = None, threshold: float = 0.05) -> Check:
    return Check("format", (column,), threshold, "WARN", pattern=pattern)


def consistency_check(column: str, threshold: float = 0.05) -> Check:
    return Check("consistency", (column,), threshold, "FAIL")


def duplicate_check(columns: Sequence[str], threshold: float = 0.0) -> Check:
    return Check("duplicate", tuple(columns), threshold, "FAIL")


def volume_check(previous: int | None, tolerance: float = 0.5) -> Check:
    """``previous`` is the row count of the last run, None on the first."""
    return Check("volume", (), tolerance, "WARN", previous=previous)


def completeness_check(required: Sequence[str]) -> Check:
    return Check("completeness", tuple(required), 1.0, "FAIL")


class Rejected(Exception):
    """The gate found failed checks; ``results`` holds all check results."""

    def __init__(self, results: list[Row]):
        self.results = results
        self.failed = [r for r in results if r["status"] == "FAIL"]
        names = ", ".join(
            f"{r['table_name']}.{r['check_name']}({r['column_name']})" for r in self.failed
        )
        super().__init__(f"failed checks: {names}")


def run_checks(df: DataFrame, table: str, checks: Iterable[Check]) -> DataFrame:
    """One row per check, in ``RESULT_COLUMNS``.

    A check on a column that ``df`` lacks fails; all others run. Completeness is a
    question to the schema: alone it reads no row, and its row count is NULL.
    """
    checks = list(checks)
    scanned = [c for c in checks if c.kind != "duplicate" or _missing(df, c)]
    if all(c.kind == "completeness" for c in scanned):
        branches = [_schema_branch(df, table, scanned)] if scanned else []
    else:
        branches = [_scan_branch(df, table, scanned)]
    branches += [_duplicate_branch(df, table, c) for c in checks if c not in scanned]
    if not branches:
        raise ValueError(f"no checks for table {table}")
    return reduce(DataFrame.unionByName, branches)


def run_suites(
    frames: Mapping[str, DataFrame], suites: Mapping[str, Iterable[Check]]
) -> DataFrame:
    """The results of every table's suite in one frame."""
    parts = [run_checks(frames[table], table, checks) for table, checks in suites.items()]
    return reduce(DataFrame.unionByName, parts)


def gate(results: DataFrame) -> list[Row]:
    """The check results, one row per check; raises ``Rejected`` if any failed."""
    rows = results.collect()
    if any(r["status"] == "FAIL" for r in rows):
        raise Rejected(rows)
    return rows


def status_summary(results: DataFrame) -> DataFrame:
    """Number of checks per status; statuses without checks count 0."""
    rows = [
        F.struct(F.lit(s).alias("status"), F.count_if(F.col("status") == s).alias("checks"))
        for s in ("PASS", "WARN", "FAIL")
    ]
    return results.agg(F.array(*rows).alias("r")).select(F.inline("r"))


def duplicate_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Key values found more than once, with their number of rows."""
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")


def volume_change(current: Column, previous: Column) -> Column:
    """|current - previous| / previous; no previous run gives 0, previous 0 gives 0 or 1."""
    return (
        F.when(previous.isNull(), F.lit(0.0))
        .when(previous == 0, F.when(current == 0, F.lit(0.0)).otherwise(F.lit(1.0)))
        .otherwise(ratio(F.abs(current - previous), previous))
    )


def volume_status(current: Column, previous: Column, tolerance: float) -> Column:
    broken = (volume_change(current, previous) > tolerance) | (
        F.coalesce(previous == 0, F.lit(False)) & (current > 0)
    )
    return F.when(broken, F.lit("WARN")).otherwise(F.lit("PASS"))


def _missing(df: DataFrame, check: Check) -> list[str]:
    return [c for c in check.columns if c not in df.columns]


def _broken(df: DataFrame, check: Check) -> bool:
    """The check cannot run because a column of it is missing."""
    return check.kind != "completeness" and bool(_missing(df, check))


def _bad_rows(df: DataFrame, check: Check) -> Column:
    if _broken(df, check):
        return F.count(F.lit(1))
    if check.kind in ("completeness", "volume"):
        return F.lit(len(_missing(df, check))).cast("bigint")
    column = F.col(check.columns[0])
    if check.kind == "null":
        return F.count_if(column.isNull())
    if check.kind == "negative":
        return F.count_if(_number(df, check) < 0)
    if check.kind == "extreme":
        number = _number(df, check)
        outside = F.lit(False)
        if check.low is not None:
            outside = outside | (number < check.low)
        if check.high is not None:
            outside = outside | (number > check.high)
        return F.count_if(outside)
    filled = F.coalesce(F.length(column) > 0, F.lit(False))
    if check.kind == "format":
        good = filled & column.rlike(check.pattern) if check.pattern else filled
        return F.count_if(~F.coalesce(good, F.lit(False)))
    if check.kind == "consistency":
        return F.count_if(~filled)
    raise ValueError(f"unknown check: {check.kind}")


def _number(df: DataFrame, check: Check) -> Column:
    name = check.columns[0]
    number = as_double(F.col(name), df.schema[name].dataType)
    if number is None:
        return F.lit(None).cast("double")
    return number


def _scan_branch(df: DataFrame, table: str, checks: Sequence[Check]) -> DataFrame:
    aggregates = [F.count(F.lit(1)).alias("n")]
    for i, check in enumerate(checks):
        aggregates.append(_bad_rows(df, check).alias(f"bad_{i}"))
        if check.kind == "extreme" and not _broken(df, check):
            aggregates.append(F.count(_number(df, check)).alias(f"valid_{i}"))
    rows = [_result(table, c, i, _broken(df, c) and _missing(df, c)) for i, c in enumerate(checks)]
    return df.agg(*aggregates).select(F.inline(F.array(*rows)))


def _schema_branch(df: DataFrame, table: str, checks: Sequence[Check]) -> DataFrame:
    counts = [F.lit(None).cast("bigint").alias("n")]
    counts += [_bad_rows(df, c).alias(f"bad_{i}") for i, c in enumerate(checks)]
    rows = [_result(table, c, i) for i, c in enumerate(checks)]
    return df.sparkSession.range(1).select(*counts).select(F.inline(F.array(*rows)))


def _duplicate_branch(df: DataFrame, table: str, check: Check) -> DataFrame:
    # NULL counts as a value: two rows with NULL keys are duplicates.
    groups = df.groupBy(*check.columns).agg(F.count(F.lit(1)).alias("copies"))
    counted = groups.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("n"),
        F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("bad_0"),
    )
    return counted.select(F.inline(F.array(_result(table, check, 0))))


def _result(table: str, check: Check, i: int, missing: Sequence[str] | bool = ()) -> Column:
    n, bad = F.col("n"), F.col(f"bad_{i}")
    value = ratio(bad, n)
    failed = value > check.threshold
    message = F.concat(bad.cast("string"), F.lit(" of "), n.cast("string"), F.lit(" rows"))
    if check.kind == "completeness":
        value = F.when(bad == 0, F.lit(1.0)).otherwise(F.lit(0.0))
        failed = bad > 0
        message = F.concat(bad.cast("string"), F.lit(" missing columns"))
    elif check.kind == "volume":
        previous = F.lit(check.previous).cast("bigint")
        value = volume_change(n, previous)
        failed = volume_status(n, previous, check.threshold) == "WARN"
        before = "no earlier run" if check.previous is None else f"{check.previous} before"
        message = F.concat(n.cast("string"), F.lit(f" rows, {before}"))
    elif check.kind == "extreme" and not missing:
        no_number = (n > 0) & (F.col(f"valid_{i}") == 0)
        value = F.when(no_number, F.lit(1.0)).otherwise(value)
        failed = no_number | failed
    status = F.when(failed, F.lit(check.level)).otherwise(F.lit("PASS"))
    if missing:
        status, value = F.lit("FAIL"), F.lit(1.0)
        message = F.lit(f"column missing: {', '.join(missing)}")
    values = (
        F.lit(table),
        F.lit(check.kind),
        F.lit(",".join(check.columns)),
        status,
        value,
        F.lit(float(check.threshold)),
        bad.cast("bigint"),
        n.cast("bigint"),
        message,
    )
    return F.struct(*(v.alias(name) for v, name in zip(values, RESULT_COLUMNS)))
