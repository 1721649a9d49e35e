"""Last checks on the output: no card number leaks, formats hold, money is exact."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row, types as T
from pyspark.sql import functions as F

from starflat.functions.masking import HASH_PATTERN, MASK_PATTERN, PAN_LENGTH, PAN_PATTERN
from starflat.functions.numbers import MONEY
from starflat.functions.times import ISO_UTC_PATTERN


_NO_GUARDS = "array<struct<guard:string,column_name:string,violations:bigint>>"


class GuardViolation(Exception):
    """Output rows broke a guard; ``report`` holds the guards that failed."""

    def __init__(self, report: list[Row]):
        self.report = report
        names = ", ".join(
            f"{r['guard']}({r['column_name']}): {r['violations']}" for r in report
        )
        super().__init__(f"output guards failed: {names}")


def guard_counts(
    df: DataFrame,
    masked: Sequence[str] = (),
    hashed: Sequence[str] = (),
    iso_times: Sequence[str] = (),
    scan_pan: bool = True,
) -> Column:
    """An aggregate: array of ``(guard, column_name, violations)`` over all rows.

    NULL and empty values pass. The scan for card numbers covers every string
    column without another guard; values that pass one of those hold none.
    """
    rows = []
    for name in masked:
        rows.append(_row("mask", name, _broken(name, MASK_PATTERN)))
    for name in hashed:
        rows.append(_row("hash", name, _broken(name, HASH_PATTERN)))
    for name in iso_times:
        rows.append(_row("iso_time", name, _broken(name, ISO_UTC_PATTERN)))
    if scan_pan:
        guarded = {*masked, *hashed, *iso_times}
        for name in string_columns(df):
            if name in guarded:
                continue
            rows.append(_row("pan", name, has_pan(F.col(name))))
    return F.array(*rows) if rows else F.array().cast(_NO_GUARDS)


def guard_report(df: DataFrame, **guards) -> DataFrame:
    """The result of ``guard_counts`` as rows."""
    return df.agg(guard_counts(df, **guards).alias("r")).select(F.inline("r"))


def enforce_guards(report: Sequence[Row]) -> None:
    """Raises ``GuardViolation`` unless every guard counts zero."""
    broken = [row for row in report if row["violations"] > 0]
    if broken:
        raise GuardViolation(broken)


def require_money(df: DataFrame, columns: Sequence[str]) -> None:
    """Money must be DECIMAL(20,2); looks at the schema only."""
    wrong = [c for c in columns if df.schema[c].dataType != MONEY]
    if wrong:
        raise TypeError(f"not {MONEY.simpleString()}: {', '.join(wrong)}")


def has_pan(text: Column) -> Column:
    """A run of exactly sixteen digits anywhere in the text."""
    return (F.length(text) >= PAN_LENGTH) & text.rlike(PAN_PATTERN)


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def _broken(name: str, pattern: str) -> Column:
    # One match per value, the empty string included.
    return ~F.col(name).rlike(f"^$|{pattern}")


def _row(guard: str, name: str, broken: Column) -> Column:
    return F.struct(
        F.lit(guard).alias("guard"),
        F.lit(name).alias("column_name"),
        F.count_if(broken).alias("violations"),
    )
