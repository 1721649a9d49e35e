from __future__ import annotations

import pytest
from bank_data import SALT

from starflat.operators.flatten import flatten
from starflat.operators.guards import (
    GuardViolation,
    enforce_guards,
    guard_report,
    require_money,
)
from starflat.operators.sinks import with_iso_times
from starflat.plans import bank


def counts(df, **guards):
    rows = guard_report(df, **guards).collect()
    return {(r["guard"], r["column_name"]): r["violations"] for r in rows}


def test_flat_table_is_safe(tiny):
    flat = with_iso_times(flatten(tiny, bank.gold_star(SALT)))
    report = guard_report(
        flat,
        masked=["card_masked"],
        hashed=["card_hash", "email_hash"],
        iso_times=["txn_time", "card_created", "account_created"],
    ).collect()
    enforce_guards(report)
    assert {r["violations"] for r in report} == {0}


def test_raw_numbers_are_found_in_every_row(spark):
    # Far more rows than a sample would read; the leak is in the last one.
    df = spark.range(0, 5000).selectExpr(
        "concat('text ', id) AS note",
        "if(id = 4999, 'card 2600111122223333 paid', 'nothing') AS memo",
    )
    assert counts(df) == {("pan", "note"): 0, ("pan", "memo"): 1}


def test_seventeen_digits_are_no_card_number(spark):
    df = spark.createDataFrame([("12345678901234567",), ("x1234567890123456",)], "s STRING")
    assert counts(df) == {("pan", "s"): 0}


def test_masks_and_hashes(spark):
    df = spark.createDataFrame(
        [("260011******3333", "a" * 64), ("******1234", "A" * 64), ("2600*", "xyz"), ("", None)],
        "m STRING, h STRING",
    )
    found = counts(df, masked=["m"], hashed=["h"], scan_pan=False)
    assert found == {("mask", "m"): 1, ("hash", "h"): 2}


def test_times_without_z_raise(spark):
    df = spark.createDataFrame([("2024-01-01T00:00:00",)], "t STRING")
    with pytest.raises(GuardViolation, match="iso_time"):
        enforce_guards(guard_report(df, iso_times=["t"]).collect())


def test_money_type(spark):
    require_money(spark.sql("SELECT CAST(1 AS DECIMAL(20,2)) AS a"), ["a"])
    for other in ("DOUBLE", "DECIMAL(10,2)"):
        with pytest.raises(TypeError):
            require_money(spark.sql(f"SELECT CAST(1 AS {other}) AS a"), ["a"])
