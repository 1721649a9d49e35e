from __future__ import annotations

from decimal import Decimal

import pytest

from starflat.operators import checks
from starflat.operators.checks import Rejected, gate, run_checks, run_suites, status_summary
from starflat.operators.metrics import check_metrics
from starflat.plans import bank


def one(df, check):
    (row,) = run_checks(df, "t", [check]).collect()
    return row["status"], row["value"]


@pytest.fixture(scope="module")
def examples(spark):
    """Five transactions, one of them negative."""
    rows = [(1, "12.25", 7), (2, "310.00", 7), (3, "-46.80", 8), (4, "5.05", 9), (5, "12.25", 7)]
    rows = [(i, Decimal(a), c) for i, a, c in rows]
    return spark.createDataFrame(rows, "txn_id INT, amount DECIMAL(10,2), card_id INT")


@pytest.fixture(scope="module")
def texts(spark):
    rows = [("2600111122223333",), ("123",), ("",), (None,)]
    return spark.createDataFrame(rows, "x STRING")


def test_document_example(examples):
    results = run_checks(
        examples,
        "transaction",
        [
            checks.completeness_check(["txn_id", "amount", "card_id"]),
            checks.negative_check("amount"),
            checks.extreme_check("amount", 0.01, 100000.0),
            checks.duplicate_check(["txn_id", "card_id"]),
        ],
    )
    found = {r["check_name"]: (r["status"], r["value"]) for r in gate(results)}
    assert found == {
        "completeness": ("PASS", 1.0),
        "negative": ("WARN", 0.2),
        "extreme": ("WARN", 0.2),
        "duplicate": ("PASS", 0.0),
    }


def test_null(texts):
    assert one(texts, checks.null_check("x")) == ("FAIL", 0.25)
    assert one(texts, checks.null_check("x", threshold=0.25)) == ("PASS", 0.25)


def test_format(texts):
    assert one(texts, checks.format_check("x", r"^\d{16}$")) == ("WARN", 0.75)
    assert one(texts, checks.format_check("x")) == ("WARN", 0.5)


def test_consistency(texts):
    assert one(texts, checks.consistency_check("x")) == ("FAIL", 0.5)


def test_duplicates_count_null_as_a_value(spark):
    df = spark.createDataFrame([(1, None), (1, None), (1, 2), (2, 2)], "a INT, b INT")
    assert one(df, checks.duplicate_check(["a", "b"])) == ("FAIL", 0.25)
    assert one(df, checks.duplicate_check(["a"])) == ("FAIL", 0.5)
    found = checks.duplicate_rows(df, ["a", "b"]).collect()
    assert [tuple(r) for r in found] == [(1, None, 2)]


def test_extreme_reads_text_and_reports_no_numbers(spark, texts):
    df = spark.createDataFrame([("1",), ("500",), ("x",)], "x STRING")
    assert one(df, checks.extreme_check("x", 0, 100)) == ("WARN", 1 / 3)
    nothing = spark.createDataFrame([("a",), (None,)], "x STRING")
    assert one(nothing, checks.extreme_check("x", 0, 100)) == ("WARN", 1.0)
    dates = spark.sql("SELECT DATE '2024-01-01' AS x")
    assert one(dates, checks.extreme_check("x", 0, 100)) == ("WARN", 1.0)


def test_extreme_bounds_are_inclusive(spark):
    df = spark.createDataFrame([(0.01,), (100000.0,)], "x DOUBLE")
    assert one(df, checks.extreme_check("x", 0.01, 100000.0)) == ("PASS", 0.0)


@pytest.mark.parametrize(
    ("previous", "rows", "expected"),
    [
        (None, 4, ("PASS", 0.0)),
        (8, 4, ("PASS", 0.5)),
        (9, 4, ("WARN", 5 / 9)),
        (0, 4, ("WARN", 1.0)),
        (0, 0, ("PASS", 0.0)),
        (5, 0, ("WARN", 1.0)),
    ],
)
def test_volume(spark, previous, rows, expected):
    assert one(spark.range(rows), checks.volume_check(previous)) == expected


def test_empty_tables_pass(spark):
    empty = spark.createDataFrame([], "x STRING, n INT")
    found = run_checks(
        empty,
        "t",
        [
            checks.null_check("x"),
            checks.negative_check("n"),
            checks.extreme_check("n", 1, 2),
            checks.format_check("x"),
            checks.consistency_check("x"),
            checks.duplicate_check(["x"]),
        ],
    ).collect()
    assert {(r["status"], r["value"]) for r in found} == {("PASS", 0.0)}


def test_missing_columns_fail_and_the_other_checks_run(spark):
    df = spark.createDataFrame([(1,), (None,)], "a INT")
    suite = [
        checks.completeness_check(["a", "b"]),
        checks.null_check("b"),
        checks.extreme_check("b", 1, 2),
        checks.duplicate_check(["a", "b"]),
        checks.null_check("a", 0.1),
        checks.duplicate_check(["a"]),
    ]
    found = run_checks(df, "t", suite).collect()
    assert [(r["check_name"], r["column_name"], r["status"], r["message"]) for r in found] == [
        ("completeness", "a,b", "FAIL", "1 missing columns"),
        ("null", "b", "FAIL", "column missing: b"),
        ("extreme", "b", "FAIL", "column missing: b"),
        ("duplicate", "a,b", "FAIL", "column missing: b"),
        ("null", "a", "FAIL", "1 of 2 rows"),
        ("duplicate", "a", "PASS", "0 of 2 rows"),
    ]


def test_completeness_alone_reads_nothing(spark):
    df = spark.range(10).selectExpr("id", "raise_error('read') AS boom")
    found = run_checks(df, "t", [checks.completeness_check(["id", "boom"])]).collect()
    assert [(r["status"], r["value"], r["total_rows"]) for r in found] == [("PASS", 1.0, None)]


def test_negative_numbers_in_text(spark):
    df = spark.createDataFrame([("-1",), ("2",), ("x",), (None,)], "a STRING")
    assert one(df, checks.negative_check("a")) == ("WARN", 0.25)


def test_gate_sees_every_table(spark, tiny):
    bad_member = tiny["member"].selectExpr(
        "member_id", "first_name", "last_name", "age", "CAST(NULL AS STRING) AS email"
    )
    # The failing table is not the last one.
    results = run_suites({**tiny, "member": bad_member}, bank.suites())
    with pytest.raises(Rejected) as error:
        gate(results)
    assert [(r["table_name"], r["column_name"]) for r in error.value.failed] == [
        ("member", "email")
    ]
    assert len(error.value.results) == 14


def test_warnings_do_not_reject(tiny):
    results = run_suites(tiny, bank.suites(previous_transactions=100))
    assert {r["status"] for r in gate(results)} == {"PASS", "WARN"}
    assert sorted(tuple(r) for r in status_summary(results).collect()) == [
        ("FAIL", 0),
        ("PASS", 13),
        ("WARN", 1),
    ]
    assert tuple(check_metrics(results).first()) == (14, 0, 1)


def test_a_suite_is_one_action(spark, tiny):
    spark.sparkContext.setJobGroup("suite", "suite")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        results = run_suites({"member": tiny["member"]}, {"member": bank.suites()["member"]})
        assert len(results.collect()) == 3
        jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("suite")
        assert len(jobs) == 1
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
