"""Dates whose source or dimension rows changed are found and loaded again, and only those."""

from __future__ import annotations

from datetime import timedelta
from decimal import Decimal

import pytest
from bank_data import ACCOUNT, CARD, MEMBER, TRANSACTION, at
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from test_runs import make_job, published, with_rows

from starflat.operators import manifest, publish, reconcile
from starflat.operators.publish import read_published
from starflat.plans import bank
from starflat.plans.runs import run, stale_report
from starflat.sources.tables import local_rows

DAYS = [(i, f"2024-03-{1 + i:02d} 10:00") for i in range(20)]


def content(spark, folder):
    return sorted(map(str, read_published(spark, folder, "transaction").collect()))


def full_content(spark, frames, folder, job):
    from dataclasses import replace

    other = replace(job, base=f"{folder}-full")
    run(spark, frames, other, "full")
    return content(spark, f"{folder}-full")


def run_of_dates(spark, folder):
    state = publish.published_state(spark, folder, "transaction")
    return {r["event_date"]: r["run_seq"] for r in manifest.snapshot(spark, folder, "transaction", state).collect()}


def test_drift_is_found_and_only_its_dates_are_written(spark, tiny, folder):
    job = make_job(folder, suites={})
    run(spark, with_rows(spark, tiny, DAYS), job, "full")
    drifted = [r for r in DAYS if r[0] not in (4, 7)]  # two dates lose their only row
    drifted += [(50, "2024-03-02 23:30"), (51, "2023-12-31 10:00")]  # late rows, one on a new date
    frames = with_rows(spark, tiny, drifted)
    frames["transaction"] = frames["transaction"].withColumn(
        "amount", F.when(F.col("txn_id") == 11, Decimal("7.00")).otherwise(F.col("amount")).cast("decimal(10,2)")
    )
    state = publish.published_state(spark, folder, "transaction")
    report = {r["event_date"]: r["reason"] for r in stale_report(spark, frames, job, state).collect()}
    # 23:30 local is the next date in UTC.
    want = {"2024-03-03": "more", "2023-12-31": "new", "2024-03-05": "gone", "2024-03-08": "gone", "2024-03-12": "changed"}
    assert report == want
    result = run(spark, frames, job, "reconcile")
    assert result.rows_in == 4
    assert content(spark, folder) == full_content(spark, frames, folder, job)
    assert {d for d, seq in run_of_dates(spark, folder).items() if seq == 2} == set(want)
    again = run(spark, frames, job, "reconcile")
    assert again.rows_in == 0 and content(spark, folder) == content(spark, f"{folder}-full")


def test_deleted_rows_alone(spark, tiny, folder):
    job = make_job(folder, suites={})
    run(spark, with_rows(spark, tiny, DAYS[:3]), job, "full")
    result = run(spark, with_rows(spark, tiny, DAYS[:2]), job, "reconcile")
    assert (result.rows_in, published(spark, folder)) == (0, [0, 1])
    run(spark, with_rows(spark, tiny, DAYS[:3]), job, "reconcile")
    assert published(spark, folder) == [0, 1, 2]


def test_missing_times_are_a_date_of_their_own(spark, tiny, folder):
    job = make_job(folder, suites={})

    def frames(ids):
        out = with_rows(spark, tiny, [(i, "2024-03-01 10:00") for i in (1, 2, *ids)])
        out["transaction"] = out["transaction"].withColumn("txn_time", F.when(F.col("txn_id") < 10, F.col("txn_time")))
        return out

    run(spark, frames([10]), job, "full")
    assert published(spark, folder) == [1, 2, 10]
    result = run(spark, frames([10, 11]), job, "reconcile")
    assert (result.rows_in, published(spark, folder)) == (2, [1, 2, 10, 11])


def test_without_a_first_load_everything_is_loaded(spark, tiny, folder):
    run(spark, tiny, make_job(folder), "reconcile")
    assert published(spark, folder) == [1, 2, 3, 4, 5]


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 3), st.one_of(st.none(), st.text(max_size=2))), max_size=6),
       st.lists(st.tuples(st.integers(0, 3), st.one_of(st.none(), st.text(max_size=2))), max_size=6))
def test_digests_differ_where_rows_do(spark, left, right):
    def frame(rows):
        return spark.createDataFrame([(at("2024-01-01") + timedelta(days=d), x) for d, x in rows], "t TIMESTAMP_NTZ, x STRING")

    stored = reconcile.date_digests(frame(left).repartition(3), "t", "UTC")
    found = {r["event_date"] for r in reconcile.differing_dates(reconcile.date_digests(frame(right), "t", "UTC"), stored).collect()}
    key = lambda rows, d: sorted(str(x) + str(x is None) for e, x in rows if e == d)
    assert found == {f"2024-01-0{d + 1}" for d in range(4) if key(left, d) != key(right, d)}


def test_a_moved_null_changes_the_hash(spark):
    df = spark.createDataFrame([(None, "a"), ("a", None)], "x STRING, y STRING")
    assert df.select(reconcile.row_hash(df).alias("h")).distinct().count() == 2


def star_frames(spark, tiny):
    return with_rows(spark, tiny, []) | {
        "transaction": local_rows(
            spark, [(i, Decimal("1.00"), "x", at(f"2024-03-{1 + i:02d} 10:00"), 1 + i % 4, "debit") for i in range(20)], TRANSACTION
        )
    }


def changes(spark, frames):
    """A renamed member (reached over card and account), an account of another type, a card that goes and one that comes."""
    member = frames["member"]
    return {
        "member": {**frames, "member": member.withColumn("first_name", F.when(F.col("member_id") == 2, "Inês").otherwise(F.col("first_name")))},
        "account": {**frames, "account": frames["account"].withColumn("account_type", F.when(F.col("account_id") == 1, "old").otherwise(F.col("account_type")))},
        "gone": {**frames, "card": frames["card"].filter("card_id <> 3")},
    }


@pytest.mark.parametrize("what", ["member", "account", "gone"])
def test_changed_dimension_rows_reach_old_dates(spark, tiny, folder, what):
    job = make_job(folder, suites={}, follow_dimensions=True, lookback_days=1)
    frames = star_frames(spark, tiny)
    run(spark, frames, job, "full")
    changed = changes(spark, frames)[what]
    run(spark, changed, job, "incremental")
    assert content(spark, folder) == full_content(spark, changed, folder, job)
    rewritten = {d for d, seq in run_of_dates(spark, folder).items() if seq == 2}
    cards = {"member": (1,), "account": (3,), "gone": (2,)}[what]
    hit = {f"2024-03-{1 + i:02d}" for i in range(20) if i % 4 in cards}
    assert rewritten == hit | {"2024-03-19", "2024-03-20"}  # those and the look-back
    # Back again: a dimension row that comes reaches the dates, too.
    run(spark, frames, job, "incremental")
    assert content(spark, folder) == full_content(spark, frames, f"{folder}-b", job)


def test_the_walk_joins_keys_only(spark, tiny):
    frames = star_frames(spark, tiny)
    empty = {t: spark.createDataFrame([], "key STRING") for t in ("member", "account", "card")}
    dates = reconcile.affected_dates(frames, bank.gold_star("s"), empty, "txn_time", bank.SOURCE_ZONE)
    assert dates.count() == 0
    one = {**empty, "member": spark.createDataFrame([("3",)], "key STRING")}
    dates = reconcile.affected_dates(frames, bank.gold_star("s"), one, "txn_time", bank.SOURCE_ZONE)
    assert sorted(r["event_date"] for r in dates.collect()) == [f"2024-03-{d:02d}" for d in (4, 8, 12, 16, 20)]


def test_duplicate_keys_add_up(spark):
    twice = spark.createDataFrame([(1, "a"), (1, "b")], "k INT, x STRING")
    now = reconcile.key_digests(twice, "k")
    assert reconcile.changed_keys(now, reconcile.key_digests(twice.orderBy("x"), "k")).count() == 0
    assert reconcile.changed_keys(now, reconcile.key_digests(twice.limit(1), "k")).count() == 1
    assert {MEMBER, ACCOUNT, CARD}
