"""What the physical plans must look like, with and without broadcasts."""

from __future__ import annotations

import re
from datetime import date

import pytest

from starflat.operators.checks import run_checks
from starflat.plans import bank
from starflat.plans.catalog import QUERIES
from starflat.sources.incremental import missed_rows, slice_since
from starflat.sources.tables import read_table

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


@pytest.fixture()
def no_broadcast(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


def simple(df) -> str:
    return df._jdf.queryExecution().simpleString()


def test_the_fact_is_shuffled_once(spark, no_broadcast):
    text = simple(QUERIES["flat_star"](spark, SF))
    # One exchange each: fact, card by account, by holder and by card id, account, member.
    assert text.count("Exchange hashpartitioning") == 6
    assert len(re.findall(r"Exchange hashpartitioning\(transaction__", text)) == 1
    assert "CartesianProduct" not in text and "BroadcastNestedLoop" not in text


def test_only_needed_columns_are_read(spark):
    text = plan(QUERIES["flat_star"](spark, SF))
    read = re.findall(r"ReadSchema: struct<([^>]*)>", text)
    assert not any("l_discount" in r or "c_acctbal" in r or "o_totalprice" in r for r in read)


def test_the_date_range_reaches_the_scan(spark):
    text = plan(QUERIES["spend_in_range"](spark, SF))
    assert re.search(r"PushedFilters: .*GreaterThanOrEqual\(l_shipdate,", text)


def test_the_date_range_of_the_sql_reaches_the_scan(spark):
    text = plan(QUERIES["spend_in_range_sql"](spark, SF))
    assert re.search(r"PushedFilters: .*GreaterThanOrEqual\(l_shipdate,1997-12-31", text)
    assert re.search(r"PushedFilters: .*LessThanOrEqual\(l_shipdate,1999-01-02", text)


def test_late_rows_are_looked_for_in_old_data_only(spark, folder):
    events = read_table(spark, SF, "events")
    dated = events.select("event_id", events["ts"].cast("date").alias("event_date"))
    dated.write.partitionBy("event_date").parquet(folder)
    published = spark.read.parquet(folder)
    late = missed_rows(
        events, "ts", bank.SOURCE_ZONE, date(2024, 1, 10), "event_id", published, "event_id"
    )
    text = plan(late)
    assert re.search(r"PushedFilters: .*LessThan\(ts,2024-01-11", text)
    assert re.search(r"PartitionFilters: \[.*event_date.* < 2024-01-10", text)


def test_the_look_back_reaches_the_scan(spark):
    events = read_table(spark, SF, "events")
    text = plan(slice_since(events, "ts", bank.SOURCE_ZONE, date(2024, 1, 20)))
    assert re.search(r"PushedFilters: .*GreaterThanOrEqual\(ts,2024-01-19", text)


def test_partitions_are_pruned(spark):
    text = plan(QUERIES["parquet_pruned_read"](spark, SF))
    assert re.search(r"PartitionFilters: \[.*event_date.*2024-01-10", text)


@pytest.mark.parametrize(
    "name",
    [
        "member_stats",
        "member_stats_raw",
        "card_balance",
        "population_summary",
        "spend_by_category",
        "spend_in_range",
    ],
)
def test_transactions_are_summed_before_the_first_join(spark, no_broadcast, name):
    text = simple(QUERIES[name](spark, SF))
    below = text[: text.index("lineitem.parquet")]
    partial = below.rindex("functions=[partial_")
    assert partial > below.rindex("SortMergeJoin")
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_scanning_checks_share_one_scan(spark):
    checks = [c for c in bank.suites()["member"] if c.kind == "consistency"]
    text = simple(run_checks(bank.members(spark, SF), "member", checks))
    assert text.count("FileScan") == 1


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_joins(spark, no_broadcast, name):
    if name in ("incremental_merge", "quarantine_late", "full_publish", "stream_merge", "stream_late_dimension"):
        pytest.skip("returns a table it wrote")
    text = simple(QUERIES[name](spark, SF))
    assert "CartesianProduct" not in text and "NestedLoop" not in text
    assert "BatchEvalPython" not in text and "ArrowEvalPython" not in text
