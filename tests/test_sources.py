from __future__ import annotations

from datetime import datetime

from types import SimpleNamespace

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from starflat.sources import jdbc, synthetic
from starflat.sources.partitioning import POLICIES, key_bounds, partition_plan


def partitions(spark, role, lower, upper):
    bounds = spark.createDataFrame([(lower, upper)], "lower_bound BIGINT, upper_bound BIGINT")
    return partition_plan(bounds, POLICIES[role]).first()["partitions"]


@pytest.mark.parametrize(
    ("role", "n", "expected"),
    [
        ("transaction", 5_000, 6),
        ("transaction", 50_000, 8),
        ("transaction", 500_000, 10),
        ("member", 2_000, 2),
        ("member", 999, 1),
        ("card", 3, 1),
        ("transaction", 1, 1),
    ],
)
def test_partition_counts(spark, role, n, expected):
    assert partitions(spark, role, 1, n) == expected


def test_no_keys_no_partitions(spark):
    bounds = key_bounds(spark.createDataFrame([], "id INT"), "id")
    assert tuple(partition_plan(bounds, POLICIES["card"]).first()) == (None, None, None)


@settings(
    max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(st.integers(-(10**9), 10**9), st.integers(0, 10**9), st.sampled_from(sorted(POLICIES)))
def test_partition_counts_stay_in_range(spark, lower, size, role):
    found = partitions(spark, role, lower, lower + size)
    assert 1 <= found <= min(POLICIES[role].max_connections, size + 1)


SOURCE = jdbc.JdbcSource("jdbc:x://host/db", "reader", "secret", "org.example.Driver")


def test_jdbc_options():
    assert SOURCE.options("t")["dbtable"] == "t"
    assert jdbc.range_options("id", 1, 500, 8) == {
        "partitionColumn": "id",
        "lowerBound": "1",
        "upperBound": "501",
        "numPartitions": "8",
    }
    assert jdbc.range_options("id", None, None, None) == {}
    assert "secret" not in repr(SOURCE)


def test_bounds_of_a_slice():
    query = jdbc.bounds_query("bank.txn", "id", ("created", datetime(2024, 3, 1, 4)))
    assert query.endswith("FROM bank.txn WHERE created >= TIMESTAMP '2024-03-01 04:00:00') key_bounds")
    with pytest.raises(ValueError):
        jdbc.bounds_query("bank.txn", "id", ("1=1 --", datetime(2024, 3, 1)))


def test_bounds_are_a_subquery():
    assert jdbc.bounds_query("bank.txn", "id") == (
        "(SELECT MIN(id) AS lower_bound, MAX(id) AS upper_bound FROM bank.txn) key_bounds"
    )


class Reader:
    """Stands in for ``spark.read``: records options, hands out prepared frames."""

    def __init__(self, *frames):
        self.frames = list(frames)
        self.calls = []

    def format(self, name):
        assert name == "jdbc"
        return self

    def options(self, **options):
        self.calls.append(options)
        return self

    def load(self):
        return self.frames.pop(0)


def test_jdbc_reads_bounds_then_ranges(spark):
    bounds = spark.createDataFrame([(1, 50_000)], "LOWER_BOUND INT, UPPER_BOUND INT")
    reader = Reader(bounds, "table")
    session = SimpleNamespace(read=reader)
    policy = POLICIES["transaction"]
    assert jdbc.read_partitioned(session, SOURCE, "txn", "id", policy) == "table"
    assert reader.calls[0]["dbtable"] == jdbc.bounds_query("txn", "id")
    assert reader.calls[1]["dbtable"] == "txn"
    assert reader.calls[1]["numPartitions"] == "8"
    assert reader.calls[1]["upperBound"] == "50001"


def test_jdbc_reads_an_empty_table_in_one_partition(spark):
    bounds = spark.createDataFrame([(None, None)], "LOWER_BOUND INT, UPPER_BOUND INT")
    reader = Reader(bounds, "table")
    jdbc.read_partitioned(SimpleNamespace(read=reader), SOURCE, "txn", "id", POLICIES["card"])
    assert "numPartitions" not in reader.calls[1]


def test_jdbc_probe(spark):
    jdbc.probe(SimpleNamespace(read=Reader(spark.range(1))), SOURCE)
    with pytest.raises(ConnectionError):
        jdbc.probe(SimpleNamespace(read=Reader(spark.range(0))), SOURCE)


@pytest.mark.parametrize("name", ["t; DROP TABLE x", "t WHERE 1=1", "", "a.b.c", "1t"])
def test_names_are_checked(name):
    with pytest.raises(ValueError):
        jdbc.bounds_query(name, "id")


@pytest.fixture(scope="module")
def generated(spark):
    members = spark.range(1, 301).select(F.col("id").alias("member_id"))
    accounts = synthetic.synthetic_accounts(members, 1, "2024-12-31")
    cards = synthetic.synthetic_cards(accounts, 1)
    return members, accounts, cards, synthetic.synthetic_transactions(cards, 1, "2024-12-31")


def test_generated_keys(generated):
    members, accounts, cards, txns = generated
    keys = ((accounts, "account_id"), (cards, "card_id"), (txns, "txn_id"), (cards, "number"))
    for df, key in keys:
        assert df.count() == df.select(key).distinct().count()
    assert accounts.join(members, "member_id", "left_anti").count() == 0
    assert cards.join(accounts, ["account_id", "member_id"], "left_anti").count() == 0
    assert txns.join(cards, "card_id", "left_anti").count() == 0


def test_generated_shape(generated):
    _, accounts, cards, txns = generated
    per_member = accounts.groupBy("member_id").count().agg(F.min("count"), F.max("count")).first()
    assert tuple(per_member) == (1, 4)
    per_card = txns.groupBy("card_id").count().agg(F.min("count"), F.max("count")).first()
    assert tuple(per_card) == (3, 12)
    assert cards.filter(~F.col("number").rlike(r"^[26]\d{15}$")).count() == 0
    assert cards.filter("card_type = 'debit' AND credit_limit <> 0").count() == 0
    assert cards.filter("expires <= created").count() == 0
    assert txns.filter("(txn_type = 'refund') <> (amount < 0)").count() == 0
    shares = dict(txns.groupBy("txn_type").agg(F.count("*")).collect())
    total = sum(shares.values())
    assert 0.73 < shares["debit"] / total < 0.83
    ranges = {n: (lo, hi) for n, lo, hi in synthetic.CATEGORIES}
    found = txns.groupBy("category").agg(F.min(F.abs("amount")), F.max(F.abs("amount"))).collect()
    assert {r[0] for r in found} == set(ranges)
    assert all(ranges[n][0] <= lo <= hi <= ranges[n][1] for n, lo, hi in found)


def test_generated_rows_do_not_depend_on_partitions(spark, generated):
    members, _, _, txns = generated
    other = members.repartition(7).orderBy(F.desc("member_id"))
    accounts = synthetic.synthetic_accounts(other, 1, "2024-12-31")
    again = synthetic.synthetic_transactions(
        synthetic.synthetic_cards(accounts, 1), 1, "2024-12-31"
    )
    digest = F.sum(F.xxhash64(*txns.columns).cast("decimal(38,0)"))
    assert again.agg(digest).first() == txns.agg(digest).first()
