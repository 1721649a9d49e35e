from __future__ import annotations

from decimal import Decimal

import pytest
from bank_data import SALT, at
from pyspark.sql import functions as F

from starflat.functions.numbers import MONEY
from starflat.operators import constraints
from starflat.operators.flatten import Link, flatten, join_star
from starflat.operators.skew import HotKeys, SkewPolicy, find_hot_keys, salted_join
from starflat.plans import bank

EAGER = SkewPolicy(share=0.1, min_rows=1, rows_per_salt=1)


@pytest.fixture(scope="module")
def flat(tiny):
    return flatten(tiny, bank.gold_star(SALT))


def test_gold_columns(flat):
    assert tuple(flat.columns) == bank.GOLD_COLUMNS
    assert flat.schema["txn_amount"].dataType == MONEY
    assert "number" not in flat.columns and "email" not in flat.columns


def test_values(flat):
    rows = {r["txn_id"]: r for r in flat.collect()}
    assert {i: (r["member_first_name"], r["card_masked"]) for i, r in rows.items()} == {
        1: ("Tomás", "260011******3333"),
        2: ("Ines", "601155******7777"),
        3: ("Tomás", "271188******0000"),
        4: ("Luc", "650012******5432"),
        5: ("Ines", "601155******7777"),
    }
    assert rows[1]["txn_time"] == at("2025-03-10 00:10")
    assert rows[4]["txn_time"] == at("2025-02-25 09:30")
    assert rows[1]["card_created"] == at("2020-12-01 14:00")
    assert rows[4]["account_created"] == at("2022-05-02 11:05")
    assert rows[1]["event_date"] == at("2025-03-10").date()
    assert rows[1]["email_masked"] == "tom****@post.example"
    assert rows[1]["email_hash"].startswith("4704127c")
    assert rows[1]["card_hash"].startswith("995f1ccf")
    assert rows[4]["txn_description"] is None and rows[2]["member_age"] is None
    assert sum(r["txn_amount"] for r in rows.values()) == Decimal("828.74")


def test_no_row_is_lost(flat, tiny):
    assert flat.count() == tiny["transaction"].count() == 5


def test_two_and_three_way_joins(tiny):
    pairs = join_star(tiny, "transaction", bank.LINKS[:1])
    owned = join_star(tiny, "account", [Link("account", "owner_id", "member", "member_id")])
    cards = join_star(tiny, "card", bank.LINKS[1:])
    assert (pairs.count(), owned.count(), cards.count()) == (5, 4, 4)


def test_left_links_keep_rows(tiny):
    links = [Link("account", "account_id", "card", "account_id", how="left")]
    rows = join_star(tiny, "account", links).collect()
    found = [(r["account__account_id"], r["card__card_id"] or 0) for r in rows]
    assert sorted(found) == [(1, 4), (2, 1), (2, 3), (3, 2), (4, 0)]


def test_member_comes_from_the_card_not_the_account(spark, tiny):
    card = tiny["card"].replace({2: 3}, subset=["account_id"])
    rows = flatten({**tiny, "card": card}, bank.gold_star(SALT)).collect()
    by_id = {r["txn_id"]: r for r in rows}
    assert by_id[1]["member_first_name"] == "Tomás"
    assert by_id[1]["account_created"] == at("2021-01-31 15:00")


def test_orphans(spark, tiny):
    extra = spark.createDataFrame([(9, 77), (10, 77), (11, None)], "txn_id INT, card_id INT")
    txn = tiny["transaction"].select("txn_id", "card_id").union(extra)
    found = constraints.orphans(txn, "card_id", tiny["card"], "card_id").collect()
    assert [tuple(r) for r in found] == [(77, 2)]


def skewed(spark, hot: int = 400, rest: int = 200):
    rows = [(i, 1) for i in range(hot)] + [(hot + i, 2 + i % 50) for i in range(rest)]
    rows += [(-i, None) for i in range(1, 101)]
    left = spark.createDataFrame(rows, "id INT, k INT")
    right = spark.createDataFrame([(i, f"v{i}") for i in range(1, 40)], "key INT, v STRING")
    return left, right


def test_hot_keys_are_found(spark):
    left, _ = skewed(spark)
    hot = find_hot_keys(left, ["k"], SkewPolicy(share=0.1, min_rows=100, rows_per_salt=100))["k"]
    assert hot.salts == {1: 4}
    assert find_hot_keys(left, ["k"])["k"].salts == {}
    assert find_hot_keys(left, ["k"], SkewPolicy(share=0.1, min_rows=50))["k"].null_salts == 2


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize(
    "hot", [HotKeys({}), HotKeys({1: 7}), HotKeys({1: 3, 2: 2, 999: 5}, null_salts=4)]
)
def test_salted_join_is_the_plain_join(spark, how, hot):
    left, right = skewed(spark)
    plain = left.join(right, left["k"] == right["key"], how)
    salted = salted_join(left, right, "k", "key", hot, how)
    assert salted.columns == plain.columns
    assert sorted(map(str, salted.collect())) == sorted(map(str, plain.collect()))


def test_hot_rows_spread_over_salts(spark):
    left, right = skewed(spark)
    joined = salted_join(left, right, "k", "key", HotKeys({1: 8}))
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert "_salt" in plan
    # The salts that the rows of the hot key really get, and how evenly.
    spread = F.pmod(F.xxhash64(*left.columns), F.lit(8))
    counts = [r["count"] for r in left.filter("k = 1").groupBy(spread.alias("s")).count().collect()]
    assert len(counts) == 8 and max(counts) < 2 * min(counts)


def test_agreement_groups_equal_rows_before_the_join(spark):
    """Rows of one key that all agree: one row a task reaches the join."""
    child = spark.range(20_000).selectExpr("1 AS via", "7 AS direct").repartition(4)
    parent = spark.createDataFrame([(1, 7), (2, 8)], "key INT, value INT")
    rule = constraints.Agreement("c", "direct", "via", "p", "key", "value")
    report = constraints.constraint_report({"c": child, "p": parent}, [rule])
    assert report.first()["violations"] == 0
    plan = report._jdf.queryExecution().optimizedPlan().toString()
    assert "_salt" not in plan and plan.rindex("Aggregate") > plan.index("Join")
    wrong = child.withColumn("direct", F.lit(8))
    report = constraints.constraint_report({"c": wrong, "p": parent}, [rule])
    assert report.first()["violations"] == 20_000


def test_flatten_with_salts_is_the_same(tiny):
    star = bank.gold_star(SALT)
    plain = sorted(map(str, flatten(tiny, star, skew=None).collect()))
    assert sorted(map(str, flatten(tiny, star, skew=EAGER).collect())) == plain
