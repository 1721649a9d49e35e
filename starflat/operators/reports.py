"""Reports over members, accounts, cards and transactions.

Every report sums the transactions per card before the first join. A card that
holds a large part of all transactions then reaches the join as one row, and
the joins move one row per card instead of one per transaction.

Frames use the column names of ``starflat.plans.bank``.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starflat.functions.numbers import MONEY
from starflat.operators.skew import find_hot_keys, salted_join


def table_counts(frames: Mapping[str, DataFrame]) -> DataFrame:
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        for name, df in frames.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def max_event_time(transactions: DataFrame) -> DataFrame:
    return transactions.agg(F.max("txn_time").alias("max_event_time"))


def totals_per_card(transactions: DataFrame, *further: str) -> DataFrame:
    """Count, sum, debits, credits and extremes of each card's transactions, also by ``further`` columns."""
    amount = F.col("amount")
    return transactions.groupBy("card_id", *further).agg(
        F.count(F.lit(1)).alias("txn_count"),
        _total(amount).alias("total"),
        _total(F.when(F.col("txn_type") == "debit", amount)).alias("debits"),
        _total(F.when(F.col("txn_type") == "credit", amount)).alias("credits"),
        F.min(amount).alias("min_amount"),
        F.max(amount).alias("max_amount"),
    )


def member_stats(
    members: DataFrame, accounts: DataFrame, cards: DataFrame, transactions: DataFrame
) -> DataFrame:
    """Accounts, cards, transactions, debits and credits of every member.

    Each side is aggregated to one row per member before it is joined, so
    accounts do not multiply transactions.
    """
    return member_stats_of(members, accounts, cards, totals_per_card(transactions))


def member_stats_of(
    members: DataFrame, accounts: DataFrame, cards: DataFrame, totals: DataFrame
) -> DataFrame:
    """:func:`member_stats` from the totals of each card."""
    per_account = accounts.groupBy(F.col("owner_id").alias("a_member")).agg(
        F.count(F.lit(1)).alias("total_accounts")
    )
    per_member = (
        cards.select("card_id", "holder_id")
        .join(totals, "card_id", "left")
        .groupBy(F.col("holder_id").alias("c_member"))
        .agg(
            F.count(F.lit(1)).alias("total_cards"),
            F.sum("txn_count").alias("total_transactions"),
            _total(F.col("debits")).alias("total_debits"),
            _total(F.col("credits")).alias("total_credits"),
        )
    )
    joined = members.join(
        per_account, F.col("member_id") == F.col("a_member"), "left"
    ).join(per_member, F.col("member_id") == F.col("c_member"), "left")
    return joined.select(
        "member_id",
        "first_name",
        "last_name",
        *(
            F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c)
            for c in ("total_accounts", "total_cards", "total_transactions")
        ),
        *(
            F.coalesce(F.col(c), F.lit(0)).cast(MONEY).alias(c)
            for c in ("total_debits", "total_credits")
        ),
    )


def member_stats_raw(
    members: DataFrame, accounts: DataFrame, cards: DataFrame, transactions: DataFrame
) -> DataFrame:
    """What the chain of left joins member, accounts, cards, transactions returns.

    There every transaction appears once per account of its member. The factor
    is the number of accounts, so it is applied to the sums and the
    accounts-times-cards rows are never built.
    """
    stats = member_stats(members, accounts, cards, transactions)
    copies = F.greatest(F.col("total_accounts"), F.lit(1))
    return stats.select(
        "member_id",
        "first_name",
        "last_name",
        "total_accounts",
        "total_cards",
        (F.col("total_transactions") * copies).alias("total_transactions"),
        (F.col("total_debits") * copies).cast(MONEY).alias("total_debits"),
        (F.col("total_credits") * copies).cast(MONEY).alias("total_credits"),
    )


def card_balance(cards: DataFrame, transactions: DataFrame) -> DataFrame:
    """Credits minus debits of every card; other types and missing rows are 0."""
    totals = totals_per_card(transactions).select("card_id", "debits", "credits")
    net = F.coalesce(F.col("credits"), F.lit(0)) - F.coalesce(F.col("debits"), F.lit(0))
    return (
        cards.select("card_id")
        .join(totals, "card_id", "left")
        .select("card_id", net.cast(MONEY).alias("balance"))
    )


def population_summary(
    members: DataFrame, accounts: DataFrame, cards: DataFrame, transactions: DataFrame
) -> DataFrame:
    """One row over all transactions that find their card, account and member."""
    # Summed again before each join: a hot account or member is then one row, too.
    per_account = _sums(
        cards.select("card_id", "account_id", "holder_id").join(
            totals_per_card(transactions), "card_id"
        ),
        "account_id",
        "holder_id",
    )
    # An account with very many holders still has as many rows, so it is salted.
    types = accounts.select(F.col("account_id").alias("_account"), "account_type")
    hot = find_hot_keys(cards, ["account_id"])["account_id"]
    per_member = _sums(
        salted_join(per_account, types, "account_id", "_account", hot),
        "holder_id",
        "account_type",
    )
    # (type, age) has few values: account types times years of life.
    per_group = _sums(
        per_member.join(
            members.select("member_id", "age"), F.col("holder_id") == F.col("member_id")
        ),
        "account_type",
        "age",
    )
    age_sum = F.sum(F.col("age").cast("bigint") * F.col("txn_count"))
    return per_group.agg(
        F.sum("txn_count").alias("transactions"),
        F.count_distinct("account_type").alias("account_types"),
        F.try_divide(age_sum.cast("double"), F.sum("txn_count").cast("double")).alias("avg_age"),
        F.min("min_amount").alias("min_amount"),
        F.max("max_amount").alias("max_amount"),
        _total(F.col("total")).alias("total_amount"),
    )


def spend_by(
    transactions: DataFrame, key: str, categories: DataFrame, category_key: str, category: str
) -> DataFrame:
    """Amount and rows per category, the category looked up by ``key``."""
    per_key = transactions.groupBy(key).agg(
        F.count(F.lit(1)).alias("n"), _total(F.col("amount")).alias("amount")
    )
    named = categories.select(F.col(category_key).alias("_key"), category)
    return (
        per_key.join(named, F.col(key) == F.col("_key"))
        .groupBy(category)
        .agg(F.sum("n").alias("txn_count"), _total(F.col("amount")).alias("total_amount"))
    )


def spend_in_range(
    members: DataFrame, cards: DataFrame, transactions: DataFrame, first: str, last: str
) -> DataFrame:
    """Spend per member with ``first <= txn_time <= last``, largest first."""
    bounds = (F.lit(x).cast("timestamp_ntz") for x in (first, last))
    per_card = totals_per_card(transactions.filter(F.col("txn_time").between(*bounds)))
    return (
        cards.select("card_id", "holder_id")
        .join(per_card, "card_id")
        .groupBy("holder_id")
        .agg(F.sum("txn_count").alias("txn_count"), _total(F.col("total")).alias("total_amount"))
        .join(members, F.col("holder_id") == F.col("member_id"))
        .select("member_id", "first_name", "last_name", "txn_count", "total_amount")
        .orderBy(F.desc("total_amount"), "member_id")
    )


def accounts_with_owner(accounts: DataFrame, members: DataFrame) -> DataFrame:
    hot = find_hot_keys(accounts, ["owner_id"])["owner_id"]
    return salted_join(accounts, members, "owner_id", "member_id", hot).select(
        "account_id", "account_type", "member_id", "first_name", "last_name"
    )


def distinct_account_types(accounts: DataFrame) -> DataFrame:
    return accounts.select("account_type").distinct()


def output_profile(flat: DataFrame) -> DataFrame:
    """Rows, columns, NULLs, negative amounts and account types of the flat table."""
    filled = reduce(Column.__add__, (F.count(c) for c in flat.columns))
    cells = F.count(F.lit(1)) * len(flat.columns)
    # Grouped by type first: the set of types is then built from a few rows.
    per_type = flat.groupBy("account_type").agg(
        F.count(F.lit(1)).alias("n"),
        (cells - filled).alias("nulls"),
        F.count_if(F.col("txn_amount") < 0).alias("negatives"),
    )
    return per_type.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"),
        F.lit(len(flat.columns)).cast("bigint").alias("column_count"),
        F.coalesce(F.sum("nulls"), F.lit(0)).alias("null_cells"),
        F.coalesce(F.sum("negatives"), F.lit(0)).alias("negative_amounts"),
        F.array_join(F.sort_array(F.collect_set("account_type")), ",").alias("account_types"),
    )


def join_yield(joined_rows: DataFrame, input_rows: DataFrame) -> DataFrame:
    """Input rows, joined rows and joined / input * 100."""
    counted = input_rows.agg(F.count(F.lit(1)).alias("i")).select(
        "i", F.lit(0).cast("bigint").alias("o")
    )
    counted = counted.unionByName(
        joined_rows.agg(F.count(F.lit(1)).alias("o")).select(
            F.lit(0).cast("bigint").alias("i"), "o"
        )
    )
    rows_in, rows_out = F.sum("i"), F.sum("o")
    percent = F.coalesce(
        F.try_divide(rows_out.cast("double") * 100, rows_in.cast("double")), F.lit(0.0)
    )
    return counted.agg(
        rows_in.alias("input_rows"), rows_out.alias("output_rows"), percent.alias("yield_percent")
    )


def _sums(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(
        F.sum("txn_count").alias("txn_count"),
        _total(F.col("total")).alias("total"),
        F.min("min_amount").alias("min_amount"),
        F.max("max_amount").alias("max_amount"),
    )


def _total(amount: Column) -> Column:
    return F.sum(amount).cast(MONEY)
