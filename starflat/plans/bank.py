"""The member / account / card / transaction model over the order tables.

==============  ===========================================================
role            source
==============  ===========================================================
transaction     ``lineitem``; refunds (R), credits (A) and debits (N)
card            ``orders``; a 16-digit number derived from the order key
account         one per customer and order priority, opened by the first order
member          ``customer``
==============  ===========================================================

Keys form a diamond: a card refers to its account and to its holder, and the
account refers to its owner.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starflat.functions import hash_value, mask_card, mask_email, money, to_utc
from starflat.operators.checks import (
    Check,
    completeness_check,
    consistency_check,
    duplicate_check,
    extreme_check,
    format_check,
    negative_check,
    null_check,
    volume_check,
)
from starflat.operators.constraints import (
    Agreement,
    Constraint,
    Domain,
    ForeignKey,
    NotNull,
    Rule,
    Unique,
)
from starflat.operators.flatten import Derived, Link, Output, Star
from starflat.sources.tables import read_table

SOURCE_ZONE = "America/Sao_Paulo"
DEMO_SALT = "demo-salt"

# Fixed values of the sources and the checks.
ACCOUNT_TYPES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
CARD_NUMBER_PATTERN = r"^\d{16}$"
AMOUNT_LOW, AMOUNT_HIGH = 0.01, 100000.0

GOLD_COLUMNS = (
    "member_first_name",
    "member_last_name",
    "member_age",
    "email_masked",
    "email_hash",
    "txn_id",
    "txn_amount",
    "txn_description",
    "txn_time",
    "card_masked",
    "card_hash",
    "card_printed_name",
    "card_created",
    "account_type",
    "account_created",
    "event_date",
)

LINKS = (
    Link("transaction", "card_id", "card", "card_id"),
    Link("card", "account_id", "account", "account_id"),
    Link("card", "holder_id", "member", "member_id"),
)


def frames(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The four tables of the model."""
    return {
        "member": members(spark, sf_dir),
        "account": accounts(spark, sf_dir),
        "card": cards(spark, sf_dir),
        "transaction": transactions(spark, sf_dir),
    }


def members(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.col("c_name")
    return read_table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("member_id"),
        F.substring_index(name, "#", 1).alias("first_name"),
        F.substring_index(name, "#", -1).alias("last_name"),
        (F.lit(18) + F.col("c_custkey") % 63).cast("int").alias("age"),
        F.concat(F.lower(F.replace(name, F.lit("#"), F.lit("."))), F.lit("@mail.example")).alias(
            "email"
        ),
    )


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read_table(spark, sf_dir, "orders")
    return (
        orders.groupBy(_account_id().alias("account_id"))
        .agg(
            F.max("o_custkey").alias("owner_id"),
            F.max("o_orderpriority").alias("account_type"),
            F.min("o_orderdate").alias("created"),
        )
    )


def cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    return read_table(spark, sf_dir, "orders").select(
        key.alias("card_id"),
        F.concat(F.lit("4"), F.lpad(key.cast("string"), 15, "0")).alias("number"),
        F.concat(F.lit("HOLDER "), F.col("o_custkey").cast("string")).alias("printed_name"),
        F.col("o_orderdate").alias("created"),
        _account_id().alias("account_id"),
        F.col("o_custkey").alias("holder_id"),
    )


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    flag = F.col("l_returnflag")
    return read_table(spark, sf_dir, "lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("txn_id"),
        money(F.col("l_extendedprice")).alias("amount"),
        F.concat(F.lit("Purchase "), flag, F.lit("/"), F.col("l_linestatus")).alias(
            "description"
        ),
        F.col("l_shipdate").alias("txn_time"),
        F.col("l_orderkey").alias("card_id"),
        F.when(flag == "R", F.lit("refund"))
        .when(flag == "A", F.lit("credit"))
        .otherwise(F.lit("debit"))
        .alias("txn_type"),
        F.col("l_partkey").alias("category_id"),
        F.col("l_suppkey").alias("merchant_id"),
    )


def _account_id():
    return F.col("o_custkey") * 10 + F.left(F.col("o_orderpriority"), F.lit(1)).cast("int")


def gold_star(salt: str, zone: str = SOURCE_ZONE) -> Star:
    """Gold columns: masked and hashed personal data, UTC times, exact money."""
    outputs = (
        Output("member_first_name", lambda t: t("member", "first_name")),
        Output("member_last_name", lambda t: t("member", "last_name")),
        Output("member_age", lambda t: t("member", "age").cast("int")),
        Output("email_masked", lambda t: t("member", "email_masked")),
        Output("email_hash", lambda t: hash_value(t("member", "email"), salt)),
        Output("txn_id", lambda t: t("transaction", "txn_id")),
        Output("txn_amount", lambda t: money(t("transaction", "amount"))),
        Output("txn_description", lambda t: t("transaction", "description")),
        Output("txn_time", lambda t: t("transaction", "utc_time")),
        Output("card_masked", lambda t: mask_card(t("card", "number"))),
        Output("card_hash", lambda t: hash_value(t("card", "number"), salt)),
        Output("card_printed_name", lambda t: t("card", "printed_name")),
        Output("card_created", lambda t: t("card", "utc_created")),
        Output("account_type", lambda t: t("account", "account_type")),
        Output("account_created", lambda t: t("account", "utc_created")),
        Output("event_date", lambda t: t("transaction", "utc_time").cast("date")),
    )
    # The hashes stay behind the joins: 64 digits per row would widen the shuffles.
    derived = (
        Derived("member", "email_masked", lambda: mask_email(F.col("email"))),
        Derived("account", "utc_created", lambda: to_utc(F.col("created"), zone)),
        Derived("card", "utc_created", lambda: to_utc(F.col("created"), zone)),
        Derived("transaction", "utc_time", lambda: to_utc(F.col("txn_time"), zone)),
    )
    return Star("transaction", LINKS, outputs, derived)


def view_star() -> Star:
    """The joined tables with their raw columns."""
    columns = (
        ("transaction", "txn_id", "txn_id"),
        ("transaction", "amount", "amount"),
        ("transaction", "description", "description"),
        ("transaction", "txn_time", "txn_time"),
        ("transaction", "txn_type", "txn_type"),
        ("transaction", "category_id", "category_id"),
        ("transaction", "merchant_id", "merchant_id"),
        ("card", "number", "card_number"),
        ("card", "printed_name", "card_printed_name"),
        ("card", "created", "card_created"),
        ("account", "account_type", "account_type"),
        ("account", "created", "account_created"),
        ("member", "first_name", "member_first_name"),
        ("member", "last_name", "member_last_name"),
        ("member", "age", "member_age"),
        ("member", "email", "member_email"),
    )
    outputs = tuple(
        Output(name, lambda t, table=table, column=column: t(table, column))
        for table, column, name in columns
    )
    return Star("transaction", LINKS, outputs)


def suites(previous_transactions: int | None = None) -> dict[str, list[Check]]:
    """The checks of each table."""
    return {
        "card": [
            completeness_check(["card_id", "number", "account_id", "holder_id"]),
            null_check("number"),
            duplicate_check(["number"]),
            format_check("number", CARD_NUMBER_PATTERN),
        ],
        "transaction": [
            completeness_check(["txn_id", "amount", "txn_time", "card_id"]),
            negative_check("amount"),
            extreme_check("amount", AMOUNT_LOW, AMOUNT_HIGH),
            volume_check(previous_transactions),
            duplicate_check(["txn_id", "card_id"]),
        ],
        "member": [
            completeness_check(["member_id", "first_name", "email"]),
            consistency_check("email"),
            consistency_check("first_name"),
        ],
        "account": [
            completeness_check(["account_id", "account_type", "owner_id"]),
            consistency_check("account_type"),
        ],
    }


def constraints() -> list[Constraint]:
    return [
        NotNull("member", "email"),
        Rule("member", "age", "age between 18 and 120"),
        Rule("member", "email", "email like '%@%'"),
        Unique("member", ("email",)),
        Domain("account", "account_type", ACCOUNT_TYPES),
        ForeignKey("account", "owner_id", "member", "member_id"),
        Rule("card", "number_length", "length(number) = 16"),
        Unique("card", ("number",)),
        ForeignKey("card", "account_id", "account", "account_id"),
        ForeignKey("card", "holder_id", "member", "member_id"),
        Agreement("card", "holder_id", "account_id", "account", "account_id", "owner_id"),
        NotNull("transaction", "txn_time"),
        Rule("transaction", "amount", "amount <> 0"),
        Domain("transaction", "txn_type", ("debit", "credit", "refund")),
        Unique("transaction", ("txn_id",)),
        ForeignKey("transaction", "card_id", "card", "card_id"),
    ]
