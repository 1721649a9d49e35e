"""Linked example data derived from a table of members.

Every value comes from a hash of the row's id and a seed, and ids of children
are computed from the id of their parent. Nothing is shuffled, and any
partitioning, order or repeated task gives the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Parameters of the example data: types, and per category the lowest and highest amount.
ACCOUNT_TYPES = ("everyday", "joint", "reserve", "youth")
CARD_TYPES = ("debit", "credit", "prepaid")
CATEGORIES = (
    ("books", 4, 120),
    ("fuel", 15, 110),
    ("groceries", 8, 260),
    ("insurance", 60, 900),
    ("rent", 420, 2600),
    ("sports", 12, 350),
    ("travel", 75, 4200),
)
MAX_ACCOUNTS, MAX_CARDS, MIN_TRANSACTIONS, MAX_TRANSACTIONS = 4, 3, 3, 12
HISTORY_DAYS, CARD_DAYS = 540, 4 * 365 + 1


def synthetic_accounts(members: DataFrame, seed: int, reference_date: str) -> DataFrame:
    """One to four accounts (45 : 30 : 15 : 10) per row of ``members(member_id)``."""
    drawn = members.select("member_id", _digest(seed, "member", "member_id"))
    weight = _draw(0, 100)
    count = F.when(weight < 45, 1).when(weight < 75, 2).when(weight < 90, 3).otherwise(4)
    children = drawn.select("member_id", _children(count).alias("k"))
    accounts = children.select(
        "member_id", (F.col("member_id") * (MAX_ACCOUNTS + 1) + F.col("k")).alias("account_id")
    )
    return accounts.select("*", _digest(seed, "account", "account_id")).select(
        "account_id",
        "member_id",
        _pick(ACCOUNT_TYPES, 0).alias("account_type"),
        F.date_sub(F.lit(reference_date).cast("date"), (_draw(1, 2500) + HISTORY_DAYS).cast("int")).alias(
            "created"
        ),
        (_draw(2, 750_000) / 100).cast("decimal(15,2)").alias("balance"),
        (_draw(3, 100) < 88).alias("active"),
    )


def synthetic_cards(accounts: DataFrame, seed: int) -> DataFrame:
    """One to three cards (55 : 30 : 15) per account, held by the account's owner."""
    drawn = accounts.select(
        "account_id", "member_id", "created", _digest(seed, "cards", "account_id")
    )
    weight = _draw(0, 100)
    count = F.when(weight < 55, 1).when(weight < 85, 2).otherwise(3)
    children = drawn.select(
        "account_id",
        "member_id",
        F.col("created").alias("opened"),
        _children(count).alias("k"),
    )
    cards = children.select(
        "*", (F.col("account_id") * (MAX_CARDS + 1) + F.col("k")).alias("card_id")
    ).select("*", _digest(seed, "card", "card_id"))
    created = F.date_add("opened", (_draw(1, 45) + 3).cast("int"))
    card_type = _pick(CARD_TYPES, 2)
    # Multiplying by a number prime to 10 permutes the fifteen digits.
    scrambled = F.pmod(F.col("card_id") * 7_919 + 104_729, F.lit(10**15))
    return cards.select(
        "card_id",
        F.concat(
            F.when(_draw(0, 2) == 0, "2").otherwise("6"),
            F.lpad(scrambled.cast("string"), 15, "0"),
        ).alias("number"),
        created.alias("created"),
        F.date_add(created, CARD_DAYS).alias("expires"),
        "account_id",
        "member_id",
        card_type.alias("card_type"),
        F.when(card_type == "debit", F.lit(0))
        .otherwise(_draw(3, 8_000) + 250)
        .cast("decimal(10,2)")
        .alias("credit_limit"),
    )


def synthetic_transactions(cards: DataFrame, seed: int, reference_date: str) -> DataFrame:
    """Three to twelve transactions per card; 78 : 14 : 8 debit, credit, refund.

    The amount range depends on the category, refunds are negative, and times
    lie in the days before the reference date.
    """
    drawn = cards.select("card_id", _digest(seed, "transactions", "card_id"))
    count = _draw(0, MAX_TRANSACTIONS - MIN_TRANSACTIONS + 1) + MIN_TRANSACTIONS
    children = drawn.select("card_id", _children(count).alias("k"))
    ids = children.select(
        "card_id", (F.col("card_id") * (MAX_TRANSACTIONS + 1) + F.col("k")).alias("txn_id")
    )
    # Two digests: one holds four draws.
    first = ids.select("*", _digest(seed, "txn", "txn_id")).select(
        "card_id",
        "txn_id",
        (_draw(0, len(CATEGORIES)) + 1).cast("int").alias("c"),
        _draw(1, 1_000_001).alias("level"),
        _draw(2, 100).alias("weight"),
        _draw(3, HISTORY_DAYS).cast("int").alias("days"),
    )
    second = first.select("*", _digest(seed, "clock", "txn_id"))
    table = F.array(
        *(
            F.struct(F.lit(n).alias("name"), F.lit(lo).alias("lo"), F.lit(hi).alias("hi"))
            for n, lo, hi in CATEGORIES
        )
    )
    entry = F.element_at(table, F.col("c"))
    kind = F.when(F.col("weight") < 78, "debit").when(F.col("weight") < 92, "credit")
    cents = entry["lo"] * 100 + F.floor(
        (entry["hi"] - entry["lo"]) * 100 * F.col("level") / F.lit(1_000_000)
    )
    amount = (cents / 100).cast("decimal(10,2)")
    day = F.date_sub(F.lit(reference_date).cast("date"), F.col("days"))
    clock = F.make_dt_interval(
        F.lit(0), _draw(0, 24).cast("int"), _draw(1, 60).cast("int"), _draw(2, 60)
    )
    kind = kind.otherwise("refund")
    return second.select(
        "txn_id",
        "card_id",
        F.when(kind == "refund", -amount).otherwise(amount).alias("amount"),
        (day.cast("timestamp_ntz") + clock).alias("txn_time"),
        kind.alias("txn_type"),
        entry["name"].alias("category"),
    )


def _digest(seed: int, purpose: str, id_column: str) -> Column:
    return F.md5(F.concat_ws("|", F.lit(str(seed)), F.lit(purpose), F.col(id_column))).alias("_h")


def _draw(part: int, size: int) -> Column:
    """A number in ``0 .. size - 1`` from one of the four parts of the digest."""
    digits = F.substring("_h", part * 8 + 1, 8)
    return F.conv(digits, 16, 10).cast("bigint") % size


def _pick(values: tuple[str, ...], part: int) -> Column:
    options = F.array(*(F.lit(v) for v in values))
    return F.element_at(options, (_draw(part, len(values)) + 1).cast("int"))


def _children(count: Column) -> Column:
    return F.explode(F.sequence(F.lit(1), count.cast("int")))
