from __future__ import annotations

import sys
from decimal import Decimal
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).resolve().parents[n]) for n in (1, 0)]

from bank_data import ACCOUNT, CARD, MEMBER, TRANSACTION, at  # noqa: E402

from starflat.session import build_session  # noqa: E402
from starflat.sources.tables import local_rows  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "starflat-tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "4g",
            "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def tiny(spark):
    """Four members, four accounts, four cards, five transactions.

    Member 4 has nothing, account 4 has no card, account 2 has two cards. An age and
    a description are NULL.
    """
    return {
        "member": local_rows(
            spark,
            [
                (1, "Tomás", "Reis", 51, "tomas.reis@post.example"),
                (2, "Ines", "Varga", None, "ines@post.example"),
                (3, "Luc", "Meyer", 19, "luc.meyer@post.example"),
                (4, "Ada", "Okoye", 67, "ada.okoye@post.example"),
            ],
            MEMBER,
        ),
        "account": local_rows(
            spark,
            [
                (1, "youth", at("2022-05-02 08:05"), 3),
                (2, "joint", at("2018-11-20 16:40"), 1),
                (3, "reserve", at("2021-01-31 12:00"), 2),
                (4, "joint", at("2023-07-09 09:15"), 1),
            ],
            ACCOUNT,
        ),
        "card": local_rows(
            spark,
            [
                (1, "2600111122223333", "TOMAS REIS", at("2020-12-01 11:00"), 2, 1),
                (2, "6011555566667777", "INES VARGA", at("2021-02-10 13:20"), 3, 2),
                (3, "2711888899990000", "T REIS", at("2021-06-15 10:10"), 2, 1),
                (4, "6500123498765432", "LUC MEYER", at("2022-06-01 17:45"), 1, 3),
            ],
            CARD,
        ),
        "transaction": local_rows(
            spark,
            [
                (1, Decimal("18.40"), "Bakery", at("2025-03-09 21:10"), 1, "debit"),
                (2, Decimal("640.00"), "Rent share", at("2025-03-02 09:00"), 2, "debit"),
                (3, Decimal("33.35"), "Tickets", at("2025-02-27 23:45"), 3, "credit"),
                (4, Decimal("7.99"), None, at("2025-02-25 06:30"), 4, "debit"),
                (5, Decimal("129.00"), "Shoes", at("2025-02-24 18:00"), 2, "debit"),
            ],
            TRANSACTION,
        ),
    }


@pytest.fixture()
def folder(tmp_path) -> str:
    return str(tmp_path / "table")
