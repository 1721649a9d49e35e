"""Constants and rows that the tests of the flat table share."""

from __future__ import annotations

from datetime import datetime

SALT = "unit-test-salt"
MEMBER = "member_id INT, first_name STRING, last_name STRING, age INT, email STRING"
ACCOUNT = "account_id INT, account_type STRING, created TIMESTAMP_NTZ, owner_id INT"
CARD = (
    "card_id INT, number STRING, printed_name STRING, created TIMESTAMP_NTZ,"
    " account_id INT, holder_id INT"
)
TRANSACTION = (
    "txn_id INT, amount DECIMAL(10,2), description STRING, txn_time TIMESTAMP_NTZ,"
    " card_id INT, txn_type STRING"
)


def at(text: str) -> datetime:
    return datetime.fromisoformat(text)
