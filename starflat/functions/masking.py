"""Masking and hashing of personal data."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Formats that masked and hashed columns must have.
PAN_LENGTH = 16
PAN_PATTERN = r"\b\d{16}\b"
MASK_PATTERN = r"^(\d{6}\*{6}\d{4}|\*{6}(\d{4})?)$"
HASH_PATTERN = r"^[0-9a-f]{64}$"
STARS = "******"

# A shorter number would show all or nearly all of its digits as 6 + 4.
MIN_DIGITS_FOR_LONG_MASK = 13


def mask_card(number: Column) -> Column:
    """First six and last four digits of a card number; the rest as stars.

    Numbers under 13 characters show the last four only, numbers of at most
    four characters show nothing. NULL stays NULL.
    """
    size = F.length(number)
    last_four = F.right(number, F.lit(4))
    return (
        F.when(
            size >= MIN_DIGITS_FOR_LONG_MASK,
            F.concat(F.left(number, F.lit(6)), F.lit(STARS), last_four),
        )
        .when(size > 4, F.concat(F.lit(STARS), last_four))
        .when(number.isNotNull(), F.lit(STARS))
    )


def redact_cards(text: Column) -> Column:
    """Free text with every full card number masked like ``mask_card``; all else stays."""
    return F.regexp_replace(text, r"\b(\d{6})\d{6}(\d{4})\b", f"$1{STARS}$2")


def mask_email(email: Column) -> Column:
    """At most three leading characters of the local part, then the domain.

    At least one character of the local part is always hidden. NULL gives the
    empty string and text without ``@`` gives stars only.
    """
    domain = F.substring_index(email, "@", -1)
    local_size = F.length(email) - F.length(domain) - 1
    shown = F.greatest(F.least(local_size - 1, F.lit(3)), F.lit(0))
    return (
        F.when(email.isNull(), F.lit(""))
        .when(~F.contains(email, F.lit("@")), F.lit("****"))
        .otherwise(F.concat(F.left(email, shown), F.lit("****@"), domain))
    )


def hash_value(value: Column, salt: str, null_as_empty: bool = False) -> Column:
    """SHA-256 of the value followed by the salt, as 64 hex digits.

    ``null_as_empty`` hashes NULL like the empty string instead of returning
    NULL. With 6 + 4 digits of a card visible only about a million candidates
    remain, so whoever holds the salt can undo the hash of a card number.
    """
    if not salt:
        raise ValueError("a salt is required")
    text = value.cast("string")
    if null_as_empty:
        text = F.coalesce(text, F.lit(""))
    return F.sha2(F.concat(text, F.lit(salt)), 256)
