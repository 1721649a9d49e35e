"""Column functions; every one takes and returns a Spark ``Column``."""

from starflat.functions.masking import hash_value, mask_card, mask_email, redact_cards
from starflat.functions.numbers import as_double, money, ratio
from starflat.functions.times import iso_utc, local_text, to_utc

__all__ = [
    "as_double",
    "hash_value",
    "iso_utc",
    "local_text",
    "mask_card",
    "mask_email",
    "money",
    "ratio",
    "redact_cards",
    "to_utc",
]
