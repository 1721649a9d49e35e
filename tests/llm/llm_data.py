"""Small tables for the operators' tests."""

from __future__ import annotations

import random

SF = "/root/testdata/sf0.001"

DOCS = "doc_id LONG, text STRING, lang STRING, source STRING, n_chars LONG"
# Further columns with names that the operators use themselves.
CLASHES = {
    "row": 1, "fp": 2, "key": "k", "words": "w", "spans": "s", "region": 3, "block": 4,
    "shard": 5, "length": 6, "index": 7, "secret_row": 8, "text_md5": "m", "least": 9,
    "substring_row": 10, "score": 0.5, "place": 11,
}


def sentence(rng: random.Random, n: int) -> str:
    return " ".join("w%d" % rng.randrange(5000) for _ in range(n)).capitalize() + "."


def passage(rng: random.Random, n: int = 8, words: int = 9) -> str:
    return " ".join(sentence(rng, words) for _ in range(n))


def frame(spark, rows):
    """Documents from ``(doc_id, text)`` or ``(doc_id, text, source)``."""
    full = [
        (r[0], r[1], "en", r[2] if len(r) > 2 else "src0", None if r[1] is None else len(r[1])) for r in rows
    ]
    return spark.createDataFrame(full, DOCS)


def odd_rows():
    """NULLs in every column, empty and very long texts, repeated rows."""
    rng = random.Random(5)
    long = passage(rng, 3000, 12)
    return [
        (1, "Plain words of a short text here."),
        (1, "Plain words of a short text here."),
        (None, None, None),
        (None, None, None),
        (2, None),
        (3, ""),
        (4, " \t\n\r\x0b\x0c "),
        (5, "ünï çödé 🙂   日本語 \x00 \x01\x02 words"),
        (None, "No id but a text."),
        (6, long),
        (7, "one"),
    ]


def odd(spark):
    from pyspark.sql import functions as F

    df = frame(spark, odd_rows())
    return df.select("*", *[F.lit(v).alias(k) for k, v in CLASHES.items()])


def empty(spark):
    return frame(spark, [])
