"""Joins on keys of which a few hold a large part of all rows.

Hot keys are found with a frequent-items sketch: one narrow scan with constant
state per task, no shuffle of the keys. A row of a hot key goes to one of many
salted groups and the matching rows of the other side are repeated once per
salt. Whatever the sketch reports, the result is the plain join.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, types as T
from pyspark.sql import functions as F

MAX_SALTS = 1 << 16


@dataclass(frozen=True)
class SkewPolicy:
    """When a key counts as hot, and how finely it is split.

    A key is hot above ``min_rows`` rows and above ``share`` of all rows or a quarter
    of an even shuffle partition's rows, whichever is less.

    ``rows_per_salt`` is far below ``min_rows``: many salts hash evenly over the
    shuffle partitions, few would collide.
    """

    share: float = 0.0025
    min_rows: int = 1_000_000
    rows_per_salt: int = 100_000
    tracked_items: int = 8192

    @property
    def max_hot_keys(self) -> int:
        return min(1000, int(4 / self.share))


@dataclass(frozen=True)
class HotKeys:
    """Salts per hot key; at most 1,000 entries."""

    salts: dict[Any, int]
    null_salts: int = 1

    def __bool__(self) -> bool:
        return bool(self.salts) or self.null_salts > 1


def find_hot_keys(
    df: DataFrame, columns: Sequence[str], policy: SkewPolicy = SkewPolicy()
) -> dict[str, HotKeys]:
    """Hot keys of each column, all columns in one pass over the data."""
    sketch = "approx_top_k(`{c}`, {k}, {n}) AS `{c}`"
    row = df.select(*columns).selectExpr(
        "count(1) AS total_rows",
        *(
            sketch.format(c=c, k=policy.max_hot_keys, n=policy.tracked_items)
            for c in columns
        ),
    ).first()
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    even = row["total_rows"] / (4 * max(partitions, 1))
    smallest = max(min(policy.share * row["total_rows"], even), policy.min_rows)
    found = {}
    for name in columns:
        salts = {
            entry["item"]: max(2, min(MAX_SALTS, -(-entry["count"] // policy.rows_per_salt)))
            for entry in row[name] or []
            if entry["count"] > smallest
        }
        null_salts = salts.pop(None, 1)
        found[name] = HotKeys(salts, null_salts)
    return found


def salted_join(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    hot: HotKeys,
    how: str = "inner",
) -> DataFrame:
    """``left`` joined to ``right`` (inner or left) with the hot keys split.

    The salt is a hash of the whole row, so rows of a hot key must differ to be
    spread: aggregate equal rows first, as the agreement constraint does.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"unsupported join type: {how}")
    match = F.col(left_key) == F.col(right_key)
    if not hot:
        return left.join(right, match, how)
    # The salt is a hash of the row, so a recomputed task salts it the same way.
    hashable = [f.name for f in left.schema.fields if not isinstance(f.dataType, T.MapType)]
    spread = F.xxhash64(*hashable)
    salted_left = left.withColumn(
        "_salt", F.pmod(spread, _salt_count(left_key, hot).cast("bigint")).cast("int")
    )
    salts = HotKeys(hot.salts)
    salted_right = right.withColumn(
        "_right_salt",
        F.explode(F.sequence(F.lit(0), _salt_count(right_key, salts) - 1)),
    )
    same_salt = F.col("_salt") == F.col("_right_salt")
    return salted_left.join(salted_right, match & same_salt, how).drop(
        "_salt", "_right_salt"
    )


def _salt_count(key: str, hot: HotKeys) -> Column:
    count = F.lit(1)
    if hot.salts:
        pairs = [F.lit(x) for item in hot.salts.items() for x in item]
        count = F.coalesce(F.try_element_at(F.create_map(*pairs), F.col(key)), F.lit(1))
    if hot.null_salts > 1:
        count = F.when(F.col(key).isNull(), F.lit(hot.null_salts)).otherwise(count)
    return count
