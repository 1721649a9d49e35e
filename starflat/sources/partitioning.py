"""How many partitions a table is read in, from the range of its integer key."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class PartitionPolicy:
    """Below ``small_threshold`` keys few partitions, above one per ``target_rows``."""

    min_partitions: int
    max_partitions: int
    small_threshold: int
    target_rows: int = 25_000
    small_rows: int = 1_000
    max_connections: int = 10


# Fixed values per role of a table.
POLICIES = {
    "member": PartitionPolicy(2, 8, 10_000),
    "account": PartitionPolicy(2, 8, 5_000),
    "card": PartitionPolicy(4, 16, 20_000),
    "transaction": PartitionPolicy(8, 32, 100_000),
}


def key_bounds(df: DataFrame, column: str) -> DataFrame:
    """One row with the smallest and largest key."""
    key = F.col(column).cast("bigint")
    return df.agg(F.min(key).alias("lower_bound"), F.max(key).alias("upper_bound"))


def partition_plan(bounds: DataFrame, policy: PartitionPolicy) -> DataFrame:
    """``bounds`` with the number of partitions; NULL bounds give NULL partitions."""
    keys = F.col("upper_bound") - F.col("lower_bound") + 1
    small = F.least(F.lit(policy.min_partitions), F.floor(keys / policy.small_rows) + 1)
    large = F.least(F.lit(policy.max_partitions), F.floor(keys / policy.target_rows) + 1)
    wanted = F.when(
        keys < policy.small_threshold, F.greatest(F.lit(1), small)
    ).otherwise(F.greatest(F.lit(policy.min_partitions), large))
    # More partitions than keys would leave some of them empty.
    fitting = F.when(keys - 1 < wanted, F.greatest(F.lit(1), keys)).otherwise(wanted)
    partitions = F.least(fitting, F.lit(policy.max_connections)).cast("int")
    return bounds.select(
        "lower_bound",
        "upper_bound",
        F.when(keys.isNotNull(), partitions).alias("partitions"),
    )
