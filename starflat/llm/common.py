"""Helpers that the operators share."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starflat.session import shared_dir


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """The rows written once to the folder all executors share, and read back.

    Cuts the lineage, so that nothing before is computed twice and a lost
    executor costs only its own tasks.
    """
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def texts(docs: DataFrame, key: str = "doc_id", text: str = "text", kind: str = "long") -> DataFrame:
    """``(key, text)`` only, so that further columns of any name do not matter."""
    return docs.select(
        F.col(key).cast(kind).alias(key),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias(text),
    )


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have, whatever its letter case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def signed(value: int) -> int:
    """An unsigned 64-bit number as Spark's signed one with the same bits."""
    return value - (1 << 64) if value >= 1 << 63 else value


def hex16(column: Column) -> Column:
    return F.lower(F.lpad(F.hex(column), 16, "0"))


def byte_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, Iterator[bytes]]]:
    """Keys of each batch, and its texts as UTF-8 bytes, one at a time."""
    for batch in batches:
        column = batch.column(1).cast(pa.large_binary())
        yield batch.column(0), (value.as_py() for value in column)


def numbered(df: DataFrame, groups: list[str], order: list[str], buckets: int, name: str) -> DataFrame:
    """Adds ``name``: 0, 1, ... within each group, without a task per group.

    Rows get a bucket from a hash of their order columns. Rows are numbered
    within ``(group, bucket)`` and start where the buckets before end; the
    numbers of those are sums over at most ``buckets`` rows a group. A group
    with most of the rows is thus spread over all tasks. Rows equal in all
    order columns are interchangeable. The input is read twice: stage it.
    """
    from pyspark.sql import Window

    bucketed = df.withColumn("_bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)))
    keys = [*groups, "_bucket"]
    before = Window.partitionBy(*groups).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        bucketed.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select(*keys, F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    )
    within = Window.partitionBy(*keys).orderBy(*order)
    counted = bucketed.withColumn("_place", F.row_number().over(within) - 1)
    return (
        counted.join(starts, keys)
        .withColumn(name, F.col("_start") + F.col("_place"))
        .drop("_bucket", "_place", "_start")
    )
