"""Column profiles and equal-width histograms."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, types as T
from pyspark.sql import functions as F

from starflat.functions import as_double, ratio


def column_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per column from one aggregate over one scan.

    ``numeric_stats`` is filled for numbers and for text that reads as a number,
    ``string_stats`` for text.
    """
    names = list(columns or df.columns)
    aggregates = [F.count(F.lit(1)).alias("n")]
    rows = []
    for i, name in enumerate(names):
        data_type = df.schema[name].dataType
        column = F.col(name)
        number = as_double(column, data_type)
        text = isinstance(data_type, T.StringType)
        aggregates.append(F.count_if(column.isNull()).alias(f"nulls_{i}"))
        if text:
            aggregates += [
                F.count_if(F.length(column) == 0).alias(f"empty_{i}"),
                F.avg(F.length(column)).alias(f"length_{i}"),
            ]
        if number is not None:
            aggregates += [
                F.min(number).alias(f"min_{i}"),
                F.max(number).alias(f"max_{i}"),
                F.avg(number).alias(f"avg_{i}"),
                F.stddev_samp(number).alias(f"std_{i}"),
            ]
        rows.append(_profile_row(i, name, data_type.simpleString(), number is not None, text))
    return df.agg(*aggregates).select(F.inline(F.array(*rows)))


def histogram(df: DataFrame, columns: Sequence[str], buckets: int = 10) -> DataFrame:
    """``(column_name, bucket, lo, hi, n)`` of the non-empty buckets.

    NaN and infinite values are counted as bucket 0, without borders. The last
    bucket includes the maximum. A constant column has one bucket with
    ``lo = hi``. Two passes over the data for all columns together: the bounds
    (one row), then one count per column and bucket.
    """
    numbers = {}
    for name in columns:
        numbers[name] = as_double(F.col(name), df.schema[name].dataType)
        if numbers[name] is None:
            raise ValueError(f"column {name} is not numeric")
    finite = {name: F.when(_finite(v), v) for name, v in numbers.items()}
    bounds = df.agg(
        *(F.min(v).alias(f"lo_{i}") for i, v in enumerate(finite.values())),
        *(F.max(v).alias(f"hi_{i}") for i, v in enumerate(finite.values())),
    ).first()
    entries = []
    for i, (name, value) in enumerate(numbers.items()):
        lo, hi = bounds[f"lo_{i}"], bounds[f"hi_{i}"]
        entries.append(
            F.struct(
                F.lit(name).alias("column_name"),
                F.when(value.isNotNull() & ~_finite(value), F.lit(0))
                .otherwise(_bucket(finite[name], lo, hi, buckets))
                .alias("bucket"),
                F.when(_finite(value), F.lit(lo).cast("double")).alias("lo"),
                F.when(_finite(value), F.lit(hi).cast("double")).alias("hi"),
            )
        )
    counted = (
        df.select(F.inline(F.array(*entries)))
        .filter(F.col("bucket").isNotNull())
        .groupBy("column_name", "bucket", "lo", "hi")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    width = (F.col("hi") - F.col("lo")) / buckets
    last = F.col("bucket") == buckets
    return counted.select(
        "column_name",
        "bucket",
        (F.col("lo") + (F.col("bucket") - 1) * width).alias("lo"),
        F.when(last, F.col("hi")).otherwise(F.col("lo") + F.col("bucket") * width).alias("hi"),
        "n",
    )


def profile_with_histograms(df: DataFrame, buckets: int = 10) -> DataFrame:
    """``column_profile`` with ``histogram ARRAY<STRUCT<lo, hi, n>>`` per column."""
    numeric = [
        f.name for f in df.schema.fields if as_double(F.col(f.name), f.dataType) is not None
    ]
    profile = column_profile(df)
    if not numeric:
        empty = F.array().cast("array<struct<lo:double,hi:double,n:bigint>>")
        return profile.withColumn("histogram", empty)
    # At most ``buckets`` entries per column are collected.
    drawn = (
        histogram(df, numeric, buckets)
        .groupBy("column_name")
        .agg(F.sort_array(F.collect_list(F.struct("lo", "hi", "n"))).alias("histogram"))
    )
    return profile.join(drawn, "column_name", "left")


def null_vector(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """NULL count of every column, side by side."""
    names = list(columns or df.columns)
    return df.agg(*(F.count_if(F.col(c).isNull()).alias(c) for c in names))


def _finite(value: Column) -> Column:
    return F.coalesce(~F.isnan(value) & (F.abs(value) < float("inf")), F.lit(False))


def _bucket(value: Column, lo: float | None, hi: float | None, buckets: int) -> Column:
    if lo is None:
        return F.lit(None).cast("int")
    if lo == hi:
        return F.when(value.isNotNull(), F.lit(1))
    # width_bucket puts the maximum into a bucket of its own, one past the last.
    raw = F.width_bucket(value, F.lit(lo), F.lit(hi), F.lit(buckets))
    return F.when(value.isNotNull(), F.least(raw.cast("int"), F.lit(buckets)))


def _profile_row(i: int, name: str, data_type: str, numeric: bool, text: bool) -> Column:
    def stat(prefix: str, present: bool) -> Column:
        return F.col(f"{prefix}_{i}") if present else F.lit(None).cast("double")

    n, nulls = F.col("n"), F.col(f"nulls_{i}")
    return F.struct(
        F.lit(name).alias("column_name"),
        F.lit(data_type).alias("data_type"),
        n.alias("total_count"),
        nulls.alias("null_count"),
        (n - nulls).alias("not_null_count"),
        ratio(nulls, n).alias("null_ratio"),
        ratio(n - nulls, n).alias("completeness"),
        (F.col(f"empty_{i}") if text else F.lit(0).cast("bigint")).alias("empty_strings"),
        F.struct(
            stat("min", numeric).alias("min"),
            stat("max", numeric).alias("max"),
            stat("avg", numeric).alias("avg"),
            stat("std", numeric).alias("std"),
        ).alias("numeric_stats"),
        F.struct(stat("length", text).alias("avg_length")).alias("string_stats"),
    )
