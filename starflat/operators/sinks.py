"""Parquet and CSV output."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, types as T
from pyspark.sql import functions as F

from starflat.functions import iso_utc

# Fixed values.
FORMATS = ("csv", "parquet")
COMPRESSIONS = ("snappy", "gzip", "zstd", "lz4", "none")
CSV_COMPRESSIONS = ("gzip", "bzip2", "deflate", "lz4", "snappy", "none")

# A compressed text file is read by one task.
ROWS_PER_COMPRESSED_FILE = 1_000_000
# Of gzip and deflate: 6 % more bytes than at the default level for 40 % of its CPU time.
ZLIB_LEVEL = "THREE"


def parse_formats(text: str) -> list[str]:
    """``"csv,parquet"`` to a list; unknown or missing names raise."""
    names = [part.strip().lower() for part in text.split(",") if part.strip()]
    unknown = [n for n in names if n not in FORMATS]
    if unknown or not names:
        raise ValueError(f"output formats must be among {', '.join(FORMATS)}: {text!r}")
    return list(dict.fromkeys(names))


def write_parquet(
    df: DataFrame,
    path: str,
    partition_by: str | None = "event_date",
    sort_by: Sequence[str] = (),
    compression: str = "snappy",
    dynamic: bool = False,
    clustered: bool = False,
    watch: Callable[[DataFrame], DataFrame] | None = None,
) -> None:
    """Parquet, partitioned by date.

    The rebalance hint brings the rows of a date together, so a date becomes
    few files, and lets AQE split a date that holds much of the data. Rows read
    from such files are ``clustered`` already and are not shuffled again.
    ``dynamic`` replaces only the partitions that occur in ``df``. ``watch`` may observe
    the rows in the tasks that write them, behind the last shuffle: there a repeated
    task is counted once.
    """
    if compression not in COMPRESSIONS:
        raise ValueError(f"compression must be among {', '.join(COMPRESSIONS)}")
    if partition_by:
        if not clustered:
            df = df.hint("rebalance", F.col(partition_by))
        if watch:
            df = watch(df)
        df = df.sortWithinPartitions(partition_by, *sort_by)
    writer = df.write.mode("overwrite").option("compression", compression)
    if partition_by:
        writer = writer.partitionBy(partition_by)
    if dynamic:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    else:
        writer = writer.option("partitionOverwriteMode", "static")
    writer.parquet(path)


def write_csv(
    df: DataFrame,
    path: str,
    order_by: Sequence[str],
    delimiter: str = ",",
    encoding: str = "UTF-8",
    header: bool = True,
    mode: str = "overwrite",
    finish: Callable[[DataFrame], DataFrame] | None = None,
    compression: str = "none",
) -> None:
    """CSV in global order over the part files: part n ends before part n+1 begins.

    TIMESTAMP_NTZ columns (UTC) are written as ISO-8601 text. ``finish`` makes the columns of
    the file from those of ``df``, row by row: it runs behind the sort, so that wide
    columns are neither shuffled nor sorted. Files are plain text unless a ``compression`` is
    given; ``read_csv`` knows it by the file's name. Compressed parts are cut into files of at
    most a million rows, which follow each other by name.
    """
    if compression not in CSV_COMPRESSIONS:
        raise ValueError(f"compression must be among {', '.join(CSV_COMPRESSIONS)}")
    ordered = df.repartitionByRange(*order_by).sortWithinPartitions(*order_by)
    writer = (
        with_iso_times(finish(ordered) if finish else ordered)
        .write.mode(mode)
        .option("header", header)
        .option("sep", delimiter)
        .option("encoding", encoding)
        .option("escape", '"')
    )
    if compression != "none":
        writer = (
            writer.option("compression", compression)
            .option("zlib.compress.level", ZLIB_LEVEL)
            .option("maxRecordsPerFile", ROWS_PER_COMPRESSED_FILE)
        )
    writer.csv(path)


def with_iso_times(df: DataFrame) -> DataFrame:
    return df.select(
        *(
            iso_utc(F.col(f.name)).alias(f.name)
            if isinstance(f.dataType, T.TimestampNTZType)
            else F.col(f.name)
            for f in df.schema.fields
        )
    )


def write_schema(df: DataFrame, path: str) -> None:
    """The schema of ``df`` as one JSON line."""
    spark = df.sparkSession
    spark.createDataFrame([(df.schema.json(),)], "value string").coalesce(1).write.mode(
        "overwrite"
    ).text(path)


def read_schema(spark: SparkSession, path: str) -> T.StructType:
    return T.StructType.fromJson(json.loads(spark.read.text(path).first()[0]))


def write_json(df: DataFrame, path: str) -> None:
    """A report as JSON lines."""
    df.write.mode("overwrite").json(path)
