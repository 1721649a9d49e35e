"""Which folder holds each date of a published table: an append-only log of runs.

A run writes its rows once, to a folder of its own below its version, and appends one
manifest row per date that it loaded. The rows count from the moment the run's state
entry says ``success``; until then readers see the folders of earlier runs. So an
increment replaces all its dates in one step, and nothing is written twice.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import DataFrame, Row, SparkSession, types as T
from pyspark.sql import functions as F

from starflat.operators.ledger import STATE_SCHEMA, append, read_log

MANIFEST_SCHEMA = T.StructType(
    [
        T.StructField("source", T.StringType(), False),
        T.StructField("version", T.StringType(), False),
        T.StructField("run_seq", T.LongType(), False),
        T.StructField("event_date", T.StringType(), False),
        T.StructField("folder", T.StringType()),
        T.StructField("source_rows", T.LongType()),
        T.StructField("digest", T.StringType()),
    ]
)
# How a missing date is written in folder names, and so here.
NO_DATE = "__HIVE_DEFAULT_PARTITION__"


@dataclass(frozen=True)
class DateEntry:
    """One date of a run: the partition as named in its folder, that folder (None if the date
    has no rows any more), and count and digest of the source rows."""

    event_date: str
    folder: str | None
    source_rows: int = 0
    digest: str = "0"


def record(
    spark: SparkSession, path: str, source: str, version: str, run_seq: int, entries: Iterable[DateEntry]
) -> None:
    rows = [(source, version, run_seq, e.event_date, e.folder, e.source_rows, e.digest) for e in entries]
    if rows:
        append(spark, path, MANIFEST_SCHEMA, rows)


def dates_of_runs(spark: SparkSession, base: str, source: str, state: Row) -> DataFrame:
    """All manifest rows of successful runs of the state's version up to that state."""
    log = read_log(spark, f"{base}/state", STATE_SCHEMA)
    done = log.filter(
        (F.col("status") == "success") & (F.col("source") == source) & (F.col("run_seq") <= state["run_seq"])
    ).select("run_seq")
    rows = read_log(spark, f"{base}/manifest", MANIFEST_SCHEMA)
    mine = rows.filter((F.col("source") == source) & (F.col("version") == state["version"]))
    return mine.join(done.distinct(), "run_seq", "left_semi")


def snapshot(spark: SparkSession, base: str, source: str, state: Row) -> DataFrame:
    """One row per date: where it lies as of ``state``, and the digest of its source rows."""
    newest = F.max_by(F.struct("run_seq", "folder", "source_rows", "digest"), "run_seq").alias("newest")
    return dates_of_runs(spark, base, source, state).groupBy("event_date").agg(newest).select("event_date", "newest.*")


def written_dates(spark: SparkSession, path: str, partition_by: str) -> list[str]:
    """Values of the date folders below ``path``, as they are named there."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = root.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in system.listStatus(root) if s.isDirectory()]
    mark = f"{partition_by}="
    return sorted(name[len(mark) :] for name in names if name.startswith(mark))


def read_dates(
    spark: SparkSession, root: str, schema: T.StructType, partition_by: str, places: Iterable[tuple[str, str]]
) -> DataFrame:
    """The rows of ``(folder, event_date)`` places below ``root`` as one table; filters on the date prune."""
    paths = [f"{root}/run={folder}/{partition_by}={date}" for folder, date in places]
    if not paths:
        return spark.createDataFrame([], schema)
    columns = schema.fieldNames()
    return spark.read.schema(schema).option("basePath", root).parquet(*sorted(paths)).select(*columns)


def digest_text(value: Decimal | int | None) -> str:
    return str(int(value or 0))
