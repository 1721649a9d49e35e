"""Append-only Parquet logs: run state and watermarks, row counts, run metrics.

A run appends one small file; Spark's commit makes it visible as a whole. The
current entry is the newest one, so no entry is rewritten and a reader never
finds a half-replaced state. When the tail of files grows long its entries go into a
checkpoint; readers take the newest checkpoint and the tail. Only small per-run
records go here.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

import pyarrow as pa
from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Row, SparkSession, types as T
from pyspark.sql import functions as F

# How a run can stand.
STATUSES = ("running", "success", "failed")

# Files after the newest checkpoint from which on the next one is made.
TAIL_FILES = 64
CHECKPOINTS = "_checkpoints"

_ARROW_TYPES = {
    "bigint": pa.int64(),
    "double": pa.float64(),
    "map<string,string>": pa.map_(pa.string(), pa.string()),
    "string": pa.string(),
    "timestamp_ntz": pa.timestamp("us"),
}

STATE_SCHEMA = T.StructType(
    [
        T.StructField("source", T.StringType(), False),
        T.StructField("run_seq", T.LongType(), False),
        T.StructField("mode", T.StringType(), False),
        T.StructField("status", T.StringType(), False),
        T.StructField("version", T.StringType()),
        T.StructField("watermark", T.TimestampNTZType()),
        T.StructField("records", T.LongType()),
        T.StructField("started_at", T.TimestampNTZType()),
        T.StructField("completed_at", T.TimestampNTZType()),
        T.StructField("error", T.StringType()),
    ]
)

VOLUME_SCHEMA = T.StructType(
    [
        T.StructField("table_name", T.StringType(), False),
        T.StructField("mode", T.StringType(), False),
        T.StructField("run_seq", T.LongType(), False),
        T.StructField("row_count", T.LongType(), False),
    ]
)


def append(spark: SparkSession, path: str, schema: T.StructType, rows: Iterable[tuple]) -> None:
    """The few ``rows`` as one file. An Arrow table is a local relation for Spark,
    which starts without Python rows being sent to tasks.
    """
    names = schema.fieldNames()
    table = pa.Table.from_pylist(
        [dict(zip(names, row)) for row in rows],
        pa.schema([(f.name, _ARROW_TYPES[f.dataType.simpleString()]) for f in schema.fields]),
    )
    spark.createDataFrame(table, schema).coalesce(1).write.mode("append").parquet(path)
    system, root = _place(spark, path)
    last = _newest_checkpoint(spark, system, root)
    if len(_visible(system, root) - last.covered) > TAIL_FILES:
        compact(spark, path, schema)


def read_log(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All entries; empty if the log was never written. Read errors are raised."""
    system, root = _place(spark, path)
    if not system.exists(root):
        return spark.createDataFrame([], schema)
    last = _newest_checkpoint(spark, system, root)
    if not last.number:
        return spark.read.schema(schema).parquet(path)
    return _read_parts(spark, path, schema, last, _visible(system, root) - last.covered)


# -- checkpoint and tail -----------------------------------------------------------


@dataclass(frozen=True)
class Checkpoint:
    """Number of a checkpoint (0: none) and the files whose entries it holds."""

    number: int = 0
    covered: frozenset[str] = frozenset()


def compact(spark: SparkSession, path: str, schema: T.StructType) -> None:
    """Puts all entries into a checkpoint, so that a log of any length has few files.

    The checkpoint counts once the list of the files that it covers is renamed to its
    place; a compaction that breaks earlier leaves the log as it was. Files that the
    checkpoint before covered are removed now, not earlier: a reader that listed the
    log just before a compaction still finds its files. Of two compactions at once
    both are whole, and the higher number counts.
    """
    system, root = _place(spark, path)
    before = _newest_checkpoint(spark, system, root)
    files = _visible(system, root)
    number = claim_run(spark, f"{path}/{CHECKPOINTS}", before.number + 1)
    rows = _read_parts(spark, path, schema, before, files - before.covered)
    rows.hint("rebalance").write.mode("overwrite").parquet(_rows_of(path, number))
    hadoop = spark._jvm.org.apache.hadoop.fs
    folder = hadoop.Path(root, CHECKPOINTS)
    draft = hadoop.Path(folder, f"draft-{number:08d}")
    stream = system.create(draft, True)
    stream.write("\n".join(sorted(files)).encode())
    stream.close()
    if not system.rename(draft, hadoop.Path(folder, f"files-{number:08d}")):
        raise OSError(f"checkpoint {number} of {path} could not be put in place")
    for name in before.covered & files:
        system.delete(hadoop.Path(root, name), False)
    for status in system.listStatus(folder):
        if int(status.getPath().getName().rsplit("-", 1)[1]) < before.number:
            system.delete(status.getPath(), True)


def _place(spark: SparkSession, path: str):
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    return root.getFileSystem(spark._jsc.hadoopConfiguration()), root


def _visible(system, root) -> frozenset[str]:
    names = (s.getPath().getName() for s in system.listStatus(root) if s.isFile())
    return frozenset(name for name in names if not name.startswith(("_", ".")))


def _rows_of(path: str, number: int) -> str:
    return f"{path}/{CHECKPOINTS}/rows-{number:08d}"


def _newest_checkpoint(spark: SparkSession, system, root) -> Checkpoint:
    folder = spark._jvm.org.apache.hadoop.fs.Path(root, CHECKPOINTS)
    if not system.exists(folder):
        return Checkpoint()
    names = [s.getPath().getName() for s in system.listStatus(folder)]
    lists = [name for name in names if name.startswith("files-")]
    if not lists:
        return Checkpoint()
    newest = max(lists)
    stream = system.open(spark._jvm.org.apache.hadoop.fs.Path(folder, newest))
    text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    stream.close()
    return Checkpoint(int(newest.rsplit("-", 1)[1]), frozenset(text.split("\n")))


def _read_parts(
    spark: SparkSession, path: str, schema: T.StructType, last: Checkpoint, tail: Iterable[str]
) -> DataFrame:
    paths = [f"{path}/{name}" for name in sorted(tail)]
    if last.number:
        paths.insert(0, _rows_of(path, last.number))
    return spark.read.schema(schema).parquet(*paths)


def append_state(spark: SparkSession, path: str, **entry) -> None:
    if entry["status"] not in STATUSES:
        raise ValueError(f"status must be among {', '.join(STATUSES)}")
    append(spark, path, STATE_SCHEMA, [tuple(entry.get(f.name) for f in STATE_SCHEMA.fields)])


def current_state(spark: SparkSession, path: str, up_to: int | None = None) -> DataFrame:
    """The newest successful entry of every source, one row per source; of runs up to ``up_to`` if given."""
    log = read_log(spark, path, STATE_SCHEMA).filter("status = 'success'")
    if up_to is not None:
        log = log.filter(F.col("run_seq") <= up_to)
    entry = F.struct(*(f.name for f in STATE_SCHEMA.fields))
    return (
        log.groupBy("source")
        .agg(F.max_by(entry, "run_seq").alias("entry"))
        .select("entry.*")
    )


def last_success(spark: SparkSession, path: str, source: str, up_to: int | None = None) -> Row | None:
    """The newest successful entry of ``source``, of runs up to number ``up_to`` if given."""
    return current_state(spark, path, up_to).filter(F.col("source") == source).first()


def claim_run(spark: SparkSession, path: str, number: int) -> int:
    """A run number of one's own, ``number`` or the next free one.

    A claim is an empty file that is created only if absent, in one step of the file
    system, so two runs that start at once get two numbers.
    """
    hadoop = spark._jvm.org.apache.hadoop.fs
    root = hadoop.Path(path)
    system = root.getFileSystem(spark._jsc.hadoopConfiguration())
    system.mkdirs(root)
    while not _create_if_absent(system, hadoop.Path(root, f"run-{number:08d}")):
        number += 1
    return number


def _create_if_absent(system, target) -> bool:
    if system.getScheme() == "file":
        # Hadoop's local file system looks first and creates then; the operating system does both at once.
        try:
            open(target.toUri().getPath(), "x").close()
        except FileExistsError:
            return False
        return True
    try:
        system.create(target, False).close()
    except Py4JJavaError:
        if system.exists(target):
            return False
        raise
    return True


def run_state(spark: SparkSession, path: str, source: str) -> tuple[Row | None, int]:
    """The newest successful entry of ``source`` and the number of the next run."""
    log = read_log(spark, path, STATE_SCHEMA)
    entry = F.struct(*(f.name for f in STATE_SCHEMA.fields))
    # One row per source and status.
    newest = (
        log.groupBy("source", "status").agg(F.max_by(entry, "run_seq").alias("entry")).collect()
    )
    last = [r["entry"] for r in newest if (r["source"], r["status"]) == (source, "success")]
    number = max((r["entry"]["run_seq"] for r in newest), default=0) + 1
    return (last[0] if last else None), number


def previous_volume(spark: SparkSession, path: str, table: str, mode: str) -> int | None:
    """Row count of the last run of this table in this mode."""
    log = read_log(spark, path, VOLUME_SCHEMA)
    mine = log.filter((F.col("table_name") == table) & (F.col("mode") == mode))
    return mine.agg(F.max_by("row_count", "run_seq")).first()[0]
