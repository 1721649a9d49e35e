"""Publishing without a moment in which readers see half a table.

Every run writes its rows once, to a folder of its own, and appends to the manifest which
dates it loaded. It becomes visible as a whole when its state entry is appended: a
full run as a new version, an increment as the new place of its dates. Until
then, and if it breaks, readers see what they saw before.

Folder layout: ``data/<version>/run=<run>``, ``schema/<version>``, ``manifest``,
``bronze/run=<run>``, ``dimensions/<table>/run=<run>``, ``state``, ``volumes``, ``metrics``.
"""

from __future__ import annotations

import json
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from starflat.operators.guards import enforce_guards, guard_counts, require_money
from starflat.operators.ledger import STATE_SCHEMA, last_success, read_log
from starflat.operators.manifest import dates_of_runs, read_dates, snapshot
from starflat.operators.sinks import read_schema, write_parquet


@dataclass(frozen=True)
class GuardSpec:
    """Which output columns must be masked, hashed and exact."""

    masked: tuple[str, ...] = ()
    hashed: tuple[str, ...] = ()
    money: tuple[str, ...] = ()


def state_path(base: str) -> str:
    return f"{base}/state"


def version_path(base: str, version: str) -> str:
    return f"{base}/data/{version}"


def schema_path(base: str, version: str) -> str:
    return f"{base}/schema/{version}"


def manifest_path(base: str) -> str:
    return f"{base}/manifest"


def filters_path(base: str, version: str) -> str:
    return f"{base}/filters/{version}"


def published_state(spark: SparkSession, base: str, source: str, run_seq: int | None = None) -> Row:
    """The newest successful entry, or the newest as of run ``run_seq``; raises if nothing was published."""
    state = last_success(spark, state_path(base), source, run_seq)
    if state is None or state["version"] is None:
        raise LookupError(f"nothing published under {base}")
    return state


def read_published(
    spark: SparkSession, base: str, source: str, run_seq: int | None = None, partition_by: str = "event_date"
) -> DataFrame:
    """The table as the newest successful run left it, or as of an earlier run.

    What is read is fixed when this is called: runs that follow do not change it.
    """
    state = published_state(spark, base, source, run_seq)
    schema = read_schema(spark, schema_path(base, state["version"]))
    places = [
        (r["folder"], r["event_date"]) for r in snapshot(spark, base, source, state).filter("folder IS NOT NULL").collect()
    ]
    return read_dates(spark, version_path(base, state["version"]), schema, partition_by, places)


@dataclass(frozen=True)
class Staged:
    """Written and guarded rows; everything later reads these."""

    rows: DataFrame
    count: int
    last: datetime | None


def stage(
    flat: DataFrame,
    path: str,
    guards: GuardSpec,
    partition_by: str,
    time_column: str,
    id_column: str,
    compression: str = "snappy",
) -> Staged:
    """``flat`` written once; guards, row count and last time are observed by the tasks that
    write, so the rows are not read again. A rejected write is removed.
    """
    spark = flat.sparkSession
    require_money(flat, guards.money)
    seen = Observation()

    def watch(rows: DataFrame) -> DataFrame:
        return rows.observe(
            seen,
            F.count(F.lit(1)).alias("n"),
            F.max(time_column).cast("string").alias("last"),
            F.to_json(guard_counts(rows, guards.masked, guards.hashed)).alias("guards"),
        )

    try:
        write_parquet(flat, path, partition_by, (time_column, id_column), compression, watch=watch)
        found = seen.get
        enforce_guards([Row(**r) for r in json.loads(found["guards"])])
    except Exception:
        remove(spark, path)
        raise
    last = datetime.fromisoformat(found["last"]) if found["last"] else None
    return Staged(spark.read.schema(flat.schema).parquet(path), found["n"], last)


def remove(spark: SparkSession, path: str) -> bool:
    """Deletes a folder this package wrote, on whatever file system it is; whether there was one."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def folder_bytes(spark: SparkSession, path: str) -> int:
    """Size of all files below a folder."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = target.getFileSystem(spark._jsc.hadoopConfiguration())
    return int(system.getContentSummary(target).getLength())


def drop_old_versions(spark: SparkSession, base: str, source: str, keep: int = 2) -> list[str]:
    """Removes all but the newest ``keep`` published versions; returns what it removed."""
    if keep < 1:
        raise ValueError("the current version must be kept")
    log = read_log(spark, state_path(base), STATE_SCHEMA)
    published = (
        log.filter((F.col("status") == "success") & (F.col("source") == source))
        .groupBy("version")
        .agg(F.max("run_seq").alias("newest"))
        .orderBy(F.desc("newest"))
    )
    old = [row["version"] for row in published.collect()[keep:] if row["version"]]
    for version in old:
        remove(spark, version_path(base, version))
        remove(spark, schema_path(base, version))
        remove(spark, filters_path(base, version))
    return old


def drop_superseded(spark: SparkSession, base: str, source: str) -> list[str]:
    """Removes date folders of the current version that the newest snapshot does not use any more.

    Snapshots as of earlier runs cannot be read afterwards. Returns what was removed.
    """
    state = published_state(spark, base, source)
    current = snapshot(spark, base, source, state).select("event_date", "folder")
    unused = (
        dates_of_runs(spark, base, source, state)
        .filter("folder IS NOT NULL")
        .select("event_date", "folder")
        .distinct()
        .join(current, ["event_date", "folder"], "left_anti")
    )
    root = version_path(base, state["version"])
    filters = filters_path(base, state["version"])
    old = [(r["folder"], r["event_date"]) for r in unused.collect()]
    for folder, date in old:
        remove(spark, f"{filters}/run={folder}/period={date}")
    paths = [f"{root}/run={folder}/event_date={date}" for folder, date in old]
    return [path for path in paths if remove(spark, path)]
