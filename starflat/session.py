"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_LOCAL_ROOTS: dict[str, str] = {}


PARTITION_BYTES = 256 * 1024**2
MIN_PARTITIONS, MAX_PARTITIONS = 200, 1_000_000


def initial_partitions(shuffle_bytes: int) -> int:
    """Partitions a shuffle of this size starts with, before AQE merges small ones."""
    return max(MIN_PARTITIONS, min(MAX_PARTITIONS, -(-shuffle_bytes // PARTITION_BYTES)))


def build_session(
    app_name: str = "starflat",
    master: str | None = None,
    shuffle_bytes: int | None = None,
    **settings: str,
) -> SparkSession:
    """A session with the settings the package is designed for.

    AQE merges small partitions but splits only skewed ones, so a large load needs
    enough of them from the start: give ``shuffle_bytes``, the expected size of the
    largest shuffle. It sets the start value of AQE and leaves
    ``spark.sql.shuffle.partitions`` alone, which fixes the state partitions of a
    stream for good.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.streaming.stateStore.providerClass": (
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
        ),
    }
    if shuffle_bytes is not None:
        key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
        defaults[key] = str(initial_partitions(shuffle_bytes))
    for key, value in {**defaults, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under ``spark.checkpoint.dir``, seen by all executors.

    Where the setting is missing a temporary folder is used, in local mode
    only: on a cluster it would exist on one machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        context = spark.sparkContext
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = _LOCAL_ROOTS.setdefault(
            context.applicationId, tempfile.mkdtemp(prefix="starflat-")
        )
    return f"{root.rstrip('/')}/starflat/{name}-{uuid.uuid4().hex}"
