"""The incremental load as a stream: late rows, duplicates, whole batches.

Rows may arrive up to ``delay`` late and more than once. Each attempt at a micro-batch
writes its rows once, to a folder of its own, and counts from its entry in the batch log
on; the newest entry of a batch id counts. So readers see whole batches, and a batch
that runs again replaces exactly what it wrote.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from datetime import UTC, datetime, timedelta

from pyspark.sql import DataFrame, Row, SparkSession, types as T
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from starflat.operators.checks import Check, gate, run_checks
from starflat.operators.flatten import Star, flatten
from starflat.operators.ledger import append, read_log
from starflat.operators.metrics import RunMetrics
from starflat.operators.publish import GuardSpec, remove, stage

_EVENT_TIME = "_event_time"

BATCH_SCHEMA = T.StructType(
    [
        T.StructField("batch_id", T.LongType(), False),
        T.StructField("run", T.StringType(), False),
        T.StructField("rows_in", T.LongType()),
        T.StructField("rows_out", T.LongType()),
        T.StructField("waiting", T.LongType()),
        T.StructField("expired", T.LongType()),
        T.StructField("newest", T.TimestampNTZType()),
        T.StructField("last", T.TimestampNTZType()),
        T.StructField("completed_at", T.TimestampNTZType()),
    ]
)


def read_stream(
    spark: SparkSession, path: str, schema: T.StructType, files_per_trigger: int | None = None
) -> DataFrame:
    """New Parquet files of a folder as they arrive."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def first_arrivals(stream: DataFrame, id_column: str, time_column: str, delay: str) -> DataFrame:
    """Each id once, for copies that arrive within ``delay`` of each other.

    Watermarks need TIMESTAMP, so the wall time is cast in the session zone; the
    cast column decides lateness only and is dropped again.
    """
    return (
        stream.withColumn(_EVENT_TIME, F.col(time_column).cast("timestamp"))
        .withWatermark(_EVENT_TIME, delay)
        .dropDuplicatesWithinWatermark([id_column])
        .drop(_EVENT_TIME)
    )


def start_merge(
    stream: DataFrame,
    dimensions: Mapping[str, DataFrame],
    star: Star,
    base: str,
    id_column: str,
    time_column: str,
    output_id: str,
    output_time: str,
    guards: GuardSpec = GuardSpec(),
    delay: str = "7 days",
    partition_by: str = "event_date",
    suite: Sequence[Check] = (),
    wait_days: int | None = None,
) -> StreamingQuery:
    """Loads what is there and stops; started again it goes on where it stopped.

    Each batch passes the gate of ``suite`` before it is joined, as a batch run
    does. Facts that do not find all their dimensions yet wait: they are stored
    beside the batch and joined again with the next one. With ``wait_days`` those that
    are so many days older than the newest fact seen, or have no time, go to quarantine
    (:func:`read_expired`) when they are not found again, so what waits stays bounded.
    """
    spark = stream.sparkSession
    arrivals = first_arrivals(stream, id_column, time_column, delay)

    def load(batch: DataFrame, batch_id: int) -> None:
        metrics = RunMetrics({"source": star.fact, "mode": "stream", "run": str(batch_id)})
        run = f"{batch_id:08d}-{uuid.uuid4().hex[:8]}"
        # Landed first: the micro-batch is evaluated once, and what follows is a
        # batch query that AQE may re-plan.
        landed_path = f"{base}/landed/run={run}"
        try:
            with metrics.stage("land"):
                batch.write.parquet(landed_path)
            landed = spark.read.schema(batch.schema).parquet(landed_path)
            entry = merge(batch_id, run, landed, metrics)
        except Exception:
            for kind in ("data", "waiting"):
                remove(spark, f"{base}/{kind}/run={run}")
            if not batches(spark, base):
                remove(spark, f"{base}/data")
            raise
        finally:
            remove(spark, landed_path)
        earlier = _log(spark, base)
        append(spark, f"{base}/batches", BATCH_SCHEMA, [(*entry, datetime.now(UTC).replace(tzinfo=None))])
        _tidy(spark, base, earlier, batch_id)
        for name, value in zip(("rows_in", "rows_out", "waiting", "expired"), entry[2:6]):
            metrics.gauge(name, value)
        metrics.save(spark, f"{base}/metrics")

    def merge(batch_id: int, run: str, landed: DataFrame, metrics: RunMetrics) -> tuple:
        """Everything between landing and log entry; gives the entry."""
        seen = landed.agg(F.count(F.lit(1)).alias("n"), F.max(time_column).cast("timestamp_ntz").alias("newest")).first()
        if suite and seen["n"]:
            with metrics.stage("checks"):
                gate(run_checks(landed, star.fact, suite))
        before = [b for b in batches(spark, base) if b["batch_id"] < batch_id]
        newest = max((t for t in (seen["newest"], *(b["newest"] for b in before)) if t), default=None)
        last = max((b["last"] for b in before if b["last"]), default=None)
        held = before[-1]["waiting"] if before else 0
        if not seen["n"] and not held:
            return batch_id, run, 0, 0, 0, 0, newest, last
        facts = landed.unionByName(read_waiting(spark, base, landed.schema, batch_id))
        with metrics.stage("write"):
            flat = flatten({**dimensions, star.fact: facts}, star)
            staged = stage(flat, f"{base}/data/run={run}", guards, partition_by, output_time, output_id)
        with metrics.stage("wait"):
            known = staged.rows.select(F.col(output_id).alias("_known"))
            lost = facts.join(known, F.col(id_column).eqNullSafe(F.col("_known")), "left_anti")
            over = F.lit(False)
            if wait_days is not None:
                limit = F.lit(None if newest is None else newest - timedelta(days=wait_days)).cast("timestamp_ntz")
                over = F.col(time_column).isNull() | F.coalesce(F.col(time_column) < limit, F.lit(False))
            # One write of both: the join runs once.
            lost.withColumn("over", over).write.partitionBy("over").parquet(f"{base}/waiting/run={run}")
            rows = _waiting(spark, base, run, landed.schema).groupBy("over").count().collect()
        counts = {r["over"]: r["count"] for r in rows}
        known_last = max((t for t in (last, staged.last) if t), default=None)
        return batch_id, run, seen["n"], staged.count, counts.get(False, 0), counts.get(True, 0), newest, known_last

    return (
        arrivals.writeStream.outputMode("append")
        .option("checkpointLocation", f"{base}/checkpoint")
        .trigger(availableNow=True)
        .foreachBatch(load)
        .start()
    )


def _log(spark: SparkSession, base: str) -> list[Row]:
    return read_log(spark, f"{base}/batches", BATCH_SCHEMA).collect()


def batches(spark: SparkSession, base: str) -> list[Row]:
    """The entry that counts of each batch, in order: rows in and out, facts that wait after
    it, facts whose time ran out with it, newest fact seen and last time published so far."""
    entries: dict[int, Row] = {}
    for row in sorted(_log(spark, base), key=lambda r: r["completed_at"]):
        entries[row["batch_id"]] = row
    return [entries[n] for n in sorted(entries)]


def _tidy(spark: SparkSession, base: str, earlier: list[Row], batch_id: int) -> None:
    """Removes what earlier attempts at a batch wrote, and facts that waited before the batch
    before it; the engine runs no batch again that is older than the last one."""
    for row in earlier:
        if row["batch_id"] == batch_id:
            for kind in ("data", "waiting"):
                remove(spark, f"{base}/{kind}/run={row['run']}")
        elif row["batch_id"] < batch_id - 1:
            remove(spark, f"{base}/waiting/run={row['run']}/over=false")


def _waiting(spark: SparkSession, base: str, run: str, schema: T.StructType) -> DataFrame:
    stored = T.StructType([*schema.fields, T.StructField("over", T.BooleanType())])
    return read_log(spark, f"{base}/waiting/run={run}", stored)


def read_waiting(
    spark: SparkSession, base: str, schema: T.StructType, before: int | None = None
) -> DataFrame:
    """Facts without all their dimensions after the newest batch (earlier than ``before``).

    A batch stores everything that still waits, so only the newest one counts and a
    batch that runs again reads what it read before.
    """
    earlier = [b for b in batches(spark, base) if before is None or b["batch_id"] < before]
    if not earlier or not earlier[-1]["waiting"]:
        return spark.createDataFrame([], schema)
    return _waiting(spark, base, earlier[-1]["run"], schema).filter("NOT over").drop("over")


def read_expired(spark: SparkSession, base: str, schema: T.StructType) -> DataFrame:
    """Facts that waited too long for their dimensions, from all batches."""
    paths = [f"{base}/waiting/run={b['run']}/over=true" for b in batches(spark, base) if b["expired"]]
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*paths)


def dropped_rows(query: StreamingQuery) -> int:
    """Rows that came later than the delay and were dropped, over the recent batches."""
    return sum(
        operator.numRowsDroppedByWatermark
        for progress in query.recentProgress
        for operator in progress.stateOperators
    )


def read_merged(spark: SparkSession, base: str) -> DataFrame:
    """All loaded batches as one table."""
    paths = [f"{base}/data/run={b['run']}" for b in batches(spark, base) if b["rows_out"]]
    if not paths:
        raise LookupError(f"nothing loaded under {base}")
    return spark.read.option("basePath", f"{base}/data").parquet(*paths).drop("run")
