"""Run metrics as rows: name, value, time, labels, type."""

from __future__ import annotations

import time
from collections.abc import Iterator, Mapping
from contextlib import contextmanager
from dataclasses import dataclass, field
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession, types as T
from pyspark.sql import functions as F

from starflat.operators.ledger import append, read_log

METRIC_SCHEMA = T.StructType(
    [
        T.StructField("name", T.StringType(), False),
        T.StructField("value", T.DoubleType(), False),
        T.StructField("ts", T.TimestampNTZType(), False),
        T.StructField("labels", T.MapType(T.StringType(), T.StringType()), False),
        T.StructField("type", T.StringType(), False),
    ]
)


@dataclass
class RunMetrics:
    """The few metric points of one run; ``save`` appends them to the metric log."""

    labels: Mapping[str, str] = field(default_factory=dict)
    points: list[tuple] = field(default_factory=list)

    def gauge(self, name: str, value: float, **labels: str) -> None:
        self._add(name, value, "gauge", labels)

    def error(self, error: BaseException) -> None:
        self._add("errors", 1.0, "counter", {"error": type(error).__name__})

    @contextmanager
    def stage(self, name: str) -> Iterator[None]:
        started = time.monotonic()
        try:
            yield
        finally:
            self._add("stage_seconds", time.monotonic() - started, "timer", {"stage": name})

    def seconds(self, stage: str) -> float:
        return sum(p[1] for p in self.points if p[3].get("stage") == stage and p[4] == "timer")

    def save(self, spark: SparkSession, path: str) -> None:
        append(spark, path, METRIC_SCHEMA, self.points)

    def _add(self, name: str, value: float, kind: str, labels: Mapping[str, str]) -> None:
        now = datetime.now(UTC).replace(tzinfo=None)
        self.points.append((name, float(value), now, {**self.labels, **labels}, kind))


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    return read_log(spark, path, METRIC_SCHEMA)


def metric_summary(metrics: DataFrame) -> DataFrame:
    """Points, total, mean and last value per metric and stage or error."""
    label = F.coalesce(F.col("labels")["stage"], F.col("labels")["error"], F.lit(""))
    return metrics.groupBy("name", label.alias("label")).agg(
        F.count(F.lit(1)).alias("points"),
        F.sum("value").alias("total"),
        F.avg("value").alias("mean"),
        F.max_by("value", "ts").alias("last"),
    )


def check_metrics(results: DataFrame) -> DataFrame:
    """Checks in total, failed and with warnings."""
    return results.agg(
        F.count(F.lit(1)).alias("checks_total"),
        F.count_if(F.col("status") == "FAIL").alias("checks_failed"),
        F.count_if(F.col("status") == "WARN").alias("checks_warned"),
    )
