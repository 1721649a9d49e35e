"""Runs: land, check, flatten, write once under guards, publish by the manifest.

``full`` loads everything as a new version. ``incremental`` reads the look-back and, with
``follow_dimensions``, the dates that changed dimension rows reach. ``reconcile``
compares the whole source with what was published, date by date, and loads only
dates that differ: late rows beyond the look-back, changed rows, deleted rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Collection, Mapping
from dataclasses import dataclass, field, replace
from datetime import UTC, date, datetime

from pyspark.sql import DataFrame, Row, SparkSession, types as T
from pyspark.sql import functions as F

from starflat.operators import history, ledger, manifest, publish, reconcile
from starflat.operators.checks import Check, gate, run_checks, run_suites, volume_check
from starflat.operators.flatten import Star, flatten
from starflat.operators.metrics import RunMetrics
from starflat.operators.partials import PERIOD
from starflat.operators.publish import GuardSpec
from starflat.operators.sinks import parse_formats, read_schema, write_csv, write_schema
from starflat.sources.incremental import cutoff_date, slice_since
from starflat.sources.tables import assert_same_schema, require_rows

MODES = ("full", "incremental", "reconcile")


@dataclass(frozen=True)
class FlatJob:
    """A flat table under ``base``; the fact alone advances by watermark.

    The table itself is Parquet; ``formats`` with ``csv`` adds the rows of each run
    as CSV. A run needs ``min_rows`` rows of every table; only the slice of an
    increment may be empty. With ``bronze`` the landed rows of every run stay, for
    :func:`replay`; it needs ``source_id``, the fact's key. With ``unique_history`` a run is
    refused whose ids are published on dates that it does not replace; filters of the
    ids lie beside the rows of each run, under the same manifest.
    """

    base: str
    star: Star
    source_time: str
    output_time: str
    output_id: str
    zone: str
    partition_by: str = "event_date"
    lookback_days: int = 7
    guards: GuardSpec = GuardSpec()
    suites: Mapping[str, list[Check]] = field(default_factory=dict)
    volume_tolerance: float = 0.5
    min_rows: int = 1
    compression: str = "snappy"
    formats: str = "parquet"
    bronze: bool = False
    source_id: str | None = None
    follow_dimensions: bool = False
    unique_history: bool = False

    @property
    def source(self) -> str:
        return self.star.fact


@dataclass(frozen=True)
class RunResult:
    mode: str
    run_seq: int
    rows_in: int
    rows_out: int
    version: str | None
    watermark: datetime | None
    cutoff: date | None
    checks: list[Row]
    bytes_out: int = 0

    @property
    def yield_percent(self) -> float:
        return self.rows_out * 100.0 / self.rows_in if self.rows_in else 0.0


def run(
    spark: SparkSession, frames: Mapping[str, DataFrame], job: FlatJob, mode: str
) -> RunResult:
    """One run. The state entry is the last effect, so a run that breaks earlier
    is repeated over the same slice and replaces the same partitions.

    An incremental or reconciling run without an earlier success loads everything.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be among {', '.join(MODES)}")
    state = publish.state_path(job.base)
    last, free = ledger.run_state(spark, state, job.source)
    seq = ledger.claim_run(spark, f"{job.base}/claims", free)
    started = _now()
    metrics = RunMetrics({"source": job.source, "mode": mode, "run": str(seq)})
    entry = {"source": job.source, "run_seq": seq, "mode": mode, "started_at": started}
    ledger.append_state(spark, state, **entry, status="running")
    try:
        result = _run(spark, frames, job, mode, last, seq, metrics)
    except Exception as error:
        metrics.error(error)
        metrics.save(spark, f"{job.base}/metrics")
        ledger.append_state(
            spark, state, **entry, status="failed", completed_at=_now(), error=str(error)
        )
        raise
    ledger.append_state(
        spark,
        state,
        **entry,
        status="success",
        version=result.version,
        watermark=result.watermark,
        records=result.rows_out,
        completed_at=_now(),
    )
    if job.follow_dimensions and last is not None:
        for table in reconcile.dimension_keys(job.star):
            publish.remove(spark, _dimension_path(job, table, last["run_seq"]))
    metrics.gauge("rows_in", result.rows_in)
    metrics.gauge("rows_out", result.rows_out)
    metrics.gauge("yield_percent", result.yield_percent)
    metrics.gauge("output_columns", len(job.star.outputs))
    metrics.gauge("output_bytes", result.bytes_out)
    for r in result.checks:
        labels = {"table": r["table_name"], "check": r["check_name"], "column": r["column_name"]}
        metrics.gauge("check", r["value"], **labels, status=r["status"])
    for status in ("PASS", "WARN", "FAIL"):
        found = sum(r["status"] == status for r in result.checks)
        metrics.gauge("checks", found, status=status)
    seconds = metrics.seconds("write")
    metrics.gauge("rows_per_second", result.rows_out / seconds if seconds else 0.0)
    metrics.save(spark, f"{job.base}/metrics")
    return result


def _run(
    spark: SparkSession,
    frames: Mapping[str, DataFrame],
    job: FlatJob,
    mode: str,
    last: Row | None,
    seq: int,
    metrics: RunMetrics,
) -> RunResult:
    replacing = mode != "full" and last is not None and last["watermark"] is not None
    cutoff = cutoff_date(last["watermark"], job.lookback_days) if replacing and mode == "incremental" else None
    with metrics.stage("compare"):
        stale = _stale_dates(spark, frames, job, mode, last, seq, replacing)
    # Dimensions are read whole: a fact row of the slice may refer to any of them.
    fact = frames[job.source]
    if replacing:
        fact = _on_dates(fact, job, stale, cutoff)
    # The slice is landed once: the gate, the search for hot keys and the join all see
    # the same rows, and the source is read a single time. The unique part keeps two
    # runs that start at once out of each other's folders.
    name = f"{seq:08d}-{uuid.uuid4().hex[:8]}"
    landed = f"{job.base}/bronze/run={name}" if job.bronze else f"{job.base}/landed/run-{name}"
    try:
        with metrics.stage("land"):
            rows = fact
            if job.bronze:
                rows = fact.withColumns({_RUN: F.lit(seq).cast("long"), _LANDED: F.lit(_now()).cast("timestamp_ntz")})
            rows.write.option("compression", job.compression).parquet(landed)
        fact = spark.read.schema(fact.schema).parquet(landed)
        inputs = {**frames, job.source: fact}
        return _publish(spark, inputs, job, mode, last, seq, metrics, cutoff, name, replacing, stale)
    except Exception:
        publish.remove(spark, landed)
        raise
    finally:
        if not job.bronze:
            publish.remove(spark, landed)


_RUN, _LANDED = "_run_seq", "_landed_at"


def _on_dates(fact: DataFrame, job: FlatJob, dates: list[str], cutoff: date | None) -> DataFrame:
    """Rows from ``cutoff`` on, and rows of the given dates. The source gets the range of
    the dates as a predicate on the bare time column, a day looser at both ends."""
    found = fact.limit(0) if cutoff is None else slice_since(fact, job.source_time, job.zone, cutoff)
    early = [d for d in dates if cutoff is None or d < cutoff.isoformat() or d == manifest.NO_DATE]
    if not early:
        return found
    known = [d for d in early if d != manifest.NO_DATE]
    local, near = F.col(job.source_time), F.lit(False)
    if known:
        low, high = (F.lit(d).cast("timestamp_ntz") for d in (min(known), max(known)))
        near = (local >= low - F.expr("INTERVAL 1 DAY")) & (local < high + F.expr("INTERVAL 2 DAYS"))
    if len(known) < len(early):
        near = near | local.isNull()
    return found.unionByName(fact.filter(near).filter(reconcile.utc_date(job.source_time, job.zone).isin(early)))


def _stale_dates(
    spark: SparkSession,
    frames: Mapping[str, DataFrame],
    job: FlatJob,
    mode: str,
    last: Row | None,
    seq: int,
    replacing: bool,
) -> list[str]:
    """Dates to load again because their source rows or their dimension rows changed; one
    name per date comes to the driver."""
    found = None
    if job.follow_dimensions:
        changed = {}
        for table, key in reconcile.dimension_keys(job.star).items():
            path = _dimension_path(job, table, seq)
            reconcile.key_digests(frames[table], key).write.mode("overwrite").parquet(path)
            now = spark.read.parquet(path)
            if replacing:
                # Without an earlier snapshot every key counts as changed.
                then = ledger.read_log(spark, _dimension_path(job, table, last["run_seq"]), now.schema)
                changed[table] = reconcile.changed_keys(now, then)
        if replacing:
            found = reconcile.affected_dates(frames, job.star, changed, job.source_time, job.zone)
    if replacing and mode == "reconcile":
        differing = stale_report(spark, frames, job, last).select("event_date")
        found = differing if found is None else found.unionByName(differing)
    return [] if found is None else sorted({r["event_date"] for r in found.distinct().collect()})


def stale_report(spark: SparkSession, frames: Mapping[str, DataFrame], job: FlatJob, last: Row) -> DataFrame:
    """Dates of the source that differ from what the run of the state ``last`` and those before it loaded."""
    now = reconcile.date_digests(frames[job.source], job.source_time, job.zone)
    return reconcile.differing_dates(now, manifest.snapshot(spark, job.base, job.source, last))


def _dimension_path(job: FlatJob, table: str, seq: int) -> str:
    return f"{job.base}/dimensions/{table}/run={seq:08d}"


def _publish(
    spark: SparkSession,
    inputs: Mapping[str, DataFrame],
    job: FlatJob,
    mode: str,
    last: Row | None,
    seq: int,
    metrics: RunMetrics,
    cutoff: date | None,
    name: str,
    replacing: bool,
    stale: list[str],
) -> RunResult:
    """Everything that follows the landing of the slice."""
    fact = inputs[job.source]
    with metrics.stage("count"):
        digests = {
            r["event_date"]: (r["source_rows"], r["digest"])
            for r in reconcile.date_digests(fact, job.source_time, job.zone).collect()
        }
    rows_in = sum(n for n, _ in digests.values())
    gone = [d for d in stale if d not in digests]
    required = {t: df for t, df in inputs.items() if not (replacing and t == job.source)}
    with metrics.stage("min_rows"):
        require_rows(required, job.min_rows)
    if rows_in == 0:  # nothing new since the last increment
        with metrics.stage("checks"):
            checks = gate(run_checks(fact, job.source, [_volume(spark, job, mode)]))
        _record(spark, job, last["version"], seq, digests, {}, gone)
        _store_volume(spark, job, mode, seq, 0)
        return RunResult(mode, seq, 0, 0, last["version"], last["watermark"], cutoff, checks)

    with metrics.stage("checks"):
        checks = _check(spark, inputs, job, mode)

    version = last["version"] if replacing else f"v{name}"
    root = publish.version_path(job.base, version)
    target = f"{root}/run={name}"
    formats = parse_formats(job.formats)
    try:
        with metrics.stage("write"):
            flat = flatten(inputs, job.star)
            schema = publish.schema_path(job.base, version)
            if replacing:
                assert_same_schema(flat, read_schema(spark, schema))
            staged = publish.stage(
                flat, target, job.guards, job.partition_by, job.output_time, job.output_id, job.compression
            )
            if not replacing:
                write_schema(flat, schema)
        if job.unique_history:
            with metrics.stage("unique"):
                _keep_unique(spark, job, staged.rows, f"{publish.filters_path(job.base, version)}/run={name}",
                             last if replacing else None, {*digests, *gone})
        bytes_out = publish.folder_bytes(spark, target)
        if "csv" in formats:
            with metrics.stage("csv"):
                write_csv(staged.rows, f"{job.base}/csv/run-{seq:08d}", (job.output_time, job.output_id))
        with metrics.stage("publish"):
            written = {d: name for d in manifest.written_dates(spark, target, job.partition_by)}
            _record(spark, job, version, seq, digests, written, gone)
    except Exception:
        publish.remove(spark, target if replacing else root)
        publish.remove(spark, f"{publish.filters_path(job.base, version)}/run={name}")
        raise
    known = [t for t in (staged.last, last["watermark"] if replacing else None) if t]
    _store_volume(spark, job, mode, seq, rows_in)
    watermark = max(known, default=None)
    return RunResult(
        mode, seq, rows_in, staged.count, version, watermark, cutoff, checks, bytes_out
    )


def _keep_unique(
    spark: SparkSession, job: FlatJob, rows: DataFrame, path: str, last: Row | None, replaced: set[str]
) -> None:
    """Refuses ids that other published dates hold, and writes the filters of the new rows."""
    if last is not None:
        history.require_new(published_duplicates(spark, job, rows, replaced, last), job.output_id)
    history.write_filters(rows, job.output_id, F.col(job.partition_by).cast("string"), path)


def published_duplicates(
    spark: SparkSession, job: FlatJob, ids: DataFrame, replaced: Collection[str] = (), state: Row | None = None
) -> DataFrame:
    """``(output_id, period)``: ids of ``ids`` that published dates other than ``replaced`` hold.

    The filters of a date lie under the folder that the manifest names for its rows, so
    they are as old as those. Only dates with a candidate are read, of them the ids
    alone; dates of runs without filters are read always.
    """
    state = state or publish.published_state(spark, job.base, job.source)
    newest = manifest.snapshot(spark, job.base, job.source, state).filter("folder IS NOT NULL")
    places = [(r["folder"], r["event_date"]) for r in newest.select("folder", "event_date").collect()]
    places = [p for p in places if p[1] not in replaced]
    schema = read_schema(spark, publish.schema_path(job.base, state["version"]))

    def read(periods: list[str | None]) -> DataFrame:
        named = {manifest.NO_DATE if p is None else p for p in periods}
        root = publish.version_path(job.base, state["version"])
        rows = manifest.read_dates(spark, root, schema, job.partition_by, [p for p in places if p[1] in named])
        return rows.select(job.output_id, F.col(job.partition_by).cast("string").alias(PERIOD))

    filters, unfiltered = history.read_filters(spark, publish.filters_path(job.base, state["version"]), places)
    return history.duplicates(ids, job.output_id, filters, read, unfiltered)


def _record(
    spark: SparkSession,
    job: FlatJob,
    version: str,
    seq: int,
    digests: Mapping[str, tuple[int, str]],
    written: Mapping[str, str],
    gone: list[str],
) -> None:
    """The manifest rows of a run: every date it loaded, those without output rows included."""
    entries = [
        manifest.DateEntry(d, written.get(d), *digests.get(d, (0, "0")))
        for d in sorted({*digests, *written, *gone})
    ]
    manifest.record(spark, publish.manifest_path(job.base), job.source, version, seq, entries)


# -- bronze and silver -------------------------------------------------------------


def read_bronze(spark: SparkSession, frames: Mapping[str, DataFrame], job: FlatJob) -> DataFrame:
    """The landed rows of all successful runs, with the run that landed them and when."""
    ingestion = [T.StructField(_RUN, T.LongType()), T.StructField(_LANDED, T.TimestampNTZType())]
    schema = T.StructType([*frames[job.source].schema.fields, *ingestion])
    rows = ledger.read_log(spark, f"{job.base}/bronze", schema).select(*schema.fieldNames())
    log = ledger.read_log(spark, publish.state_path(job.base), ledger.STATE_SCHEMA)
    done = log.filter((F.col("status") == "success") & (F.col("source") == job.source))
    return rows.join(done.select(F.col("run_seq").cast("long").alias(_RUN)).distinct(), _RUN, "left_semi")


def silver(spark: SparkSession, frames: Mapping[str, DataFrame], job: FlatJob) -> DataFrame:
    """The newest landed row of each id, by one aggregate; equally new ones in favour of the larger hash.

    Rows without an id are kept once per content. Rows that the source deleted are
    still here: bronze holds what arrived.
    """
    if not job.source_id:
        raise ValueError("silver needs the job's source_id")
    columns = frames[job.source].columns
    landed = read_bronze(spark, frames, job)
    rank = F.struct(F.col(_RUN), reconcile.row_hash(landed.select(*columns)).alias("h"))
    newest = (
        landed.filter(F.col(job.source_id).isNotNull())
        .groupBy(job.source_id)
        .agg(F.max_by(F.struct(*columns), rank).alias("newest"))
        .select("newest.*")
    )
    return newest.unionByName(landed.filter(F.col(job.source_id).isNull()).select(*columns).distinct())


def replay(spark: SparkSession, frames: Mapping[str, DataFrame], job: FlatJob) -> RunResult:
    """A full run whose fact comes from bronze instead of the source; lands nothing again."""
    return run(spark, {**frames, job.source: silver(spark, frames, job)}, replace(job, bronze=False), "full")


def _check(
    spark: SparkSession, frames: Mapping[str, DataFrame], job: FlatJob, mode: str
) -> list[Row]:
    if not job.suites:
        return []
    suites = {table: list(checks) for table, checks in job.suites.items()}
    fact_checks = [c for c in suites.get(job.source, []) if c.kind != "volume"]
    suites[job.source] = [*fact_checks, _volume(spark, job, mode)]
    return gate(run_suites(frames, suites))


def _volume(spark: SparkSession, job: FlatJob, mode: str) -> Check:
    previous = ledger.previous_volume(spark, f"{job.base}/volumes", job.source, mode)
    return volume_check(previous, job.volume_tolerance)


def _store_volume(spark: SparkSession, job: FlatJob, mode: str, seq: int, rows: int) -> None:
    entry = (job.source, mode, seq, rows)
    ledger.append(spark, f"{job.base}/volumes", ledger.VOLUME_SCHEMA, [entry])


def _now() -> datetime:
    return datetime.now(UTC).replace(tzinfo=None)
