from __future__ import annotations

from dataclasses import replace
from datetime import date
from decimal import Decimal
from pathlib import Path

import pytest
from bank_data import SALT, TRANSACTION, at
from pyspark.sql import functions as F

from starflat.operators import ledger, publish
from starflat.operators.checks import Rejected, null_check
from starflat.operators.flatten import Output, flatten
from starflat.operators.guards import GuardViolation
from starflat.operators.metrics import read_metrics
from starflat.operators.publish import GuardSpec, drop_old_versions, read_published
from starflat.plans import bank
from starflat.plans.runs import FlatJob, run
from starflat.sources.incremental import cutoff_date, missed_rows, slice_since
from starflat.sources.tables import SchemaMismatch, local_rows

GUARDS = GuardSpec(("card_masked",), ("card_hash", "email_hash"), ("txn_amount",))


def make_job(folder, **changes) -> FlatJob:
    job = FlatJob(
        base=folder,
        star=bank.gold_star(SALT),
        source_time="txn_time",
        output_time="txn_time",
        output_id="txn_id",
        zone=bank.SOURCE_ZONE,
        guards=GUARDS,
        suites=bank.suites(),
    )
    return replace(job, **changes)


def with_rows(spark, tiny, rows):
    rows = [(i, Decimal("1.00"), "x", at(t), 1, "debit") for i, t in rows]
    return {**tiny, "transaction": local_rows(spark, rows, TRANSACTION)}


def published(spark, folder):
    return sorted(r["txn_id"] for r in read_published(spark, folder, "transaction").collect())


def test_cutoff_is_a_whole_utc_date():
    assert cutoff_date(at("2024-10-13 00:30"), 7) == date(2024, 10, 6)
    with pytest.raises(ValueError):
        cutoff_date(at("2024-10-13 00:30"), -1)


def test_slice_keeps_the_whole_date(spark):
    # 21:00 local is 00:00 UTC of the next day.
    times = ["2024-10-05 20:59", "2024-10-05 21:00", "2024-10-06 12:00"]
    df = spark.createDataFrame([(at(t),) for t in times], "ts TIMESTAMP_NTZ")
    kept = slice_since(df, "ts", bank.SOURCE_ZONE, date(2024, 10, 6)).collect()
    assert sorted(r["ts"] for r in kept) == [at(t) for t in times[1:]]
    assert slice_since(df, "ts", bank.SOURCE_ZONE, None).count() == 3


def test_full_run(spark, tiny, folder):
    result = run(spark, tiny, make_job(folder), "full")
    assert (result.rows_in, result.rows_out, result.yield_percent) == (5, 5, 100.0)
    assert result.watermark == at("2025-03-10 00:10")
    expected = flatten(tiny, bank.gold_star(SALT))
    found = read_published(spark, folder, "transaction").select(expected.columns)
    assert sorted(map(str, found.collect())) == sorted(map(str, expected.collect()))
    assert {r["status"] for r in result.checks} == {"PASS"}
    names = {r["name"] for r in read_metrics(spark, f"{folder}/metrics").collect()}
    assert names >= {"rows_in", "rows_out", "yield_percent", "checks", "stage_seconds"}


def test_a_full_run_replaces_the_version(spark, tiny, folder):
    run(spark, with_rows(spark, tiny, [(1, "2024-01-01")]), make_job(folder), "full")
    run(spark, with_rows(spark, tiny, [(2, "2024-02-01")]), make_job(folder), "full")
    assert published(spark, folder) == [2]
    assert [v[:9] for v in drop_old_versions(spark, folder, "transaction", keep=1)] == ["v00000001"]
    assert published(spark, folder) == [2]
    assert not list(Path(folder, "data").glob("v00000001*"))


def test_incremental_keeps_history_and_takes_late_rows(spark, tiny, folder):
    job = make_job(folder)
    first = [(1, "2024-01-01 10:00"), (2, "2024-02-01 10:00")]
    run(spark, with_rows(spark, tiny, first), job, "incremental")
    late = [(3, "2024-01-28 10:00"), (4, "2024-02-03 10:00")]
    result = run(spark, with_rows(spark, tiny, first + late), job, "incremental")
    assert result.cutoff == date(2024, 1, 25)
    assert result.rows_in == 3
    assert published(spark, folder) == [1, 2, 3, 4]
    assert result.watermark == at("2024-02-03 13:00")


def test_running_again_changes_nothing(spark, tiny, folder):
    job = make_job(folder)
    for _ in range(3):
        run(spark, tiny, job, "incremental")
    assert published(spark, folder) == [1, 2, 3, 4, 5]
    assert not list(Path(folder, "staging").glob("*"))


def test_rows_beyond_the_look_back_are_found(spark, tiny, folder):
    job = make_job(folder)
    rows = [(1, "2024-02-01 10:00")]
    run(spark, with_rows(spark, tiny, rows), job, "incremental")
    frames = with_rows(spark, tiny, rows + [(2, "2024-01-02 10:00")])
    result = run(spark, frames, job, "incremental")
    assert published(spark, folder) == [1]
    missed = missed_rows(
        frames["transaction"],
        "txn_time",
        bank.SOURCE_ZONE,
        result.cutoff,
        "txn_id",
        read_published(spark, folder, "transaction"),
        "txn_id",
    )
    assert [r["txn_id"] for r in missed.collect()] == [2]
    run(spark, frames, job, "full")
    assert published(spark, folder) == [1, 2]


def test_no_new_rows_write_nothing(spark, tiny, folder):
    job = make_job(folder)
    run(spark, tiny, job, "incremental")
    before = sorted(Path(folder, "data").rglob("*.parquet"))
    none = {**tiny, "transaction": tiny["transaction"].limit(0)}
    result = run(spark, none, job, "incremental")
    assert (result.rows_in, result.rows_out) == (0, 0)
    assert sorted(Path(folder, "data").rglob("*.parquet")) == before
    assert result.watermark == at("2025-03-10 00:10")
    assert published(spark, folder) == [1, 2, 3, 4, 5]


def test_rejected_input_publishes_nothing(spark, tiny, folder):
    bad = {**tiny, "card": tiny["card"].withColumn("number", F.lit(None).cast("string"))}
    with pytest.raises(Rejected):
        run(spark, bad, make_job(folder), "full")
    with pytest.raises(LookupError):
        read_published(spark, folder, "transaction")
    log = ledger.read_log(spark, publish.state_path(folder), ledger.STATE_SCHEMA)
    assert sorted(r["status"] for r in log.collect()) == ["failed", "running"]
    errors = read_metrics(spark, f"{folder}/metrics").filter("name = 'errors'")
    assert errors.first()["labels"]["error"] == "Rejected"


def test_a_crash_before_the_state_entry_is_repaired(spark, tiny, folder, monkeypatch):
    job = make_job(folder)
    rows = [(1, "2024-02-01 10:00"), (2, "2024-02-02 10:00")]
    run(spark, with_rows(spark, tiny, rows[:1]), job, "incremental")
    append_state = ledger.append_state

    def crash(*args, **entry):
        if entry["status"] == "success":
            raise OSError("lost")
        append_state(*args, **entry)

    monkeypatch.setattr(ledger, "append_state", crash)
    with pytest.raises(OSError):
        run(spark, with_rows(spark, tiny, rows), job, "incremental")
    monkeypatch.undo()
    result = run(spark, with_rows(spark, tiny, rows), job, "incremental")
    assert result.cutoff == date(2024, 1, 25)
    assert published(spark, folder) == [1, 2]


def test_a_leak_keeps_the_published_version(spark, tiny, folder):
    job = make_job(folder)
    run(spark, tiny, job, "full")
    star = job.star
    outputs = [o for o in star.outputs if o.name != "txn_description"]
    leak = Output("txn_description", lambda t: t("card", "number"))
    leaking = replace(job, star=replace(star, outputs=(*outputs, leak)))
    for mode in ("full", "incremental"):
        with pytest.raises(GuardViolation, match="pan"):
            run(spark, tiny, leaking, mode)
    assert published(spark, folder) == [1, 2, 3, 4, 5]
    assert not list(Path(folder, "staging").glob("*"))
    assert [p.name[:9] for p in Path(folder, "data").iterdir()] == ["v00000001"]


def test_volume_history_is_kept_per_mode(spark, tiny, folder):
    job = make_job(folder)
    run(spark, tiny, job, "full")
    half = {**tiny, "transaction": tiny["transaction"].filter("txn_id = 1")}
    # The first slice is not compared with the full load.
    result = run(spark, half, job, "incremental")
    assert {r["status"] for r in result.checks if r["check_name"] == "volume"} == {"PASS"}
    result = run(spark, half, job, "full")
    assert {r["status"] for r in result.checks if r["check_name"] == "volume"} == {"WARN"}


def test_csv_beside_parquet(spark, tiny, folder):
    run(spark, tiny, make_job(folder, formats="parquet,csv"), "full")
    lines = [x for p in Path(folder, "csv").rglob("*.csv") for x in p.read_text().splitlines()]
    assert sum("2025-03-10T00:10:00Z" in line for line in lines) == 1
    schema = spark.read.text(f"{folder}/schema/v00000001*").first()[0]
    assert "card_masked" in schema
    with pytest.raises(ValueError):
        run(spark, tiny, make_job(folder, formats="orc"), "full")


@pytest.mark.parametrize("lost", ["transaction", "card", "member"])
def test_a_full_run_needs_rows_of_every_table(spark, tiny, folder, lost):
    run(spark, tiny, make_job(folder), "full")
    with pytest.raises(ValueError, match=lost):
        run(spark, {**tiny, lost: tiny[lost].limit(0)}, make_job(folder), "full")
    assert published(spark, folder) == [1, 2, 3, 4, 5]
    log = ledger.read_log(spark, publish.state_path(folder), ledger.STATE_SCHEMA)
    assert [r["run_seq"] for r in log.filter("status = 'failed'").collect()] == [2]


def test_an_empty_slice_is_recorded_and_checked(spark, tiny, folder):
    job = make_job(folder)
    run(spark, tiny, job, "incremental")
    none = {**tiny, "transaction": tiny["transaction"].limit(0)}
    result = run(spark, none, job, "incremental")
    assert [(r["check_name"], r["status"]) for r in result.checks] == [("volume", "WARN")]
    volumes = ledger.read_log(spark, f"{folder}/volumes", ledger.VOLUME_SCHEMA)
    assert sorted(r["row_count"] for r in volumes.collect()) == [0, 5]
    with pytest.raises(ValueError, match="card"):
        run(spark, {**tiny, "card": tiny["card"].limit(0)}, job, "incremental")


def test_an_increment_with_other_columns_is_refused(spark, tiny, folder):
    job = make_job(folder)
    run(spark, tiny, job, "incremental")
    more = Output("card_count", lambda t: F.lit(1))
    renamed = Output("nothing", lambda t: F.lit("x"))
    for outputs in ((*job.star.outputs, more), (*job.star.outputs[:-2], renamed, job.star.outputs[-1])):
        changed = replace(job, star=replace(job.star, outputs=outputs))
        with pytest.raises(SchemaMismatch):
            run(spark, tiny, changed, "incremental")
    assert published(spark, folder) == [1, 2, 3, 4, 5]


def test_the_whole_reason_of_a_failure_is_stored(spark, tiny, folder):
    many = [null_check(f"column_number_{i:03d}") for i in range(80)]
    with pytest.raises(Rejected):
        run(spark, tiny, make_job(folder, suites={"card": many}), "full")
    log = ledger.read_log(spark, publish.state_path(folder), ledger.STATE_SCHEMA)
    reason = log.filter("status = 'failed'").first()["error"]
    assert len(reason) > 1000 and all(f"column_number_{i:03d}" in reason for i in range(80))


@pytest.mark.parametrize("mode", ["full", "incremental"])
def test_the_source_is_read_once(spark, tiny, folder, mode):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("int")
    def watch(value):
        seen.add(1)
        return value

    watched = tiny["transaction"].withColumn("card_id", watch("card_id"))
    run(spark, {**tiny, "transaction": watched}, make_job(folder), mode)
    assert seen.value == 5
    assert not list(Path(folder, "landed").glob("*"))


def test_metrics_have_each_check_and_the_size(spark, tiny, folder):
    result = run(spark, tiny, make_job(folder), "full")
    found = read_metrics(spark, f"{folder}/metrics")
    assert found.filter("name = 'check'").count() == len(result.checks)
    size = found.filter("name = 'output_bytes'").first()["value"]
    files = [p for p in Path(folder, "data").rglob("*") if p.is_file() and p.suffix == ".parquet"]
    assert size >= sum(p.stat().st_size for p in files) > 0


def test_mode_is_an_argument(spark, tiny, folder):
    with pytest.raises(ValueError):
        run(spark, tiny, make_job(folder), "sometimes")


def test_any_split_into_runs_gives_the_full_table(spark, tiny, folder):
    rows = [(i, f"2024-03-{1 + i:02d} {(i * 5) % 24:02d}:30") for i in range(12)]
    job = make_job(folder)
    # Each row arrives up to five days after its time.
    for step in (4, 9, 12):
        arrived = [r for r in rows if r[0] + (r[0] * 3) % 6 <= step or step == 12]
        run(spark, with_rows(spark, tiny, arrived), job, "incremental")
    assert published(spark, folder) == list(range(12))
