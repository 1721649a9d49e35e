from __future__ import annotations

from pathlib import Path

import pytest
from bank_data import at
from pyspark.errors import AnalysisException

from starflat.operators import ledger
from starflat.operators.metrics import RunMetrics, metric_summary, read_metrics
from starflat.operators.sinks import write_json


def entry(spark, path, source, seq, status="success", watermark=None):
    ledger.append_state(
        spark, path, source=source, run_seq=seq, mode="full", status=status, watermark=watermark
    )


def test_newest_success_wins(spark, folder):
    entry(spark, folder, "a", 1, watermark=at("2024-01-01"))
    entry(spark, folder, "b", 2, watermark=at("2024-02-01"))
    entry(spark, folder, "a", 3, watermark=at("2024-03-01"))
    entry(spark, folder, "a", 4, status="failed")
    entry(spark, folder, "a", 5, status="running")
    found = {r["source"]: (r["run_seq"], r["watermark"]) for r in
             ledger.current_state(spark, folder).collect()}
    assert found == {"a": (3, at("2024-03-01")), "b": (2, at("2024-02-01"))}
    last, number = ledger.run_state(spark, folder, "a")
    assert (last["run_seq"], number) == (3, 6)
    assert ledger.run_state(spark, folder, "c") == (None, 6)


def test_absent_log_is_empty(spark, folder):
    assert ledger.last_success(spark, folder, "a") is None
    assert ledger.run_state(spark, folder, "a") == (None, 1)
    assert ledger.previous_volume(spark, folder, "a", "full") is None


def test_other_read_errors_are_raised(spark, tmp_path):
    (tmp_path / "part-0.parquet").write_text("not parquet")
    with pytest.raises(Exception) as error:
        ledger.last_success(spark, str(tmp_path), "a")
    assert not isinstance(error.value, AnalysisException) or (
        error.value.getCondition() != "PATH_NOT_FOUND"
    )


def test_unknown_status(spark, folder):
    with pytest.raises(ValueError):
        entry(spark, folder, "a", 1, status="completed")


def test_volume_is_kept_per_mode(spark, folder):
    rows = [("t", "full", 1, 100), ("t", "incremental", 2, 5), ("u", "full", 3, 7)]
    for row in rows:
        ledger.append(spark, folder, ledger.VOLUME_SCHEMA, [row])
    assert ledger.previous_volume(spark, folder, "t", "full") == 100
    assert ledger.previous_volume(spark, folder, "t", "incremental") == 5


def test_metrics(spark, folder):
    metrics = RunMetrics({"source": "t"})
    with metrics.stage("outer"), metrics.stage("out"):
        pass
    metrics.gauge("rows", 5)
    metrics.error(KeyError("x"))
    metrics.save(spark, folder)
    found = read_metrics(spark, folder)
    summary = {(r["name"], r["label"]): r["points"] for r in metric_summary(found).collect()}
    assert summary == {
        ("stage_seconds", "outer"): 1,
        ("stage_seconds", "out"): 1,
        ("rows", ""): 1,
        ("errors", "KeyError"): 1,
    }
    write_json(found, folder + "-json")
    labels = spark.read.json(folder + "-json").filter("name = 'rows'").first()["labels"]
    assert labels["source"] == "t"


def files_below(path):
    return [p for p in Path(path).rglob("*.parquet") if p.is_file()]


def test_a_long_log_has_few_files(spark, folder, monkeypatch):
    monkeypatch.setattr(ledger, "TAIL_FILES", 5)
    most = 0
    for seq in range(1, 41):
        ledger.append(spark, folder, ledger.VOLUME_SCHEMA, [("t", "full", seq, 10 * seq)])
        most = max(most, len(files_below(folder)))
    assert most <= 3 * (5 + 2)
    log = ledger.read_log(spark, folder, ledger.VOLUME_SCHEMA)
    assert sorted(r["run_seq"] for r in log.collect()) == list(range(1, 41))
    assert ledger.previous_volume(spark, folder, "t", "full") == 400


def test_a_compaction_that_breaks_changes_nothing(spark, folder, monkeypatch):
    for seq in range(1, 5):
        ledger.append(spark, folder, ledger.VOLUME_SCHEMA, [("t", "full", seq, seq)])
    numbers = lambda: sorted(r[0] for r in ledger.read_log(spark, folder, ledger.VOLUME_SCHEMA).select("run_seq").collect())
    with monkeypatch.context() as broken:
        broken.setattr(ledger, "_rows_of", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            ledger.compact(spark, folder, ledger.VOLUME_SCHEMA)
    assert numbers() == [1, 2, 3, 4]
    # One that listed the log earlier and ends after another has ended.
    late = ledger.read_log(spark, folder, ledger.VOLUME_SCHEMA)
    ledger.compact(spark, folder, ledger.VOLUME_SCHEMA)
    assert late.count() == 4
    ledger.append(spark, folder, ledger.VOLUME_SCHEMA, [("t", "full", 5, 5)])
    ledger.compact(spark, folder, ledger.VOLUME_SCHEMA)
    ledger.compact(spark, folder, ledger.VOLUME_SCHEMA)
    assert numbers() == [1, 2, 3, 4, 5]
    assert len(files_below(folder)) <= 3
