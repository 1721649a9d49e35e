from __future__ import annotations

from pathlib import Path

import pytest
from bank_data import SALT, at
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from starflat.operators.checks import null_check
from starflat.operators.flatten import Output, Star, flatten
from starflat.operators.publish import GuardSpec
from starflat.plans import bank
from starflat.operators.metrics import read_metrics
from starflat.streaming.merge import (
    batches,
    dropped_rows,
    read_expired,
    read_merged,
    read_stream,
    read_waiting,
    start_merge,
)

GUARDS = GuardSpec(("card_masked",), ("card_hash",), ("txn_amount",))


def load(spark, tiny, folder, star=None, suite=(), wait_days=None):
    dimensions = {k: v for k, v in tiny.items() if k != "transaction"}
    return start_merge(
        read_stream(spark, f"{folder}/inbox", tiny["transaction"].schema, files_per_trigger=1),
        dimensions,
        star or bank.gold_star(SALT),
        f"{folder}/out",
        "txn_id",
        "txn_time",
        "txn_id",
        "txn_time",
        GUARDS,
        suite=suite,
        wait_days=wait_days,
    )


def send(df, folder):
    df.coalesce(1).write.mode("append").parquet(f"{folder}/inbox")


def test_stream_equals_batch(spark, tiny, folder):
    txns = tiny["transaction"]
    send(txns.filter("txn_id in (2, 4)"), folder)
    load(spark, tiny, folder).awaitTermination()
    # Rows of the first delivery again, and a row earlier than those loaded.
    send(txns.filter("txn_id in (1, 2, 3)"), folder)
    send(txns, folder)
    load(spark, tiny, folder).awaitTermination()
    expected = flatten(tiny, bank.gold_star(SALT))
    found = read_merged(spark, f"{folder}/out").select(expected.columns)
    assert sorted(map(str, found.collect())) == sorted(map(str, expected.collect()))


def test_a_repeated_batch_replaces_itself(spark, tiny, folder):
    send(tiny["transaction"], folder)
    load(spark, tiny, folder).awaitTermination()
    # The engine forgets that batch 0 was done and runs it again.
    for commit in Path(folder, "out", "checkpoint", "commits").glob("*"):
        commit.unlink()
    load(spark, tiny, folder).awaitTermination()
    assert read_merged(spark, f"{folder}/out").count() == 5


def test_rows_later_than_the_delay_are_dropped(spark, tiny, folder):
    txns = tiny["transaction"]
    send(txns, folder)
    load(spark, tiny, folder).awaitTermination()
    old = txns.filter("txn_id = 1").select(
        F.lit(99).alias("txn_id"),
        *[c for c in txns.columns if c not in ("txn_id", "txn_time")],
        F.lit(at("2024-01-01")).alias("txn_time"),
    )
    send(old.select(txns.columns), folder)
    load(spark, tiny, folder).awaitTermination()
    assert read_merged(spark, f"{folder}/out").filter("txn_id = 99").count() == 0


def test_a_leak_stops_the_stream(spark, tiny, folder):
    star = bank.gold_star(SALT)
    leak = Output("txn_description", lambda t: t("card", "number"))
    kept = [o for o in star.outputs if o.name != "txn_description"]
    send(tiny["transaction"], folder)
    with pytest.raises(StreamingQueryException):
        load(spark, tiny, folder, Star(star.fact, star.links, (*kept, leak))).awaitTermination()
    assert not Path(folder, "out", "data").exists()


def test_facts_wait_for_their_dimensions(spark, tiny, folder):
    send(tiny["transaction"], folder)
    late = {**tiny, "card": tiny["card"].filter("card_id <> 2")}
    load(spark, late, folder).awaitTermination()
    out = f"{folder}/out"
    assert sorted(r["txn_id"] for r in read_merged(spark, out).collect()) == [1, 3, 4]
    waiting = read_waiting(spark, out, tiny["transaction"].schema)
    assert sorted(r["txn_id"] for r in waiting.collect()) == [2, 5]
    more = tiny["transaction"].filter("txn_id = 1").withColumn("txn_id", F.lit(6))
    send(more, folder)
    load(spark, tiny, folder).awaitTermination()
    assert sorted(r["txn_id"] for r in read_merged(spark, out).collect()) == [1, 2, 3, 4, 5, 6]
    assert read_waiting(spark, out, tiny["transaction"].schema).count() == 0


def test_the_gate_stops_a_bad_batch(spark, tiny, folder):
    send(tiny["transaction"].withColumn("card_id", F.lit(None).cast("int")), folder)
    with pytest.raises(StreamingQueryException, match="failed checks"):
        load(spark, tiny, folder, suite=[null_check("card_id")]).awaitTermination()
    assert not Path(folder, "out", "data").exists()


def test_dropped_rows_are_counted(spark, tiny, folder):
    send(tiny["transaction"], folder)
    load(spark, tiny, folder).awaitTermination()
    old = tiny["transaction"].withColumn("txn_id", F.col("txn_id") + 50).withColumn(
        "txn_time", F.lit(at("2024-01-01"))
    )
    send(old, folder)
    query = load(spark, tiny, folder)
    query.awaitTermination()
    assert dropped_rows(query) == 5


def test_facts_that_wait_too_long_are_quarantined(spark, tiny, folder):
    """Transactions 2 and 5 lack their card; the newest fact is of 2025-03-09 21:10."""
    late = {**tiny, "card": tiny["card"].filter("card_id <> 2")}
    schema, out = tiny["transaction"].schema, f"{folder}/out"
    send(tiny["transaction"], folder)
    load(spark, late, folder, wait_days=10).awaitTermination()
    assert [r["txn_id"] for r in read_expired(spark, out, schema).collect()] == [5]
    assert [r["txn_id"] for r in read_waiting(spark, out, schema).collect()] == [2]
    # A newer fact moves the limit; the card of the expired one comes too late.
    send(tiny["transaction"].filter("txn_id = 1").withColumn("txn_id", F.lit(6)), folder)
    load(spark, tiny, folder, wait_days=10).awaitTermination()
    assert sorted(r["txn_id"] for r in read_merged(spark, out).collect()) == [1, 2, 3, 4, 6]
    assert read_waiting(spark, out, schema).count() == 0
    log = [b for b in batches(spark, out) if b["rows_in"]]
    assert [(b["rows_in"], b["rows_out"], b["waiting"], b["expired"]) for b in log] == [(5, 3, 1, 1), (1, 2, 0, 0)]
    found = read_metrics(spark, f"{out}/metrics").filter("name = 'rows_out' AND value > 0").collect()
    assert sorted(r["value"] for r in found) == [2.0, 3.0]
    # Rows are kept once: landed slices go, each batch has one folder.
    assert not list(Path(out, "landed").glob("*/*"))
    files = [str(f) for f in Path(out, "data").rglob("*.parquet")]
    assert spark.read.parquet(*files).count() == 5
