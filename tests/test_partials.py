"""Stored partial aggregates and sketches against the plain results, however loads are split."""

from __future__ import annotations

import random
from decimal import Decimal

import pytest
from bank_data import TRANSACTION, at
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starflat.operators import ledger, manifest, partials, reports
from starflat.sources.tables import local_rows


def day():
    return F.date_format("txn_time", "yyyy-MM-dd")


def transactions(spark, rng, rows):
    kinds = ["debit", "credit", "refund", None]
    made = [
        (i, round(rng.uniform(-50, 500), 2), "x", None if i % 17 == 0 else at(f"2024-03-{rng.randint(1, 6):02d}"),
         rng.choice([1, 2, 3, 4, None]), rng.choice(kinds))
        for i in range(rows)
    ]
    return local_rows(spark, [(r[0], Decimal(str(r[1])), *r[2:]) for r in made], TRANSACTION)


def store_of(folder, df):
    fields = [f for f in df.schema if f.name != partials.PERIOD]
    return partials.PeriodStore(folder, "t", T.StructType([*fields, df.schema[partials.PERIOD]]))


def rows_of(df):
    return sorted(map(str, (r.asDict() for r in df.collect())))


def test_any_split_gives_the_plain_totals(spark, folder):
    rng = random.Random(3)
    df = transactions(spark, rng, 200).cache()
    days = [None, *(f"2024-03-{d:02d}" for d in range(1, 7))]
    first = partials.period_totals(df.filter("txn_id % 2 = 0"), day())
    store = store_of(folder, first)
    # A first load lacks half of the rows, later ones replace the periods in three parts.
    assert store.read(spark).count() == 0
    store.replace(spark, first, days)
    for part in (days[:2], days[2:3], days[3:]):
        named = [d for d in part if d]
        of = day().isin(named) | (day().isNull() if None in part else F.lit(False))
        store.replace(spark, partials.period_totals(df.filter(of), day()), part)
    plain = reports.totals_per_card(df)
    merged = partials.merge_totals(store.read(spark)).select(*plain.columns)
    assert rows_of(merged) == rows_of(plain)
    # As of the first load.
    half = partials.merge_totals(store.read(spark, 1)).agg(F.sum("txn_count")).first()[0]
    assert half == 100
    spans = {r["span"]: (r["active_cards"], r["transactions"]) for r in
             partials.active_cards(store.read(spark).filter("period IS NOT NULL"), F.substring("period", 1, 7)).collect()}
    known = df.filter("txn_time IS NOT NULL")
    assert spans == {"2024-03": (known.agg(F.count_distinct("card_id")).first()[0], known.count())}


def test_deleted_periods_and_foreign_rows(spark, folder):
    df = transactions(spark, random.Random(4), 60)
    totals = partials.period_totals(df.filter("txn_time IS NOT NULL"), day())
    store = store_of(folder, totals)
    days = [f"2024-03-{d:02d}" for d in range(1, 7)]
    store.replace(spark, totals, days)
    store.replace(spark, totals.limit(0), days[:5])
    assert {r[0] for r in store.read(spark).select("period").distinct().collect()} == {days[5]}
    with pytest.raises(ValueError):
        store.replace(spark, totals, days[:2])
    assert {r[0] for r in store.read(spark).select("period").distinct().collect()} == {days[5]}


def test_a_load_that_breaks_is_not_seen(spark, folder, monkeypatch):
    df = transactions(spark, random.Random(5), 60).filter("txn_time IS NOT NULL")
    totals = partials.period_totals(df, day())
    store = store_of(folder, totals)
    days = [f"2024-03-{d:02d}" for d in range(1, 7)]
    store.replace(spark, totals, days)
    before = rows_of(store.read(spark))
    for module, step in ((manifest, "record"), (ledger, "append_state")):
        with monkeypatch.context() as broken:
            broken.setattr(module, step, lambda *a, **k: 1 / 0)
            with pytest.raises(ZeroDivisionError):
                store.replace(spark, totals.limit(0), days)
        assert rows_of(store.read(spark)) == before


def test_sketches_merge_to_the_exact_profile_within_bounds(spark, folder):
    df = spark.range(20000).select(
        F.when(F.col("id") % 10 > 0, F.col("id") % 7000).alias("number"),
        F.when(F.col("id") % 5 == 0, F.lit(float("nan"))).otherwise(F.col("id").cast("double")).alias("real"),
        F.concat(F.lit("t"), F.col("id") % 300).alias("text"),
        F.lit(None).cast("double").alias("nothing"),
        F.concat(F.lit("p"), F.col("id") % 8).alias("part"),
    )
    store = partials.PeriodStore(folder, "t", partials.SKETCH_SCHEMA)
    names = ["number", "real", "text", "nothing"]
    parts = [f"p{i}" for i in range(8)]
    for own in (parts[:5], parts[4:]):
        of = df.filter(F.col("part").isin(own))
        store.replace(spark, partials.period_sketches(of, F.col("part"), names), own)
    found = {r["column_name"]: r for r in partials.merge_sketches(store.read(spark), (0.1, 0.5)).collect()}
    assert {n: (r["total_count"], r["null_count"]) for n, r in found.items()} == {
        "number": (20000, 2000), "real": (20000, 0), "text": (20000, 0), "nothing": (20000, 20000)
    }
    assert (found["real"]["min_value"], found["real"]["max_value"]) == (1, 19999)
    assert found["text"]["quantiles"] is None and found["nothing"]["quantiles"] is None
    assert abs(found["text"]["distinct_estimate"] - 300) <= 15
    assert found["nothing"]["distinct_estimate"] == 0
    exact = df.agg(F.count_distinct("number")).first()[0]
    assert abs(found["number"]["distinct_estimate"] - exact) <= 0.05 * exact
    low, middle = found["real"]["quantiles"]
    assert abs(low - 2000) <= 0.02 * 20000 and abs(middle - 10000) <= 0.02 * 20000
