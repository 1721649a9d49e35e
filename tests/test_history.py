"""Unique ids against history, and constraints from what periods keep, against plain results."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from test_runs import make_job, published, with_rows

from starflat.operators import deltas, history
from starflat.operators.constraints import (
    Agreement,
    Domain,
    ForeignKey,
    NotNull,
    Rule,
    Unique,
    constraint_report,
)

from starflat.operators.history import HeldBefore
from starflat.operators.publish import drop_superseded, read_published
from starflat.plans.runs import published_duplicates, run


def day():
    return F.col("day")


def rows_of(df):
    return sorted(map(str, (r.asDict() for r in df.collect())))


def stored(spark, folder, df, days):
    store = history.filter_store(folder, "t")
    store.replace(spark, history.period_filters(df, "id", day()), days)
    return store


def reader(df, asked):
    def read(periods):
        asked.append(periods)
        named = df.withColumn("period", day())
        return named.filter(F.col("period").isin([p for p in periods if p]) | (F.col("period").isNull() & F.lit(None in periods)))

    return read


@pytest.mark.parametrize("kind", ["int", "string"])
def test_duplicates_equal_a_plain_join(spark, folder, kind):
    rng = random.Random(5)
    days = ["d1", "d2", "d3", None]
    old = [(rng.randrange(4000), rng.choices(days, (20, 2, 2, 1))[0]) for _ in range(3000)] + [(None, "d1")] * 5
    old_df = spark.createDataFrame(old, "id int, day string").withColumn("id", F.col("id").cast(kind)).cache()
    new_df = spark.createDataFrame([(i,) for i in range(2000, 6000, 3)] + [(None,), (2000,)], "id int")
    new_df = new_df.withColumn("id", F.col("id").cast(kind))
    store = stored(spark, folder, old_df, days)
    sent = {i for i in range(2000, 6000, 3)}
    for replaced in ((), ("d1",), ("d2", None)):
        kept = F.coalesce(F.col("period"), F.lit("none")).isin([d or "none" for d in days if d not in replaced])
        found = history.duplicates(new_df, "id", store.read(spark).filter(kept), reader(old_df, []))
        expected = {(str(i), d) for i, d in old if i in sent and d not in replaced}
        got = [(r["id"] if kind == "string" else str(r["id"]), r["period"]) for r in found.collect()]
        assert len(got) == len(set(got)) and set(got) == expected


def test_only_candidate_periods_are_read(spark, folder):
    old_df = spark.range(50_000).select("id", F.concat(F.lit("d"), (F.col("id") % 5).cast("string")).alias("day"))
    store = stored(spark, folder, old_df, [f"d{i}" for i in range(5)])
    asked = []
    slice_ids = spark.createDataFrame([(10,), (60_000,)], "id long")
    found = history.duplicates(slice_ids, "id", store.read(spark), reader(old_df, asked))
    assert [tuple(r) for r in found.collect()] == [(10, "d0")]
    assert asked == [["d0"]]
    # Filters let few absent ids pass, and every present one.
    absent = spark.range(100_000, 120_000)
    assert history.candidates(absent, "id", store.read(spark)).count() < 50
    assert history.candidates(spark.range(50_000), "id", store.read(spark)).select("id").distinct().count() == 50_000


def test_filters_grow_with_their_period(spark):
    df = spark.range(400_000).select("id", F.when(F.col("id") < 10, "small").otherwise("large").alias("day"))
    sizes = {r["period"]: r["bitmaps"] for r in history.period_filters(df, "id", day()).select("period", "bitmaps").distinct().collect()}
    assert sizes == {"small": 64, "large": 512}


def test_no_history_and_no_ids(spark, folder):
    ids = spark.createDataFrame([(1,), (None,)], "id int")
    empty = spark.createDataFrame([], "id int, day string")
    store = history.filter_store(folder, "t")
    assert history.duplicates(ids, "id", store.read(spark), reader(empty, [])).collect() == []
    store.replace(spark, history.period_filters(empty, "id", day()), ["d1"])
    assert history.duplicates(ids, "id", store.read(spark), reader(empty, [])).collect() == []
    assert history.duplicates(ids.limit(0), "id", store.read(spark), reader(empty, [])).collect() == []


OLD = [(1, "2024-02-01 10:00"), (2, "2024-02-02 10:00"), (3, "2024-02-20 10:00")]


def test_a_run_refuses_ids_of_other_dates(spark, tiny, folder):
    job = make_job(folder, unique_history=True)
    run(spark, with_rows(spark, tiny, OLD), job, "incremental")
    # The look-back is loaded again: its ids are replaced, they are no duplicates.
    again = [*OLD, (4, "2024-02-21 10:00")]
    run(spark, with_rows(spark, tiny, again), job, "incremental")
    assert published(spark, folder) == [1, 2, 3, 4]
    with pytest.raises(HeldBefore, match=r"^1 ids .*: 2 \(2024-02-02\)$"):
        run(spark, with_rows(spark, tiny, [*again, (2, "2024-02-22 10:00"), (5, "2024-02-22 11:00")]), job, "incremental")
    assert published(spark, folder) == [1, 2, 3, 4]
    run(spark, with_rows(spark, tiny, [*again, (5, "2024-02-22 11:00")]), job, "incremental")
    assert published(spark, folder) == [1, 2, 3, 4, 5]
    ids = spark.createDataFrame([(i,) for i in (2, 4, 9)], "txn_id int")
    plain = read_published(spark, folder, "transaction").join(ids, "txn_id", "left_semi")
    found = published_duplicates(spark, job, ids)
    assert sorted(map(tuple, found.collect())) == sorted((r["txn_id"], str(r["event_date"])) for r in plain.collect())
    # Superseded filters go with their rows.
    drop_superseded(spark, folder, "transaction")
    assert sorted(map(tuple, published_duplicates(spark, job, ids).collect())) == sorted(map(tuple, found.collect()))


def test_dates_of_runs_without_filters_are_read(spark, tiny, folder):
    run(spark, with_rows(spark, tiny, OLD), make_job(folder), "incremental")
    job = make_job(folder, unique_history=True)
    with pytest.raises(HeldBefore):
        run(spark, with_rows(spark, tiny, [*OLD, (1, "2024-02-21 10:00")]), job, "incremental")
    run(spark, with_rows(spark, tiny, [*OLD, (4, "2024-02-21 10:00")]), job, "incremental")
    assert published(spark, folder) == [1, 2, 3, 4]


def test_a_date_without_candidates_is_not_read(spark, tiny, folder):
    job = make_job(folder, unique_history=True)
    run(spark, with_rows(spark, tiny, OLD), job, "full")
    found = published_duplicates(spark, job, spark.createDataFrame([(3,), (77,)], "txn_id int"))
    read = found.inputFiles()
    assert read and all("event_date=2024-02-20" in f for f in read if "event_date=" in f)
    assert [tuple(r) for r in found.collect()] == [(3, "2024-02-20")]


CONSTRAINTS = [
    NotNull("t", "kind"),
    Rule("t", "n", "n > 0"),
    Domain("t", "kind", ("a", "b")),
    Unique("t", ("id",)),
    Unique("t", ("id", "kind")),
    ForeignKey("t", "n", "p", "key"),
    Agreement("t", "id", "n", "p", "key", "owner"),
    NotNull("p", "owner"),
    Unique("p", ("key",)),
]


def test_stored_counts_give_the_full_report(spark, folder):
    rng = random.Random(11)
    days = ["d1", "d2", "d3", None]

    def fact(rows):
        made = [
            (rng.choice([None, *range(12)]), rng.choice(["a", "b", "c", None]), rng.choice([None, -1, *range(9)]), rng.choice(days))
            for _ in range(rows)
        ]
        return spark.createDataFrame(made, "id int, kind string, n int, day string").cache()

    def parents(keys):
        return spark.createDataFrame([(k, rng.choice([None, 1, 2, 3])) for k in keys], "key int, owner int").cache()

    store = deltas.count_store(folder, "t")
    first, second = fact(80), fact(60)
    store.replace(spark, deltas.period_counts(first, CONSTRAINTS[:7], day()), days)
    # The second load replaces two periods, the third takes one away; dimensions change between them.
    changed = ["d2", None]
    in_changed = F.col("day").isNull() | (F.col("day") == "d2")
    after = first.filter(~F.coalesce(in_changed, F.lit(True))).unionByName(second.filter(in_changed))
    for state, load, keys in (
        (first, None, range(5)),
        (first, None, range(3, 9)),
        (after, (second.filter(in_changed), changed), range(3, 9)),
        (after.filter("day IS NULL OR day <> 'd1'"), (second.limit(0), ["d1"]), (0, 1, 7)),
    ):
        if load:
            store.replace(spark, deltas.period_counts(load[0], CONSTRAINTS[:7], day()), load[1])
        p = parents(keys)
        found = deltas.report_of(store.read(spark), {"p": p}, "t", CONSTRAINTS)
        assert rows_of(found) == rows_of(constraint_report({"t": state, "p": p}, CONSTRAINTS))


def test_keys_are_shuffled_in_their_own_types(spark):
    """Keys become text after they are counted."""
    fact = spark.createDataFrame([(1, "a", "d1"), (1, None, "d1"), (None, "b", "d2")], "id long, n string, day string")
    counts = deltas.period_counts(fact, [Unique("t", ("id",)), ForeignKey("t", "n", "p", "key")], day())
    found = sorted((r["constraint_name"], r["key"], r["n"], r["period"]) for r in counts.collect())
    assert found == [
        ("foreign_key(n)", "a", 1, "d1"),
        ("foreign_key(n)", "b", 1, "d2"),
        ("unique(id)", '{"id":1}', 2, "d1"),
    ]
    plan = counts._jdf.queryExecution().optimizedPlan().toString().lower()
    assert "json" in plan
    assert "json" not in "".join(plan.split("aggregate")[1].splitlines()[1:])
