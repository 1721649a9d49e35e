"""The registered queries: each reads the given tables whole."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, types as T
from pyspark.sql import functions as F

from starflat.functions import hash_value, local_text, mask_card, mask_email, redact_cards
from starflat.operators import checks, constraints, deltas, guards, ledger, manifest, partials, profile, publish, reports, sinks
from starflat.operators.flatten import finish, flatten, join_needed
from starflat.operators.metrics import metric_summary, read_metrics
from starflat.plans import activity, bank
from starflat.plans.runs import published_duplicates, replay, run, stale_report
from starflat.session import shared_dir
from starflat.sources import partitioning, synthetic
from starflat.sources.incremental import cutoff_date, missed_rows, slice_since
from starflat.sources.tables import read_csv, read_table
from starflat.streaming.merge import read_expired, read_merged, read_stream, start_merge

Query = Callable[[SparkSession, str], DataFrame]

RESULT = ("table_name", "check_name", "column_name", "status", "value", "bad_rows", "total_rows")

SHORT_DELAY, LONG_DELAY = 5, 12


def flat_star(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten(bank.frames(spark, sf_dir), bank.gold_star(bank.DEMO_SALT))


def star_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten(bank.frames(spark, sf_dir), bank.view_star())


def text_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The joined tables with every column as text and times in local format."""
    view = star_view(spark, sf_dir)
    texts = {
        f.name: local_text(F.col(f.name))
        if isinstance(f.dataType, T.TimestampNTZType)
        else F.col(f.name).cast("string")
        for f in view.schema.fields
    }
    return view.select(*(text.alias(name) for name, text in texts.items()))


def account_owners(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.accounts_with_owner(bank.accounts(spark, sf_dir), bank.members(spark, sf_dir))


def orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """References without a target: a sound one, and two that look up the wrong table."""
    part = read_table(spark, sf_dir, "part")
    supplier = read_table(spark, sf_dir, "supplier")
    lineitem = read_table(spark, sf_dir, "lineitem")
    orders = read_table(spark, sf_dir, "orders")
    found = [
        ("lineitem.l_orderkey", lineitem, "l_orderkey", orders, "o_orderkey"),
        ("lineitem.l_partkey as supplier", lineitem, "l_partkey", supplier, "s_suppkey"),
        ("part.p_size as supplier", part, "p_size", supplier, "s_suppkey"),
    ]
    result = None
    for name, child, key, parent, parent_key in found:
        missing = constraints.orphans(child, key, parent, parent_key).agg(
            F.lit(name).alias("reference"),
            F.count(F.lit(1)).alias("missing_keys"),
            F.coalesce(F.sum("orphans"), F.lit(0)).alias("orphan_rows"),
        )
        result = missing if result is None else result.unionByName(missing)
    return result


def join_yield(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = bank.frames(spark, sf_dir)
    return reports.join_yield(flatten(tables, bank.view_star()), tables["transaction"])


def member_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = bank.frames(spark, sf_dir)
    return reports.member_stats(t["member"], t["account"], t["card"], t["transaction"])


def _maintained_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals by card and month after two loads: the first lacks the newest two months and a
    third of the two before, the second replaces the newest four."""
    transactions = bank.transactions(spark, sf_dir).withColumn("month", partials.month_of(F.col("txn_time")))
    months = sorted(r[0] for r in transactions.select("month").distinct().collect())
    last, missing = F.col("month").isin(months[-4:]), F.col("month").isin(months[-2:])
    early = transactions.filter(~missing & (~last | (F.col("txn_id") % 3 != 0)))
    first = partials.period_totals(early, F.col("month"))
    schema = T.StructType([*(f for f in first.schema if f.name != partials.PERIOD), first.schema[partials.PERIOD]])
    store = partials.PeriodStore(shared_dir(spark, "partials"), "transaction", schema)
    store.replace(spark, first, months[:-2])
    store.replace(spark, partials.period_totals(transactions.filter(last), F.col("month")), months[-4:])
    return store.read(spark)


def member_stats_maintained(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The member report from stored sums, without another look at the transactions."""
    t = bank.frames(spark, sf_dir)
    totals = partials.merge_totals(_maintained_totals(spark, sf_dir))
    return reports.member_stats_of(t["member"], t["account"], t["card"], totals)


def active_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Different cards a year, from the months' key sets."""
    return partials.active_cards(_maintained_totals(spark, sf_dir), F.substring("period", 1, 4))


def sketch_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profile of the orders from monthly sketches, two loads, and whether it keeps its bounds."""
    orders = read_table(spark, sf_dir, "orders")
    names = ["o_custkey", "o_totalprice", "o_orderpriority"]
    month = partials.month_of(F.col("o_orderdate"))
    months = sorted(r[0] for r in orders.select(month).distinct().collect())
    store = partials.PeriodStore(shared_dir(spark, "sketches"), "orders", partials.SKETCH_SCHEMA)
    store.replace(spark, partials.period_sketches(orders.filter(month.isin(months[:-3])), month, names), months[:-3])
    store.replace(spark, partials.period_sketches(orders.filter(month.isin(months[-5:])), month, names), months[-5:])
    found = partials.merge_sketches(store.read(spark)).collect()
    exact = []
    for row in found:
        value = F.col(row["column_name"])
        median = F.lit(row["quantiles"][0] if row["quantiles"] else None).cast("double")
        distinct = F.count_distinct(value)
        below = F.count_if(value.cast("double") < median) / F.count(value)
        up_to = F.count_if(value.cast("double") <= median) / F.count(value)
        exact.append(
            orders.agg(
                F.lit(row["column_name"]).alias("column_name"),
                F.lit(row["total_count"]).cast("bigint").alias("total_count"),
                F.lit(row["null_count"]).cast("bigint").alias("null_count"),
                F.lit(row["min_value"]).cast("double").alias("min_value"),
                F.lit(row["max_value"]).cast("double").alias("max_value"),
                (F.abs(distinct - F.lit(row["distinct_estimate"])) <= 0.05 * distinct).alias("distinct_within"),
                ((below <= 0.52) & (up_to >= 0.48)).alias("median_within")
                if row["quantiles"]
                else F.lit(None).cast("boolean").alias("median_within"),
            )
        )
    return reduce(DataFrame.unionByName, exact)


def member_stats_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = bank.frames(spark, sf_dir)
    return reports.member_stats_raw(t["member"], t["account"], t["card"], t["transaction"])


def card_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.card_balance(bank.cards(spark, sf_dir), bank.transactions(spark, sf_dir))


def population_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = bank.frames(spark, sf_dir)
    summary = reports.population_summary(
        t["member"], t["account"], t["card"], t["transaction"]
    )
    return summary.withColumn("avg_age", F.round("avg_age", 6))


def spend_by_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = read_table(spark, sf_dir, "part")
    return reports.spend_by(
        bank.transactions(spark, sf_dir), "category_id", part, "p_partkey", "p_type"
    )


def spend_in_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = bank.frames(spark, sf_dir)
    return reports.spend_in_range(
        t["member"], t["card"], t["transaction"], "1997-01-01 00:00:00", "1997-12-31 23:59:59"
    )


def spend_in_range_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same kind of report as SQL text over the flat table.

    The scan gets the range on the bare local time, one day wider on either side
    than the UTC dates asked for.
    """
    tables = bank.frames(spark, sf_dir)
    local = F.col("txn_time")
    near = local.between(
        F.lit("1997-12-31").cast("timestamp_ntz"), F.lit("1999-01-02").cast("timestamp_ntz")
    )
    tables["transaction"] = tables["transaction"].filter(near)
    return spark.sql(
        """
        SELECT member_last_name, count(*) AS txn_count,
               CAST(sum(txn_amount) AS DECIMAL(20,2)) AS total_amount
        FROM {flat}
        WHERE event_date BETWEEN DATE '1998-01-01' AND DATE '1998-12-31'
        GROUP BY member_last_name
        ORDER BY total_amount DESC, member_last_name
        """,
        flat=flatten(tables, bank.gold_star(bank.DEMO_SALT)),
    )


def table_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.table_counts(bank.frames(spark, sf_dir))


def max_event_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.max_event_time(bank.transactions(spark, sf_dir))


def account_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.distinct_account_types(bank.accounts(spark, sf_dir))


def _events_with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events whose ``error`` type is NULL and ``signup`` type is empty."""
    kind = F.col("event_type")
    return read_table(spark, sf_dir, "events").withColumn(
        "event_type", F.when(kind == "signup", "").when(kind != "error", kind)
    )


def null_vector(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.null_vector(_events_with_gaps(spark, sf_dir))


def _checked(df: DataFrame, table: str, *requested: checks.Check) -> DataFrame:
    found = checks.run_checks(df, table, requested).select(*RESULT)
    return found.withColumn("value", F.round("value", 6))


def check_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _checked(
        _events_with_gaps(spark, sf_dir),
        "events",
        checks.null_check("event_type"),
        checks.null_check("value"),
    )


def check_negative(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _checked(
        read_table(spark, sf_dir, "customer"), "customer", checks.negative_check("c_acctbal")
    )


def check_extreme(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _checked(
        read_table(spark, sf_dir, "lineitem"),
        "lineitem",
        checks.extreme_check("l_extendedprice", bank.AMOUNT_LOW, bank.AMOUNT_HIGH),
        checks.extreme_check("l_quantity", 1, 50),
        checks.extreme_check("l_linestatus", 1, 50),
    )


def check_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _checked(
        bank.cards(spark, sf_dir).withColumn(
            "short_number", F.left("number", (F.col("card_id") % 17).cast("int"))
        ),
        "card",
        checks.format_check("number", bank.CARD_NUMBER_PATTERN),
        checks.format_check("short_number", bank.CARD_NUMBER_PATTERN),
        checks.format_check("short_number"),
    )


def check_consistency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _checked(
        _events_with_gaps(spark, sf_dir),
        "events",
        checks.consistency_check("event_type"),
        checks.consistency_check("props"),
    )


def check_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = _checked(
        read_table(spark, sf_dir, "lineitem"),
        "lineitem",
        checks.duplicate_check(["l_orderkey", "l_linenumber"]),
    )
    orders = read_table(spark, sf_dir, "orders")
    return lineitem.unionByName(
        _checked(orders, "orders", checks.duplicate_check(["o_orderkey"]))
    )


def check_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = flat_star(spark, sf_dir)
    complete = _checked(flat, "flat", checks.completeness_check(bank.GOLD_COLUMNS))
    # Columns that must never reach the flat table count as missing.
    raw = _checked(flat, "raw", checks.completeness_check(("number", "email")))
    return complete.unionByName(raw)


def check_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each day of events against the day before, as if every day were a run."""
    daily = (
        read_table(spark, sf_dir, "events")
        .groupBy(F.col("ts").cast("date").alias("day"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    before = daily.select(F.date_add("day", 1).alias("day"), F.col("n").alias("previous"))
    tolerance = 0.05
    joined = daily.join(before, "day", "left")
    return joined.select(
        "day",
        "n",
        F.round(checks.volume_change(F.col("n"), F.col("previous")), 6).alias("value"),
        checks.volume_status(F.col("n"), F.col("previous"), tolerance).alias("status"),
    )


def duplicate_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = read_table(spark, sf_dir, "lineitem")
    return checks.duplicate_rows(lineitem, ["l_orderkey", "l_linenumber"])


def _suite_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.run_suites(bank.frames(spark, sf_dir), bank.suites())


def suite_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _suite_results(spark, sf_dir).select(*RESULT).withColumn("value", F.round("value", 6))


def suite_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.status_summary(_suite_results(spark, sf_dir))


def constraint_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return constraints.constraint_report(bank.frames(spark, sf_dir), bank.constraints())


def constraints_maintained(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The constraint report from stored counts after three loads, whose cards change in between."""
    frames = bank.frames(spark, sf_dir)
    fact = frames.pop("transaction").withColumn("month", partials.month_of(F.col("txn_time")))
    months = sorted(r[0] for r in fact.select("month").distinct().collect())
    declared = [c for c in bank.constraints() if c.table == "transaction"]
    store = deltas.count_store(shared_dir(spark, "counts"), "transaction")
    month = F.col("month")
    # The first load has a third of its rows twice, the others replace all of its months.
    first = fact.unionByName(fact.filter("txn_id % 3 = 0"))
    for rows, periods in ((first, months), (fact, months[:-4]), (fact, months[-4:])):
        load = rows.filter(month.isin(periods))
        store.replace(spark, deltas.period_counts(load, declared, month), periods)
    # A third of the cards goes after the loads; their transactions are not read again.
    known = {**frames, "card": frames["card"].filter("card_id % 3 <> 0")}
    return deltas.report_of(store.read(spark), known, "transaction", bank.constraints())


def duplicate_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event ids that a delivery shares with published dates, found by the filters of the dates.

    Published is what arrived until the first load day; delivered is what came since, and
    every ninth of all events once more.
    """
    base = shared_dir(spark, "unique")
    tables = activity.frames(spark, sf_dir)
    events = tables["event"]
    job = replace(activity.job(base), unique_history=True)
    first = activity.load_days(events)[0]
    run(spark, {**tables, "event": activity.arrived(events, first, SHORT_DELAY)}, job, "full")
    since = activity.arrived(events, None, SHORT_DELAY, since=first + timedelta(days=1))
    delivered = since.unionByName(events.filter("event_id % 9 = 0"))
    return published_duplicates(spark, job, delivered.select("event_id"))


def column_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every column of the events, and of the order amounts as text."""
    orders = read_table(spark, sf_dir, "orders").select(
        F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice").cast("decimal(12,2)"))
        .cast("string")
        .alias("price_text"),
        "o_totalprice",
    )
    found = profile.column_profile(_events_with_gaps(spark, sf_dir)).unionByName(
        profile.column_profile(orders)
    )
    stats = F.col("numeric_stats")
    return found.select(
        "column_name",
        "total_count",
        "null_count",
        "not_null_count",
        F.round("null_ratio", 6).alias("null_ratio"),
        F.round("completeness", 6).alias("completeness"),
        "empty_strings",
        stats["min"].alias("min_value"),
        stats["max"].alias("max_value"),
        F.round(stats["avg"], 4).alias("avg_value"),
        F.round(stats["std"], 4).alias("std_value"),
        F.round(F.col("string_stats")["avg_length"], 6).alias("avg_length"),
    )


def quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The profile with histograms as a JSON report, read back."""
    path = shared_dir(spark, "report")
    orders = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_totalprice", "o_orderstatus", "o_orderdate"
    )
    report = profile.profile_with_histograms(orders)
    sinks.write_json(report, path)
    stored = spark.read.schema(report.schema).json(path)
    counted = F.aggregate(
        "histogram", F.lit(0).cast("bigint"), lambda total, bucket: total + bucket["n"]
    )
    return stored.select(
        "column_name",
        "data_type",
        "total_count",
        "null_count",
        F.coalesce(F.array_size("histogram"), F.lit(0)).alias("buckets"),
        F.coalesce(counted, F.lit(0)).cast("bigint").alias("bucket_rows"),
    )


def histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    quantity = F.col("l_quantity")
    lineitem = read_table(spark, sf_dir, "lineitem").withColumns(
        {
            "constant": F.lit(7),
            # Now and then a measurement that is no number, or without end.
            "odd": F.when(F.col("l_linenumber") == 1, F.lit(float("nan")))
            .when(F.col("l_linenumber") == 2, F.lit(float("-inf")))
            .otherwise(quantity),
        }
    )
    found = profile.histogram(lineitem, ["l_extendedprice", "l_quantity", "constant", "odd"])
    return found.select(
        "column_name", "bucket", F.round("lo", 4).alias("lo"), F.round("hi", 4).alias("hi"), "n"
    )


def output_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.output_profile(flat_star(spark, sf_dir))


def pan_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows with a full card number in each string column of the documents."""
    return guards.guard_report(read_table(spark, sf_dir, "documents"))


def mask_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All guards over the flat table, and over the joined tables with raw columns."""
    flat = sinks.with_iso_times(flat_star(spark, sf_dir)).drop("event_date")
    safe = guards.guard_report(
        flat,
        masked=["card_masked"],
        hashed=["card_hash", "email_hash"],
        iso_times=["txn_time", "card_created", "account_created"],
    ).withColumn("table_name", F.lit("flat"))
    raw = guards.guard_report(
        star_view(spark, sf_dir),
        masked=["card_number"],
        hashed=["member_email"],
    ).withColumn("table_name", F.lit("view"))
    return safe.unionByName(raw)


def incremental_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events a run reads again: whole UTC dates from seven days before the last event."""
    events = read_table(spark, sf_dir, "events")
    last = events.agg(F.max("ts")).first()[0]
    cutoff = cutoff_date(last, 7)
    return slice_since(events, "ts", bank.SOURCE_ZONE, cutoff)


def incremental_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three loads while events arrive up to four days late; equals one full load."""
    base = shared_dir(spark, "incremental")
    days = activity.load_days(read_table(spark, sf_dir, "events"))
    _load_as_arrived(spark, sf_dir, base, days, SHORT_DELAY)
    return publish.read_published(spark, base, "event")


def _load_as_arrived(
    spark: SparkSession, sf_dir: str, base: str, days: tuple, delay_days: int
) -> list:
    tables = activity.frames(spark, sf_dir)
    events = tables["event"]
    job = activity.job(base)
    return [
        run(
            spark,
            {**tables, "event": activity.arrived(events, day, delay_days)},
            job,
            "incremental",
        )
        for day in days
    ]


def quarantine_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events that arrived later than the look-back and that no load published."""
    base = shared_dir(spark, "quarantine")
    first, _, last = activity.load_days(read_table(spark, sf_dir, "events"))
    results = _load_as_arrived(spark, sf_dir, base, (first, last), LONG_DELAY)
    return missed_rows(
        read_table(spark, sf_dir, "events"),
        "ts",
        bank.SOURCE_ZONE,
        results[-1].cutoff,
        "event_id",
        publish.read_published(spark, base, "event"),
        "event_id",
    ).select("event_id", "ts", "event_type")


def full_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two full loads; readers get the second version."""
    base = shared_dir(spark, "full")
    tables = activity.frames(spark, sf_dir)
    job = activity.job(base)
    first = activity.load_days(tables["event"])[0]
    early = {**tables, "event": activity.arrived(tables["event"], first, SHORT_DELAY)}
    run(spark, early, job, "full")
    run(spark, tables, job, "full")
    publish.drop_old_versions(spark, base, "event", keep=1)
    return publish.read_published(spark, base, "event")


def _drifted(events: DataFrame) -> DataFrame:
    """What a source held before: in its first fifth of days some rows had not come, some had
    another value, and some were still there that the source deletes later."""
    first, last = events.agg(F.min("ts").cast("date"), F.max("ts").cast("date")).first()
    early = F.col("ts").cast("date") < F.lit(first + timedelta((last - first).days // 5))
    number = F.col("event_id")
    changed = F.when(early & (number % 701 == 0), F.col("value") + 1).otherwise(F.col("value"))
    return events.filter(~(early & (number % 601 == 0))).withColumn("value", changed)


def _source_now(events: DataFrame) -> DataFrame:
    first, last = events.agg(F.min("ts").cast("date"), F.max("ts").cast("date")).first()
    early = F.col("ts").cast("date") < F.lit(first + timedelta((last - first).days // 5))
    return events.filter(~(early & (F.col("event_id") % 803 == 0)))


def reconcile_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load of an earlier source, then a reconciling run: the dates that it found and loaded
    again, with the rows of each before, in the source, and published afterwards."""
    base = shared_dir(spark, "reconcile")
    tables = activity.frames(spark, sf_dir)
    events, job = tables["event"], activity.job(base)
    run(spark, {**tables, "event": _drifted(events)}, job, "full")
    now = {**tables, "event": _source_now(events)}
    state = publish.published_state(spark, base, "event")
    report = shared_dir(spark, "reconcile-report")
    stale_report(spark, now, job, state).write.parquet(report)
    run(spark, now, job, "reconcile")
    after = publish.published_state(spark, base, "event")
    rewritten = manifest.snapshot(spark, base, "event", after).filter(F.col("run_seq") == after["run_seq"])
    published = (
        publish.read_published(spark, base, "event")
        .groupBy(F.col("event_date").cast("string").alias("event_date"))
        .agg(F.count(F.lit(1)).alias("published_rows"))
    )
    return (
        rewritten.select("event_date")
        .join(spark.read.parquet(report), "event_date", "full_outer")
        .join(published, "event_date", "left")
        .select("event_date", "source_rows", "stored_rows", "reason", "published_rows")
    )


def reconciled_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table after such a run: late, changed and deleted rows of old dates as in the source."""
    base = shared_dir(spark, "reconciled")
    tables = activity.frames(spark, sf_dir)
    job = activity.job(base)
    run(spark, {**tables, "event": _drifted(tables["event"])}, job, "full")
    run(spark, {**tables, "event": _source_now(tables["event"])}, job, "reconcile")
    return publish.read_published(spark, base, "event")


def changed_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Members that get another name after the first load reach all dates with an incremental run."""
    base = shared_dir(spark, "dimension")
    tables = activity.frames(spark, sf_dir)
    job = replace(activity.job(base), follow_dimensions=True)
    before = F.when(F.col("member_id") % 97 == 0, F.lit("?")).otherwise(F.col("member_name"))
    old = tables["member"].withColumn("member_name", before)
    run(spark, {**tables, "member": old}, job, "incremental")
    run(spark, tables, job, "incremental")
    return publish.read_published(spark, base, "event")


def replay_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table as a full run makes it of the landed rows of several increments."""
    base = shared_dir(spark, "replay")
    tables = activity.frames(spark, sf_dir)
    events = tables["event"]
    job = replace(activity.job(base), bronze=True, source_id="event_id")
    for day in activity.load_days(events):
        run(spark, {**tables, "event": activity.arrived(events, day, SHORT_DELAY)}, job, "incremental")
    replay(spark, tables, job)
    return publish.read_published(spark, base, "event")


def stream_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The incremental load as a stream, with some events delivered twice."""
    base = shared_dir(spark, "stream")
    tables = activity.frames(spark, sf_dir)
    events = tables.pop("event")
    inbox = f"{base}/inbox"
    days = activity.load_days(events)
    for before, day in zip((None, *days), days):
        # The arrivals of the last day of a delivery come again with the next one.
        delivered = activity.arrived(events, day, SHORT_DELAY, since=before)
        delivered.write.mode("append").parquet(inbox)
        start_merge(
            read_stream(spark, inbox, events.schema),
            tables,
            activity.star(),
            f"{base}/table",
            "event_id",
            "ts",
            "event_id",
            "event_time",
            activity.GUARDS,
        ).awaitTermination()
    return read_merged(spark, f"{base}/table")


def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, rows = shared_dir(spark, "csv"), shared_dir(spark, "csv-rows")
    star = bank.gold_star(bank.DEMO_SALT)
    # The range partitioner samples its input: stored rows, not the joins again. They are
    # stored and sorted without the hashed columns. Two hashes of 64 digits make up 40 % of a
    # line, so plain CSV would be most of what the query puts on disk.
    join_needed(bank.frames(spark, sf_dir), star).write.option("compression", "zstd").parquet(rows)
    joined = spark.read.parquet(rows)
    order = [joined["transaction__utc_time"], joined["transaction__txn_id"]]
    sinks.write_csv(joined, path, order, finish=lambda df: finish(df, star), compression="gzip")
    return read_csv(spark, path, sinks.with_iso_times(finish(joined, star)).schema)


def parquet_pruned_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "parquet")
    flat = flatten(activity.frames(spark, sf_dir), activity.star())
    sinks.write_parquet(flat, path, sort_by=("event_time", "event_id"), compression="zstd")
    first, last = (F.lit(d).cast("date") for d in ("2024-01-10", "2024-01-12"))
    return spark.read.parquet(path).filter(F.col("event_date").between(first, last))


def partition_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The number of read partitions of each table, from its key range."""
    keys = {
        "member": ("customer", "c_custkey"),
        "card": ("orders", "o_orderkey"),
        "transaction": ("events", "event_id"),
        "account": ("part", "p_partkey"),
    }
    result = None
    for role, (table, key) in keys.items():
        bounds = partitioning.key_bounds(read_table(spark, sf_dir, table), key)
        plan = partitioning.partition_plan(bounds, partitioning.POLICIES[role]).withColumn(
            "role", F.lit(role)
        )
        result = plan if result is None else result.unionByName(plan)
    return result


def watermark_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The state of two sources after several loads: one row per source, the newest."""
    path = shared_dir(spark, "state")
    events = read_table(spark, sf_dir, "events")
    orders = read_table(spark, sf_dir, "orders").withColumnRenamed("o_orderdate", "ts")
    loads = [("events", activity.arrived(events, day, SHORT_DELAY)) for day in activity.load_days(events)]
    loads.insert(1, ("orders", orders))
    for seq, (source, df) in enumerate(loads, start=1):
        last, n = df.agg(F.max("ts"), F.count(F.lit(1))).first()
        ledger.append_state(
            spark,
            path,
            source=source,
            run_seq=seq,
            mode="incremental",
            status="success",
            watermark=last,
            records=n,
        )
    ledger.append_state(
        spark, path, source="orders", run_seq=len(loads) + 1, mode="incremental", status="failed"
    )
    return ledger.current_state(spark, path).select(
        "source", "run_seq", "status", "watermark", "records"
    )


def volume_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row counts of three loads, and the count each load is compared with."""
    path = shared_dir(spark, "volumes")
    events = read_table(spark, sf_dir, "events")
    results = None
    for seq, day in enumerate(activity.load_days(events), start=1):
        slice_ = activity.arrived(events, day, SHORT_DELAY)
        previous = ledger.previous_volume(spark, path, "events", "full")
        found = checks.run_checks(slice_, "events", [checks.volume_check(previous)]).select(
            F.lit(seq).cast("bigint").alias("run_seq"),
            "status",
            F.round("value", 6).alias("value"),
            F.col("total_rows").alias("row_count"),
        )
        row = found.first()
        ledger.append(
            spark, path, ledger.VOLUME_SCHEMA, [("events", "full", seq, row["row_count"])]
        )
        results = found if results is None else results.unionByName(found)
    history = ledger.read_log(spark, path, ledger.VOLUME_SCHEMA)
    return history.select("run_seq", F.col("row_count").alias("stored_rows")).join(
        results, "run_seq"
    )


def _synthetic(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    members = read_table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("member_id"))
    accounts = synthetic.synthetic_accounts(members, 7, "2024-12-31")
    cards = synthetic.synthetic_cards(accounts, 7)
    return accounts, cards, synthetic.synthetic_transactions(cards, 7, "2024-12-31")


def synthetic_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _synthetic(spark, sf_dir)[0]


def synthetic_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _synthetic(spark, sf_dir)[1]


def synthetic_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _synthetic(spark, sf_dir)[2]


def run_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What one full load records about itself, without times."""
    base = shared_dir(spark, "metrics")
    run(spark, activity.frames(spark, sf_dir), activity.job(base), "full")
    names = ("rows_in", "rows_out", "yield_percent", "output_columns", "checks")
    labels = F.col("labels")
    return (
        read_metrics(spark, f"{base}/metrics")
        .filter(F.col("name").isin(*names))
        .select(
            "name",
            "value",
            labels["mode"].alias("mode"),
            F.coalesce(labels["status"], F.lit("")).alias("status"),
        )
    )


def min_row_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each table of the two stars against the rows that a run needs."""
    least = 25
    tables = {**bank.frames(spark, sf_dir), **activity.frames(spark, sf_dir)}
    return reports.table_counts(tables).select(
        "table_name", "row_count", F.lit(least).cast("bigint").alias("required"),
        (F.col("row_count") >= least).alias("enough"),
    )


def early_exit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """States and row counts of a load, of a run without new rows, and of the whole load."""
    base = shared_dir(spark, "early")
    tables = activity.frames(spark, sf_dir)
    events, job = tables["event"], activity.job(base)
    first = activity.load_days(events)[0]
    loaded = activity.arrived(events, first, SHORT_DELAY)
    for slice_ in (loaded, events.filter("event_id < 0"), events):
        run(spark, {**tables, "event": slice_}, job, "incremental")
    log = ledger.read_log(spark, publish.state_path(base), ledger.STATE_SCHEMA)
    done = log.filter("status = 'success'").select("run_seq", "status", "watermark")
    volumes = ledger.read_log(spark, f"{base}/volumes", ledger.VOLUME_SCHEMA)
    return done.join(volumes.select("run_seq", "row_count"), "run_seq")


def mask_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Masks and hashes of card numbers of 0 to 19 digits, of odd e-mails, and of NULL."""
    key = F.col("o_orderkey")
    digits = F.repeat(key.cast("string"), F.lit(20))
    number = F.when(key % 21 != 20, F.left(digits, (key % 21).cast("int")))
    user = F.left(F.concat(F.lit("user"), key.cast("string")), (key % 7).cast("int"))
    email = (
        F.when(key % 5 == 0, F.lit(None).cast("string"))
        .when(key % 5 == 1, user)
        .when(key % 5 == 2, F.concat(user, F.lit("@mail.example")))
        .when(key % 5 == 3, F.concat(user, F.lit("@b@mail.example")))
        .otherwise(F.lit(""))
    )
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", number.alias("n"), email.alias("e"))
    return orders.select(
        "o_orderkey",
        mask_card(F.col("n")).alias("card_masked"),
        hash_value(F.col("n"), bank.DEMO_SALT).alias("card_hash"),
        hash_value(F.col("n"), bank.DEMO_SALT, null_as_empty=True).alias("card_hash_or_empty"),
        mask_email(F.col("e")).alias("email_masked"),
        hash_value(F.col("e"), bank.DEMO_SALT).alias("email_hash"),
    )


def pan_redact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents with their full card numbers masked."""
    documents = read_table(spark, sf_dir, "documents")
    return documents.select("doc_id", redact_cards(F.col("text")).alias("text"))


def csv_options(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts with names that need quotes, through CSV with other options."""
    path = shared_dir(spark, "csv-options")
    part = read_table(spark, sf_dir, "part").select(
        "p_partkey", F.concat_ws("|", "p_name", F.lit('"quoted"'), "p_brand").alias("label"), "p_retailprice"
    )
    sinks.write_csv(part, path, ["p_partkey"], delimiter="|", encoding="ISO-8859-1", header=True)
    return read_csv(spark, path, part.schema, delimiter="|", encoding="ISO-8859-1")


def csv_beside_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The CSV that a full run writes beside its table."""
    base = shared_dir(spark, "formats")
    job = replace(activity.job(base), formats="parquet,csv")
    result = run(spark, activity.frames(spark, sf_dir), job, "full")
    flat = publish.read_published(spark, base, "event")
    path = f"{base}/csv/run-{result.run_seq:08d}"
    return read_csv(spark, path, sinks.with_iso_times(flat).schema)


def point_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event with the largest number, by its key."""
    events = read_table(spark, sf_dir, "events")
    return events.filter(F.col("event_id") == events.agg(F.max("event_id")).first()[0])


def _one_run_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = shared_dir(spark, "summary")
    run(spark, activity.frames(spark, sf_dir), activity.job(base), "full")
    # Times and sizes of files differ from run to run.
    return read_metrics(spark, f"{base}/metrics").filter(
        "name IN ('rows_in', 'rows_out', 'check')"
    )


def metric_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points, total, mean and last value of a run's metrics."""
    return metric_summary(_one_run_metrics(spark, sf_dir)).filter("name <> 'check'").select(
        "name", "points", "total", "mean", "last"
    )


def metrics_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The status of every check of a run, through the JSON form of its metrics."""
    path = shared_dir(spark, "metrics-json")
    found = _one_run_metrics(spark, sf_dir).filter("name = 'check'")
    sinks.write_json(found, path)
    labels = F.col("labels")
    return spark.read.schema(found.schema).json(path).select(
        labels["table"].alias("table_name"), labels["check"].alias("check_name"),
        labels["column"].alias("column_name"), labels["status"].alias("status"),
    )


def _stream_twice(
    spark: SparkSession, sf_dir: str, base: str, members_of_second: str, wait_days: int | None = None
) -> T.StructType:
    """Two deliveries, the first with half of the members; the schema of the events."""
    tables = activity.frames(spark, sf_dir)
    events, member = tables.pop("event"), tables["member"]
    first = activity.load_days(events)[0]
    for before, day, members in ((None, first, "member_id % 2 = 0"), (first, None, members_of_second)):
        delivered = activity.arrived(events, day, SHORT_DELAY, since=before)
        delivered.write.mode("append").parquet(f"{base}/inbox")
        start_merge(
            read_stream(spark, f"{base}/inbox", events.schema),
            {**tables, "member": member.filter(members)},
            activity.star(),
            f"{base}/table",
            "event_id",
            "ts",
            "event_id",
            "event_time",
            activity.GUARDS,
            wait_days=wait_days,
        ).awaitTermination()
    return events.schema


def stream_late_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events that arrive before half of their members; they follow with the next delivery."""
    base = shared_dir(spark, "stream-late")
    _stream_twice(spark, sf_dir, base, "true")
    return read_merged(spark, f"{base}/table")


def stream_expired(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events whose members never come, thirty days before the newest event: in quarantine."""
    base = shared_dir(spark, "stream-expired")
    schema = _stream_twice(spark, sf_dir, base, "member_id % 2 = 0", wait_days=30)
    return read_expired(spark, f"{base}/table", schema).select("event_id", "user_id", "ts")


QUERIES: dict[str, Query] = {
    q.__name__: q
    for q in (
        flat_star,
        star_view,
        text_projection,
        account_owners,
        orphans,
        join_yield,
        member_stats,
        member_stats_maintained,
        active_cards,
        sketch_profile,
        member_stats_raw,
        card_balance,
        population_summary,
        spend_by_category,
        spend_in_range,
        spend_in_range_sql,
        table_counts,
        max_event_time,
        account_types,
        null_vector,
        check_null,
        check_negative,
        check_extreme,
        check_format,
        check_consistency,
        check_duplicates,
        check_completeness,
        check_volume,
        duplicate_rows,
        suite_results,
        suite_gate,
        constraint_report,
        constraints_maintained,
        duplicate_history,
        column_profile,
        quality_report,
        histogram,
        output_profile,
        pan_scan,
        mask_guard,
        incremental_slice,
        incremental_merge,
        quarantine_late,
        full_publish,
        reconcile_dates,
        reconciled_table,
        changed_dimension,
        replay_bronze,
        stream_merge,
        csv_roundtrip,
        parquet_pruned_read,
        partition_plan,
        watermark_state,
        volume_history,
        synthetic_accounts,
        synthetic_cards,
        synthetic_transactions,
        run_metrics,
        min_row_report,
        early_exit,
        mask_edges,
        pan_redact,
        csv_options,
        csv_beside_parquet,
        point_lookup,
        metric_report,
        metrics_json,
        stream_late_dimension,
        stream_expired,
    )
}
