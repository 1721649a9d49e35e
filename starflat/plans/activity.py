"""The event star: ``events`` with their member and the member's nation."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starflat.functions import hash_value, mask_email, money, to_utc
from starflat.operators.checks import (
    Check,
    completeness_check,
    consistency_check,
    duplicate_check,
    extreme_check,
    negative_check,
    null_check,
)
from starflat.operators.flatten import Derived, Link, Output, Star
from starflat.operators.publish import GuardSpec
from starflat.plans import bank
from starflat.plans.runs import FlatJob
from starflat.sources.tables import read_table

LINKS = (
    Link("event", "user_id", "member", "member_id"),
    Link("member", "nation_id", "nation", "n_nationkey"),
)
GUARDS = GuardSpec(hashed=("email_hash",), money=("amount",))


def frames(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {
        "event": read_table(spark, sf_dir, "events"),
        "member": dimension_members(spark, sf_dir),
        "nation": read_table(spark, sf_dir, "nation"),
    }


def dimension_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.col("c_name")
    return read_table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("member_id"),
        F.col("c_nationkey").alias("nation_id"),
        name.alias("member_name"),
        F.concat(F.lower(F.replace(name, F.lit("#"), F.lit("."))), F.lit("@mail.example")).alias(
            "email"
        ),
    )


def star(salt: str = bank.DEMO_SALT, zone: str = bank.SOURCE_ZONE) -> Star:
    outputs = (
        Output("event_id", lambda t: t("event", "event_id")),
        Output("event_type", lambda t: t("event", "event_type")),
        Output("amount", lambda t: money(t("event", "value"))),
        Output("event_time", lambda t: t("event", "utc_time")),
        Output("member_name", lambda t: t("member", "member_name")),
        Output("email_masked", lambda t: t("member", "email_masked")),
        Output("email_hash", lambda t: hash_value(t("member", "email"), salt)),
        Output("nation", lambda t: t("nation", "n_name")),
        Output("event_date", lambda t: t("event", "utc_time").cast("date")),
    )
    derived = (
        Derived("member", "email_masked", lambda: mask_email(F.col("email"))),
        Derived("event", "utc_time", lambda: to_utc(F.col("ts"), zone)),
    )
    return Star("event", LINKS, outputs, derived)


def suites() -> dict[str, list[Check]]:
    """The checks of a run; the run adds the volume check of the events."""
    return {
        "event": [
            completeness_check(["event_id", "ts", "user_id", "value"]),
            null_check("user_id"),
            negative_check("value"),
            extreme_check("value", bank.AMOUNT_LOW, bank.AMOUNT_HIGH),
            duplicate_check(["event_id"]),
        ],
        "member": [consistency_check("email")],
    }


def job(base: str, lookback_days: int = 7) -> FlatJob:
    return FlatJob(
        base=base,
        star=star(),
        source_time="ts",
        output_time="event_time",
        output_id="event_id",
        zone=bank.SOURCE_ZONE,
        lookback_days=lookback_days,
        guards=GUARDS,
        suites=suites(),
    )


def arrived(
    events: DataFrame, day: date | None, delay_days: int, since: date | None = None
) -> DataFrame:
    """What a source received until ``day`` (from ``since``, both included) if event n
    arrives ``n mod delay_days`` days late. Without a day, everything.
    """
    late = (F.col("event_id") % delay_days).cast("int")
    arrival = F.date_add(F.col("ts").cast("date"), late)
    received = F.lit(True)
    if day:
        received = received & (arrival <= F.lit(day))
    if since:
        received = received & (arrival >= F.lit(since))
    return events.filter(received)


def load_days(events: DataFrame) -> tuple[date, date, None]:
    """When the source is read: after two fifths and seven tenths of its days, then whole."""
    first, last = events.agg(F.min("ts").cast("date"), F.max("ts").cast("date")).first()
    if first is None:
        raise ValueError("no events")
    days = (last - first).days
    return first + timedelta(days * 2 // 5), first + timedelta(days * 7 // 10), None
