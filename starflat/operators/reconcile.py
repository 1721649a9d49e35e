"""What of a published table no longer matches its source: dates by digests, dates by changed dimensions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starflat.functions import to_utc
from starflat.operators.flatten import Star
from starflat.operators.manifest import NO_DATE

_EXACT = "decimal(38,0)"


def row_hash(df: DataFrame) -> Column:
    """A hash of all columns in the order of their names; NULL and a moved value change it."""
    names = sorted(df.columns)
    marks = [F.col(name).isNull() for name in names]
    return F.xxhash64(*(F.col(name) for name in names), *marks)


def utc_date(time_column: str, zone: str) -> Column:
    """The UTC date of a local time as it names a partition."""
    return F.coalesce(to_utc(F.col(time_column), zone).cast("date").cast("string"), F.lit(NO_DATE))


def date_digests(df: DataFrame, time_column: str, zone: str) -> DataFrame:
    """``(event_date, source_rows, digest)``: rows and the exact sum of their hashes.

    The sum does not depend on order or partitioning and changes with any row that
    comes, goes or differs. Partial sums leave one row per date and task for the shuffle.
    """
    dated = df.select(utc_date(time_column, zone).alias("event_date"), row_hash(df).alias("h"))
    return dated.groupBy("event_date").agg(
        F.count(F.lit(1)).alias("source_rows"), F.sum(F.col("h").cast(_EXACT)).cast("string").alias("digest")
    )


def differing_dates(source: DataFrame, stored: DataFrame) -> DataFrame:
    """``(event_date, source_rows, stored_rows, reason)`` of dates whose digests differ."""
    now = source.select("event_date", F.col("source_rows"), F.col("digest").alias("_now"))
    then = stored.select("event_date", F.col("source_rows").alias("stored_rows"), F.col("digest").alias("_then"))
    rows = [F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in ("source_rows", "stored_rows")]
    n, was = F.col("source_rows"), F.col("stored_rows")
    reason = (
        F.when(n == was, "changed").when(was == 0, "new").when(n == 0, "gone").when(n > was, "more").otherwise("fewer")
    )
    return (
        now.join(then, "event_date", "full_outer")
        .select("event_date", *rows, (~F.col("_now").eqNullSafe(F.col("_then"))).alias("_differs"))
        .filter(F.col("_differs") & ((n > 0) | (was > 0)))
        .select("event_date", "source_rows", "stored_rows", reason.alias("reason"))
    )


# -- dimensions --------------------------------------------------------------------


def dimension_keys(star: Star) -> dict[str, str]:
    """The key column by which each dimension is referred to."""
    return {link.parent: link.key for link in star.links}


def key_digests(df: DataFrame, key: str) -> DataFrame:
    """``(key, digest)`` of a dimension; rows that share a key add up."""
    hashed = df.select(F.col(key).cast("string").alias("key"), row_hash(df).alias("h"))
    return hashed.filter(F.col("key").isNotNull()).groupBy("key").agg(F.sum(F.col("h").cast(_EXACT)).alias("digest"))


def changed_keys(now: DataFrame, then: DataFrame) -> DataFrame:
    """Keys that came, went or whose rows differ between two tables of :func:`key_digests`."""
    before = then.select("key", F.col("digest").alias("_then"))
    both = now.select("key", F.col("digest").alias("_now")).join(before, "key", "full_outer")
    return both.filter(~F.col("_now").eqNullSafe(F.col("_then"))).select("key")


def affected_dates(
    frames: Mapping[str, DataFrame], star: Star, changed: Mapping[str, DataFrame], time_column: str, zone: str
) -> DataFrame:
    """Distinct dates of facts that refer, directly or through other dimensions, to a changed key.

    The star is walked from its far ends to the fact: a row of a table is affected if
    its own key changed or if it refers to an affected row. Only keys are joined,
    and a hot foreign key of the fact costs no more than its rows: a semi-join never adds any.
    """
    keys = dimension_keys(star)

    def affected(table: str) -> DataFrame | None:
        """Keys of affected rows of a dimension."""
        found = changed.get(table)
        for link in star.links:
            if link.child == table:
                far = affected(link.parent)
                if far is not None:
                    near = _referring(frames[table], link.foreign_key, far).select(F.col(keys[table]).cast("string").alias("key"))
                    found = near if found is None else found.unionByName(near)
        return None if found is None else found.distinct()

    dates = None
    for link in star.links:
        if link.child == star.fact:
            far = affected(link.parent)
            if far is not None:
                hit = _referring(frames[star.fact], link.foreign_key, far).select(utc_date(time_column, zone).alias("event_date"))
                dates = hit if dates is None else dates.unionByName(hit)
    if dates is None:
        return frames[star.fact].limit(0).select(utc_date(time_column, zone).alias("event_date"))
    return dates.distinct()


def _referring(df: DataFrame, foreign_key: str, keys: DataFrame) -> DataFrame:
    return df.join(keys, F.col(foreign_key).cast("string") == F.col("key"), "left_semi")
