"""The slice of a source that an incremental run reads again."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starflat.functions import to_utc


def cutoff_date(watermark: datetime, lookback_days: int) -> date:
    """First UTC date that is read again.

    Whole dates are read because whole date partitions are replaced.
    """
    if lookback_days < 0:
        raise ValueError("the look-back must not be negative")
    return watermark.date() - timedelta(days=lookback_days)


def slice_since(df: DataFrame, time_column: str, zone: str, cutoff: date | None) -> DataFrame:
    """Rows whose UTC date is at or after ``cutoff``; all rows without a cutoff.

    The first predicate compares the bare local time column, so the source can
    skip files, row groups or JDBC rows. It is one day looser than the exact one
    because no zone is further than a day from UTC.
    """
    if cutoff is None:
        return df
    local = F.col(time_column)
    loose = F.lit(datetime.combine(cutoff - timedelta(days=1), datetime.min.time()))
    exact = to_utc(local, zone).cast("date") >= F.lit(cutoff)
    return df.filter(local >= loose.cast("timestamp_ntz")).filter(exact)


def missed_rows(
    df: DataFrame,
    time_column: str,
    zone: str,
    cutoff: date,
    id_column: str,
    published: DataFrame,
    published_id: str,
    published_date: str = "event_date",
) -> DataFrame:
    """Source rows before ``cutoff`` that the published table lacks.

    Such rows arrived later than the look-back; an incremental run never reads
    them. The source gets a bare-column predicate, one day looser than the exact
    one, and of the published table only the partitions before ``cutoff`` are read.
    """
    local = F.col(time_column)
    loose = F.lit(datetime.combine(cutoff + timedelta(days=1), datetime.min.time()))
    old = df.filter(local < loose.cast("timestamp_ntz")).filter(
        to_utc(local, zone).cast("date") < F.lit(cutoff)
    )
    known = published.filter(F.col(published_date) < F.lit(cutoff)).select(F.col(published_id).alias("_published_id"))
    return old.join(known, F.col(id_column) == F.col("_published_id"), "left_anti")
