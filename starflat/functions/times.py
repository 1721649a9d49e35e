"""Wall-clock times; nothing here depends on the session time zone."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# Fixed values.
UTC_NAMES = ("UTC", "Etc/UTC", "Z")
ISO_UTC_PATTERN = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}Z$"


def to_utc(wall_time: Column, zone: str) -> Column:
    """TIMESTAMP_NTZ in ``zone`` to TIMESTAMP_NTZ in UTC, daylight saving included.

    ``convert_timezone`` looks up both zones for every row. In a UTC session the
    casts to and from TIMESTAMP change nothing, so the several times faster
    ``to_utc_timestamp`` gives the same result.
    """
    wall_time = wall_time.cast("timestamp_ntz")
    session = SparkSession.getActiveSession()
    if session is not None and session.conf.get("spark.sql.session.timeZone") in UTC_NAMES:
        return F.to_utc_timestamp(wall_time.cast("timestamp"), zone).cast("timestamp_ntz")
    return F.convert_timezone(F.lit(zone), F.lit("UTC"), wall_time)


def local_text(wall_time: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss``, 19 characters."""
    return F.left(wall_time.cast("timestamp_ntz").cast("string"), F.lit(19))


def iso_utc(utc_time: Column) -> Column:
    """``yyyy-MM-ddTHH:mm:ssZ`` of a TIMESTAMP_NTZ that holds UTC.

    ``date_format`` would go through the session zone and move times that fall
    in one of its daylight saving gaps.
    """
    return F.concat(F.replace(local_text(utc_time), F.lit(" "), F.lit("T")), F.lit("Z"))
