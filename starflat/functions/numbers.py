"""Numbers: exact money, safe casts, safe ratios."""

from __future__ import annotations

from pyspark.sql import Column, types as T
from pyspark.sql import functions as F

MONEY = T.DecimalType(20, 2)


def money(value: Column) -> Column:
    """DECIMAL(20,2), so that sums do not depend on the order of the rows."""
    return value.cast(MONEY)


def as_double(value: Column, data_type: T.DataType) -> Column | None:
    """The value as DOUBLE, or None where the type has no numeric reading.

    Text is read with ``try_cast``: rows that are no numbers give NULL.
    """
    if isinstance(data_type, (T.NumericType, T.BooleanType)):
        return value.cast("double")
    if isinstance(data_type, T.StringType):
        return value.try_cast("double")
    return None


def ratio(part: Column, whole: Column) -> Column:
    """``part / whole`` as DOUBLE; 0 where ``whole`` is 0 or NULL."""
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))
