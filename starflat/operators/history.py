"""Ids of a slice that earlier periods already hold, found without reading their rows.

Each period keeps a blocked Bloom filter of its ids: bitmaps of 32,768 bits, whose number
grows with the period's rows. An id belongs to one bitmap of each period, so a slice meets
the filters by an equi-join. Only periods where all bits of an id are set are read, and
there the ids themselves decide, so the result is exact.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession, types as T
from pyspark.sql import functions as F

from starflat.operators import manifest, publish
from starflat.operators.partials import PERIOD, PeriodStore

# 24 bits and 8 probes an id: an id that a period lacks passes its filter in 0.004 % of cases.
BITMAP_BITS = 2**15
IDS_PER_BITMAP = BITMAP_BITS // 24
PROBES = 8
# Small periods have at least so many bitmaps, so that a slice is spread over as many join keys.
LEAST_BITMAPS = 64

FILTER_SCHEMA = T.StructType(
    [
        T.StructField("bitmaps", T.LongType()),
        T.StructField("bitmap", T.LongType()),
        T.StructField("bits", T.BinaryType()),
        T.StructField(PERIOD, T.StringType()),
    ]
)


def filter_store(base: str, source: str) -> PeriodStore:
    return PeriodStore(base, source, FILTER_SCHEMA)


def period_filters(df: DataFrame, key: str, period: Column) -> DataFrame:
    """The filters of every period of ``df``; rows without a key are in none.

    Bitmaps are built in partial aggregates, so a period that holds most rows reaches
    the shuffle as its bitmaps per task.
    """
    ids = df.select(F.col(key).alias("_key"), period.alias(PERIOD)).filter("_key IS NOT NULL")
    sizes = ids.groupBy(F.col(PERIOD).alias("_period")).agg(
        F.greatest(
            F.lit(LEAST_BITMAPS).cast("long"),
            F.pow(2, F.ceil(F.log2(F.count(F.lit(1)) / IDS_PER_BITMAP))).cast("long"),
        ).alias("bitmaps")
    )
    placed = ids.join(sizes, F.col(PERIOD).eqNullSafe(F.col("_period"))).select(
        PERIOD, "bitmaps", _bitmap(F.col("_key"), F.col("bitmaps")).alias("bitmap"), F.explode(_bits(F.col("_key"))).alias("bit")
    )
    built = placed.groupBy(PERIOD, "bitmaps", "bitmap").agg(F.bitmap_construct_agg("bit").alias("bits"))
    return built.select(*FILTER_SCHEMA.fieldNames())


def candidates(ids: DataFrame, key: str, filters: DataFrame) -> DataFrame:
    """``(key, period)`` where the period may hold the id; all that do hold it are among them."""
    # Powers of two: at most a few dozen different numbers of bitmaps, whatever the history.
    sizes = [r["bitmaps"] for r in filters.select("bitmaps").distinct().collect()]
    if not sizes:
        return ids.select(key, F.lit(None).cast("string").alias(PERIOD)).limit(0)
    keys = ids.select(key).filter(F.col(key).isNotNull()).distinct()
    numbers = F.array(*(F.lit(n).cast("long") for n in sorted(sizes)))
    asked = keys.select(key, F.explode(numbers).alias("bitmaps")).withColumn("bitmap", _bitmap(F.col(key), F.col("bitmaps")))
    probes = _bits(F.col(key))
    held = F.lit(True)
    for i in range(PROBES):
        held = held & _is_set(F.col("bits"), probes[i])
    return asked.join(filters, ["bitmaps", "bitmap"]).filter(held).select(key, PERIOD)


def duplicates(
    ids: DataFrame,
    key: str,
    filters: DataFrame,
    read_periods: Callable[[list[str | None]], DataFrame],
    unfiltered: Iterable[str | None] = (),
) -> DataFrame:
    """``(key, period)``: ids of a slice and the earlier periods that hold them, exactly.

    ``read_periods`` gives rows with the key and ``period`` of the periods it is asked
    for: those with a candidate, and those of ``unfiltered``, which have no filters. An
    id that occurs several times is given once per period.
    """
    found = candidates(ids, key, filters)
    # One name per period comes to the driver.
    periods = {r[PERIOD] for r in found.select(PERIOD).distinct().collect()} | set(unfiltered)
    there = read_periods(sorted(periods, key=lambda p: (p is not None, p or ""))).select(key, PERIOD).distinct()
    return there.join(ids.select(key), key, "left_semi")


def write_filters(df: DataFrame, key: str, period: Column, path: str) -> None:
    """The filters of ``df`` below ``path``, a folder a period."""
    period_filters(df, key, period).hint("rebalance", PERIOD).write.partitionBy(PERIOD).parquet(path)


def read_filters(
    spark: SparkSession, root: str, places: Iterable[tuple[str, str]]
) -> tuple[DataFrame, list[str | None]]:
    """Filters of the ``(folder, period)`` places of a manifest, and the periods that have none."""
    there: dict[str, list[str]] = {}
    wanted: dict[str, list[str]] = {}
    for folder, period in places:
        wanted.setdefault(folder, []).append(period)
    for folder in wanted:
        path = f"{root}/run={folder}"
        if publish.exists(spark, path):
            there[folder] = manifest.written_dates(spark, path, PERIOD)
    found = [(f, p) for f, periods in wanted.items() for p in periods if p in there.get(f, ())]
    lacking = [p for f, periods in wanted.items() for p in periods if p not in there.get(f, ())]
    filters = manifest.read_dates(spark, root, FILTER_SCHEMA, PERIOD, found)
    return filters, [None if p == manifest.NO_DATE else p for p in lacking]


class HeldBefore(Exception):
    """Ids of a slice that dates it does not replace hold already."""

    def __init__(self, count: int, examples: list[str]):
        super().__init__(f"{count} ids are published on other dates: {', '.join(examples)}")


def require_new(found: DataFrame, key: str) -> None:
    """Raises for any row of :func:`duplicates`."""
    first = found.orderBy(key, PERIOD).limit(5).collect()
    if first:
        raise HeldBefore(found.count(), [f"{r[key]} ({r[PERIOD] or 'no date'})" for r in first])


def _bitmap(key: Column, bitmaps: Column) -> Column:
    # As text: an id has the same place whether it comes as a short or a long number.
    return F.pmod(F.xxhash64(key.cast("string"), F.lit(0)), bitmaps)


def _bits(key: Column) -> Column:
    """Eight bit numbers of 15 bits, four from each of two hashes."""
    parts = []
    for seed in range(1, PROBES // 4 + 1):
        hashed = F.xxhash64(key.cast("string"), F.lit(seed))
        parts += [F.shiftrightunsigned(hashed, 15 * i).bitwiseAND(F.lit(BITMAP_BITS - 1)) for i in range(4)]
    return F.array(*parts)


def _is_set(bits: Column, bit: Column) -> Column:
    # bitmap_construct_agg puts bit n into byte n / 8, lowest bit first.
    byte = F.conv(F.hex(F.substring(bits, F.floor(bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.floor(byte / F.pow(2, bit % 8)).cast("int") % 2 == 1
