"""What reports and profiles need of each period, stored per period and replaced with it.

Sums per key, key sets and sketches of a period (a date, or a month) are computed when
the period is loaded. Reports merge the stored rows and never read the fact again. A
load replaces its periods in one step through the manifest, so a late row, a corrected
row and a deleted row all need no more than their period's rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, types as T
from pyspark.sql import functions as F

from starflat.functions.numbers import MONEY
from starflat.operators import ledger, manifest
from starflat.operators.publish import state_path
from starflat.operators.reports import totals_per_card

PERIOD = "period"
# Sizes of the sketches: 1.04 / 2^6 = 1.6 % standard error of distinct counts, and 99 % of
# the ranks of quantiles within 0.7 %.
HLL_LOG_SIZE = 12
KLL_SIZE = 400


@dataclass(frozen=True)
class PeriodStore:
    """Rows with a ``period`` text below ``base``; a load replaces whole periods."""

    base: str
    source: str
    schema: T.StructType

    @property
    def _root(self) -> str:
        return f"{self.base}/data"

    def replace(self, spark: SparkSession, rows: DataFrame, periods: Iterable[str | None]) -> int:
        """Puts ``rows`` in the place of all rows of ``periods``; gives the load's number.

        A period without rows is then empty; None is that of rows without a time. Rows of
        other periods are refused. Readers see the load as a whole, from its state entry
        on; a load that breaks earlier is simply repeated.
        """
        state = state_path(self.base)
        _, free = ledger.run_state(spark, state, self.source)
        seq = ledger.claim_run(spark, f"{self.base}/claims", free)
        folder = f"{seq:08d}-{uuid.uuid4().hex[:8]}"
        path = f"{self._root}/run={folder}"
        rows.select(*self.schema.fieldNames()).hint("rebalance", PERIOD).write.partitionBy(PERIOD).parquet(path)
        written = set(manifest.written_dates(spark, path, PERIOD))
        asked = {manifest.NO_DATE if p is None else p for p in periods}
        if not written <= asked:
            raise ValueError(f"rows of periods that are not replaced: {', '.join(sorted(written - asked))}")
        entries = [manifest.DateEntry(p, folder if p in written else None) for p in sorted(asked)]
        manifest.record(spark, f"{self.base}/manifest", self.source, "partials", seq, entries)
        ledger.append_state(
            spark, state, source=self.source, run_seq=seq, mode="replace", status="success", version="partials"
        )
        return seq

    def read(self, spark: SparkSession, run_seq: int | None = None) -> DataFrame:
        """The rows as of the newest load, or as of load ``run_seq``; empty before the first."""
        state = ledger.last_success(spark, state_path(self.base), self.source, run_seq)
        if state is None:
            return spark.createDataFrame([], self.schema)
        places = manifest.snapshot(spark, self.base, self.source, state).filter("folder IS NOT NULL")
        found = [(r["folder"], r["event_date"]) for r in places.select("folder", "event_date").collect()]
        return manifest.read_dates(spark, self._root, self.schema, PERIOD, found)


def month_of(time: Column) -> Column:
    return F.date_format(time, "yyyy-MM")


# -- sums and key sets -------------------------------------------------------------


def period_totals(transactions: DataFrame, period: Column) -> DataFrame:
    """:func:`totals_per_card` of each period; its cards are the period's key set."""
    return totals_per_card(transactions.withColumn(PERIOD, period), PERIOD)


def merge_totals(partials: DataFrame, *by: str) -> DataFrame:
    """Totals per card (or ``by``) over all periods: sums of sums, extremes of extremes."""
    sums = [F.sum(c).cast(MONEY).alias(c) for c in ("total", "debits", "credits")]
    return partials.groupBy(*(by or ("card_id",))).agg(
        F.sum("txn_count").alias("txn_count"),
        *sums,
        F.min("min_amount").alias("min_amount"),
        F.max("max_amount").alias("max_amount"),
    )


def active_cards(partials: DataFrame, span: Column) -> DataFrame:
    """Different cards and transactions of each span of periods (a year, say).

    Distinct counts of periods do not add up; their key sets do.
    """
    keys = partials.groupBy(span.alias("span"), "card_id").agg(F.sum("txn_count").alias("n"))
    return keys.groupBy("span").agg(
        F.count("card_id").alias("active_cards"), F.sum("n").alias("transactions")
    )


# -- mergeable profiles ------------------------------------------------------------

SKETCH_SCHEMA = T.StructType(
    [
        T.StructField("column_name", T.StringType()),
        T.StructField("total_count", T.LongType()),
        T.StructField("null_count", T.LongType()),
        T.StructField("min_value", T.DoubleType()),
        T.StructField("max_value", T.DoubleType()),
        T.StructField("different", T.BinaryType()),
        T.StructField("ranks", T.BinaryType()),
        T.StructField(PERIOD, T.StringType()),
    ]
)


def period_sketches(df: DataFrame, period: Column, columns: Sequence[str]) -> DataFrame:
    """A row per period and column: counts, extremes, and sketches of distinct values and ranks.

    Numbers alone have extremes and ranks; NaN and infinity have neither. All columns
    share one aggregate, whose state is a few kilobytes a column whatever the rows.
    """
    numeric = {f.name for f in df.schema if isinstance(f.dataType, T.NumericType)}
    parts = []
    for name in columns:
        value = F.col(name).cast("double") if name in numeric else F.lit(None).cast("double")
        finite = F.when(F.abs(value) < F.lit(float("inf")), value)
        finite = F.when(~F.isnan(value), finite)
        parts.append(
            F.struct(
                F.lit(name).alias("column_name"),
                F.count(F.lit(1)).alias("total_count"),
                F.count_if(F.col(name).isNull()).alias("null_count"),
                F.min(finite).alias("min_value"),
                F.max(finite).alias("max_value"),
                F.hll_sketch_agg(F.col(name).cast("string"), HLL_LOG_SIZE).alias("different"),
                F.when(F.count(finite) > 0, F.kll_sketch_agg_double(finite, KLL_SIZE)).alias("ranks"),
            )
        )
    grouped = df.groupBy(period.alias(PERIOD)).agg(F.array(*parts).alias("parts"))
    return grouped.select(PERIOD, F.inline("parts")).select(*SKETCH_SCHEMA.fieldNames())


def merge_sketches(sketches: DataFrame, quantiles: Sequence[float] = (0.5,)) -> DataFrame:
    """The profile of all periods: a row per column, distinct count and quantiles estimated.

    Quantiles are NULL where a column has no finite number.
    """
    merged = sketches.groupBy("column_name").agg(
        F.sum("total_count").alias("total_count"),
        F.sum("null_count").alias("null_count"),
        F.min("min_value").alias("min_value"),
        F.max("max_value").alias("max_value"),
        F.hll_sketch_estimate(F.hll_union_agg("different")).alias("distinct_estimate"),
    )
    ranks = (
        sketches.filter("ranks IS NOT NULL")
        .groupBy("column_name")
        .agg(F.kll_merge_agg_double("ranks").alias("ranks"))
        .select(
            "column_name",
            F.array(*(F.kll_sketch_get_quantile_double("ranks", F.lit(float(q))) for q in quantiles)).alias("quantiles"),
        )
    )
    return merged.join(ranks, "column_name", "left")
