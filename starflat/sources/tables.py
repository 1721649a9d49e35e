"""File sources and schema checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, types as T


# The schemas of the tables the queries read.
TABLES = {
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE,"
    " c_mktsegment STRING",
    "documents": "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING,"
    " value DOUBLE, props STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT,"
    " l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE,"
    " l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP_NTZ",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE,"
    " o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT,"
    " p_retailprice DOUBLE",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
}


class SchemaMismatch(Exception):
    """A frame lacks declared columns or has them with another type."""


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One Parquet table of a folder with its declared schema: no job reads footers first."""
    return spark.read.schema(TABLES[name]).parquet(f"{folder}/{name}.parquet")


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    delimiter: str = ",",
    encoding: str = "UTF-8",
    multi_line: bool = False,
) -> DataFrame:
    """CSV with a header row and a given schema: no extra pass to infer types.

    ``multi_line`` is needed where text holds line breaks; a file is then read by
    one task.
    """
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("sep", delimiter)
        .option("encoding", encoding)
        .option("escape", '"')
        .option("multiLine", multi_line)
        .csv(path)
    )


def local_rows(spark: SparkSession, rows: Sequence[tuple], schema: str | T.StructType) -> DataFrame:
    """A small frame from literal rows with an explicit schema."""
    return spark.createDataFrame(list(rows), schema)


def assert_schema(df: DataFrame, expected: T.StructType) -> None:
    """Every expected column is there with the expected type; extras are allowed."""
    found = {f.name: f.dataType for f in df.schema.fields}
    wrong = [
        f"{f.name}: expected {f.dataType.simpleString()}, "
        f"found {found[f.name].simpleString() if f.name in found else 'nothing'}"
        for f in expected.fields
        if found.get(f.name) != f.dataType
    ]
    if wrong:
        raise SchemaMismatch("; ".join(wrong))


def assert_same_schema(df: DataFrame, stored: T.StructType) -> None:
    """The same columns with the same types as stored, in any order."""
    assert_schema(df, stored)
    known = set(stored.fieldNames())
    added = [c for c in df.columns if c not in known]
    if added:
        raise SchemaMismatch(f"new columns: {', '.join(added)}; a full run takes them in")


def require_columns(df: DataFrame, required: Sequence[str]) -> None:
    """Looks at the schema only."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise SchemaMismatch(f"missing columns: {', '.join(missing)}")


def require_rows(frames: Mapping[str, DataFrame], min_rows: int = 1) -> None:
    """Each frame has at least ``min_rows`` rows; stops reading once they are found."""
    short = [name for name, df in frames.items() if df.limit(min_rows).count() < min_rows]
    if short:
        raise ValueError(f"fewer than {min_rows} rows: {', '.join(short)}")
