from __future__ import annotations

import gzip
import json
from pathlib import Path

import pytest
from bank_data import SALT
from pyspark.sql import functions as F

from starflat.operators import sinks
from starflat.operators.flatten import finish, flatten, join_needed
from starflat.operators.sinks import (
    parse_formats,
    with_iso_times,
    write_csv,
    write_json,
    write_parquet,
    write_schema,
)
from starflat.plans import bank, catalog
from starflat.sources.tables import read_csv


@pytest.fixture(scope="module")
def flat(tiny):
    return flatten(tiny, bank.gold_star(SALT))


def test_formats():
    assert parse_formats("csv") == ["csv"]
    assert parse_formats(" Parquet, csv,csv") == ["parquet", "csv"]
    for text in ("", "xcsvx", "csv,orc"):
        with pytest.raises(ValueError):
            parse_formats(text)


def test_csv_round_trip(spark, flat, folder):
    tricky = flat.withColumn("txn_description", F.lit('say "hi", é;\\'))
    write_csv(tricky, folder, ["txn_time", "txn_id"], delimiter=";", encoding="UTF-8")
    back = read_csv(spark, folder, with_iso_times(tricky).schema, delimiter=";")
    assert sorted(map(str, back.collect())) == sorted(map(str, with_iso_times(tricky).collect()))
    assert {r["txn_time"] for r in back.collect()} >= {"2025-03-10T00:10:00Z"}


def test_csv_columns_are_made_behind_the_sort(spark, tiny, folder):
    star = bank.gold_star(SALT)
    joined, order = join_needed(tiny, star), ["transaction__utc_time", "transaction__txn_id"]
    assert "member__email" in joined.columns and "transaction__txn_type" not in joined.columns
    write_csv(joined, folder, order, finish=lambda df: finish(df, star))
    want = with_iso_times(flatten(tiny, star))
    back = read_csv(spark, folder, want.schema)
    assert sorted(map(str, back.collect())) == sorted(map(str, want.collect()))


def test_csv_parts_are_in_global_order(spark, folder):
    df = spark.range(1000).select(((F.col("id") * 7919) % 1000).alias("k"), "id")
    write_csv(df, folder, ["k", "id"])
    values = []
    for part in sorted(Path(folder).glob("part-*.csv")):
        lines = part.read_text().splitlines()
        assert lines[0] == "k,id"
        values += [int(line.split(",")[0]) for line in lines[1:]]
    assert len(values) == 1000 and values == sorted(values)
    assert len(list(Path(folder).glob("part-*.csv"))) >= 1


@pytest.mark.parametrize("compression", sinks.CSV_COMPRESSIONS)
def test_csv_compression(spark, flat, folder, compression):
    tricky = flat.withColumn("txn_description", F.lit('say "hi", é;\\'))
    write_csv(tricky, folder, ["txn_time", "txn_id"], compression=compression)
    back = read_csv(spark, folder, with_iso_times(tricky).schema)
    assert sorted(map(str, back.collect())) == sorted(map(str, with_iso_times(tricky).collect()))


def test_unknown_csv_compression(flat, folder):
    with pytest.raises(ValueError):
        write_csv(flat, folder, ["txn_time"], compression="zip")


def test_compressed_csv_is_cut_into_files_in_global_order(spark, folder, monkeypatch):
    monkeypatch.setattr(sinks, "ROWS_PER_COMPRESSED_FILE", 100)
    df = spark.range(1000).select(((F.col("id") * 7919) % 1000).alias("k"), "id")
    write_csv(df, folder, ["k", "id"], compression="gzip")
    parts = sorted(Path(folder).glob("part-*"))
    texts = [gzip.open(part, "rt").read().splitlines() for part in parts]
    assert all(p.name.endswith(".csv.gz") for p in parts)
    assert all(lines[0] == "k,id" and len(lines) <= 101 for lines in texts)
    values = [int(line.split(",")[0]) for lines in texts for line in lines[1:]]
    assert values == list(range(1000))
    assert read_csv(spark, folder, df.schema).count() == 1000


def test_csv_roundtrip_takes_less_than_half_of_plain_csv(spark, tmp_path, monkeypatch):
    n = 2000
    tables = {
        "customer": f"SELECT id c_custkey, format_string('Customer#%09d', id) c_name, 1 c_nationkey,"
        f" 1D c_acctbal, 'A' c_mktsegment FROM range({n // 10})",
        "orders": f"SELECT id o_orderkey, id % {n // 10} o_custkey, 'O' o_orderstatus, 1D o_totalprice,"
        " timestamp_ntz'1996-01-01' + make_dt_interval(id % 900) o_orderdate, '1-URGENT' o_orderpriority"
        f" FROM range({n // 4})",
        "lineitem": f"SELECT id DIV 4 l_orderkey, id l_partkey, id l_suppkey, int(id % 4) l_linenumber,"
        " 1D l_quantity, id / 7 l_extendedprice, 0D l_discount, 0D l_tax, 'R' l_returnflag, 'O' l_linestatus,"
        f" timestamp_ntz'1997-01-01' + make_dt_interval(id * 37 % 900) l_shipdate FROM range({n})",
    }
    for name, text in tables.items():
        spark.sql(text).write.parquet(f"{tmp_path}/{name}.parquet")
    monkeypatch.setattr(catalog, "shared_dir", lambda _, name: f"{tmp_path}/{name}")
    back = catalog.csv_roundtrip(spark, str(tmp_path))
    want = with_iso_times(catalog.flat_star(spark, str(tmp_path)))
    assert back.count() == n and sorted(map(str, back.collect())) == sorted(map(str, want.collect()))
    parts = sorted((tmp_path / "csv").glob("part-*"))
    write_csv(catalog.flat_star(spark, str(tmp_path)), f"{tmp_path}/plain", ["txn_time", "txn_id"])
    plain = sum(p.stat().st_size for p in (tmp_path / "plain").glob("part-*"))
    assert sum(p.stat().st_size for p in parts) < plain / 2
    rows = [line.split(",") for p in parts for line in gzip.open(p, "rt").read().splitlines()[1:]]
    time, txn = (bank.GOLD_COLUMNS.index(c) for c in ("txn_time", "txn_id"))
    order = [(row[time], int(row[txn])) for row in rows]
    assert len(order) == n and order == sorted(order)


@pytest.mark.parametrize("compression", ["snappy", "gzip", "zstd", "lz4", "none"])
def test_parquet_compression(spark, flat, folder, compression):
    write_parquet(flat, folder, compression=compression)
    assert spark.read.parquet(folder).count() == 5
    assert sorted(p.name for p in Path(folder).glob("event_date=*"))[0] == "event_date=2025-02-24"


def test_unknown_compression(flat, folder):
    with pytest.raises(ValueError):
        write_parquet(flat, folder, compression="zip")


def test_dynamic_overwrite_keeps_other_dates(spark, flat, folder):
    write_parquet(flat, folder)
    one = flat.filter("txn_id = 4").withColumn("txn_description", F.lit("changed"))
    write_parquet(one, folder, dynamic=True)
    found = {r["txn_id"]: r["txn_description"] for r in spark.read.parquet(folder).collect()}
    assert found == {1: "Bakery", 2: "Rent share", 3: "Tickets", 4: "changed", 5: "Shoes"}


def test_a_hot_date_is_split_into_several_files(spark, folder):
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64KB")
    try:
        df = spark.range(0, 60_000, 1, 8).select(
            "id",
            F.sha2(F.col("id").cast("string"), 256).alias("payload"),
            F.when(F.col("id") % 3 == 0, F.lit("2024-01-01").cast("date"))
            .otherwise(F.date_add(F.lit("2024-02-01").cast("date"), (F.col("id") % 20).cast("int")))
            .alias("event_date"),
        )
        write_parquet(df, folder, sort_by=("id",))
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(list(Path(folder).glob("event_date=2024-01-01/*.parquet"))) > 1
    assert spark.read.parquet(folder).count() == 60_000


def test_schema_and_report_files(spark, flat, folder):
    write_schema(flat, folder + "-schema")
    text = spark.read.text(folder + "-schema").first()[0]
    assert [f["name"] for f in json.loads(text)["fields"]] == list(bank.GOLD_COLUMNS)
    write_json(spark.createDataFrame([("a", 1.0)], "name STRING, value DOUBLE"), folder + "-json")
    assert spark.read.json(folder + "-json").first()["value"] == 1.0
