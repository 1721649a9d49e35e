from __future__ import annotations

import pytest
from pyspark.sql import types as T
from pyspark.sql import functions as F

from starflat.session import initial_partitions, shared_dir
from starflat.sources.tables import (
    TABLES,
    SchemaMismatch,
    assert_schema,
    read_table,
    require_columns,
    require_rows,
)

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(TABLES))
def test_declared_schemas_match_the_files(spark, name):
    declared = read_table(spark, SF, name)
    found = spark.read.parquet(f"{SF}/{name}.parquet")
    assert [(f.name, f.dataType) for f in declared.schema] == [
        (f.name, f.dataType) for f in found.schema
    ]


def test_reading_with_a_declared_schema_starts_no_job(spark):
    spark.sparkContext.setJobGroup("read", "read")
    read_table(spark, SF, "orders").filter(F.col("o_orderkey") > 1)
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("read")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_assert_schema(tiny):
    expected = T.StructType([T.StructField("age", T.IntegerType())])
    assert_schema(tiny["member"], expected)
    with pytest.raises(SchemaMismatch, match="age"):
        assert_schema(tiny["card"], expected)
    with pytest.raises(SchemaMismatch, match="email"):
        require_columns(tiny["card"], ["card_id", "email"])


def test_min_rows(tiny, spark):
    require_rows(tiny, 3)
    with pytest.raises(ValueError, match="transaction"):
        require_rows({"transaction": tiny["transaction"]}, 6)
    with pytest.raises(ValueError):
        require_rows({"x": spark.createDataFrame([], "a INT")})


def test_plain_comparison_and_point_lookup(tiny):
    assert tiny["member"].filter("age > 30").count() == 2
    assert tiny["member"].filter("member_id = 2").first()["first_name"] == "Ines"


@pytest.mark.parametrize(
    ("size", "expected"), [(0, 200), (10 * 1024**4, 40_960), (100 * 1024**4, 409_600), (10**6 * 1024**4, 1_000_000)]
)
def test_initial_partitions(size, expected):
    assert initial_partitions(size) == expected


def test_shared_dir_follows_the_setting(spark):
    root = spark.conf.get("spark.checkpoint.dir", None)
    path = shared_dir(spark, "x")
    assert path != shared_dir(spark, "x")
    if root:
        assert path.startswith(root.rstrip("/") + "/starflat/x-")
