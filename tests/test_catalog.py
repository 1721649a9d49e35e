"""Every registered query against its SQL."""

from __future__ import annotations

from pathlib import Path

import pytest
from oracle import compare

import __spark_entry__
from starflat.plans.catalog import QUERIES
from starflat.plans.oracles import ORACLES

SF = "/root/testdata/sf0.001"


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, name):
    assert compare(spark, SF, name) is None


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
    assert set(QUERIES) <= set(__spark_entry__.queries())
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def with_an_event_of(tmp_path, time: str):
    """The small tables with one more event at a time."""
    import duckdb

    folder = tmp_path / "sf"
    folder.mkdir()
    for path in Path(SF).glob("*.parquet"):
        if path.stem != "events":
            (folder / path.name).symlink_to(path)
    duckdb.execute(
        f"COPY (SELECT * FROM '{SF}/events.parquet' UNION ALL SELECT 10000003, TIMESTAMP '{time}',"
        f" user_id, event_type, value, props FROM (FROM '{SF}/events.parquet' LIMIT 1))"
        f" TO '{folder}/events.parquet' (FORMAT parquet)"
    )
    return str(folder)


@pytest.mark.parametrize("name", ["incremental_merge", "stream_merge", "quarantine_late", "volume_history"])
def test_load_days_follow_the_data(spark, tmp_path, name):
    """An event in another year is loaded, too."""
    folder = with_an_event_of(tmp_path, "2025-06-01 10:00:00")
    assert compare(spark, folder, name) is None
    if name == "incremental_merge":
        found = QUERIES[name](spark, folder)
        assert found.filter("event_id = 10000003").count() == 1
