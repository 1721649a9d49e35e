from __future__ import annotations

import zlib
from collections import Counter

import pytest
from llm_data import empty, frame, odd, odd_rows

from starflat.llm import sharding


def check(rows, texts, shards):
    counts = Counter(r["shard"] for r in rows)
    assert len(rows) == len(texts)
    assert set(counts) <= set(range(shards))
    sizes = [counts.get(s, 0) for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1
    for s in range(shards):
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(sizes[s]))
    want = Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in texts)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == want
    assert {r["law"] for r in rows} == {"rows"} and {r["grown_shard"] for r in rows} == {None}


@pytest.mark.parametrize("n", [1, 15, 16, 1000])
def test_exact_sizes(spark, n):
    texts = [(i, "same" if i % 3 else f"t{i}") for i in range(n)]
    check(sharding.shard(frame(spark, texts)).collect(), texts, 16)


def test_odd_and_empty_tables(spark):
    rows = sharding.shard(odd(spark), shards=4).collect()
    check(rows, [(r[0], r[1]) for r in odd_rows()], 4)
    assert sharding.shard(empty(spark)).count() == 0


def test_counts_follow_the_hypergeometric_law(spark):
    """Mean and variance of the matrix entries over many seeds."""
    counts = spark.createDataFrame([(b, 30 + b) for b in range(8)], "block INT, rows LONG")
    total, seen = sum(30 + b for b in range(8)), []
    for seed in range(60):
        rows = {r["block"]: r["ends"] for r in sharding.communication_matrix(counts, 4, seed).collect()}
        matrix = [[e - s for s, e in zip([0, *rows[b]], rows[b])] for b in range(8)]
        assert [sum(m) for m in matrix] == [30 + b for b in range(8)]
        columns = [sum(m[s] for m in matrix) for s in range(4)]
        assert sum(columns) == total and max(columns) - min(columns) <= 1
        assert min(min(m) for m in matrix) >= 0
        seen += [m[s] - (30 + b) / 4 for b, m in enumerate(matrix) for s in range(4)]
    mean = sum(seen) / len(seen)
    variance = sum(x * x for x in seen) / len(seen)
    n = sum((30 + b) for b in range(8)) / 8
    wanted = n * 0.25 * 0.75 * (total - n) / (total - 1)
    assert abs(mean) < 0.05
    assert 0.85 < variance / wanted < 1.15


def test_seeds_differ_and_repeat(spark):
    texts = [(i, f"t{i}") for i in range(200)]
    order = lambda seed: sorted((r["doc_id"], r["shard"], r["slot"]) for r in sharding.shard(frame(spark, texts), seed=seed).collect())
    first = order(1)
    assert first == order(1) and first != order(2)


def test_no_python_in_the_plan(spark):
    plan = sharding.shard(odd(spark))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan
