"""Hard negatives against brute force."""

from __future__ import annotations

import math
import random

import numpy as np
import pandas as pd
from starflat.llm import negatives, queries

SCHEMA = "vec_id LONG, embedding ARRAY<FLOAT>, label INT, block INT, v STRING, tile INT, dim STRING, scores INT"
COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
LONG = 2**63 - 1


def slow(rows, positives=5, least_hard=3, every=50, least=50, most=95):
    def usable(v):
        return v is not None and all(x is not None and math.isfinite(x) for x in v)

    whole = [(i, [math.floor(256 * x) for x in v], y) for i, v, y in rows if i is not None and y is not None and usable(v)]

    def dot(a, b):
        return max(-LONG - 1, min(LONG, sum(x * y for x, y in zip(a, b))))

    found = []
    for anchor in sorted({i for i, _, _ in whole if i % every == 0}):
        label, dim, mine = min((y, len(v), v) for i, v, y in whole if i == anchor)
        others = sorted((-dot(mine, v), i, y) for i, v, y in whole if i != anchor and len(v) == dim)
        for s, i, _ in [o for o in others if o[2] == label][:positives]:
            fits = [(t, j) for t, j, y in others if y != label and least * -s <= 100 * -t <= most * -s]
            found += [(anchor, i, r + 1, j, -s, -t) for r, (t, j) in enumerate(fits[:least_hard])]
    return sorted(found)


def run(spark, rows, **options):
    df = spark.createDataFrame([(*r, 1, "x", 2, "y", 3) for r in rows], SCHEMA)
    found = negatives.mine(df, **options)
    assert found.columns == COLUMNS
    return sorted(map(tuple, found.collect()))


def vector(rng, n=6):
    return [float(rng.randrange(-40, 40)) / 32 for _ in range(n)]


def test_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(negatives, "LEAST_ROWS", 40)
    monkeypatch.setattr(negatives, "BLOCK_BYTES", 20 * 48)
    monkeypatch.setattr(negatives, "STEP", 2)
    rng = random.Random(4)
    rows = [(i, vector(rng), rng.randrange(4)) for i in range(300)]
    # One vector, label and many ids in a third of the rows: ties everywhere.
    rows += [(300 + i, [1.0, 0.5, 0.0, -0.5, 0.25, 1.0], i % 2) for i in range(150)]
    want = slow(rows, every=20)
    assert len(want) > 100
    assert run(spark, rows, every=20) == want
    assert run(spark, rows, every=20, positives=2, negatives=7, least=10, most=100) == slow(rows, 2, 7, 20, 10, 100)


def test_scan_equals_products_whatever_the_step():
    rng = np.random.default_rng(2)
    vectors = np.floor(rng.normal(size=(500, 24)) * rng.uniform(0.1, 60, 24))
    block = negatives.Block(pd.DataFrame({"vec_id": np.arange(500), "label": 0, "v": list(vectors)}))
    for q in vectors[:20]:
        scores = (vectors @ q).astype(int)
        order = sorted(range(500), key=lambda i: (-scores[i], i))
        places, found = negatives.scan_nearest(block, q, np.arange(500), 7)
        assert places.tolist() == order[:7] and found.tolist() == scores[order[:7]].tolist()
        top = int(scores.max())
        windows = [(top // 4, top // 2), (0, top // 3), (top + 1, top + 5), (-50, 0)]
        for (low, high), (places, _) in zip(windows, negatives.scan_windows(block, q, np.arange(500), windows, 3)):
            assert places.tolist() == [i for i in order if low <= scores[i] <= high][:3]


def test_bounds_shrink_the_candidates(monkeypatch):
    """Fewer products than a full scan: what the unread dimensions can add decides early."""
    rng = np.random.default_rng(5)
    vectors = np.floor(rng.normal(size=(2000, 64)) * 100 / (1 + np.arange(64)))
    block = negatives.Block(pd.DataFrame({"vec_id": np.arange(2000), "label": 0, "v": list(vectors)}))
    read = []

    class Counting(np.ndarray):
        def __getitem__(self, key):
            out = np.asarray(super().__getitem__(key))
            if isinstance(key, tuple):
                read.append(out.size)
                return out
            return out.view(Counting)

    block.columns = block.columns.view(Counting)
    negatives.scan_nearest(block, vectors[0], np.arange(2000), 5)
    assert 0 < sum(read) < 2000 * 64 / 2


def test_window_bounds_are_exact():
    for p in (*range(-7, 50), LONG, LONG - 1):
        low, high = negatives.window(p, 50, 95)
        for n in {low - 1, low, low + 1, high - 1, high, high + 1}:
            assert (low <= n <= high) == (50 * p <= 100 * n <= 95 * p)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 2.0], 1), (None, [1.0, 2.0], 1), (1, None, 1), (2, [None, 1.0], 1), (3, [nan, 1.0], 1), (4, [inf, 1.0], 2),
        (5, [], 1), (6, [], 2), (50, [], 1), (51, [1.0, 2.0], 1), (52, [0.75, 1.5], 2), (53, [0.75, 1.5], 3),
        (54, [0.75, 1.5], None), (100, [-1.0, 0.0], 7), (101, [1.0, 0.0], 7), (102, [-1.0, 1.0], 8),
        (150, [1.0, 2.0, 3.0], 1), (200, [1e30, 1.0], 4), (201, [1e30, 1.0], 4), (202, [4e29, 1.0], 5),
        (51, [1.0, 2.0], 1), (51, [1.0, 2.0], 1), (0, [1.0, 2.0], 1), (0, [3.0, 2.0], 2),
    ]
    got, want = run(spark, rows), slow(rows)
    assert got == want and want


def test_empty_and_few_rows(spark):
    assert negatives.mine(spark.createDataFrame([], SCHEMA)).count() == 0
    assert run(spark, [(0, [1.0], 1)]) == []
    rows = [(0, [1.0], 1), (1, [1.0], 1), (2, [0.75], 2), (3, [0.25], 2)]
    assert run(spark, rows) == [(0, 1, 1, 2, 65536, 49152)]


def test_query_moves_labels(spark, tmp_path):
    rows = [(0, [1.0], 9), (1, [1.0], 0), (7, [0.75], 9), (8, [0.75], 9)]
    spark.createDataFrame(rows, "vec_id LONG, embedding ARRAY<FLOAT>, label INT").write.parquet(f"{tmp_path}/embeddings.parquet")
    found = queries.op12_negatives(spark, str(tmp_path)).collect()
    # Rows 0 and 7 become label 0.
    assert sorted((r["positive_id"], r["negative_id"]) for r in found) == [(1, 8)]
