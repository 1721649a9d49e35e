from __future__ import annotations

import random

from starflat.llm import topk

SCHEMA = "vec_id LONG, embedding ARRAY<FLOAT>, label INT, shard INT, v STRING"


def slow(rows, k, every):
    import math

    def usable(v):
        return v is not None and all(x is not None and math.isfinite(x) for x in v)

    whole = [(i, [math.floor(256 * x) for x in v]) for i, v, *_ in rows if i is not None and usable(v)]
    found = []
    for q in sorted({i for i, _ in whole if i % every == 0}):
        mine = min(v for i, v in whole if i == q)
        scored = sorted(
            (-sum(a * b for a, b in zip(mine, v)), i) for i, v in whole if i != q and len(v) == len(mine)
        )
        found += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])]
    return found


def run(spark, rows, **options):
    df = spark.createDataFrame([(*r, 0, 1, "x") for r in rows], SCHEMA)
    found = topk.top_k(df, **options)
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    return sorted(map(tuple, found.collect()))


def vector(rng, n=6):
    return [float(rng.randrange(-40, 40)) / 32 for _ in range(n)]


def test_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(topk, "SHARD_ROWS", 40)
    monkeypatch.setattr(topk, "QUERY_ROWS", 3)
    monkeypatch.setattr(topk, "FAN_IN", 2)
    rng = random.Random(1)
    rows = [(i, vector(rng)) for i in range(300)]
    rows += [(300 + i, [1.0] * 6) for i in range(100)]  # one vector in a quarter of the rows
    assert run(spark, rows, k=5, every=20) == sorted(slow(rows, 5, 20))


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 2.0]), (None, [1.0, 2.0]), (1, None), (2, [None, 1.0]), (3, [nan, 1.0]), (4, [inf, 1.0]),
        (5, []), (50, [0.5, -0.5]), (50, [0.5, -0.5]), (51, [1.0, 2.0, 3.0]), (52, [1e30, 1.0]), (100, []),
        (53, [-0.001, 0.001]), (53, [-0.001, 0.001]),
    ]
    found = run(spark, rows, k=5, every=50)
    want = [(q, r, i, min(s, 2**63 - 1)) for q, r, i, s in slow(rows, 5, 50)]
    assert found == sorted(want)


def test_empty_table_and_few_rows(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert topk.top_k(df).count() == 0
    assert run(spark, [(0, [1.0])]) == []
    assert run(spark, [(0, [1.0]), (7, [2.0])]) == [(0, 1, 7, 256 * 512)]
