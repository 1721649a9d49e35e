"""Exact top-k search by tiled matrix products."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from starflat.llm.common import staged

K, QUERY_EVERY, SCALE = 5, 50, 256
# Rows of a tile on either side, and lists merged in one step of the tree.
QUERY_ROWS, SHARD_ROWS, FAN_IN = 1024, 4096, 32
EXACT_FLOAT, LONG_MAX = 2**53, 2**63 - 1


def quantised(vectors: DataFrame, scale: int = SCALE, keep: tuple[str, ...] = ()) -> DataFrame:
    """``(vec_id, v)``, and columns to ``keep``, with ``floor(scale * x)`` of each component; rows
    that cannot be searched are left out."""
    x = F.transform(F.col("embedding"), lambda c: F.floor(c.cast("double") * scale).cast("double"))
    usable = F.forall(
        "embedding",
        lambda c: F.coalesce(~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf")), F.lit(False)),
    )
    return (
        vectors.filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & usable)
        .select(F.col("vec_id").cast("long").alias("vec_id"), *keep, x.alias("v"))
        .withColumn("dim", F.size("v"))
    )


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of integer rows, saturated at the bounds of a long."""
    widest = a.shape[1] * (np.abs(a).max(initial=0.0) * np.abs(b).max(initial=0.0))
    if widest < EXACT_FLOAT:
        return (a @ b.T).astype(np.int64)
    whole = [[int(x) for x in row] for row in b]
    out = np.empty((len(a), len(b)), np.int64)
    for i, row in enumerate(a):
        left = [int(x) for x in row]
        for j, right in enumerate(whole):
            score = sum(x * y for x, y in zip(left, right))
            out[i, j] = max(-LONG_MAX - 1, min(LONG_MAX, score))
    return out


def tile(queries: pd.DataFrame, shard: pd.DataFrame, k: int) -> pd.DataFrame:
    """The k best rows of a shard for each query of a tile, ties to the smaller id."""
    shard = shard.sort_values("vec_id", kind="stable")
    ids, q_ids = shard["vec_id"].to_numpy(), queries["query_id"].to_numpy()
    a, b = np.vstack(queries["q"].to_numpy()), np.vstack(shard["v"].to_numpy())
    scores = products(a, b)
    own = q_ids[:, None] == ids[None, :]
    rows, columns, best = [], [], []
    for at in range(len(q_ids)):
        line = scores[at]
        allowed = np.flatnonzero(~own[at])
        if not len(allowed):
            continue
        line = line[allowed]
        if len(line) > k:
            # All that reach the k-th best score; a stable sort then keeps small ids.
            least = np.partition(line, len(line) - k)[len(line) - k]
            over = np.flatnonzero(line > least)
            equal = np.flatnonzero(line == least)[: k - len(over)]
            chosen = np.sort(np.concatenate([over, equal]))
        else:
            chosen = np.arange(len(line))
        chosen = chosen[np.argsort(-line[chosen].astype(object), kind="stable")]
        rows.append(np.full(len(chosen), q_ids[at]))
        columns.append(ids[allowed[chosen]])
        best.append(line[chosen])
    if not rows:
        return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype("int64")
    return pd.DataFrame(
        {"query_id": np.concatenate(rows), "vec_id": np.concatenate(columns), "score": np.concatenate(best)}
    )


def top_k(vectors: DataFrame, k: int = K, every: int = QUERY_EVERY) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: each query's k best other rows by integer inner product.

    Queries are the rows whose ``vec_id`` is divisible by ``every``. Queries and
    candidates are dealt by hash into tiles of bounded size; each pair of a
    query tile and a shard is one task-sized matrix product, of which only k
    rows a query go on. Those lists are merged ``FAN_IN`` shards at a time, then
    over the groups, so no query's lists meet in one step.

    Ties go to the smaller ``vec_id``. Vectors that are NULL or hold NULL or
    non-finite components take no part, nor do rows without an id. Vectors of
    different lengths are not compared. A repeated id is one candidate per row,
    and never its own; as a query it appears once, by its first vector. Scores
    beyond a long are cut to its bounds. Empty tables give no rows.
    """
    rows = staged(quantised(vectors), "vectors")
    n = rows.count()
    shards = max(1, -(-n // SHARD_ROWS))
    asked = (
        rows.filter(F.col("vec_id") % every == 0)
        .groupBy("vec_id")
        .agg(F.min(F.struct("v", "dim")).alias("first"))
        .select("vec_id", "first.v", "first.dim")
    )
    tiles = max(1, -(-asked.count() // QUERY_ROWS))
    spread = lambda m, *more: F.pmod(F.xxhash64("vec_id", *more), F.lit(m)).cast("int")
    every_one = lambda m: F.explode(F.sequence(F.lit(0), F.lit(m - 1)))
    left = asked.select(
        F.col("dim").alias("dim"), spread(tiles).alias("tile"), every_one(shards).alias("shard"),
        F.col("vec_id").alias("query_id"), F.col("v").alias("q"),
    )
    # A repeated id would fill one shard: the vector takes part in the hash.
    right = rows.select(
        F.col("dim").alias("dim"), every_one(tiles).alias("tile"),
        spread(shards, F.to_json("v")).alias("shard"),
        F.col("vec_id").alias("vec_id"), F.col("v").alias("v"),
    )
    keys = ["dim", "tile", "shard"]

    def multiply(key, queries: pd.DataFrame, shard: pd.DataFrame) -> pd.DataFrame:
        if not len(queries) or not len(shard):
            return pd.DataFrame({"query_id": [], "shard": [], "vec_id": [], "score": []}).astype("int64")
        # Identical rows beyond a shard's usual size are taken a part at a time.
        parts = [tile(queries, shard.iloc[i : i + SHARD_ROWS], k) for i in range(0, len(shard), SHARD_ROWS)]
        return pd.concat(parts).assign(shard=key[2])[["query_id", "shard", "vec_id", "score"]]

    partial = (
        left.groupBy(*keys)
        .cogroup(right.groupBy(*keys))
        .applyInPandas(multiply, "query_id long, shard int, vec_id long, score long")
    )
    order = [F.desc("score"), F.asc("vec_id")]
    group = F.floor(F.col("shard") / FAN_IN)
    merged = (
        partial.withColumn("group", group)
        .withColumn("rank", F.row_number().over(Window.partitionBy("query_id", "group").orderBy(*order)))
        .filter(F.col("rank") <= k)
        .withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(*order)))
        .filter(F.col("rank") <= k)
    )
    return merged.select("query_id", "rank", "vec_id", "score")
