"""Hard negatives by a vertical scan: dimensions in each anchor's order, candidates shrink by bounds."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from starflat.llm.common import staged
from starflat.llm.topk import EXACT_FLOAT, products, quantised

POSITIVES, NEGATIVES, ANCHOR_EVERY = 5, 3, 50
# A negative scores at least 50 and at most 95 hundredths of its positive.
LEAST, MOST = 50, 95
# A block of rows or a tile of anchors is one task's matter: bytes of its vectors, and
# rows below which a table is not cut further.
BLOCK_BYTES, LEAST_ROWS = 16 * 1024**2, 2048
# Dimensions that are read before the candidates are thinned again.
STEP = 8


# -- one block in one task ---------------------------------------------------------


class Block:
    """Rows of a block, dimension by dimension, with each dimension's range."""

    def __init__(self, rows: pd.DataFrame) -> None:
        rows = rows.sort_values("vec_id", kind="stable")
        self.ids, self.labels = rows["vec_id"].to_numpy(), rows["label"].to_numpy()
        self.vectors = np.vstack(rows["v"].to_numpy())
        self.columns = np.ascontiguousarray(self.vectors.T)
        self.low, self.high = self.vectors.min(axis=0), self.vectors.max(axis=0)
        self.widest = max(np.abs(self.low).max(initial=0.0), np.abs(self.high).max(initial=0.0))

    def steps(self, q: np.ndarray):
        """Dimensions by descending magnitude of the anchor, ``STEP`` at a time, and the least and
        most that those still unread can add to any row of the block."""
        order = np.argsort(-np.abs(q), kind="stable")
        ends = np.stack([q * self.low, q * self.high])[:, order]
        least, most = ends.min(axis=0), ends.max(axis=0)
        for at in range(0, len(order), STEP):
            yield order[at : at + STEP], least[at + STEP :].sum(), most[at + STEP :].sum()

    def exact(self, q: np.ndarray) -> bool:
        """Whether all sums stay whole numbers that a double holds."""
        return len(q) * self.widest * np.abs(q).max(initial=0.0) < EXACT_FLOAT


def _largest(values: np.ndarray, k: int):
    """The k-th largest value; -infinity if there are fewer."""
    return np.partition(values, len(values) - k)[len(values) - k] if len(values) >= k else -np.inf


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best scores, ties to the smaller id; ``ids`` ascend."""
    if len(scores) > k:
        near = np.flatnonzero(scores >= _largest(scores, k))
        return near[np.argsort(-scores[near], kind="stable")][:k]
    return np.argsort(-scores, kind="stable")


def scan_nearest(block: Block, q: np.ndarray, alive: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and scores of the k best rows among the places ``alive``."""
    if not block.exact(q):
        scores = products(q[None, :], block.vectors[alive])[0]
    else:
        scores = np.zeros(len(alive))
        for dims, least, most in block.steps(q):
            scores += q[dims] @ block.columns[dims][:, alive]
            keep = scores + most >= _largest(scores, k) + least
            if not keep.all():
                alive, scores = alive[keep], scores[keep]
        scores = scores.astype(np.int64)
    best = _best(block.ids[alive], scores, k)
    return alive[best], scores[best]


def scan_windows(
    block: Block, q: np.ndarray, alive: np.ndarray, windows: list[tuple[int, int]], k: int
) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each window ``(low, high)`` of scores, places and scores of the k best rows in it.

    A row stays while it may still end in some window with as good a score as
    the k rows that certainly end in that window.
    """
    if not block.exact(q):
        scores = products(q[None, :], block.vectors[alive])[0]
    else:
        scores = np.zeros(len(alive))
        for dims, least, most in block.steps(q):
            scores += q[dims] @ block.columns[dims][:, alive]
            under, over = scores + least, scores + most
            keep = np.zeros(len(alive), bool)
            for low, high in windows:
                sure = under[(under >= low) & (over <= high)]
                keep |= (under <= high) & (over >= max(low, _largest(sure, k)))
            if not keep.all():
                alive, scores = alive[keep], scores[keep]
        scores = scores.astype(np.int64)
    found = []
    for low, high in windows:
        inside = np.flatnonzero((scores >= low) & (scores <= high))
        best = inside[_best(block.ids[alive[inside]], scores[inside], k)]
        found.append((alive[best], scores[best]))
    return found


def window(positive: int, least: int, most: int) -> tuple[int, int]:
    """The scores n with ``least * positive <= 100 * n <= most * positive``."""
    return -((-least * positive) // 100), (most * positive) // 100


# -- tables ------------------------------------------------------------------------


def _blocks(rows: DataFrame, name: str, n: int, row_bytes: int, parallel: int) -> tuple[DataFrame, int]:
    """Rows dealt round robin over numbered blocks of bounded size; equal rows spread like any others."""
    by_size = -(-n * row_bytes // BLOCK_BYTES)
    count = max(1, by_size, min(parallel, -(-n // LEAST_ROWS)))
    dealt = rows.repartition(count).withColumn(name, F.spark_partition_id())
    return staged(dealt, name), count


def _every(name: str, count: int):
    return F.explode(F.sequence(F.lit(0), F.lit(count - 1))).alias(name)


def mine(
    vectors: DataFrame,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    every: int = ANCHOR_EVERY,
    least: int = LEAST,
    most: int = MOST,
) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``.

    Anchors are the rows whose ``vec_id`` is divisible by ``every``. An anchor's
    positives are its ``positives`` best other rows of the same label; for each,
    the ``negatives`` best rows of other labels follow whose score lies between
    ``least`` and ``most`` hundredths of the positive's. Scores are integer inner
    products of ``floor(256 * x)``; ties go to the smaller ``vec_id``.

    All rows lie in blocks, all anchors in tiles of bounded size. A task takes
    one tile and one block, whose vectors it holds dimension by dimension, and
    for each anchor reads the dimensions by the anchor's descending magnitudes.
    What the unread ones can add at least and at most shrinks the anchor's set
    of candidates until it is decided; only the few best of a block go on. One
    such pass finds the positives, a second one the negatives in the windows.

    Rows with a NULL label, a NULL vector or a NULL or non-finite component take
    no part, nor do rows without an id. Vectors of different lengths are not
    compared. A repeated id is one candidate a row, and never its own; as an anchor
    it appears once, by its first label and vector. A negative positive score
    has no window; for a score of zero it holds zero alone. Scores beyond a long
    are cut to its bounds. An empty table gives no rows; further columns do not matter.
    """
    labels = vectors.filter(F.col("label").isNotNull())
    usable = quantised(labels.select("vec_id", "embedding", "label"), keep=("label",))
    rows = staged(usable.select("vec_id", F.col("label").cast("long").alias("label"), "v", "dim"), "vectors")
    n, wide = rows.agg(F.count(F.lit(1)), F.max("dim")).first()
    parallel = 2 * rows.sparkSession.sparkContext.defaultParallelism
    candidates, blocks = _blocks(rows, "block", n, 8 * (wide or 1), parallel)
    asked = (
        rows.filter(F.col("vec_id") % every == 0)
        .groupBy("vec_id")
        .agg(F.min(F.struct("label", "dim", "v")).alias("first"))
        .select(F.col("vec_id").alias("anchor_id"), "first.label", "first.dim", "first.v")
    )
    asked = staged(asked, "asked")
    anchors, tiles = _blocks(asked, "tile", asked.count(), 8 * (wide or 1), 1)
    keys = ["dim", "tile", "block"]
    right = candidates.select("dim", _every("tile", tiles), "block", "vec_id", "label", "v")

    def nearest(key, tile: pd.DataFrame, part: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(tile) and len(part):
            block = Block(part)
            for anchor, label, q in zip(tile["anchor_id"], tile["label"], tile["v"]):
                alive = np.flatnonzero((block.labels == label) & (block.ids != anchor))
                places, scores = scan_nearest(block, np.asarray(q), alive, positives)
                found += [(anchor, i, s) for i, s in zip(block.ids[places], scores)]
        return pd.DataFrame(found, columns=["anchor_id", "positive_id", "positive_score"]).astype("int64")

    def in_windows(key, tile: pd.DataFrame, part: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(tile) and len(part):
            block = Block(part)
            for anchor, label, q, scored in zip(tile["anchor_id"], tile["label"], tile["v"], tile["scores"]):
                bounds = [window(int(s), least, most) for s in scored]
                different = sorted({(low, high) for low, high in bounds if low <= high})
                alive = np.flatnonzero(block.labels != label)
                lists = dict(zip(different, scan_windows(block, np.asarray(q), alive, different, negatives)))
                for at, bound in enumerate(bounds):
                    places, scores = lists.get(bound, ((), ()))
                    found += [(anchor, at + 1, block.ids[p], s) for p, s in zip(places, scores)]
        names = ["anchor_id", "positive_rank", "negative_id", "negative_score"]
        return pd.DataFrame(found, columns=names).astype("int64")

    left = anchors.select("dim", "tile", _every("block", blocks), "anchor_id", "label", "v")
    partial = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(
        nearest, "anchor_id long, positive_id long, positive_score long"
    )
    best = Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), F.asc("positive_id"))
    chosen = staged(
        partial.withColumn("positive_rank", F.row_number().over(best).cast("long")).filter(
            F.col("positive_rank") <= positives
        ),
        "positives",
    )
    # At most ``positives`` rows an anchor.
    scored = chosen.groupBy("anchor_id").agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("positive_rank", "positive_score"))), lambda p: p["positive_score"]
        ).alias("scores")
    )
    left = anchors.join(scored, "anchor_id").select(
        "dim", "tile", _every("block", blocks), "anchor_id", "label", "v", "scores"
    )
    partial = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(
        in_windows, "anchor_id long, positive_rank long, negative_id long, negative_score long"
    )
    hardest = Window.partitionBy("anchor_id", "positive_rank").orderBy(F.desc("negative_score"), F.asc("negative_id"))
    ranked = partial.withColumn("rank", F.row_number().over(hardest)).filter(F.col("rank") <= negatives)
    return ranked.join(chosen, ["anchor_id", "positive_rank"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )
