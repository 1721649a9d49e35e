"""A uniform shuffle into shards of exact sizes, in DataFrame and SQL functions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from starflat.llm.common import numbered, staged, texts

SHARDS = 16
MIN_BLOCKS, MAX_BLOCKS, BLOCK_ROWS = 256, 4096, 50_000
SEED = 20240607

# One draw of a hypergeometric number: how many of `n` rows go to a shard that
# still takes `k` of the `pool` rows left. Weights of the outcomes relative to
# the mode come from the ratio of neighbouring probabilities. The outcome is
# where their running sum passes the share `u` of their total. Outcomes over
# ten standard deviations off the mode (below 1e-20 together) are left out.
_RATIO_UP = "(d.k - i) * (d.n - i) / ((i + 1) * (d.pool - d.k - d.n + i + 1))"
_RATIO_DOWN = "i * (d.pool - d.k - d.n + i) / ((d.k - i + 1) * (d.n - i + 1))"
_DRAW = f"""
transform(transform(transform(
  array({{given}}),
  d -> named_struct('k', d.k, 'n', d.n, 'pool', d.pool, 'u', d.u,
    'mode', least(d.k, d.n, floor((d.n + 1) * (d.k + 1) / (d.pool + 2))),
    'span', 10 + ceil(10 * sqrt(d.n * (d.k / greatest(d.pool, 1D))
                                * (1 - d.k / greatest(d.pool, 1D)))))),
  d -> named_struct('k', d.k, 'n', d.n, 'pool', d.pool, 'u', d.u,
    'ups', sequence(bigint(d.mode), bigint(least(d.k, d.n, d.mode + d.span))),
    'downs', sequence(bigint(d.mode),
                      bigint(greatest(0D, d.n - (d.pool - d.k), d.mode - d.span))))),
  d -> transform(array(named_struct(
      'up', aggregate(d.ups, named_struct('w', 1D, 's', 0D),
        (a, i) -> named_struct('w', a.w * {_RATIO_UP}, 's', a.s + a.w), a -> a.s),
      'down', aggregate(d.downs, named_struct('w', 1D, 's', -1D),
        (a, i) -> named_struct('w', a.w * {_RATIO_DOWN}, 's', a.s + a.w), a -> a.s))),
    t -> if(d.u * (t.up + t.down) < t.up,
      aggregate(d.ups, named_struct('w', 1D, 's', 0D, 'pick', -1L),
        (a, i) -> named_struct('w', a.w * {_RATIO_UP}, 's', a.s + a.w,
          'pick', if(a.s <= d.u * (t.up + t.down), i, a.pick)), a -> a.pick),
      aggregate(d.downs, named_struct('w', 1D, 's', t.up - 1, 'pick', -1L),
        (a, i) -> named_struct('w', a.w * {_RATIO_DOWN}, 's', a.s + a.w,
          'pick', if(a.s <= d.u * (t.up + t.down), i, a.pick)), a -> a.pick)))[0])[0]
"""


def communication_matrix(counts: DataFrame, shards: int, seed: int) -> DataFrame:
    """``(block, ends)``: how many rows of each block go up to and including each shard.

    The counts are those of a uniform assignment with shard sizes that differ
    by at most one, drawn block by block and shard by shard from what the
    earlier ones left. ``counts`` has ``(block, rows)``, at most ``MAX_BLOCKS``
    rows, so one task folds over it whatever the number of documents.
    """
    given = (
        "named_struct('k', double(quota), 'n', double(t.n), 'pool', double(t.pool),"
        f" 'u', pmod(xxhash64({seed}L, b.block, size(t.out)), 9007199254740992L)"
        " / 9007199254740992D)"
    )
    row = f"""
    aggregate(acc.quotas,
      named_struct('n', b.rows, 'pool', aggregate(acc.quotas, 0L, (x, y) -> x + y),
                   'out', cast(array() AS array<bigint>)),
      (t, quota) -> transform(array({_DRAW.format(given=given)}), drawn ->
        named_struct('n', t.n - drawn, 'pool', t.pool - quota,
                     'out', concat(t.out, array(drawn))))[0],
      t -> t.out)
    """
    quotas = (
        f"transform(sequence(0, {shards - 1}), i -> aggregate(blocks, 0L, (x, b) -> x + b.rows)"
        f" div {shards} + if(i < aggregate(blocks, 0L, (x, b) -> x + b.rows) % {shards}, 1L, 0L))"
    )
    matrix = f"""
    aggregate(blocks,
      named_struct('quotas', {quotas}, 'rows', cast(array() AS array<array<bigint>>)),
      (acc, b) -> transform(array({row}), drawn -> named_struct(
        'quotas', zip_with(acc.quotas, drawn, (x, y) -> x - y),
        'rows', concat(acc.rows, array(drawn))))[0],
      acc -> acc.rows)
    """
    together = counts.agg(
        F.sort_array(F.collect_list(F.struct("block", F.col("rows").cast("long").alias("rows")))).alias("blocks")
    )
    ends = "transform(sequence(1, size(drawn)), i -> aggregate(slice(drawn, 1, i), 0L, (x, y) -> x + y))"
    return (
        together.select("blocks", F.posexplode(F.expr(matrix)).alias("at", "drawn"))
        .select(F.expr("blocks[at].block").alias("block"), F.expr(ends).alias("ends"))
    )


def shard(docs: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """Each row's shard and place in it, uniform over all such shuffles.

    Rows fall into blocks. The exact number of rows that each block sends to
    each shard is drawn first; a block's rows, in random order, are then dealt
    by those numbers, and each shard is put into a random order again. Shard
    sizes differ by at most one row, whatever the texts are: law ``rows``.
    Texts never move, only ids, sizes and checksums do.

    Gives ``doc_id, size, text_crc32, law, shard, slot, grown_shard``. NULL
    texts count as empty; NULL ids and repeated rows are dealt like any other
    row; an empty table gives no rows. Blocks come from row numbers, so no key
    can be hot. The same files give the same shuffle; the seed gives another.
    """
    row = F.monotonically_increasing_id()
    narrow = texts(docs).select(
        "doc_id",
        (F.octet_length("text") + 1).cast("long").alias("size"),
        F.crc32(F.col("text").cast("binary")).alias("text_crc32"),
        F.xxhash64(F.lit(seed), row).alias("mix"),
        row.alias("row"),
    )
    rows = staged(narrow, "shard-rows")
    blocks = min(MAX_BLOCKS, max(MIN_BLOCKS, -(-rows.count() // BLOCK_ROWS)))
    rows = rows.withColumn("block", F.pmod("mix", F.lit(blocks)))
    counts = rows.groupBy("block").agg(F.count(F.lit(1)).alias("rows"))
    matrix = communication_matrix(counts, shards, seed)
    local = Window.partitionBy("block").orderBy(F.xxhash64(F.lit(seed + 1), "mix"), "row")
    dealt = (
        rows.withColumn("place", F.row_number().over(local))
        # At most MAX_BLOCKS rows of one number per shard.
        .join(F.broadcast(matrix), "block")
        .withColumn("shard", F.expr("size(filter(ends, e -> e < place))"))
        .withColumn("again", F.xxhash64(F.lit(seed + 2), "mix"))
        .select("doc_id", "size", "text_crc32", "shard", "again", "row")
    )
    placed = numbered(staged(dealt, "shard-dealt"), ["shard"], ["again", "row"], blocks, "slot")
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
