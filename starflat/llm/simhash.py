"""Near-duplicates by SimHash fingerprints and pivot distance tables."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starflat.llm.common import byte_rows, fresh, hex16, signed, staged, texts
from starflat.llm.components import components

BITS, SEED, SHINGLE = 64, 42, 3
MAX_BITS = 2
# 5-word fingerprints of documents with Jaccard similarity 0.8 differ in 9.7 bits, give or take 2.9.
SIMILAR_BITS = 17
# Documents meet where all rows of one band of their MinHash signatures agree: 99.1 % of pairs of
# similarity 0.8 do, 5 in a thousand of those of 0.3.
BANDS, BAND_ROWS = 20, 7
SHINGLES_AT_ONCE = 2048
# Pairs whose signatures agree in fewer rows are left out: 3 standard deviations below 0.8.
LEAST_ROWS_EQUAL = int(BANDS * BAND_ROWS * 0.7)
# Pairs that a task holds before it verifies them, and partners of a text verified at once.
PAIRS_HELD, PARTNERS_AT_ONCE = 1 << 21, 1024
BLOCKS, SAME_BLOCKS = 5, 3
GROUP_ROWS, GROUP_SHINGLES = 4096, 1 << 21
HASHES_AT_ONCE = 1 << 16
N_PIVOTS = 24
# The reference fingerprints: hashes of 0, 1, 2, ...
PIVOTS = np.array(
    [xxhash.xxh64_intdigest(str(i).encode(), SEED) for i in range(N_PIVOTS)], dtype=np.uint64
)


def shingle_hashes(words: list[bytes], shingle: int) -> np.ndarray:
    """Hashes of all runs of so many words, of a shorter text as a whole; an empty one has none."""
    if not words:
        return np.zeros(0, np.uint64)
    if len(words) < shingle:
        shingles = [b" ".join(words)]
    else:
        shingles = list(map(b" ".join, zip(*(words[i:] for i in range(shingle)))))
    return np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), np.uint64, len(shingles))


def fingerprint(text: bytes) -> int:
    """The 64 majority bits of the hashes of all word shingles of a UTF-8 text."""
    return majority(shingle_hashes(text.lower().split(), SHINGLE))


def majority(hashes: np.ndarray) -> int:
    """The bits that more than half of the hashes have; 0 without hashes."""
    ones = np.zeros(BITS, np.int64)
    for start in range(0, len(hashes), HASHES_AT_ONCE):
        part = hashes[start : start + HASHES_AT_ONCE]
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int32)
    return sum(1 << int(i) for i in np.flatnonzero(2 * ones > len(hashes)))


def fingerprints(docs: DataFrame) -> DataFrame:
    """``(doc_id, fp)``, one row per row; a NULL or empty text has fingerprint 0."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, rows in byte_rows(batches):
            found = np.fromiter(map(fingerprint, rows), np.uint64, len(keys))
            yield pa.RecordBatch.from_arrays([keys, pa.array(found.view(np.int64))], ["doc_id", "fp"])

    return texts(docs).mapInArrow(compute, "doc_id long, fp long")


def pivot_table(values: np.ndarray) -> np.ndarray:
    """Hamming distances of each fingerprint to every reference fingerprint."""
    return np.bitwise_count(values[:, None] ^ PIVOTS[None, :]).astype(np.int8)


def close_pairs(values: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs within ``MAX_BITS``.

    Two fingerprints are at least as far apart as their distances to any pivot
    differ, so a pair with a larger difference in any coordinate is discarded.
    Sorting by the first coordinate bounds the partners of each row; the other
    coordinates thin them out; the survivors are compared bit by bit.
    """
    order = np.argsort(table[:, 0], kind="stable")
    first = table[order, 0].astype(np.int64)
    ends = np.searchsorted(first, first + MAX_BITS, side="right")
    left, right = [], []
    for start in range(0, len(order), 256):
        rows = order[start : start + 256]
        stop = int(ends[min(start + 255, len(order) - 1)])
        others = order[start:stop]
        a, b = np.triu_indices(len(rows), 1, len(others))
        for pivot in range(1, N_PIVOTS):
            near = np.abs(table[rows[a], pivot] - table[others[b], pivot]) <= MAX_BITS
            a, b = a[near], b[near]
        a, b = rows[a], others[b]
        linked = np.bitwise_count(values[a] ^ values[b]) <= MAX_BITS
        left.append(a[linked])
        right.append(b[linked])
    return np.concatenate(left), np.concatenate(right)


def _star(values: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links from each value to the first value of its component within the group."""
    a, b = close_pairs(values, table)
    label = np.arange(len(values))
    while True:
        least = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, least)
        np.minimum.at(new, b, least)
        new = new[new]
        if np.array_equal(new, label):
            break
        label = new
    moved = np.flatnonzero(label != np.arange(len(values)))
    return values[moved], values[label[moved]]


def _group_links(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Links within each group of rows that follow each other with the same keys."""
    rest = None
    for frame in _and_end(frames):
        if frame is not None:
            both = frame if rest is None else pd.concat([rest, frame], ignore_index=True)
        else:
            both = rest
        if both is None or not len(both):
            continue
        where, key = both["part"].to_numpy(), both["key"].to_numpy()
        cuts = np.flatnonzero((where[1:] != where[:-1]) | (key[1:] != key[:-1])) + 1
        starts = np.concatenate([[0], cuts])
        ends = np.concatenate([cuts, [len(both)]])
        if frame is not None:  # the last group may go on in the next batch
            rest = both.iloc[starts[-1] :].reset_index(drop=True)
            starts, ends = starts[:-1], ends[:-1]
        values = both["fp"].to_numpy().view(np.uint64)
        several = np.flatnonzero(ends - starts > 1)
        left, right = [], []
        for i in several:
            group = values[starts[i] : ends[i]]
            a, b = _star(group, pivot_table(group))
            left.append(a)
            right.append(b)
        if left:
            yield pd.DataFrame(
                {"a": np.concatenate(left).view(np.int64), "b": np.concatenate(right).view(np.int64)}
            )


def _and_end(frames):
    yield from frames
    yield None


def _masks(bits: list[int]) -> list[int]:
    """Masks of all choices of SAME_BLOCKS from BLOCKS even blocks of these bits."""
    blocks = [int(sum(1 << b for b in part)) for part in np.array_split(np.array(bits, object), BLOCKS)]
    return [sum(chosen) for chosen in combinations(blocks, SAME_BLOCKS)]


WIDE = _masks(list(range(BITS)))
NARROW = [
    [wide | m for m in _masks([b for b in range(BITS) if not wide >> b & 1])] for wide in WIDE
]


def links(nodes: DataFrame) -> DataFrame:
    """``(a, b)`` whose components are those of all pairs within ``MAX_BITS``.

    ``nodes`` has distinct fingerprints ``fp``. Two changed bits leave at least
    three of five blocks as they are, so linked fingerprints meet under one of
    ten keys. A key with more than ``GROUP_ROWS`` fingerprints is split by
    applying the same rule to its free bits: under such a finer key at most
    2^11 different fingerprints exist, so no group outgrows a task, and
    no link is lost. Within a group the pivot tables decide.
    """
    wide = F.array(
        *[
            F.struct(F.lit(i).alias("part"), F.col("fp").bitwiseAND(F.lit(signed(m))).alias("key"))
            for i, m in enumerate(WIDE)
        ]
    )
    keyed = nodes.select("fp", F.explode(wide).alias("k")).select("fp", "k.part", "k.key")
    hot = (
        keyed.groupBy("part", "key")
        .count()
        .filter(F.col("count") > GROUP_ROWS)
        .select("part", "key", F.lit(True).alias("hot"))
    )
    masks = F.array(*[F.array(*[F.lit(signed(m)) for m in row]) for row in NARROW])
    fine = F.transform(
        F.element_at(masks, F.col("part") + 1),
        lambda mask, i: F.struct(
            (F.col("part") * 100 + 1 + i).cast("int").alias("part"),
            F.col("fp").bitwiseAND(mask).alias("key"),
        ),
    )
    coarse = F.array(F.struct((F.col("part") * 100).cast("int").alias("part"), F.col("key")))
    parted = (
        keyed.join(hot, ["part", "key"], "left")
        .select("fp", F.explode(F.when(F.col("hot"), fine).otherwise(coarse)).alias("k"))
        .select("k.part", "k.key", "fp")
    )
    grouped = parted.repartition("part", "key").sortWithinPartitions("part", "key", "fp")
    return grouped.mapInPandas(_group_links, "a long, b long").distinct()


def _roots(prints: DataFrame) -> DataFrame:
    """``(fp, least, root)`` of each fingerprint: its smallest doc_id, and its component's name."""
    nodes = prints.groupBy("fp").agg(F.min("doc_id").alias("least"))
    roots = components(links(nodes.select("fp")))
    return nodes.join(roots, nodes.fp == roots.node, "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``(doc_id, fingerprint, component_id)`` for every row of ``docs``.

    Rows whose fingerprints differ in at most two bits are linked; a component
    is named by its smallest doc_id. Copies share a fingerprint and are one
    node, so a group of copies of any size costs one row. NULL and empty texts
    have fingerprint 0, linked like any other. Rows with a NULL doc_id are kept;
    a component with no doc_id at all has a NULL id. Repeated rows stay repeated,
    an empty table gives an empty result, further columns are ignored.
    """
    prints = staged(fingerprints(docs), "fingerprints")
    named = _roots(prints)
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    return (
        prints.join(named.select("fp", "root").join(least, "root"), "fp")
        .select("doc_id", hex16(F.col("fp")).alias("fingerprint"), "component_id")
    )


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """``docs`` with one document of each component, the one with the smallest doc_id; all columns stay.

    A component without any doc_id keeps one of its rows; of repeated rows one
    stays. Fingerprints are computed a second time beside the rows instead of
    writing all texts once more.
    """
    prints = staged(fingerprints(docs), "fingerprints")
    kept = (
        _roots(prints)
        .groupBy("root")
        .agg(F.min(F.struct(F.col("least").isNull().alias("unnamed"), "least", "fp")).alias("k"))
        .select(F.col("k.least").alias("kept_id"), F.col("k.fp").alias("kept_fp"))
    )
    name = fresh(docs, "fp")

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("text").cast(pa.large_binary())
            found = np.fromiter((fingerprint(v.as_py() or b"") for v in column), np.uint64, len(batch))
            columns = [*batch.columns, pa.array(found.view(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, name])

    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.LongType())])
    marked = docs.mapInArrow(mark, schema)
    same = marked["doc_id"].cast("long").eqNullSafe(kept["kept_id"]) & (marked[name] == kept["kept_fp"])
    return marked.join(kept, same, "left_semi").dropDuplicates(["doc_id", name]).select(*docs.columns)


def _multipliers(n: int, salt: str) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(f"{salt}{i}".encode(), SEED) | 1 for i in range(n)], np.uint64)


MULTIPLY, ADD = (_multipliers(BANDS * BAND_ROWS, salt) for salt in ("multiply", "add"))


def signature(hashes: np.ndarray) -> np.ndarray:
    """The MinHash signature of a set of hashes."""
    least = np.full(len(MULTIPLY), np.iinfo(np.uint64).max)
    for start in range(0, len(hashes), SHINGLES_AT_ONCE):
        part = hashes[start : start + SHINGLES_AT_ONCE]
        np.minimum(least, (part[:, None] * MULTIPLY + ADD).min(axis=0), out=least)
    return least


def band_keys(least: np.ndarray) -> np.ndarray:
    """One key per band of a signature."""
    rows = least.reshape(BANDS, BAND_ROWS)
    return np.array([xxhash.xxh3_64_intdigest(row.tobytes()) for row in rows], np.uint64).view(np.int64)


def _verified(x: np.ndarray, y: np.ndarray, sets: list[bytes], similarity: float, label: np.ndarray, parent: np.ndarray) -> Iterator[np.ndarray]:
    """Labels of components that links of the pairs join, one array a join; ``parent`` follows them.

    The pairs of each ``x`` are verified at once: its shingles are marked, those of its
    partners counted. Partners of its own component need no look.
    """
    places, at = np.unique(np.concatenate([x, y]), return_inverse=True)
    sizes = np.array([len(sets[i]) // 8 for i in places])
    begun = np.append(0, sizes.cumsum())
    _, code = np.unique(np.frombuffer(b"".join([sets[i] for i in places]), np.int64), return_inverse=True)
    marked = np.zeros(int(code.max()) + 1, bool)
    order = np.argsort(at[: len(x)], kind="stable")
    x, y = at[: len(x)][order], at[len(x) :][order]
    label = label[places]
    for partners in np.split(y, np.flatnonzero(np.diff(x)) + 1):
        here, x = x[0], x[len(partners) :]
        mine = code[begun[here] : begun[here + 1]]
        marked[mine] = True
        for start in range(0, len(partners), PARTNERS_AT_ONCE):
            others = partners[start : start + PARTNERS_AT_ONCE]
            others = others[_ends(label[others], parent) != _ends(label[here : here + 1], parent)]
            if not len(others):
                continue
            found = marked[np.concatenate([code[begun[i] : begun[i + 1]] for i in others])]
            common = np.add.reduceat(found, np.append(0, sizes[others].cumsum()[:-1]), dtype=np.int64)
            linked = common * (1 + similarity) >= similarity * (len(mine) + sizes[others]) - 1e-9
            joined = np.unique(_ends(label[np.append(others[linked], here)], parent))
            if len(joined) > 1:
                parent[joined] = joined[0]
                yield joined
        marked[mine] = False


def _ends(labels: np.ndarray, parent: np.ndarray) -> np.ndarray:
    """The labels that stand for the components of these."""
    ends = parent[labels]
    while not np.array_equal(parent[ends], ends):
        ends = parent[ends]
    parent[labels] = ends
    return ends


def _meetings(frames: Iterator[pd.DataFrame], radius: int, similarity: float, between: bool) -> Iterator[pd.DataFrame]:
    """``(a, b)``: links between roots, at most one a row, that join what the verified links within groups join.

    Rows of a group are sorted by their distance to the first pivot, so partners
    lie within the radius of it. A pair whose distances to any of the other
    pivots differ by more cannot be near and is discarded; bits, a second fingerprint,
    sizes and signatures thin out the rest; the shingles decide. With ``between`` only
    rows of different cells are compared.
    """
    rest = None
    for frame in _and_end(frames):
        both = rest if frame is None else frame if rest is None else pd.concat([rest, frame], ignore_index=True)
        if both is None or not len(both):
            continue
        names = both[["part", "key", "cell"]].to_numpy()
        cuts = np.flatnonzero((names[1:] != names[:-1]).any(axis=1)) + 1
        if frame is not None:  # the last group may go on in the next batch
            start = cuts[-1] if len(cuts) else 0
            rest = both.iloc[start:].reset_index(drop=True)
            both, cuts = both.iloc[:start], cuts[:-1]
            if not len(both):
                continue
        ends = np.repeat(np.append(cuts, len(both)), np.diff(np.concatenate([[0], cuts, [len(both)]])))
        fp, second = both["fp"].to_numpy().view(np.uint64), both["second"].to_numpy().view(np.uint64)
        roots, label = np.unique(both["root"].to_numpy(), return_inverse=True)
        size, table, first, own = both["n"].to_numpy(), pivot_table(fp), both["pivot"].to_numpy(), both["own"].to_numpy()
        rows = np.frombuffer(b"".join(both["rows"]), np.uint8).reshape(len(both), -1)
        sets, parent = both["shingles"].tolist(), np.arange(len(roots))
        held, n_held, left, right = [], 0, [], []

        def verify():
            x, y = (np.concatenate([h[i] for h in held]) for i in range(2))
            for joined in _verified(x, y, sets, similarity, label, parent):
                left.append(np.repeat(roots[joined[:1]], len(joined) - 1))
                right.append(roots[joined[1:]])

        at, step = np.arange(len(both)), 1
        while True:
            at = at[at + step < ends[at]]
            at = at[first[at + step] - first[at] <= radius]
            if not len(at):
                break
            a, b = at, at + step
            keep = parent[label[a]] != parent[label[b]]
            if between:
                keep &= own[a] != own[b]
            keep &= np.minimum(size[a], size[b]) >= similarity * np.maximum(size[a], size[b]) - 1e-9
            a, b = a[keep], b[keep]
            keep = (np.abs(table[a] - table[b]) <= radius).all(axis=1)
            a, b = a[keep], b[keep]
            apart = np.bitwise_count(fp[a] ^ fp[b])
            keep = (apart <= radius) & (apart + np.bitwise_count(second[a] ^ second[b]) <= 2 * radius)
            a, b = a[keep], b[keep]
            keep = (rows[a] == rows[b]).sum(axis=1) >= LEAST_ROWS_EQUAL
            if keep.any():
                held.append((a[keep], b[keep]))
                n_held += int(keep.sum())
            if n_held > PAIRS_HELD:
                verify()
                held, n_held = [], 0
                _ends(np.arange(len(parent)), parent)
            step += 1
        if held:
            verify()
        if left:
            yield pd.DataFrame({"a": np.concatenate(left), "b": np.concatenate(right)})


def _memberships(nodes: DataFrame) -> DataFrame:
    """``(node, part, key, cells, own)`` of nodes that share a band key with another node.

    A key of more than ``GROUP_ROWS`` nodes or ``GROUP_SHINGLES`` shingles is dealt by hash
    over cells of that size. Of keys with the same nodes one is kept: near copies
    share many bands, and one meeting is enough.
    """
    keyed = nodes.select("node", "n", F.posexplode("bands").alias("part", "key"))
    cells = F.greatest(F.ceil(F.col("rows") / GROUP_ROWS), F.ceil(F.col("shingles") / GROUP_SHINGLES))
    shared = (
        keyed.groupBy("part", "key")
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.sum("n").alias("shingles"),
            *(F.bit_xor(F.xxhash64("node", F.lit(i))).alias(f"same{i}") for i in range(2)),
        )
        .filter("rows > 1")
        .groupBy("rows", "shingles", "same0", "same1")
        .agg(F.min(F.struct("part", "key")).alias("k"))
        .select("k.part", "k.key", cells.cast("long").alias("cells"))
    )
    return staged(
        keyed.drop("n").join(shared, ["part", "key"]).withColumn("own", F.pmod(F.xxhash64("node"), F.col("cells"))),
        "similar-memberships",
    )


def _links(members: DataFrame, state: DataFrame, apart: int, radius: int, similarity: float) -> DataFrame:
    """``(a, b)``: verified links between components, by their roots, fewer than memberships.

    Cells meet themselves, or the cell ``apart`` from them; a key whose nodes all
    belong to one component is done.
    """
    own, n_cells = F.col("own"), F.col("cells")
    active, cell = members, own
    if apart:
        active = members.filter(n_cells >= 2 * apart)
        ends = active.join(state.select("node", "root"), "node").groupBy("part", "key")
        several = ends.agg(F.min("root").alias("x"), F.max("root").alias("y")).filter("x <> y")
        active = active.join(several.select("part", "key"), ["part", "key"], "left_semi")
        # In a ring of two cells both neighbours are the same cell.
        meeting = F.when(n_cells == 2 * apart, F.array(F.pmod(own, F.lit(apart)))).otherwise(F.array(own, F.pmod(own - apart, n_cells)))
        cell = F.explode(meeting)
    pivot = F.bit_count(F.col("fp").bitwiseXOR(F.lit(signed(int(PIVOTS[0])))))
    columns = ["own", "fp", "second", "n", "rows", "root", "shingles"]
    grouped = (
        active.join(state, "node")
        .select("part", "key", cell.alias("cell"), *columns, pivot.alias("pivot"))
        .repartition("part", "key", "cell")
        .sortWithinPartitions("part", "key", "cell", "pivot")
    )
    found = grouped.mapInPandas(lambda frames: _meetings(frames, radius, similarity, apart > 0), "a long, b long")
    return staged(found, "similar-links")


WORDS_HASH = "h1 long, h2 long"


def _words_hash(words: list[bytes]) -> tuple[int, int]:
    """128 bits of a text's words, as two signed longs."""
    whole = xxhash.xxh3_128_intdigest(b" ".join(words))
    return signed(whole >> 64), signed(whole & (1 << 64) - 1)


def _marked(docs: DataFrame, names: tuple[str, str]) -> DataFrame:
    """``docs`` and the hash of each text's words in two columns."""

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("text").cast(pa.large_binary())
            found = [_words_hash((v.as_py() or b"").lower().split()) for v in column]
            added = [pa.array([f[n] for f in found], pa.int64()) for n in (0, 1)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], [*batch.schema.names, *names])

    fields = [T.StructField(name, T.LongType()) for name in names]
    return docs.mapInArrow(mark, T.StructType([*docs.schema.fields, *fields]))


def _sets(docs: DataFrame, wanted: DataFrame, shingle: int) -> DataFrame:
    """``(node, shingles)`` of the wanted nodes, from one of the texts of each: eight bytes a shingle."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, rows in byte_rows(batches):
            sets = [np.unique(shingle_hashes(r.lower().split(), shingle)).tobytes() for r in rows]
            yield pa.RecordBatch.from_arrays([keys, pa.array(sets, pa.binary())], ["node", "shingles"])

    texts_only = docs.select(F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    one_each = (
        _marked(texts_only, ("h1", "h2")).join(wanted, ["h1", "h2"]).groupBy("node").agg(F.first("text").alias("text"))
    )
    return one_each.mapInArrow(cut, "node long, shingles binary")


def drop_similar(
    docs: DataFrame,
    shingle: int = 5,
    radius: int = SIMILAR_BITS,
    similarity: float = 0.8,
) -> DataFrame:
    """``docs`` with one document of each group of similar ones, the one with the smallest doc_id.

    Documents are linked whose sets of ``shingle``-word shingles have a Jaccard
    similarity of at least ``similarity``; links are looked for among those that
    agree on a band of their MinHash signatures and whose fingerprints over such
    shingles differ in at most ``radius`` bits. Texts with the same words are one
    node, so are NULL and empty texts. All columns stay, whatever their names.

    Nodes that share a key meet in one task with their shingles, where pairs are compared
    and verified; only links that join components leave it, fewer than rows come in.
    Large keys are dealt over cells, which meet in turn; what is one component by
    then is not compared again. The shingles of each node with a shared key are written once.

    A group without any doc_id keeps one of its rows; of repeated rows one stays.
    A very long text is held whole by its task. An empty table gives an empty one.
    """

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, rows in byte_rows(batches):
            names, prints, seconds, sizes, rows_of, bands = [], [], [], [], [], []
            for row in rows:
                words = row.lower().split()
                hashes = shingle_hashes(words, shingle)
                names.append(_words_hash(words))
                prints.append(majority(hashes))
                mixed = (hashes ^ (hashes >> np.uint64(32))) * np.uint64(0xC4CEB9FE1A85EC53)
                seconds.append(majority(mixed ^ (mixed >> np.uint64(29))))
                different = np.unique(hashes)
                sizes.append(len(different))
                least = signature(different)
                rows_of.append((least >> np.uint64(40)).astype(np.uint8).tobytes())
                # Texts without words are one node and meet nobody.
                bands.append(band_keys(least) if words else np.zeros(0, np.int64))
            yield pa.RecordBatch.from_arrays(
                [
                    keys,
                    *(pa.array([name[n] for name in names], pa.int64()) for n in (0, 1)),
                    pa.array(np.array(prints, np.uint64).view(np.int64)),
                    pa.array(np.array(seconds, np.uint64).view(np.int64)),
                    pa.array(sizes, pa.int32()),
                    pa.array(rows_of, pa.binary()),
                    pa.array(bands, pa.list_(pa.int64())),
                ],
                ["doc_id", "h1", "h2", "fp", "second", "n", "rows", "bands"],
            )

    prints = texts(docs).mapInArrow(
        compute, f"doc_id long, {WORDS_HASH}, fp long, second long, n int, rows binary, bands array<long>"
    )
    grouped = prints.groupBy("h1", "h2").agg(
        *(F.first(c).alias(c) for c in ("fp", "second", "n", "rows", "bands")), F.min("doc_id").alias("least")
    )
    nodes = staged(grouped.withColumn("node", F.monotonically_increasing_id()), "similar-nodes")
    roots = _linked(docs, nodes, shingle, radius, similarity)
    named = nodes.select("node", "h1", "h2", "least")
    if roots is not None:
        named = named.join(roots.withColumnRenamed("node", "linked"), F.col("node") == F.col("linked"), "left")
    root = F.col("node") if roots is None else F.coalesce("root", "node")
    kept = (
        named.groupBy(root.alias("root"))
        .agg(F.min(F.struct(F.col("least").isNull().alias("unnamed"), "least", "h1", "h2")).alias("k"))
        .select(F.col("k.least").alias("kept_id"), F.col("k.h1").alias("kept_h1"), F.col("k.h2").alias("kept_h2"))
    )
    names = fresh(docs, "h1"), fresh(docs, "h2")
    marked = _marked(docs, names)
    same = (
        marked["doc_id"].cast("long").eqNullSafe(kept["kept_id"])
        & (marked[names[0]] == kept["kept_h1"])
        & (marked[names[1]] == kept["kept_h2"])
    )
    return marked.join(kept, same, "left_semi").dropDuplicates(["doc_id", *names]).select(*docs.columns)


def _linked(docs: DataFrame, nodes: DataFrame, shingle: int, radius: int, similarity: float) -> DataFrame | None:
    """``(node, root)`` of the nodes that may have links; None without any."""
    members = _memberships(nodes)
    cells = members.agg(F.max("cells")).first()[0] or 0
    if not cells:
        return None
    wanted = nodes.join(members.select("node").distinct(), "node", "left_semi")
    sets = _sets(docs, wanted.select("node", "h1", "h2"), shingle)
    state = staged(wanted.select("node", "fp", "second", "n", "rows").join(sets, "node"), "similar-state")
    roots = state.select("node", F.col("node").alias("root"))
    # Cells lie in a ring: those half a ring apart are the farthest.
    for apart in range(cells // 2 + 1):
        found = _links(members, state.join(roots, "node"), apart, radius, similarity)
        if found.isEmpty():
            continue
        # Links between components, by their names.
        joined = components(found).select(F.col("node").alias("root"), F.col("root").alias("new_root"))
        merged = roots.join(joined, "root", "left").select("node", F.coalesce("new_root", "root").alias("root"))
        roots = staged(merged, "similar-roots")
    return roots
