"""Benchmark passages in documents, also edited ones, by CGK embedding and bit sampling."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starflat.llm.common import byte_rows, fresh, staged, texts

SIMILARITY = 0.8
MIN_WORDS = 5
# Windows of one size serve items up to so many times shorter.
CLASS_RATIO = 1.15
# Repetitions of the embedding, and positions sampled in each: a pair whose
# embeddings agree in half of their places meets with 1 - (1 - 1/4)^24 > 0.998.
REPEATS, SAMPLED = 24, 2
SEED = 20240611
# The filter has at least 2^20 places and 16 a known run; beyond 2^26 it is fuller, which
# costs time but loses nothing.
FILTER_BITS, MOST_BITS, PLACES_A_RUN = 20, 26, 16
BITMAP_BYTES = 4096  # of the bitmap functions
WINDOWS_AT_ONCE = 1 << 15
# Runs of words that the filter knows; the longest that any similar passage must share.
GRAMS = (3, 2)
REGION_ITEMS = 4
REGIONS_A_TASK = 1000

WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def words_of(text: bytes) -> list[bytes]:
    """Lower-case runs of letters and digits; beyond ASCII everything counts as a letter."""
    return WORD.findall(text.decode("utf-8", "replace").lower().encode())


def _codes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(crc32, words), np.uint32, len(words))


def filter_bits(runs: int) -> int:
    """The filter's size for so many known runs, as a power of two."""
    return min(MOST_BITS, max(FILTER_BITS, (PLACES_A_RUN * runs - 1).bit_length()))


def _gram_places(codes: np.ndarray, size: int, bits: int) -> np.ndarray:
    """Places of the runs of ``size`` words in a filter of ``2^bits``."""
    n = len(codes) - size + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    mixed = np.full(n, size, np.uint64)
    for i in range(size):
        mixed = (mixed ^ codes[i : i + n]) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(31)
    return (mixed >> np.uint64(64 - bits)).astype(np.int64)


def allowed(length: int) -> int:
    """Edits that leave an item of so many words similar enough."""
    return int((1 - SIMILARITY) * length + 1e-9)


@dataclass(frozen=True)
class Kind:
    """Items of ``least`` to ``most`` words, looked for through runs of ``gram`` words."""

    least: int
    most: int
    gram: int
    enough: int  # runs that a similar passage has in common with any of these items


def kinds_of(lengths: list[int]) -> list[Kind]:
    """Classes of item lengths; an edit breaks at most as many runs as a run has words."""
    classes: list[list[int]] = []
    for length in sorted(set(lengths)):
        if classes and length <= classes[-1][0] * CLASS_RATIO:
            classes[-1].append(length)
        else:
            classes.append([length])
    found = []
    for group in classes:
        enough = {q: min(n - q + 1 - q * allowed(n) for n in group) for q in GRAMS}
        gram = next((q for q in GRAMS if enough[q] >= 1), GRAMS[-1])
        found.append(Kind(group[0], group[-1], gram, max(1, enough[gram])))
    return found


def _counts(known: np.ndarray, window: int, gram: int, words: int) -> np.ndarray:
    """Known runs in the window that starts at each word, cut at the end."""
    sums = np.concatenate([[0], np.cumsum(known)])
    starts = np.minimum(np.arange(words), len(known))
    return sums[np.minimum(starts + max(window - gram + 1, 0), len(known))] - sums[starts]


def _known(codes: np.ndarray, bits: np.ndarray, kinds: list[Kind]) -> dict[int, np.ndarray]:
    size = len(bits).bit_length() - 1
    return {q: bits[_gram_places(codes, q, size)] for q in {k.gram for k in kinds}}


def _regions(known: dict[int, np.ndarray], words: int, kinds: list[Kind]) -> list[tuple[int, int]]:
    """Word ranges that hold all windows with enough known runs, long ones cut with overlap."""
    n = words
    widest = max(k.most + allowed(k.most) for k in kinds)
    edges = np.zeros(n + 1, np.int64)
    for gram, runs in known.items():
        mine = [k for k in kinds if k.gram == gram]
        if _counts(runs, widest, gram, n).max() < min(k.enough for k in mine):
            continue
        for kind in mine:
            window = kind.most + allowed(kind.most)
            starts = np.flatnonzero(_counts(runs, window, gram, n) >= kind.enough)
            np.add.at(edges, starts, 1)
            np.add.at(edges, np.minimum(starts + window, n), -1)
    covered = np.cumsum(edges[:-1]) > 0
    turns = np.flatnonzero(np.diff(np.concatenate([[0], covered.astype(np.int8), [0]])))
    found = []
    longest, step = REGION_ITEMS * widest, (REGION_ITEMS - 1) * widest
    for start, end in zip(turns[::2].tolist(), turns[1::2].tolist()):
        while end - start > longest:
            found.append((start, start + longest))
            start += step
        found.append((start, end))
    return found


def walk(codes: np.ndarray, starts: np.ndarray, width: int, repeat: int, places: np.ndarray) -> np.ndarray:
    """Some places of the CGK walks over the windows of ``width`` codes at ``starts``, 0 beyond them.

    Each step writes the word the walk stands at and goes on by a random bit
    that depends on the step and on the word. Where two windows differ by an edit
    their walks part, and soon fall into step again by chance. A word's bits for
    64 steps come from one hash of it, and all windows over it share them.
    ``codes`` ends with room for one more step than the highest place.
    """
    out = np.zeros((len(starts), len(places)), np.uint32)
    here, at = np.arange(len(codes), dtype=np.int32), starts.astype(np.int32)
    ends = at + np.int32(width)
    for step in range(int(places.max()) + 1):
        if step % 64 == 0:
            salt = np.random.default_rng([SEED, repeat, step]).integers(1, 1 << 63, dtype=np.uint64)
            bits = (codes.astype(np.uint64) ^ salt) * np.uint64(0xFF51AFD7ED558CCD)
            bits = (bits ^ (bits >> np.uint64(32))) * np.uint64(0xC4CEB9FE1A85EC53)
            bits ^= bits >> np.uint64(29)
            halves = [(bits & np.uint64(0xFFFFFFFF)).astype(np.uint32), (bits >> np.uint64(32)).astype(np.uint32)]
        for column in np.flatnonzero(places == step):
            out[:, column] = np.where(at < ends, codes[np.minimum(at, ends)], 0)
        turns = (halves[step % 64 // 32] >> np.uint32(step % 32)) & np.uint32(1)
        at = (here + turns.view(np.int32)).take(at)
    return out


def embed(windows: np.ndarray, repeat: int, places: np.ndarray) -> np.ndarray:
    """:func:`walk` over rows of word codes."""
    rows, width = windows.shape
    room = np.zeros((rows, int(places.max()) + 2), np.uint32)
    codes = np.hstack([windows, room])
    return walk(codes.ravel(), np.arange(rows) * codes.shape[1], width, repeat, places)


def window_keys(codes: np.ndarray, starts: np.ndarray, number: int, kind: Kind) -> np.ndarray:
    """One key per repetition of each window of a class: sampled places of its walk."""
    keys = np.zeros((len(starts), REPEATS), np.uint64)
    for repeat in range(REPEATS):
        places = np.random.default_rng([SEED, number, repeat]).integers(0, 2 * kind.least, SAMPLED)
        walked = walk(codes, starts, kind.most, repeat, places)
        key = np.full(len(starts), number * REPEATS + repeat + 1, np.uint64)
        for symbols in walked.T:
            key = (key ^ symbols) * np.uint64(0x9E3779B97F4A7C15)
            key ^= key >> np.uint64(29)
        keys[:, repeat] = key
    return keys.view(np.int64)


def distance(item: list[bytes], region: list[bytes]) -> int:
    """Least word edits between the item and any part of the region."""
    ids = {w: i for i, w in enumerate(dict.fromkeys([*item, *region]))}
    there = np.array([ids[w] for w in region])
    along = np.arange(len(region) + 1)
    row = np.zeros(len(region) + 1, np.int64)
    for at, word in enumerate(item):
        best = np.minimum(row[:-1] + (there != ids[word]), row[1:] + 1)
        row = np.concatenate([[at + 1], best])
        row = np.minimum.accumulate(row - along) + along
    return int(row.min())


def may_be_close(item: list[bytes], region_pairs: set) -> bool:
    """Whether enough word pairs are shared: an edit takes at most two pairs of the item away."""
    pairs = set(zip(item, item[1:]))
    return len(pairs & region_pairs) >= len(pairs) - 2 * allowed(len(item))


def _starts(codes: np.ndarray, bits: np.ndarray, kinds: list[Kind]) -> Iterator[tuple[int, np.ndarray]]:
    """Where the windows of each class with enough known runs start."""
    known = _known(codes, bits, kinds)
    for number, kind in enumerate(kinds):
        counts = _counts(known[kind.gram], kind.most, kind.gram, len(codes))
        # The window is shorter than the one that decided: it may lack the last runs.
        needed = max(1, kind.enough - allowed(kind.most))
        yield number, np.flatnonzero(counts >= needed)


def _windows(codes: np.ndarray, bits: np.ndarray, kinds: list[Kind]) -> Iterator[tuple[int, np.ndarray]]:
    """The words of those windows, a part at a time."""
    for number, starts in _starts(codes, bits, kinds):
        padded = np.concatenate([codes, np.zeros(kinds[number].most, np.uint32)])
        for first in range(0, len(starts), WINDOWS_AT_ONCE):
            part = starts[first : first + WINDOWS_AT_ONCE]
            yield number, padded[part[:, None] + np.arange(kinds[number].most)]


def room_of(kind: Kind) -> int:
    """Zeros that a walk over the last window can reach."""
    return max(kind.most, 2 * kind.least) + 2


def matches(
    docs: DataFrame,
    items: DataFrame,
    item_id: str = "item_id",
    item_text: str = "text",
    key_type: str = "long",
) -> DataFrame:
    """``(doc_id, item_id, item_words, distance)`` of each document and item it holds.

    A document holds an item if some part of it equals the item's words but for
    edits (inserted, left out or other words) in at most a fifth of them.

    1. Runs of two and three words of the items set bits of a filter that grows with them.
       Windows with fewer known runs than that many edits would leave are out.
       The rest are regions; equal regions of many documents are handled once.
    2. All windows as long as the items, over the regions, are embedded by random
       walks that turn edits into few differing places. Keys of sampled places,
       ``REPEATS`` of them, are joined with those of the items.
    3. The edit distance of every pair that met is computed exactly, unless they
       share too few word pairs for it to be small enough.

    Items under ``MIN_WORDS`` words are no passages and match nothing, nor do
    NULL or empty texts. Repeated rows of an id count as one document; NULL ids
    are kept as one. Empty tables give no rows.
    """
    named = texts(items, item_id, item_text).withColumnRenamed(item_id, "item_id")

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, rows in byte_rows(batches):
            found = [words_of(r) for r in rows]
            codes = [_codes(w) for w in found]
            places = [np.unique(np.concatenate([_gram_places(c, q, 32) for q in GRAMS])) for c in codes]
            yield pa.RecordBatch.from_arrays(
                [
                    keys,
                    pa.array([b" ".join(w).decode() for w in found], pa.string()),
                    pa.array([len(w) for w in found], pa.int32()),
                    pa.array(places, pa.list_(pa.int64())),
                ],
                ["item_id", "words", "n", "places"],
            )

    schema = "item_id long, words string, n int, places array<long>"
    wanted = staged(
        named.mapInArrow(split, schema).filter(f"n >= {MIN_WORDS}"), "benchmark-items"
    )
    places = wanted.select(F.explode("places").alias("place"))
    size = filter_bits(places.distinct().count())
    # Built as bitmaps of 2^15 places each, so at most 2^MOST_BITS / 8 bytes come to the driver.
    place = F.shiftright("place", 32 - size) + 1
    bitmaps = places.groupBy(F.bitmap_bucket_number(place).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits")
    )
    packed = np.zeros((max(1, (1 << size) >> 15), BITMAP_BYTES), np.uint8)
    for row in bitmaps.collect():
        packed[row["bucket"] - 1] = np.frombuffer(row["bits"], np.uint8)
    packed = packed.ravel()
    lengths = [r["n"] for r in wanted.select("n").distinct().collect()]
    kinds = kinds_of(lengths or [MIN_WORDS])

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known_bits = np.unpackbits(packed, bitorder="little").view(bool)
        for keys, rows in byte_rows(batches):
            where, found = [], []
            for at, row in enumerate(rows):
                words = words_of(row)
                known = _known(_codes(words), known_bits, kinds)
                if any(runs.any() for runs in known.values()):
                    for start, end in _regions(known, len(words), kinds):
                        where.append(at)
                        found.append(b" ".join(words[start:end]).decode())
            yield pa.RecordBatch.from_arrays(
                [keys.take(pa.array(where, pa.int64())), pa.array(found, pa.string())],
                ["doc_id", "words"],
            )

    regions = staged(
        texts(docs, kind=key_type)
        .mapInArrow(find, f"doc_id {key_type}, words string")
        .withColumn("region", F.xxhash64("words")),
        "benchmark-regions",
    )
    different = staged(
        regions.groupBy("region").agg(F.first("words").alias("words")), "benchmark-different"
    )

    def region_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known_bits = np.unpackbits(packed, bitorder="little").view(bool)
        for keys, rows in byte_rows(batches):
            # Of each class: regions one after another, with room between, until enough windows.
            stacks: dict[int, list] = {}
            waiting = dict.fromkeys(range(len(kinds)), 0)
            for at, row in enumerate(rows):
                codes = _codes(row.split())
                for number, starts in _starts(codes, known_bits, kinds):
                    if len(starts):
                        stacks.setdefault(number, []).append((at, codes, starts))
                        waiting[number] += len(starts)
                        if waiting[number] >= WINDOWS_AT_ONCE:
                            waiting[number] = 0
                            yield keyed(keys, number, stacks.pop(number))
            for number, parts in stacks.items():
                yield keyed(keys, number, parts)

    def keyed(keys: pa.Array, number: int, parts: list) -> pa.RecordBatch:
        room = np.zeros(room_of(kinds[number]), np.uint32)
        flat = np.concatenate([x for _, codes, _ in parts for x in (codes, room)])
        begins = np.cumsum([0, *(len(codes) + len(room) for _, codes, _ in parts[:-1])])
        starts = np.concatenate([begin + s for begin, (_, _, s) in zip(begins, parts)])
        owners = np.repeat([at for at, _, _ in parts], [len(s) for _, _, s in parts])
        found = window_keys(flat, starts, number, kinds[number])
        owners, found = np.repeat(owners, REPEATS), found.ravel()
        order = np.lexsort((found, owners))
        owners, found = owners[order], found[order]
        new = np.append(True, (owners[1:] != owners[:-1]) | (found[1:] != found[:-1]))
        return pa.RecordBatch.from_arrays([keys.take(pa.array(owners[new])), pa.array(found[new])], ["region", "key"])

    def item_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, rows in byte_rows(batches):
            where, found = [], []
            for at, row in enumerate(rows):
                codes = _codes(row.split())
                number = next(i for i, k in enumerate(kinds) if k.least <= len(codes) <= k.most)
                codes = np.concatenate([codes, np.zeros(room_of(kinds[number]), np.uint32)])
                found.append(window_keys(codes, np.zeros(1, np.int64), number, kinds[number]).ravel())
                where.extend([at] * REPEATS)
            yield pa.RecordBatch.from_arrays(
                [
                    keys.take(pa.array(where, pa.int64())),
                    pa.array(np.concatenate(found) if found else [], pa.int64()),
                ],
                ["item_id", "key"],
            )

    # Regions are short rows with much work each: tasks by their number, not by their bytes.
    tasks = -(-different.count() // REGIONS_A_TASK) or 1
    of_region = different.select("region", "words").repartition(tasks).mapInArrow(region_keys, "region long, key long")
    of_item = wanted.select("item_id", "words").mapInArrow(item_keys, "item_id long, key long")
    met = of_region.join(of_item, "key").select("region", "item_id").distinct()
    pairs = (
        met.join(different, "region")
        .join(wanted.select("item_id", F.col("words").alias("item"), "n"), "item_id")
        .select("region", "item_id", "n", "words", "item")
    )

    def verify(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            kept, found = [], []
            for text, rows in frame.groupby("words", sort=False).indices.items():
                words = text.encode().split()
                pairs = set(zip(words, words[1:]))
                for row in rows:
                    item = frame["item"].iat[row].encode().split()
                    if may_be_close(item, pairs):
                        edits = distance(item, words)
                        if edits <= allowed(len(item)):
                            kept.append(row)
                            found.append(edits)
            near = frame.iloc[kept].assign(distance=found)
            yield near[["region", "item_id", "n", "distance"]]

    close = pairs.mapInPandas(verify, "region long, item_id long, n int, distance int")
    return (
        regions.select("region", "doc_id")
        .join(close, "region")
        .groupBy("doc_id", "item_id")
        .agg(F.first("n").alias("item_words"), F.min("distance").alias("distance"))
    )


def decontaminate(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``docs`` without the documents that hold an item; all columns stay.

    What a document holds depends on its text alone, so texts are told apart by
    their checksums: each row is judged by its own text, whatever its id.
    """
    name = fresh(docs, "text_md5")
    keyed = docs.withColumn(name, F.md5(F.coalesce(F.col("text").cast("string"), F.lit(""))))
    found = matches(keyed.select(F.col(name).alias("doc_id"), "text"), items, key_type="string")
    bad = found.select(F.col("doc_id").alias(name)).distinct()
    return keyed.join(bad, name, "left_anti").select(*docs.columns)
