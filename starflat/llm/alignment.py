"""Token alignment between two tokenizers through windows between shared word starts."""

from __future__ import annotations

import gc
import json
import os
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starflat.llm.common import byte_rows, staged, texts

# Windows whose alignment a task remembers (long ones count more): the last so many and, of what
# came before, what was used again.
KEPT = 100_000
# Text handled at a time.
BATCH_BYTES = 500_000
# At most so many pairs are sent to every task; the others are joined by a shuffle.
COMMON_PAIRS = 1 << 17
MARK = "\u2581"
# Fixed value: how byte-level vocabularies split texts into words.
WORDS = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


# -- the two tokenizers ------------------------------------------------------------


def byte_alphabet() -> dict[str, int]:
    """Characters that stand for bytes in a byte-level vocabulary: printable Latin-1
    characters stand for themselves, the other bytes follow from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(others)}


class ByteLevel:
    """A byte-level tokenizer file; special tokens in texts are plain text.

    Where ids follow the order of merges, as they do in the public file, the lowest
    id that a merge can make is the next merge: the ids are ranks, and the
    rank encoder gives the same ids in a fifth of the time.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one core a task
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        letters = byte_alphabet()
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        self.bytes_of = [b""] * (max(self.tokenizer.get_vocab().values()) + 1)
        for entry, token in vocabulary.items():
            known = all(letter in letters for letter in entry)
            self.bytes_of[token] = bytes(letters[x] for x in entry) if known else entry.encode()
        self.ranked = self._ranked(json.loads(self.tokenizer.to_str()))

    def _ranked(self, settings: dict):
        splitter, model = settings["pre_tokenizer"] or {}, settings["model"]
        merges = ["".join(m) if isinstance(m, list) else m.replace(" ", "") for m in model.get("merges", ())]
        in_order = [model["vocab"].get(m) for m in merges] == list(range(256, 256 + len(merges)))
        if not in_order or settings["normalizer"] or splitter.get("type") != "ByteLevel" or not splitter.get("use_regex"):
            return None
        import tiktoken

        ranks = {self.bytes_of[i]: i for i in range(256 + len(merges))}
        return tiktoken.Encoding("ranks", pat_str=WORDS, mergeable_ranks=ranks, special_tokens={})

    def encode(self, rows: list[str]) -> list[list[int]]:
        rows = [f" {row}" for row in rows]
        if self.ranked is not None:
            return [self.ranked.encode_ordinary(row) for row in rows]
        return [one.ids for one in self.tokenizer.encode_batch_fast(rows, add_special_tokens=False)]


class Pieces:
    """A sentencepiece model with byte fallback, which puts a space before the text."""

    def __init__(self, path: str) -> None:
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.bytes_of = [
            bytes([int(piece[3:5], 16)]) if self.model.is_byte(i) else piece.replace(MARK, " ").encode()
            for i, piece in enumerate(pieces)
        ]

    def encode(self, rows: list[str]) -> list[list[int]]:
        return self.model.encode(rows, num_threads=1)


class _Side:
    """Lengths and first bytes of a tokenizer's tokens."""

    def __init__(self, tokenizer) -> None:
        self.tokenizer, self.bytes_of = tokenizer, tokenizer.bytes_of
        self.lengths = np.array([len(b) for b in self.bytes_of], np.int64)
        self.spaced = np.array([b[:1] == b" " for b in self.bytes_of])
        # Decimal ids, each with the mark that can follow.
        self.decimals = np.array([f"{i}{mark}" for mark in ",|;" for i in range(len(self.bytes_of))], object)

    def spells(self, ids: list[int], whole: bytes) -> bool:
        bytes_of = self.bytes_of
        return b"".join([bytes_of[i] for i in ids]) == whole


# -- windows -----------------------------------------------------------------------


# The ids of either side, four bytes each, with a mark between that is no id.
Window = bytes
BETWEEN = b"\xff" * 4


def cut_windows(raw_a: bytes, raw_b: bytes, left: _Side, right: _Side) -> list[Window]:
    """The windows of a text: they end at byte offsets at which both sides end a token and
    both go on with a token that starts with a space, and at the end."""
    a, b = np.frombuffer(raw_a, np.int32), np.frombuffer(raw_b, np.int32)
    marked_a, marked_b = np.flatnonzero(left.spaced[a[1:]]), np.flatnonzero(right.spaced[b[1:]])
    ends_a, ends_b = left.lengths[a].cumsum()[marked_a], right.lengths[b].cumsum()[marked_b]
    at = np.searchsorted(ends_b, ends_a)
    same = np.flatnonzero(np.append(ends_b, -1)[at] == ends_a)
    to_a = [0, *(4 * marked_a[same] + 4).tolist(), len(raw_a)]
    to_b = [0, *(4 * marked_b[at[same]] + 4).tolist(), len(raw_b)]
    return [raw_a[i:j] + BETWEEN + raw_b[k:m] for i, j, k, m in zip(to_a, to_a[1:], to_b, to_b[1:])]


class _Memory:
    """Alignments of windows in two generations: what the newer one has not used again is forgotten in time."""

    def __init__(self, limit: int) -> None:
        self.limit, self.size, self.new, self.old = limit, 0, {}, {}

    def unknown(self, texts: list[list[Window]]) -> list[Window]:
        """Windows not seen yet; all others can be read from ``new`` until the next call."""
        if self.size > self.limit:
            self.new, self.old, self.size = {}, self.new, 0
        new, missing = self.new, []
        for window in {w for windows in texts for w in windows if w not in new}:
            value = self.old.get(window)
            if value is None:
                missing.append(window)
            else:
                self.put(window, value)
        return missing

    def put(self, window: Window, value) -> None:
        self.new[window] = value
        self.size += 1 + len(window) // 256


def align_windows(windows: list[Window], left: _Side, right: _Side) -> list[tuple[str, bytes, int]]:
    """For each window its groups as text, its linked pairs as longs, and how many groups it has.

    All windows are put one after another: their ends are shared ends. Between two
    neighbouring token ends of either side lies one token of each, so every such
    stretch is one link; where both sides end, a group ends.
    """
    ids = np.frombuffer(b"".join([w + BETWEEN for w in windows]), np.int32)
    marks = np.flatnonzero(ids < 0)
    side = np.zeros(len(ids), np.int8)
    side[marks] = 1
    odd = side.cumsum() % 2 == 1
    a, b = ids[~odd & (ids >= 0)], ids[odd & (ids >= 0)]
    ends_a, ends_b = left.lengths[a].cumsum(), right.lengths[b].cumsum()
    ends = np.union1d(ends_a, ends_b)
    pairs = (a[np.searchsorted(ends_a, ends)].astype(np.int64) << 32) | b[np.searchsorted(ends_b, ends)]
    shared = np.intersect1d(ends_a, ends_b, assume_unique=True)
    # Groups before each token, and the place of each token in the text: a group's A ids, then its B ids.
    group_a, group_b = np.searchsorted(shared, ends_a), np.searchsorted(shared, ends_b)
    last_a, last_b = shared[group_a] == ends_a, shared[group_b] == ends_b
    begun_a, begun_b = np.searchsorted(group_a, np.arange(len(shared) + 1)), np.searchsorted(group_b, np.arange(len(shared) + 1))
    words = np.empty(len(a) + len(b), object)
    n_a, n_b = len(left.bytes_of), len(right.bytes_of)
    words[np.arange(len(a)) + begun_b[group_a]] = left.decimals[a + n_a * last_a]
    words[np.arange(len(b)) + begun_a[group_b + 1]] = right.decimals[b + n_b * 2 * last_b]
    words = words.tolist()
    sizes = (np.diff(marks, prepend=-1) - 1).reshape(-1, 2)
    stops = ends_a[sizes[:, 0].cumsum() - 1]
    links, groups = np.searchsorted(ends, stops) + 1, np.searchsorted(shared, stops) + 1
    raw, found, at, link, group = pairs.tobytes(), [], 0, 0, 0
    for stop, to, upto in zip(sizes.sum(axis=1).cumsum().tolist(), links.tolist(), groups.tolist()):
        found.append(("".join(words[at:stop])[:-1], raw[8 * link : 8 * to], upto - group))
        at, link, group = stop, to, upto
    return found


def _aligner(byte_file: str, piece_file: str):
    """A function from texts (UTF-8) to one result a text."""
    left, right = _Side(ByteLevel(byte_file)), _Side(Pieces(piece_file))
    memory = _Memory(KEPT)

    def cut(row: bytes, a: list[int], b: list[int]) -> list[Window]:
        whole = b" " + row
        # The rank encoder splits the text's own bytes, so its tokens spell them.
        if not row or not (left.tokenizer.ranked or left.spells(a, whole)) or not right.spells(b, whole):
            return []
        return cut_windows(array("i", a).tobytes(), array("i", b).tobytes(), left, right)

    def one(a: list[int], b: list[int], windows: list[Window]):
        new = memory.new
        parts = [new[w] for w in windows]
        text = ";".join([part[0] for part in parts])
        links = np.frombuffer(b"".join([part[1] for part in parts]), np.int64)
        pairs, uses = np.unique(links, return_counts=True)
        return len(a), len(b), sum([part[2] for part in parts]), len(links), text, pairs, uses

    def many(rows: list[bytes]):
        # What is no UTF-8 is replaced; its tokens spell the replacement, not the text.
        plain = [row.decode("utf-8", "replace") for row in rows]
        ids = list(zip(left.tokenizer.encode(plain), right.tokenizer.encode(plain)))
        windows = [cut(row, a, b) for row, (a, b) in zip(rows, ids)]
        unseen = memory.unknown(windows)
        for window, found in zip(unseen, align_windows(unseen, left, right) if unseen else ()):
            memory.put(window, found)
        for (a, b), mine in zip(ids, windows):
            yield one(a, b, mine) if mine else None

    return many


def _chunks(rows: Iterator[bytes]) -> Iterator[list[bytes]]:
    """Rows in order, ``BATCH_BYTES`` or one row at a time."""
    held, size = [], 0
    for row in rows:
        if held and size + len(row) > BATCH_BYTES:
            yield held
            held, size = [], 0
        held.append(row)
        size += len(row)
    if held:
        yield held


def alignments(docs: DataFrame, byte_file: str, piece_file: str) -> DataFrame:
    """One row per document: ``doc_id, n_a, n_b, n_groups, n_links, groups, pairs, uses``.

    ``groups`` is the text ``a1,a2|b1;a3|b2,b3`` of the aligned token ids, ``pairs``
    the different linked pairs ``a << 32 | b`` and ``uses`` how often each occurs.
    Both tokenizers give the ids of the whole text first. Byte offsets where both end a
    token before one that starts with a space cut the ids into windows, a word
    or a few words each; a task remembers the alignment of each window by its ids.

    NULL and empty texts, and texts that the tokens of a side do not spell, have
    zeros, an empty ``groups`` and no pairs. Rows with NULL or repeated ids are
    rows of their own; columns other than ``doc_id`` and ``text`` do not matter;
    an empty table gives no rows. A very long text is held whole by its task.
    """

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Millions of small objects without cycles: the collector would look at them again and again.
        gc.disable()
        try:
            yield from aligned(batches)
        finally:
            gc.enable()

    def aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        many = _aligner(byte_file, piece_file)
        for keys, rows in byte_rows(batches):
            begun = 0
            for chunk in _chunks(rows):
                found = [one or (0, 0, 0, 0, "", (), ()) for one in many(chunk)]
                counts = zip(*(one[:4] for one in found))
                lists = [
                    pa.ListArray.from_arrays(
                        pa.array(np.cumsum([0, *(len(one[n]) for one in found)]), pa.int32()),
                        pa.array(np.concatenate([np.asarray(one[n], np.int64) for one in found])),
                    )
                    for n in (5, 6)
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        keys.slice(begun, len(chunk)),
                        *(pa.array(c, pa.int64()) for c in counts),
                        pa.array([one[4] for one in found], pa.string()),
                        *lists,
                    ],
                    ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "pairs", "uses"],
                )
                begun += len(chunk)

    return texts(docs).mapInArrow(
        align,
        "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string,"
        " pairs array<long>, uses array<long>",
    )


# -- counts over the corpus --------------------------------------------------------


def pair_counts(rows: DataFrame) -> DataFrame:
    """``(pair, a_id, b_id, docs, best)``: how many documents hold a pair linked, and whether
    that is the most that any pair of its A id has."""
    counted = rows.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("docs"))
    a_id = F.shiftright("pair", 32).cast("int")
    split = counted.select("pair", a_id.alias("a_id"), F.col("pair").bitwiseAND(0xFFFFFFFF).cast("int").alias("b_id"), "docs")
    # An id has at most as many pairs as the other vocabulary has tokens, all aggregated.
    most = split.groupBy("a_id").agg(F.max("docs").alias("most"))
    return split.join(most, "a_id").select("pair", "a_id", "b_id", "docs", (F.col("docs") == F.col("most")).alias("best"))


def score(rows: DataFrame, counts: DataFrame, common_pairs: int = COMMON_PAIRS) -> DataFrame:
    """``(row, n_best, count_sum)`` for each row of ``rows`` that has links.

    Pairs that at least 1 / ``common_pairs`` of all incidences of documents and
    pairs belong to number at most ``common_pairs``: those are sent to every
    task, so that a pair in every document needs no shuffle. All others are
    joined by the pair; none of them is hot.
    """
    table = counts.select("pair", "docs", "best")
    incidences, pairs = counts.agg(F.sum("docs"), F.count(F.lit(1))).first()
    is_common = F.lit(pairs <= common_pairs) | (F.col("docs") * common_pairs >= F.lit(incidences or 0))
    uses = rows.select("row", F.explode(F.arrays_zip("pairs", "uses")).alias("u")).select(
        "row", F.col("u.pairs").alias("pair"), F.col("u.uses").alias("n")
    )
    sums = [
        F.sum(F.when(F.col("best"), F.col("n")).otherwise(0)).alias("n_best"),
        F.sum(F.col("n") * F.col("docs")).alias("count_sum"),
    ]
    common = F.broadcast(table.filter(is_common))
    found = uses.join(common, "pair").groupBy("row").agg(*sums)
    if pairs > common_pairs:
        rare = uses.join(common, "pair", "left_anti").join(table.filter(~is_common), "pair")
        found = found.unionByName(rare.groupBy("row").agg(*sums))
        found = found.groupBy("row").agg(*(F.sum(c).alias(c) for c in ("n_best", "count_sum")))
    return found


def align(docs: DataFrame, byte_file: str, piece_file: str) -> tuple[DataFrame, DataFrame]:
    """The stored rows of :func:`alignments` with a ``row`` number, and their :func:`pair_counts`."""
    rows = staged(
        alignments(docs, byte_file, piece_file).withColumn("row", F.monotonically_increasing_id()), "alignments"
    )
    return rows, staged(pair_counts(rows), "pairs")


def digest(rows: DataFrame, counts: DataFrame) -> DataFrame:
    """One row per document: its counts, the hash of its groups and its links' counts in the corpus.

    Documents without tokens have zeros and an empty ``groups_sha256``. Ties
    for the highest count are all best.
    """
    hashed = F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise("")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    plain = rows.select("row", "doc_id", "n_a", "n_b", "n_groups", "n_links", hashed.alias("groups_sha256"))
    return plain.join(score(rows, counts), "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", zero("n_best"), zero("count_sum"), "groups_sha256"
    )

