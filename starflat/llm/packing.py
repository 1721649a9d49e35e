"""Best-fit packing of token pieces into sequences by bin completion."""

from __future__ import annotations

import heapq
import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starflat.llm.alignment import byte_alphabet
from starflat.llm.common import byte_rows, numbered, staged, texts

CAPACITY = 2048
ID_BYTES = 4
END_OF_DOCUMENT = 0
# Words whose ids a task keeps; beyond that it starts afresh.
KEPT_WORDS = 600_000
# Effort of the search below the incumbent, and of one enumeration of fillings.
SEARCH_NODES = 4_000
FILLINGS = 8
FILL_STEPS = 400
ROWS_PER_BUCKET = 50_000
MIN_BUCKETS, MAX_BUCKETS = 256, 4096


# -- pieces of tokenised documents -------------------------------------------------


# Marks the end of a run of characters; words hold no unprintable character.
RUN_END = "\0"
BEYOND_LATIN = re.compile("[^\0-\u024f]")
# Longer words are left to the tokenizer one by one.
LONG_WORD = 1000


def rank_table(settings: dict) -> dict[bytes, int]:
    """Token bytes of a byte-level vocabulary with a suffix for the end of a run, which becomes
    ``RUN_END``, and their ids."""
    letters, suffix = byte_alphabet(), settings["model"]["end_of_word_suffix"]
    table = {}
    for entry, token in settings["model"]["vocab"].items():
        body = entry.removesuffix(suffix)
        if body and all(letter in letters for letter in body):
            table[bytes(map(letters.get, body)) + RUN_END.encode() * (body != entry)] = token
    return table


def is_ranked(path: str) -> bool:
    """Whether merging by lowest id gives the ids that this tokenizer file gives.

    It does if ids follow the order of merges and every token, encoded by the merges
    alone, is one token again: were two parts put together that are no merge, then
    their token would have stayed in two parts.
    """
    from tokenizers import Tokenizer, models

    settings = json.loads(Tokenizer.from_file(path).to_str())
    model, suffix = settings["model"], settings["model"].get("end_of_word_suffix")
    merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model.get("merges", ())]
    if not suffix or any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "ignore_merges")):
        return False
    letters = byte_alphabet()
    base = [x for letter in letters for x in (letter, letter + suffix)]
    order = [model["vocab"].get(x, -1) for x in base], [model["vocab"].get("".join(m), -1) for m in merges]
    if min(order[0]) < 0 or order[1] != list(range(len(base), len(base) + len(merges))) or max(order[0]) >= len(base):
        return False
    end = "\u2581"
    plain = lambda entry: entry.removesuffix(suffix) + end * entry.endswith(suffix)
    vocabulary = {plain(entry): token for entry, token in model["vocab"].items()}
    vocabulary[end] = max(vocabulary.values()) + 1
    steps = [(letter, end) for letter in letters] + [(plain(a), plain(b)) for a, b in merges]
    known = models.BPE(vocab=vocabulary, merges=steps)
    return all(len(known.tokenize(plain("".join(m)))) == 1 for m in merges)


class _Words(dict):
    """Ids of words as UTF-8 bytes, found on first use.

    The tokenizer drops white space and never joins across it, so a text's ids
    are those of its words, one after another. Words are split at ASCII white
    space; what else counts as white space is left to the tokenizer. A text's new
    words are encoded in one call, by a rank encoder where ids are ranks.
    """

    def __init__(self, path: str, ranked: bool | None = None) -> None:
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        settings = json.loads(self.tokenizer.to_str())
        self.special = [t["content"] for t in settings["added_tokens"]]
        self.ranks = None
        if is_ranked(path) if ranked is None else ranked:
            import tiktoken

            table = rank_table(settings)
            pattern = f"[^{RUN_END} ]+{RUN_END}| "
            self.ranks = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={})
            self.between = table[b" "]
            self.runs = regex.compile(settings["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])

    def __missing__(self, word: bytes) -> bytes:
        ids = self.tokenizer.encode(word.decode("utf-8", "replace"), add_special_tokens=False).ids
        found = self[word] = np.array(ids, "<u4").tobytes()
        return found

    def learn(self, words: list[bytes]) -> None:
        """Encodes words at once; odd ones are left to be looked up one by one."""
        joined = b" ".join(words).decode("utf-8", "replace")
        # Beyond Latin letters, what a letter is depends on the version of Unicode.
        if not self._is_plain(joined):
            words = [word for word in words if self._is_plain(word.decode("utf-8", "replace"))]
            joined = b" ".join(words).decode()
        if not words:
            return
        plain = joined.lower() if joined.isascii() else self.tokenizer.normalizer.normalize_str(joined)
        ids = np.array(self.ranks.encode_ordinary(self.runs.sub(rf"\g<0>{RUN_END}", plain)), "<u4")
        ends = (ID_BYTES * np.append(np.flatnonzero(ids == self.between), len(ids))).tolist()
        raw, start = ids.tobytes(), 0
        for word, end in zip(words, ends, strict=True):
            self[word] = raw[start:end]
            start = end + ID_BYTES

    def _is_plain(self, text: str) -> bool:
        if not text.isprintable() or (not text.isascii() and BEYOND_LATIN.search(text)):
            return False
        return not any(mark in text for mark in self.special)

    def encode(self, text: bytes) -> bytes:
        if len(self) > KEPT_WORDS:
            self.clear()
        words = text.split()
        if self.ranks is not None:
            new = [word for word in set(words) if word not in self and len(word) <= LONG_WORD]
            if new:
                self.learn(new)
        return b"".join(map(self.__getitem__, words))


def pieces(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32)``: each document's ids, then the end id, cut
    into pieces of ``capacity``; only the last may be shorter.

    ``vocabulary`` is the tokenizer file, present on every executor.
    """
    step, ranked = capacity * ID_BYTES, is_ranked(vocabulary)
    end = np.array([END_OF_DOCUMENT], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _Words(vocabulary, ranked)
        for keys, rows in byte_rows(batches):
            where, starts, lengths, sums = [], [], [], []
            for at, row in enumerate(rows):
                ids = words.encode(row) + end
                for start in range(0, len(ids), step):
                    part = ids[start : start + step]
                    where.append(at)
                    starts.append(start // ID_BYTES)
                    lengths.append(len(part) // ID_BYTES)
                    sums.append(zlib.crc32(part))
            begun = np.array(starts, np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    keys.take(pa.array(where, pa.int64())),
                    pa.array((begun // capacity).astype(np.int32)),
                    pa.array(begun),
                    pa.array(lengths, pa.int64()),
                    pa.array(sums, pa.int64()),
                ],
                ["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return texts(docs).mapInArrow(
        cut, "doc_id long, piece int, start long, length long, ids_crc32 long"
    )


# -- the plan over the histogram of lengths ----------------------------------------

Filling = tuple[tuple[int, int], ...]  # (length, how many), longest first
Plan = list[tuple[Filling, int]]  # fillings and how many sequences get each


def best_fit(counts: dict[int, int], capacity: int) -> Plan:
    """Best-fit decreasing over a histogram: equal sequences are handled as one group."""
    groups: dict[int, dict[Filling, int]] = {capacity: {}}
    room: list[int] = []  # a heap of free sizes, smallest first
    for length in sorted(counts, reverse=True):
        left, tight = counts[length], []
        while left:
            while room and (room[0] < length or not groups.get(room[0])):
                tight.append(heapq.heappop(room))
            free = room[0] if room else capacity
            fits = free // length
            if room:
                filling = next(iter(groups[free]))
                there = groups[free].pop(filling)
            else:
                filling, there = (), -(-left // fits)
            full = min(there, left // fits)
            rest = left - full * fits if full < there else 0
            moves = [(full, fits), (1 if rest else 0, rest), (there - full - bool(rest), 0)]
            for number, items in moves:
                if number > 0:
                    after = (*filling, (length, items)) if items else filling
                    size = free - items * length
                    kept = groups.setdefault(size, {})
                    if not kept and size < capacity:
                        heapq.heappush(room, size)
                    kept[after] = kept.get(after, 0) + number
            left -= full * fits + rest
        for size in tight:
            if groups.get(size):
                heapq.heappush(room, size)
    return [(filling, n) for kept in groups.values() for filling, n in kept.items() if filling]


def least_sequences(counts: dict[int, int], capacity: int) -> int:
    """A lower bound: total size, or pieces over a threshold that cannot share with small ones."""
    total = sum(length * n for length, n in counts.items())
    bound = -(-total // capacity)
    lengths = sorted(counts)
    for k in [x for x in lengths if 2 * x <= capacity][:256]:
        alone = sum(n for x, n in counts.items() if x > capacity - k)
        half = sum(n for x, n in counts.items() if capacity - k >= x > capacity // 2)
        half_size = sum(n * x for x, n in counts.items() if capacity - k >= x > capacity // 2)
        small = sum(n * x for x, n in counts.items() if k <= x <= capacity // 2)
        bound = max(bound, alone + half + max(0, -(-(small - (half * capacity - half_size)) // capacity)))
    return bound


def fillings(lengths: list[int], counts: dict[int, int], free: int, limit: int) -> list[Filling]:
    """Undominated fillings of ``free``, least waste first.

    A filling dominates another if the other's pieces fit into the room that its
    pieces take; what is kept cannot be widened by a piece and has no single
    piece that the largest unused one still fitting could replace. An exact
    single piece dominates everything.
    """
    if counts.get(free, 0):
        return [((free, 1),)]
    found: list[tuple[int, Filling]] = []
    steps = 0

    def descend(at: int, room: int, chosen: Filling) -> None:
        nonlocal steps
        steps += 1
        if steps > FILL_STEPS or (found and found[0][0] == 0 and len(found) >= limit):
            return
        # The longest piece that fits replaces any shorter one taken alone.
        nxt = at
        while nxt < len(lengths) and lengths[nxt] > room:
            nxt += 1
        if nxt == len(lengths):
            if _undominated(lengths, counts, chosen, room):
                heapq.heappush(found, (room, chosen))
            return
        tried = 0
        while nxt < len(lengths) and tried < limit:
            length = lengths[nxt]
            most = min(counts[length], room // length)
            for n in range(most, 0, -1):
                descend(nxt + 1, room - n * length, (*chosen, (length, n)))
            nxt, tried = nxt + 1, tried + 1

    descend(0, free, ())
    found.sort()
    return [filling for _, filling in found[:limit]] or [()]


def _undominated(lengths: list[int], counts: dict[int, int], chosen: Filling, waste: int) -> bool:
    used = dict(chosen)
    for length, _ in chosen:
        for wider in range(length + 1, length + waste + 1):
            if counts.get(wider, 0) > used.get(wider, 0):
                return False
    return True


def complete(counts: dict[int, int], capacity: int = CAPACITY, nodes: int = SEARCH_NODES) -> Plan:
    """A plan for a histogram ``length -> pieces`` by branch and bound over bin completions.

    The first incumbent is the best-fit plan. The search takes the longest
    piece left, tries its undominated fillings by growing waste and uses each
    as often as the pieces allow. A branch is cut off where the waste so far
    leaves it no fewer sequences than the incumbent: used sequences plus the
    rest's total size. It ends when the lower bound is met or after ``nodes``
    fillings, with the best plan found. Each use of a filling exhausts a length
    or nearly so, so effort and plan follow the number of different lengths
    (at most ``capacity``), not the number of pieces.
    """
    counts = {length: n for length, n in counts.items() if n}
    whole = counts.pop(capacity, 0)
    head: Plan = [(((capacity, 1),), whole)] if whole else []
    if not counts:
        return head
    incumbent = best_fit(counts, capacity)
    fewest = sum(n for _, n in incumbent)
    bound = least_sequences(counts, capacity)
    lengths_all = sorted(counts, reverse=True)
    total = sum(length * n for length, n in counts.items())
    budget = nodes
    # An explicit stack of (plan entry, remaining choices), not recursion.
    left, used, size = dict(counts), 0, total
    trail: list[tuple[Filling, int, list[Filling]]] = []

    def choices() -> list[Filling]:
        lengths = [x for x in lengths_all if left[x]]
        first = lengths[0]
        left[first] -= 1
        rest = [x for x in lengths if left[x]]
        found = fillings(rest, left, capacity - first, FILLINGS)
        left[first] += 1
        return [_with(first, f) for f in found]

    pending = choices() if fewest > bound else []
    while fewest > bound and budget > 0:
        if pending:
            filling, pending = pending[0], pending[1:]
            budget -= 1
            times = min(left[x] // n for x, n in filling)
            for x, n in filling:
                left[x] -= n * times
            used += times
            size -= times * sum(x * n for x, n in filling)
            trail.append((filling, times, pending))
            if not size:
                if used < fewest:
                    fewest = used
                    incumbent = [(f, t) for f, t, _ in trail]
                pending = []
            elif used + -(-size // capacity) >= fewest:
                pending = []
            else:
                pending = choices()
                continue
            if fewest <= bound:
                break
        if not pending:
            if not trail:
                break
            filling, times, pending = trail.pop()
            for x, n in filling:
                left[x] += n * times
            used -= times
            size += times * sum(x * n for x, n in filling)
    return head + incumbent


def _with(first: int, filling: Filling) -> Filling:
    counted = dict(filling)
    counted[first] = counted.get(first, 0) + 1
    return tuple(sorted(counted.items(), reverse=True))


# -- from the plan to places -------------------------------------------------------


def slots(plan: Plan) -> pd.DataFrame:
    """Runs of equal places: pieces ``low`` .. of a length go, ``per`` to a sequence, from
    sequence ``first`` and offset ``at`` on. A few rows per length."""
    rows, next_sequence, taken = [], 0, {}
    for filling, times in plan:
        at = 0
        for length, n in filling:
            low = taken.get(length, 0)
            rows.append((length, low, n, next_sequence, at))
            taken[length] = low + n * times
            at += n * length
        next_sequence += times
    return pd.DataFrame(rows, columns=["length", "low", "per", "first", "at"]).astype(np.int64)


def pack(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY) -> DataFrame:
    """Each document's pieces with their sequence and their offset in it.

    Gives ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``. What
    decides the packing is the histogram of piece lengths, at most ``capacity``
    numbers whatever the corpus; the plan over it says how many sequences are
    filled in which way. Pieces are numbered within their length by Spark and
    look up their place. Full pieces are sequences of their own.

    A NULL or empty text is one piece with the end id. Rows with NULL or
    repeated ids are packed like any other; an empty table gives no rows.
    Pieces of one length are interchangeable, so ties do not change the number
    of sequences.
    """
    rows = staged(pieces(docs, vocabulary, capacity), "pieces")
    histogram = {r["length"]: r["n"] for r in rows.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    places = slots(complete(histogram, capacity))
    buckets = min(MAX_BUCKETS, max(MIN_BUCKETS, -(-sum(histogram.values()) // ROWS_PER_BUCKET)))
    indexed = numbered(rows, ["length"], ["doc_id", "piece", "ids_crc32"], buckets, "index")
    places = places.sort_values(["length", "low"], ignore_index=True)
    columns = {name: places[name].to_numpy() for name in places}
    # Runs of each length, in order: where they begin.
    begins = np.searchsorted(columns["length"], np.arange(capacity + 2))

    def place(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            length, index = frame["length"].to_numpy(), frame["index"].to_numpy()
            run = np.empty(len(frame), np.int64)
            for size in np.unique(length):
                of = length == size
                lows = columns["low"][begins[size] : begins[size + 1]]
                run[of] = begins[size] + np.searchsorted(lows, index[of], side="right") - 1
            nth = index - columns["low"][run]
            per = columns["per"][run]
            frame["sequence_id"] = columns["first"][run] + nth // per
            frame["offset"] = columns["at"][run] + nth % per * length
            yield frame.drop(columns="index")

    schema = (
        "doc_id long, piece int, start long, length long, ids_crc32 long,"
        " sequence_id long, offset long"
    )
    return indexed.select(
        "doc_id", "piece", "start", "length", "ids_crc32", "index"
    ).mapInPandas(place, schema)
