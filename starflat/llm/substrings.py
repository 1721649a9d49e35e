"""Passages that repeat across documents, by sliding spans of sentences."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starflat.llm.common import byte_rows, fresh, staged

# A span is the shortest run of so many sentences with so many words.
SPAN_SENTENCES, SPAN_WORDS = 3, 15
# Longer sentences are cut after words whose hash is divisible by CUT.
LONG_SENTENCE, CUT = 12, 6

WORD = re.compile(r"[^\W_]+")
END = re.compile(r"[.!?]+(?=\s)|[\r\n]+")


def sentences(text: str) -> list[tuple[int, int, list[str]]]:
    """``(start, end, words)`` of each sentence; together they cover the whole text.

    A sentence ends after its closing marks or with its line. One of more than
    ``LONG_SENTENCE`` words is cut on, at places that its words decide, so that
    text without any marks has sentences too and equal passages are cut alike.
    """
    found = []
    start = 0
    ends = [m.end() for m in END.finditer(text)]
    for end in [*ends, len(text)]:
        if end <= start:
            continue
        matches = list(WORD.finditer(text, start, end))
        if len(matches) <= LONG_SENTENCE:
            found.append((start, end, [m[0].lower() for m in matches]))
        else:
            words, begun = [], start
            for i, m in enumerate(matches):
                word = m[0].lower()
                words.append(word)
                if i + 1 < len(matches) and xxhash.xxh32_intdigest(word) % CUT == 0:
                    found.append((begun, m.end(), words))
                    words, begun = [], m.end()
            found.append((begun, end, words))
        start = end
    return found


def span_table(text: str) -> tuple[int, list[int], list[int], list[int], list[int]]:
    """The number of sentences, and first sentence, length and 128-bit hash of each span.

    Sentences without a word belong to the span they lie in but do not count.
    """
    parts = sentences(text)
    units = [(i, words) for i, (_, _, words) in enumerate(parts) if words]
    sizes = [len(words) for _, words in units]
    joined = [" ".join(words) for _, words in units]
    at, lengths, high, low = [], [], [], []
    end, inside = 0, 0
    for i in range(len(units)):
        if end < i + 1:
            end, inside = i + 1, sizes[i]
        while end < len(units) and (end - i < SPAN_SENTENCES or inside < SPAN_WORDS):
            inside += sizes[end]
            end += 1
        if end - i < SPAN_SENTENCES or inside < SPAN_WORDS:
            break
        digest = xxhash.xxh3_128_intdigest(" ".join(joined[i:end]))
        at.append(units[i][0])
        lengths.append(units[end - 1][0] + 1 - units[i][0])
        high.append((digest >> 64) - (1 << 63))
        low.append((digest & ((1 << 64) - 1)) - (1 << 63))
        inside -= sizes[i]
    return len(parts), at, lengths, high, low


def spans(docs: DataFrame) -> DataFrame:
    """``(row, doc_id, sentences, at, length, high, low)``: every span of every row of ``(row, doc_id, text)``."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, rows in byte_rows(batches):
            where, columns = [], ([], [], [], [], [])
            for i, row in enumerate(rows):
                total, at, lengths, high, low = span_table(row.decode("utf-8", "replace"))
                where.extend([i] * len(at))
                for column, values in zip(columns, ([total] * len(at), at, lengths, high, low)):
                    column.extend(values)
            index = pa.array(where, pa.int64())
            kinds = (pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    keys.field("row").take(index),
                    keys.field("doc_id").take(index),
                    *[pa.array(c, kind) for c, kind in zip(columns, kinds)],
                ],
                ["row", "doc_id", "sentences", "at", "length", "high", "low"],
            )

    keyed = docs.select(
        F.struct("row", F.col("doc_id").cast("long").alias("doc_id")).alias("keys"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    return keyed.mapInArrow(
        cut, "row long, doc_id long, sentences int, at int, length int, high long, low long"
    )


def repeats(docs: DataFrame) -> DataFrame:
    """``(row, doc_id, sentences, at, length, first_doc_id)``: spans that occurred before.

    The first occurrence of a span is the one with the smallest document id
    (NULL last), then row, then place.

    Half of each hash decides first: it is counted alone, partly before the
    shuffle, so a passage in a third of all documents sends one row a task. Spans
    whose half occurs once are out; the semi-join that drops them has one row a
    half on its other side and AQE splits it. Whole hashes decide over the rest.
    """
    found = staged(spans(docs), "spans")
    several = found.groupBy("low").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("low")
    candidates = staged(found.join(several, "low", "left_semi"), "span-candidates")
    place = F.struct(
        F.col("doc_id").isNull().alias("unnamed"), F.col("doc_id").alias("first_doc_id"), "row", "at"
    )
    repeated = (
        candidates.groupBy("high", "low")
        .agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("first"))
        .filter("n > 1")
        .select("high", "low", "first")
    )
    later = candidates.join(repeated, ["high", "low"]).filter(
        (F.col("row") != F.col("first.row")) | (F.col("at") != F.col("first.at"))
    )
    return later.select("row", "doc_id", "sentences", "at", "length", F.col("first.first_doc_id"))


def numbered_rows(docs: DataFrame) -> DataFrame:
    return docs.withColumn("row", F.monotonically_increasing_id())


def removals(docs: DataFrame) -> DataFrame:
    """One row per document that loses sentences.

    Gives ``row, doc_id, n_sentences, removed`` (sorted numbers of the sentences
    that some repeated span covers) and ``first_doc_ids`` (where they occurred
    first). ``docs`` has ``row``, a number of its own for each row.

    NULL and empty texts have no spans. A text that repeats its own sentences
    loses the later ones. Rows with NULL or equal ids are kept apart. Documents
    without repeats are not in the result; an empty table gives no rows.
    """
    covered = F.array_sort(
        F.array_distinct(
            F.flatten(F.transform("spans", lambda s: F.sequence(s["at"], s["at"] + s["length"] - 1)))
        )
    )
    return (
        repeats(docs.select("row", "doc_id", "text"))
        .groupBy("row")
        .agg(
            F.first("doc_id").alias("doc_id"),
            F.first("sentences").alias("n_sentences"),
            F.collect_list(F.struct("at", "length")).alias("spans"),
            F.array_sort(F.collect_set("first_doc_id")).alias("first_doc_ids"),
        )
        .select("row", "doc_id", "n_sentences", covered.alias("removed"), "first_doc_ids")
    )


def ranges(numbers: Column) -> Column:
    """Sorted numbers as text: ``3-5,9-9``."""

    def add(state: Column, n: Column) -> Column:
        grown = F.struct(state["done"].alias("done"), state["start"].alias("start"), n.alias("end"))
        done = F.when(state["end"] < 0, state["done"]).otherwise(
            F.concat(state["done"], F.array(F.concat_ws("-", state["start"], state["end"])))
        )
        return F.when(n == state["end"] + 1, F.when(state["end"] >= 0, grown).otherwise(
            F.struct(done.alias("done"), n.alias("start"), n.alias("end"))
        )).otherwise(F.struct(done.alias("done"), n.alias("start"), n.alias("end")))

    start = F.struct(
        F.array().cast("array<string>").alias("done"), F.lit(-1).alias("start"), F.lit(-1).alias("end")
    )
    last = lambda s: F.concat(s["done"], F.array(F.concat_ws("-", s["start"], s["end"])))
    return F.array_join(F.aggregate(numbers, start, add, last), ",")


def keep_sentences(text: str, removed: list[int]) -> str:
    """The text without some of its sentences."""
    out = set(removed)
    return "".join(text[a:b] for i, (a, b, _) in enumerate(sentences(text)) if i not in out)


def deduplicate(docs: DataFrame) -> DataFrame:
    """``docs`` with every sentence taken out that a non-first repeated span covers; all columns stay."""
    row, lost = fresh(docs, "substring_row"), fresh(docs, "substring_removed")
    rows = staged(docs.withColumn(row, F.monotonically_increasing_id()), "substring-docs")
    found = removals(rows.select(F.col(row).alias("row"), "doc_id", "text")).select(
        F.col("row").alias(row), F.col("removed").alias(lost)
    )

    def rewrite(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            frame["text"] = [
                t if r is None or t is None else keep_sentences(t, r)
                for t, r in zip(frame["text"], frame[lost])
            ]
            yield frame.drop(columns=[lost])

    # Rows that lose nothing never leave the JVM.
    both = rows.join(found, row, "left")
    changed = both.filter(F.col(lost).isNotNull()).select(*docs.columns, lost)
    same = both.filter(F.col(lost).isNull()).select(*docs.columns)
    return same.unionByName(changed.mapInPandas(rewrite, docs.schema))
