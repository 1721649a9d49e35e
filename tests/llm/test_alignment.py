"""Alignment against a plain per-text one without windows."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import public_tokenizers
import pytest
from llm_data import CLASHES, SF, empty, frame, odd, odd_rows, passage
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from starflat.llm import alignment, queries

FILES = [public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.fixture(scope="module")
def tokenizers():
    a = Tokenizer.from_file(FILES[0])
    a.encode_special_tokens = True
    return a, SentencePieceProcessor(model_file=FILES[1])


def spans(parts):
    at, found = 0, []
    for part in parts:
        found.append((at, at + len(part)))
        at += len(part)
    return found


def plain(text, tokenizers):
    """Ids, groups and linked pairs of one text; None without tokens."""
    a, b = tokenizers
    if not text:
        return None
    letters = alignment.byte_alphabet()
    a_ids, b_ids = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    a_bytes = [bytes(letters[c] for c in a.id_to_token(i)) for i in a_ids]
    b_bytes = []
    for i in b_ids:
        piece = b.id_to_piece(i)
        is_byte = len(piece) == 6 and piece.startswith("<0x")
        b_bytes.append(bytes([int(piece[3:5], 16)]) if is_byte else piece.replace("\u2581", " ").encode())
    whole = (" " + text).encode()
    if b"".join(a_bytes) != whole or b"".join(b_bytes) != whole:
        return None
    a_spans, b_spans = spans(a_bytes), spans(b_bytes)
    ends = sorted({e for _, e in a_spans} & {e for _, e in b_spans})
    groups, low = [], 0
    for end in ends:
        mine = [",".join(str(i) for i, (_, e) in zip(ids, s) if low < e <= end) for ids, s in ((a_ids, a_spans), (b_ids, b_spans))]
        groups.append("|".join(mine))
        low = end
    links = [(x, y) for x, (s, e) in zip(a_ids, a_spans) for y, (t, f) in zip(b_ids, b_spans) if s < f and t < e]
    return a_ids, b_ids, groups, links


def slow(rows, tokenizers):
    done = [(i, plain(text, tokenizers)) for i, text in rows]
    docs = Counter(pair for _, one in done if one for pair in set(one[3]))
    most = {}
    for (x, _), n in docs.items():
        most[x] = max(most.get(x, 0), n)
    found = []
    for i, one in done:
        if one is None:
            found.append((i, 0, 0, 0, 0, 0, 0, ""))
            continue
        a_ids, b_ids, groups, links = one
        best = sum(docs[link] == most[link[0]] for link in links)
        text = hashlib.sha256(";".join(groups).encode()).hexdigest()
        found.append((i, len(a_ids), len(b_ids), len(groups), len(links), best, sum(docs[x] for x in links), text))
    return sorted(found, key=str)


def run(df):
    found = alignment.digest(*alignment.align(df, *FILES))
    assert found.columns == COLUMNS
    return sorted(map(tuple, found.collect()), key=str)


def hard_texts():
    rng = random.Random(3)
    signs = ["a", "ß", "é", " ", "  ", "\n", "\t", "日", "本", "🙂", "'s", "<s>", "</s>", "<unk>", "<|endoftext|>", "<0x41>",
             "\u2581", "\u00a0", "\u0300", "\x00", "1", "23", ".", "Word", " the", "ing", "\u200d", "ا", "\r\n"]
    return ["".join(rng.choice(signs) for _ in range(rng.randrange(1, 60))) for _ in range(300)]


def test_equals_brute_force_on_odd_texts(spark, tokenizers):
    rows = list(enumerate(hard_texts()))
    rows += [(7, "same words here"), (7, "same words here"), (None, "no id"), (500, None), (501, ""), (502, " "), (503, "x" * 3000)]
    got, want = run(frame(spark, rows)), slow(rows, tokenizers)
    assert got == want
    assert sum(r[1] > 0 for r in want) > 100 and sum(r[1] == 0 for r in want) > 3


def test_whole_table_equals_brute_force(spark, tokenizers):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    short = [r for r in rows if len(r[1] or "") < 3000]
    assert len(short) > 100
    assert run(docs.filter(F.coalesce(F.length("text"), F.lit(0)) < 3000)) == slow(short, tokenizers)
    assert queries.op11_alignment(spark, SF).count() == len(rows)


def test_rare_pairs_take_the_other_way(spark, tokenizers):
    rng = random.Random(9)
    rows = [(i, passage(rng, 2)) for i in range(40)] + [(50 + i, "One text that many rows hold.") for i in range(40)]
    table, counts = alignment.align(frame(spark, rows), *FILES)
    want = sorted(map(tuple, alignment.score(table, counts).collect()))
    for common in (1, 20):
        assert sorted(map(tuple, alignment.score(table, counts, common).collect())) == want
    assert counts.count() > 20


def test_small_memory_gives_the_same(spark, tokenizers, monkeypatch):
    rows = list(enumerate(hard_texts()[:60]))
    want = slow(rows, tokenizers)
    monkeypatch.setattr(alignment, "KEPT", 10)
    monkeypatch.setattr(alignment, "BATCH_BYTES", 100)
    assert run(frame(spark, rows)) == want


def test_odd_and_empty_tables(spark, tokenizers):
    assert run(empty(spark)) == []
    rows = [(i, t) for i, t, *_ in odd_rows()]
    assert set(CLASHES) <= set(odd(spark).columns)
    got = run(odd(spark))
    assert len(got) == len(rows)
    small = [r for r in rows if r[0] != 6]
    counts = {(r[0], r[1], r[2], r[3], r[4]) for r in got if r[0] != 6}
    assert counts == {(r[0], r[1], r[2], r[3], r[4]) for r in slow(small, tokenizers)}


def test_pair_counts_are_documents(spark, tokenizers):
    rows = [(1, "a a a a"), (2, "a"), (3, None)]
    _, counts = alignment.align(frame(spark, rows), *FILES)
    assert {r["docs"] for r in counts.collect()} == {2}
    assert all(r["best"] for r in counts.collect())
