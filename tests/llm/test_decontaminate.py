from __future__ import annotations

import random

import numpy as np
from llm_data import empty, frame, odd, passage

from starflat.llm import decontaminate as d

ITEMS = "item_id LONG, text STRING, words STRING, region LONG"


def edited(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        at = rng.randrange(len(words))
        kind = rng.choice("sid")
        if kind == "s":
            words[at] = "zz%d" % rng.randrange(999)
        elif kind == "i":
            words.insert(at, "yy%d" % rng.randrange(999))
        else:
            words.pop(at)
    return words


def slow_distance(item, region):
    row = [0] * (len(region) + 1)
    for i, word in enumerate(item, 1):
        new = [i]
        for j, other in enumerate(region, 1):
            new.append(min(row[j - 1] + (word != other), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def test_distance_equals_brute_force():
    rng = random.Random(1)
    for _ in range(200):
        item = [rng.choice([b"a", b"b", b"c"]) for _ in range(rng.randrange(1, 8))]
        region = [rng.choice([b"a", b"b", b"c"]) for _ in range(rng.randrange(1, 12))]
        assert d.distance(item, region) == slow_distance(item, region)


def test_recall_and_precision_against_brute_force(spark):
    rng = random.Random(2)
    items = [(i, " ".join(passage(rng, 5).split()[: rng.randrange(6, 55)])) for i in range(40)]
    texts, k = [], 0
    for i, text in items:
        for share in (0, 0.1, 0.2, 0.4):
            host = passage(rng, 6).split()
            at = rng.randrange(len(host))
            words = text.split()
            host[at:at] = edited(rng, words, int(share * len(words)))
            texts.append((k, " ".join(host)))
            k += 1
    texts += [(k + i, passage(rng, 8)) for i in range(50)]
    bench = spark.createDataFrame([(*r, "x", 1) for r in items], ITEMS)
    found = {(r["doc_id"], r["item_id"]): r["distance"] for r in d.matches(frame(spark, texts), bench).collect()}
    words = {i: d.words_of(t.encode()) for i, t in items}
    want = {}
    for k, text in texts:
        region = d.words_of(text.encode())
        for i, item in words.items():
            if set(item) & set(region):
                n = d.distance(item, region)
                if n <= d.allowed(len(item)):
                    want[k, i] = n
    assert len(want) > 100
    assert set(found) <= set(want)
    assert all(found[p] == want[p] for p in found)
    assert len(found) >= 0.98 * len(want)


def test_embedding_keeps_close_strings_close():
    rng = np.random.default_rng(3)
    base = rng.integers(1, 5000, (60, 40), dtype=np.uint32)
    near = base.copy()
    near[:, 11] = 7
    far = rng.integers(1, 5000, (60, 40), dtype=np.uint32)
    same = lambda a, b: (d.embed(a, 0, np.arange(80)) == d.embed(b, 0, np.arange(80))).mean()
    assert same(base, base) == 1
    assert same(base, near) > 0.7 > 0.2 > same(base, far)


def test_documents_go_with_their_passages(spark):
    rng = random.Random(4)
    item = passage(rng, 3)
    rows = [(1, "Before. " + item.upper().replace(" ", "\n") + " After."), (2, passage(rng, 5)), (None, item), (None, None)]
    bench = spark.createDataFrame([(1, item, "x", 1), (2, None, "x", 1), (None, "", "x", 1), (3, "one two", "x", 1)], ITEMS)
    out = d.decontaminate(frame(spark, rows), bench)
    assert sorted(str(r["doc_id"]) for r in out.collect()) == ["2", "None"]


def test_odd_and_empty_tables(spark):
    bench = spark.createDataFrame([(1, "Plain words of a short text here", "x", 1)] * 2, ITEMS)
    none = spark.createDataFrame([], ITEMS)
    df = odd(spark)
    found = d.matches(df, bench).collect()
    assert [(r["doc_id"], r["item_id"], r["distance"]) for r in found] == [(1, 1, 0)]
    assert d.decontaminate(df, bench).count() == df.count() - 2
    assert d.matches(df, none).count() == 0
    assert d.matches(empty(spark), bench).count() == 0
    assert d.decontaminate(df, none).columns == df.columns


def test_a_long_run_of_known_words(spark):
    """A text that repeats an item's words for long is cut into overlapping regions."""
    rng = random.Random(5)
    item = passage(rng, 2)
    text = " ".join([item] * 40)
    bench = spark.createDataFrame([(1, item, "x", 1)], ITEMS)
    assert d.matches(frame(spark, [(1, text)]), bench).count() == 1


def starts_of_passages(bench, texts, places):
    """How many of the given starts are among the windows that are embedded."""
    kinds = d.kinds_of([len(i) for i in bench])
    known = {int(p) for i in bench for q in d.GRAMS for p in d._gram_places(d._codes(i), q, 20)}
    bits = np.zeros(1 << 20, bool)
    bits[list(known)] = True
    hits = 0
    for text, at in zip(texts, places):
        codes = d._codes(text)
        kind = kinds[0]
        own = np.concatenate([codes, np.zeros(kind.most, np.uint32)])[at : at + kind.most]
        hits += any((w == own).all(axis=1).any() for _, w in d._windows(codes, bits, kinds))
    return hits


def test_no_window_is_left_out_by_a_full_filter_or_nested_items():
    """Of 30,000 items the smallest filter is nearly full, and passages stand among known words."""
    rng = random.Random(6)
    word = lambda: b"w%d" % rng.randrange(100000)
    bench = [[word() for _ in range(37)] for _ in range(30000)]
    texts, places = [], []
    for item in bench[:100]:
        before = [word() for _ in range(60)]
        texts.append(before + item + [word() for _ in range(60)])
        places.append(60)
    assert starts_of_passages(bench, texts, places) == 100
    long = [word() for _ in range(90)]
    assert starts_of_passages([long[20:57], long], [long], [20]) == 1
    assert d.filter_bits(100) == 20 and d.filter_bits(2_000_000) == 25


def test_nested_items_are_found(spark):
    rng = random.Random(7)
    rows, texts = [], []
    for i in range(30):
        words = passage(rng, 12).split()
        rows += [(2 * i, " ".join(words), "x", 1), (2 * i + 1, " ".join(words[30:67]), "x", 1)]
        texts.append((i, " ".join(words)))
    found = d.matches(frame(spark, texts), spark.createDataFrame(rows, ITEMS)).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found} == {(i, 2 * i + k) for i in range(30) for k in (0, 1)}
