from __future__ import annotations

import random

from llm_data import empty, frame, odd, odd_rows, passage

from starflat.llm import substrings


def slow(texts):
    """Sentences of each text that a span covers which came up before, in order of ids."""
    seen, lost = set(), {}
    for i, text in texts:
        units = [(k, w) for k, (_, _, w) in enumerate(substrings.sentences(text or "")) if w]
        out = set()
        for a in range(len(units)):
            for b in range(a + substrings.SPAN_SENTENCES, len(units) + 1):
                if sum(len(w) for _, w in units[a:b]) >= substrings.SPAN_WORDS:
                    span = tuple(x for _, w in units[a:b] for x in w)
                    if span in seen:
                        out.update(range(units[a][0], units[b - 1][0] + 1))
                    seen.add(span)
                    break
        if out:
            lost[i] = sorted(out)
    return lost


def found(spark, texts):
    rows = substrings.removals(substrings.numbered_rows(frame(spark, texts))).collect()
    return {r["doc_id"]: r["removed"] for r in rows}


def test_equals_brute_force(spark):
    rng = random.Random(1)
    shared = [passage(rng, 7, 9) for _ in range(4)] + [" ".join("x%d" % rng.randrange(10**6) for _ in range(70))]
    texts = []
    for i in range(80):
        words = passage(rng, 6).split()
        if i % 3 == 0:
            at = rng.randrange(len(words))
            words[at:at] = rng.choice(shared).split()
        texts.append((i, " ".join(words)))
    lost = found(spark, texts)
    assert lost == slow(texts)
    # Every later copy of a passage is found, also one in mid-sentence or without marks; no clean text.
    first, later = set(), set()
    for i, text in texts:
        for n, p in enumerate(shared):
            if p in text:
                (later if n in first else set()).add(i)
                first.add(n)
    assert set(lost) == later


def test_texts_keep_the_rest(spark):
    rng = random.Random(2)
    common = passage(rng, 6)
    texts = [(1, "Head one. " + common + " Tail one."), (2, "Head two. " + common + " Tail two.")]
    out = {r["doc_id"]: r["text"] for r in substrings.deduplicate(frame(spark, texts)).collect()}
    assert out[1] == texts[0][1]
    assert out[2].split() == "Head two. Tail two.".split()


def test_sentences_cover_the_text():
    for _, text, *_ in odd_rows():
        if text:
            assert "".join(text[a:b] for a, b, _ in substrings.sentences(text)) == text


def test_odd_and_empty_tables(spark):
    rng = random.Random(3)
    p = passage(rng, 6)
    df = odd(spark).unionByName(frame(spark, [(None, p), (None, p), (90, p), (90, p)]), allowMissingColumns=True)
    rows = substrings.removals(substrings.numbered_rows(df.select("doc_id", "text")))
    assert sorted(str(r["doc_id"]) for r in rows.collect()) == ["90", "None", "None"]
    out = substrings.deduplicate(df)
    assert out.columns == df.columns and out.count() == len(odd_rows()) + 4
    assert substrings.removals(substrings.numbered_rows(empty(spark))).count() == 0
    assert substrings.deduplicate(empty(spark)).count() == 0


def test_ranges(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([([1, 2, 3, 7, 9, 10],), ([],), ([0],)], "n ARRAY<INT>")
    got = [r[0] for r in df.filter(F.size("n") > 0).select(substrings.ranges(F.col("n"))).collect()]
    assert got == ["1-3,7-7,9-10", "0-0"]
