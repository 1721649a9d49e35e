from __future__ import annotations

import random
import zlib

from llm_data import CLASHES, empty, frame, odd, odd_rows, passage
from pyspark.sql import functions as F

from starflat.llm import toxicity as t

LABELS = "doc_id LONG, quality INT, toxic INT"


def corpus(n, seed):
    """Toxic texts hold words with one of two stems, as many languages form them."""
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        words = passage(rng, 6).split()
        bad = i % 5 == 0
        if bad:
            for _ in range(4):
                stem = rng.choice(["grolm", "vexar"])
                words.insert(rng.randrange(len(words)), stem + rng.choice(["us", "ina", "ette", "og", "ilk"]))
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(bad)))
    return rows, labels


def test_held_out_accuracy(spark):
    rows, labels = corpus(1500, 1)
    found = t.judge(frame(spark, rows), spark.createDataFrame(labels, LABELS)).collect()
    assert len(found) == len(rows)
    for r in found:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)
    truth = {i: bad for i, _, bad in labels}
    held = [r for r in found if r["held_out"]]
    right = sum(r["predicted"] == truth[r["doc_id"]] for r in held)
    assert len(held) > 300 and right >= 0.97 * len(held)


def test_held_out_labels_do_not_matter(spark):
    rows, labels = corpus(600, 2)
    other = [(i, q, 1 - x if zlib.crc32(str(i).encode()) % 4 == 2 else x) for i, q, x in labels]
    docs = frame(spark, rows)
    score = lambda marks: sorted((r["doc_id"], r["score"]) for r in t.judge(docs, spark.createDataFrame(marks, LABELS)).collect())
    assert score(labels) == score(other)


def test_grammar_tells_clauses_apart():
    scorer = t.ClauseScorer({"idiot": 4.0})
    at = {name: i for i, name in enumerate(t.FEATURES)}

    def hit(text):
        values = scorer.features(text)
        return {name for name in t.SCORED if values[at[name]]}

    assert hit("An idiot wrote.") == {t.INSULT}
    assert hit("You idiot.") == {t.AIMED}
    assert hit("You left. An idiot came.") == {t.INSULT}
    assert hit("This is not an idiot.") == {t.NEGATED}
    assert hit("not one of all so many is an idiot") == {t.INSULT}
    assert hit("He said idiot.") == {t.QUOTED}
    assert hit("They kill.") == {t.AIMED_THREAT}
    assert hit("kill") == {t.THREAT}
    assert hit("Calm words.") == set()


def test_composition_equals_running_one_after_another():
    rng = random.Random(3)
    parts = (t.negation(), t.reported(), t.aimed())
    for _ in range(200):
        symbols = [rng.choice(t.SYMBOLS) for _ in range(10)]
        want, states = [], [p.start for p in parts]
        for s in symbols:
            for i, p in enumerate(parts):
                states[i], s = p.step(states[i], s)
            want.append(s)
        state, found = t.GRAMMAR.start, []
        for s in symbols:
            state, out = t.GRAMMAR.arcs[state, s]
            found.append(out)
        assert found == want


def test_rejection_keeps_clean_rows_and_columns(spark):
    rows, labels = corpus(1000, 4)
    docs = frame(spark, rows).select("*", *[F.lit(v).alias(k) for k, v in CLASHES.items()])
    kept = t.reject(docs, spark.createDataFrame(labels, LABELS))
    assert kept.columns == docs.columns
    ids = {r["doc_id"] for r in kept.collect()}
    clean = {i for i, _, bad in labels if not bad}
    assert len(clean - ids) <= 0.01 * len(clean)
    assert len(ids - clean) <= 0.05 * (len(rows) - len(clean))


def test_odd_and_empty_tables(spark):
    labels = spark.createDataFrame([(1, 1, 1), (1, 0, 0), (None, 1, 1), (2, None, None), (3, 0, 0)], LABELS)
    found = t.judge(odd(spark), labels).collect()
    assert len(found) == len(odd_rows())
    assert all(0 <= r["score"] <= 1 for r in found)
    none = spark.createDataFrame([], LABELS)
    assert t.judge(odd(spark), none).count() == len(odd_rows())
    assert t.judge(empty(spark), labels).count() == 0
    assert t.reject(odd(spark), none).count() == len(odd_rows())
