from __future__ import annotations

import random
from collections import Counter

from llm_data import empty, frame, odd, passage

from starflat.llm import licenses


def slow(text, templates, threshold):
    """Every run of sentences against every template."""
    finder = licenses.Finder(templates, threshold)
    plain = text.lower().encode()
    words = licenses.WORD.findall(plain)
    starts = finder._breaks(plain, len(words))
    best = {}
    for t in finder.templates:
        for i, a in enumerate(starts):
            for b in starts[i + 1 :]:
                grams = Counter(zip(words[a:b], words[a + 1 : b]))
                size = sum(grams.values())
                if size:
                    score = 2 * sum((grams & t.grams).values()) / (size + t.size)
                    key = (-score, a, b - a)
                    if score >= threshold and key < best.get(t.name, (0, 0, 0)):
                        best[t.name] = key
    return {name: (-key[0], key[1], key[2]) for name, key in best.items()}


def test_equals_brute_force():
    rng = random.Random(1)
    finder = licenses.Finder(licenses.TEMPLATES, 0.8)
    for _ in range(60):
        parts = [passage(rng, 2) for _ in range(3)]
        name, text = rng.choice(licenses.TEMPLATES)
        words = text.split()
        for _ in range(rng.randrange(4)):
            words[rng.randrange(len(words))] = "other"
        parts.insert(rng.randrange(4), " ".join(words) + ".")
        whole = "\n".join(parts)
        want = slow(whole, licenses.TEMPLATES, 0.8)
        found = {n: (s, a, b) for n, s, a, b in finder.find(whole.encode())}
        assert set(found) <= set(want)
        for n, (score, a, b) in found.items():
            assert (score, a, b) == want[n]
        for n in set(want) - set(found):  # only if a better one lies over it
            score, a, b = want[n]
            assert any(s > score and not (a >= x + y or x >= a + b) for s, x, y in found.values())


def test_scan(spark):
    rng = random.Random(2)
    rows = [
        (1, passage(rng) + "\nReleased under the MIT License.\n" + passage(rng)),
        (2, passage(rng) + " Licensed under CC BY-NC 4.0."),
        (3, passage(rng)),
        (4, "We license this under terms of a general public nature, version 3."),
        (5, "THIS WORK IS LICENSED UNDER THE GNU GENERAL PUBLIC LICENSE, VERSION 3."),
    ]
    found = {(r["doc_id"], r["license"]): r["score"] for r in licenses.scan(frame(spark, rows)).collect()}
    assert found == {(1, "MIT"): 1.0, (2, "CC-BY-NC-4.0"): 1.0, (5, "GPL-3.0"): 1.0}


def test_odd_and_empty_tables(spark):
    assert licenses.scan(odd(spark)).count() == 0
    assert licenses.scan(empty(spark)).count() == 0
    twice = frame(spark, [(None, "Released under the MIT License.")] * 2)
    assert licenses.scan(twice).count() == 2
