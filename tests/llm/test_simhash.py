from __future__ import annotations

import random

import numpy as np
import xxhash
from llm_data import empty, frame, odd, odd_rows, passage

from starflat.llm import simhash
from starflat.llm.common import signed
from starflat.llm.components import components


def slow_fingerprint(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    words, word = [], ""
    for c in lower + " ":
        if c in " \t\n\x0b\x0c\r":
            if word:
                words.append(word)
            word = ""
        else:
            word += c
    if not words:
        return 0
    shingles = [" ".join(words)] if len(words) < 3 else [" ".join(words[i : i + 3]) for i in range(len(words) - 2)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(values):
    values = sorted(set(values))
    root = {v: v for v in values}

    def find(v):
        while root[v] != v:
            root[v] = root[root[v]]
            v = root[v]
        return v

    for i, a in enumerate(values):
        for b in values[i + 1 :]:
            if (a ^ b).bit_count() <= 2:
                root[find(b)] = find(a)
    return {v: find(v) for v in values}


def check(rows, texts):
    prints = [slow_fingerprint(t or "") for _, t in texts]
    root = slow_components(prints)
    least = {}
    for (i, _), p in zip(texts, prints):
        if i is not None:
            least[root[p]] = min(least.get(root[p], i), i)
    want = sorted((str(i), f"{p:016x}", str(least.get(root[p]))) for (i, _), p in zip(texts, prints))
    assert sorted((str(r["doc_id"]), r["fingerprint"], str(r["component_id"])) for r in rows) == want


def test_equals_brute_force(spark):
    rng = random.Random(2)
    texts = []
    for i in range(60):
        words = passage(rng, 5).split()
        texts.append((len(texts), " ".join(words)))
        for _ in range(rng.randrange(5)):
            changed = list(words)
            changed[rng.randrange(len(words))] = "changed"
            texts.append((len(texts), " ".join(changed)))
    texts += [(500 + i, "a b") for i in range(20)]
    check(simhash.near_duplicates(frame(spark, texts)).collect(), texts)


def test_odd_and_empty_tables(spark):
    texts = [(r[0], r[1]) for r in odd_rows()]
    check(simhash.near_duplicates(odd(spark)).collect(), texts)
    assert simhash.near_duplicates(empty(spark)).count() == 0
    kept = simhash.drop_near_duplicates(odd(spark))
    assert kept.columns == odd(spark).columns
    prints = slow_components([slow_fingerprint(t or "") for _, t in texts])
    assert kept.count() == len(set(prints.values()))
    assert simhash.drop_near_duplicates(empty(spark)).count() == 0


def test_links_of_a_group_beyond_the_limit(spark, monkeypatch):
    """Thousands of fingerprints around one: keys are split, no component falls apart."""
    monkeypatch.setattr(simhash, "GROUP_ROWS", 50)
    rng = random.Random(3)
    centre = rng.getrandbits(64)
    values = {centre}
    while len(values) < 600:
        v = rng.choice(list(values)) if rng.random() < 0.5 else centre
        values.add(v ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)))
    values |= {rng.getrandbits(64) for _ in range(300)}
    nodes = spark.createDataFrame([(signed(v),) for v in values], "fp LONG")
    found = simhash.links(nodes).collect()
    root = {v: v for v in values}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    for r in found:
        a, b = r["a"] % (1 << 64), r["b"] % (1 << 64)
        root[find(a)] = find(b)
    want = slow_components(values)
    groups = lambda f: {frozenset(v for v in values if f(v) == r) for r in {f(v) for v in values}}
    assert groups(find) == groups(want.get)


def test_pivots_lose_no_pair():
    rng = np.random.default_rng(4)
    values = rng.integers(0, 1 << 63, 300, dtype=np.uint64)
    near = values[:100] ^ (np.uint64(1) << rng.integers(0, 63, 100, dtype=np.uint64))
    values = np.unique(np.concatenate([values, near]))
    a, b = simhash.close_pairs(values, simhash.pivot_table(values))
    found = {frozenset(p) for p in zip(a.tolist(), b.tolist())}
    want = {
        frozenset((i, j)) for i in range(len(values)) for j in range(i + 1, len(values))
        if int(values[i] ^ values[j]).bit_count() <= 2
    }
    assert found == want


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(200)]
    star = [(1000, 1000 + i) for i in range(1, 300)]
    links = spark.createDataFrame(chain + star + [(5, 5), (7, 3)], "a LONG, b LONG")
    found = {r["node"]: r["root"] for r in components(links).collect()}
    assert found == {**{i: 0 for i in range(201)}, **{1000 + i: 1000 for i in range(300)}}
    assert components(links.filter("a < 0")).count() == 0


def jaccard(x, y):
    sets = [{tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} for w in (x.lower().split(), y.lower().split())]
    return len(sets[0] & sets[1]) / len(sets[0] | sets[1])


def kept_by_brute_force(texts):
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            if jaccard(texts[i], texts[j]) >= 0.8:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i for i in range(len(texts)) if find(i) == i}


def planted(rng):
    """Texts with copies that differ in some words, also copies of copies."""
    texts = []
    for _ in range(40):
        words = passage(rng, 22).split()
        texts.append(" ".join(words))
        for _ in range(rng.randrange(1, 4)):
            source = rng.choice([words, texts[-1].split()])
            copy = list(source)
            for _ in range(rng.randrange(1, 9)):
                copy[rng.randrange(len(copy))] = "changed%d" % rng.randrange(99)
            texts.append(" ".join(copy))
    return texts


def test_near_copies_go(spark):
    texts = planted(random.Random(6))
    want = kept_by_brute_force(texts)
    assert len(texts) - len(want) > 25
    kept = simhash.drop_similar(frame(spark, list(enumerate(texts))))
    assert {r["doc_id"] for r in kept.collect()} == want
    by_prints = simhash.drop_near_duplicates(frame(spark, list(enumerate(texts))))
    assert by_prints.count() > len(want) + 20


def test_the_stage_drops_near_copies(spark, tmp_path):
    import corpus_pipeline

    texts = planted(random.Random(7))
    kept = corpus_pipeline.drop_near_duplicates(spark, frame(spark, list(enumerate(texts))), str(tmp_path))
    assert {r["doc_id"] for r in kept.collect()} == kept_by_brute_force(texts)


def test_large_keys_are_cut_into_cells(spark, monkeypatch):
    monkeypatch.setattr(simhash, "GROUP_ROWS", 7)
    texts = planted(random.Random(8))
    kept = simhash.drop_similar(frame(spark, list(enumerate(texts))))
    assert {r["doc_id"] for r in kept.collect()} == kept_by_brute_force(texts)


def test_rows_do_not_grow_with_the_pairs_of_a_group(spark, monkeypatch):
    """Texts just too different for a link: all pairs are compared, no row a pair is written."""
    rng = random.Random(9)
    words = passage(rng, 60).split()[:400]
    texts = []
    for i in range(120):
        copy = list(words)
        for place in rng.sample(range(len(copy)), 6):
            copy[place] = f"changed{i}"
        texts.append(" ".join(copy))
    assert jaccard(texts[0], texts[1]) < 0.8
    written, plain = {}, simhash.staged

    def counted(df, name):
        kept = plain(df, name)
        written[name] = max(written.get(name, 0), kept.count())
        return kept

    monkeypatch.setattr(simhash, "staged", counted)
    kept = simhash.drop_similar(frame(spark, list(enumerate(texts))))
    assert {r["doc_id"] for r in kept.collect()} == kept_by_brute_force(texts)
    memberships = written.pop("similar-memberships")
    assert memberships <= simhash.BANDS * len(texts)
    assert all(n <= len(texts) for n in written.values())


def test_similar_documents_of_odd_and_empty_tables(spark):
    kept = simhash.drop_similar(odd(spark))
    assert kept.columns == odd(spark).columns
    words = {tuple((r[1] or "").lower().encode().split()) for r in odd_rows()}
    assert kept.count() == len(words)
    assert simhash.drop_similar(empty(spark)).count() == 0
