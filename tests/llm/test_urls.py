"""URL rules against a plain reading, features against Python, and trees on held-out URLs."""

from __future__ import annotations

import math
import random
from collections import Counter

from llm_data import SF
from pyspark.sql import functions as F

from starflat.llm import queries, urls

SCHEMA = "page_id LONG, url STRING, html STRING, host STRING, score STRING, bucket INT, label STRING, features STRING"


def frame(spark, texts):
    return spark.createDataFrame([(i, u, None, "h", "s", 1, "l", "f") for i, u in enumerate(texts)], SCHEMA)


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    at = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host, path = rest[:at], rest[at:]
    end = min([path.find(c) for c in "?#" if c in path], default=len(path))
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    return lower, path[:end]


def plain_rule(url):
    host, path = parts(url)
    fits = [
        r for r in urls.RULES
        if ("." + host).endswith("." + r.host) and path.startswith(r.path)
    ]
    best = max(fits, key=lambda r: len(r.name), default=None)
    return (host, path, best.name if best else None, best.verdict if best else None)


ODD = [
    None, "", "no scheme", "://", "http://", "http://a.org", "http://A.ORG/", "http://a.org/?q=://b.com/de/", "http://xorg/",
    "http://org/x", "http://example.org/es/1", "http://EXAMPLE.org/en/12", "http://a.example.org/en/2", "http://notexample.org/es/",
    "http://a.com/de/x#f", "http://a.com/DE/x", "http://a.com?x=/de/", "http://a.com#/de/", "http://a.com:80/de/", "http://u@a.com/de/",
    "http://ÄÖ.com/de/ü", "http://a.com/fr/\n/x", "ftp://com/fr/", "http://.com/fr/", "http://a.com/fr", "x://y://z.org/",
    "http://a.net/en/1?" + "p=1&" * 20_000, "http://a.net/" + "ab/" * 30_000, " http://a.org/ ",
]


def test_rules_equal_a_plain_reading(spark):
    got = urls.judge(frame(spark, ODD)).collect()
    assert len(got) == len(ODD)
    for row in got:
        host, path, rule, verdict = plain_rule(ODD[row["page_id"]])
        assert (row["host"], row["path"], row["rule"]) == (host, path, rule), ODD[row["page_id"]]
        assert row["verdict"] == verdict if rule else row["verdict"] in ("allow", "block")
        assert (row["score"] is None) == (rule is not None)


def test_every_given_page(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    got = {r["page_id"]: r for r in queries.op13_urls(spark, SF).collect()}
    given = pages.select("page_id", "url").collect()
    assert len(got) == len(given)
    for page in given:
        row, (host, path, rule, verdict) = got[page["page_id"]], plain_rule(page["url"])
        assert (row["host"], row["path"], row["rule"]) == (host, path, rule)
        assert rule is None or row["verdict"] == verdict


def test_lexical_features(spark):
    texts = ["https://a1-b.Sub.net/x12/y.html?a=1&b=2;c#z", "http://n.net/aab", None, "://", "http://日本.net/日日本"]
    rows = urls.described(frame(spark, texts), urls.RULES).orderBy("page_id").collect()

    def bits(text):
        n = len(text)
        return -sum(k / n * math.log2(k / n) for k in Counter(text).values()) if n else 0.0

    for row, text in zip(rows, texts):
        host, path = parts(text)
        assert row["x_host_length"] == len(host) and row["x_path_length"] == len(path)
        assert math.isclose(row["x_host_entropy"], bits(host), abs_tol=1e-9)
        assert math.isclose(row["x_path_entropy"], bits(path), abs_tol=1e-9)
    first = rows[0]
    assert (first["x_parameters"], first["x_path_depth"], first["x_host_labels"]) == (3, 2, 3)
    assert math.isclose(first["x_path_digits"], 2 / 11) and first["x_secure"] == first["x_fragment"] == 1


def spam(rng):
    host = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz0123456789-") for _ in range(22))
    path = "/".join("".join(rng.choice("0123456789abcdef") for _ in range(12)) for _ in range(5))
    return host, path + "?" + "&".join(f"k{i}={rng.randrange(10**6)}" for i in range(6))


def plain(rng):
    words = ["news", "garden", "music", "city", "river", "book"]
    return rng.choice(words) + rng.choice(words), rng.choice(words) + "/" + rng.choice(words)


def test_trees_judge_unlabelled_urls(spark):
    """Rules label .test hosts; the same kinds of URL below .net, which no rule knows, are judged by their shape."""
    rng = random.Random(8)
    rules = (urls.UrlRule("block", "test", "/b/"), urls.UrlRule("allow", "test", "/a/"))
    texts, bad = [], []
    for i in range(1200):
        is_bad = i % 3 == 0
        host, path = spam(rng) if is_bad else plain(rng)
        labelled = i % 2 == 0
        texts.append(f"http://{host}.test/{'b' if is_bad else 'a'}/{path}" if labelled else f"http://{host}.net/c/{path}")
        bad.append(is_bad)
    held_out = urls.judge(frame(spark, texts), rules).filter("rule IS NULL").collect()
    right = sum((r["verdict"] == "block") == bad[r["page_id"]] for r in held_out)
    assert len(held_out) == 600 and right >= 0.95 * 600
    assert all(0 <= r["score"] <= 1 for r in held_out)
    again = urls.judge(frame(spark, texts), rules).filter("rule IS NULL").collect()
    assert {r["page_id"]: r["score"] for r in again} == {r["page_id"]: r["score"] for r in held_out}


def test_one_or_no_verdict_labelled(spark):
    none = urls.judge(frame(spark, ["http://a.net/", None])).collect()
    assert {(r["verdict"], r["score"]) for r in none} == {("allow", 0.0)}
    blocked = urls.judge(frame(spark, ["http://a.com/de/", "http://a.net/", "http://a.net/"])).collect()
    assert sorted((r["verdict"], r["rule"]) for r in blocked if r["rule"] is None) == [("block", None)] * 2


def test_statistics_count_all_rows(spark):
    rows = urls.described(frame(spark, ["http://a.com/de/x.html"] * 30 + ["http://b.com/fr/y"] * 10), urls.RULES)
    counts = urls.suffix_counts(rows).filter(F.col("kind") == "domain").collect()
    assert [(r["rows"], r["labelled"], r["blocked"]) for r in counts] == [(40, 40, 30)]


def test_empty_table(spark):
    assert urls.judge(frame(spark, [])).collect() == []


def test_longest_rule_wins_and_ties_go_to_the_first(spark):
    rules = (urls.UrlRule("block", "a.b", "/x"), urls.UrlRule("allow", "b", "/xyz"), urls.UrlRule("allow", "b", "/x/"))
    got = urls.judge(frame(spark, ["http://a.b/xyz", "http://a.b/x/", "http://c.b/x/1", "http://c.b/q"]), rules).collect()
    assert [r["rule"] for r in sorted(got, key=lambda r: r["page_id"])] == ["a.b/x", "a.b/x", "b/x/", None]
