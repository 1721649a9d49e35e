from __future__ import annotations

import hashlib
import random
import re

from llm_data import empty, frame, odd, odd_rows

from starflat.llm import secrets

ASSIGN = re.compile(
    r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.A
)
ACCESS, HEX = re.compile("AKIA[A-Z0-9]+"), re.compile("[0-9a-f]+")


def base(text):
    text = text or ""
    found = [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    found += [(m.start(), 1, "access", m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= 16]
    found += [(m.start(), 2, "hex", m.end()) for m in HEX.finditer(text) if len(m[0]) >= 32]
    return sorted(found)


def listed(found):
    return ",".join(f"{kind}:{start}:{end}" for start, _, kind, end in found)


def random_text(rng):
    parts = [
        "token", "Token=", "pass", "password : ", "api_key='", "APIKEY\" = \"", "secret:", "=", " ", "é", "🙂",
        "AKIA", "AKIA0123456789AB", "0123456789abcdef" * 2, "abcdefgh", "x.y=z/q+1", "\u0001", "\u0002", "\n",
    ]
    return "".join(rng.choice(parts) for _ in range(rng.randrange(40)))


def test_base_spans_equal_brute_force(spark):
    rng = random.Random(1)
    rows = [(i, random_text(rng), f"s{rng.randrange(4)}") for i in range(400)]
    rows += [(1000 + i, t) for i, (_, t, *_) in enumerate(odd_rows())]
    found = {r["doc_id"]: r for r in secrets.digest(secrets.scan(frame(spark, rows))).collect()}
    assert len(found) == len(rows)
    for i, text, *_ in rows:
        want, row = base(text), found[i]
        assert row["base_sha256"] == hashlib.sha256(listed(want).encode()).hexdigest(), text
        assert [row["n_assign"], row["n_access"], row["n_hex"]] == [
            sum(s[1] == k for s in want) for k in range(3)
        ]
        kept = ",".join(s for s in row["spans"].split(",") if not s.startswith("bare"))
        assert kept == listed(want)


def test_owners_tell_copies_from_live_secrets(spark):
    copied, live, bare = "token=EXAMPLEKEY123", "token=ownvalue99", "Zq7" * 10
    rows = [(i, f"see {copied} here", f"owner{i}") for i in range(5)]
    rows += [(10 + i, live, "owner1") for i in range(30)]
    rows += [(50, f"x {bare} y", "owner2"), (51, "y " + "Aa1" * 9, "a"), (52, "Aa1" * 9, "b"), (53, "Aa1" * 9, "c")]
    found = {r["doc_id"]: r for r in secrets.digest(secrets.scan(frame(spark, rows))).collect()}
    assert found[0]["n_copied"] == 1 and found[0]["n_live"] == 0
    assert found[10]["n_copied"] == 0 and found[10]["n_live"] == 1
    assert found[50]["spans"] == "bare:2:32"
    assert found[51]["spans"] == "" and found[53]["spans"] == ""


def test_redaction(spark):
    rows = [(1, 'a token = "' + "0123456789abcdef" * 3 + '" b'), (2, "nothing"), (3, None), (None, "secret=abcdefghij")]
    rows += [(10 + i, "secret=commonvalue", f"o{i}") for i in range(3)]
    out = {r["doc_id"]: r for r in secrets.redact(frame(spark, rows)).collect()}
    assert len(out) == len(rows)
    assert out[1]["text"] == 'a <SECRET>" b' and out[1]["n_chars"] == len(out[1]["text"])
    assert out[2]["text"] == "nothing" and out[3]["text"] is None
    assert out[None]["text"] == "<SECRET>" and out[10]["text"] == "<EXAMPLE_SECRET>"


def test_odd_and_empty_tables(spark):
    df = odd(spark)
    assert secrets.scan(df).count() == len(odd_rows())
    again = secrets.redact(df)
    assert again.columns == df.columns and again.count() == len(odd_rows())
    assert secrets.digest(secrets.scan(empty(spark))).count() == 0
    assert secrets.redact(empty(spark)).count() == 0


def test_no_python_in_the_plan(spark):
    plan = secrets.digest(secrets.scan(odd(spark)))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan
