from __future__ import annotations

from starflat.operators.constraints import (
    Agreement,
    Domain,
    ForeignKey,
    NotNull,
    Rule,
    Unique,
    constraint_report,
)
from starflat.plans import bank


def report(frames, *constraints):
    rows = constraint_report(frames, constraints).collect()
    return {r["constraint_name"]: r["violations"] for r in rows}


def test_sound_tables_have_no_violations(tiny):
    found = constraint_report(tiny, bank.constraints()).collect()
    broken = {(r["table_name"], r["constraint_name"]) for r in found if r["violations"]}
    # The tiny accounts have their own type names.
    assert broken == {("account", "domain(account_type)")}
    assert len(found) == len(bank.constraints())


def test_violations_are_counted(spark):
    frames = {
        "t": spark.createDataFrame(
            [(1, "a", 5), (1, "b", -1), (2, None, None), (None, "x", 7), (None, "a", 0)],
            "id INT, kind STRING, n INT",
        ),
        "p": spark.createDataFrame([(5, 2), (7, 7)], "key INT, owner INT"),
    }
    assert report(
        frames,
        NotNull("t", "kind"),
        Rule("t", "n", "n > 0"),
        Domain("t", "kind", ("a", "b")),
        Unique("t", ("id",)),
        ForeignKey("t", "n", "p", "key"),
        Agreement("t", "id", "n", "p", "key", "owner"),
    ) == {
        "not_null(kind)": 1,
        "check(n)": 2,
        "domain(kind)": 1,
        "unique(id)": 1,
        "foreign_key(n)": 2,
        "agreement(id,p.owner)": 1,
    }


def test_holder_is_not_the_account_owner(tiny):
    card = tiny["card"].replace({3: 1}, subset=["account_id"])
    agreement = [c for c in bank.constraints() if isinstance(c, Agreement)]
    assert report({**tiny, "card": card}, *agreement) == {
        "agreement(holder_id,account.owner_id)": 1
    }
    assert report(tiny, *agreement) == {"agreement(holder_id,account.owner_id)": 0}


def test_empty_tables(spark):
    frames = {"t": spark.createDataFrame([], "id INT")}
    assert report(frames, NotNull("t", "id"), Unique("t", ("id",))) == {
        "not_null(id)": 0,
        "unique(id)": 0,
    }
