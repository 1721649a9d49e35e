"""Declared star of tables to one flat table.

The dimensions are widened first (card with its account and its member), so
the fact is shuffled once for each dimension it references itself, not once
for every table of the star.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starflat.operators.skew import HotKeys, SkewPolicy, find_hot_keys, salted_join


@dataclass(frozen=True)
class Link:
    """``child.foreign_key`` refers to ``parent.key``."""

    child: str
    foreign_key: str
    parent: str
    key: str
    how: str = "inner"


@dataclass(frozen=True)
class Output:
    """One column of the flat table, built from ``ref(table, column)`` columns."""

    name: str
    build: Callable[[Callable[[str, str], Column]], Column]


@dataclass(frozen=True)
class Derived:
    """A column added to a table before it is joined.

    For work that is done once per dimension row instead of once per fact row.
    """

    table: str
    name: str
    build: Callable[[], Column]


@dataclass(frozen=True)
class Star:
    fact: str
    links: tuple[Link, ...]
    outputs: tuple[Output, ...]
    derived: tuple[Derived, ...] = ()


def ref(table: str, column: str) -> Column:
    """A column of a joined star; columns carry their table name."""
    return F.col(_qualified(table, column))


def join_star(
    frames: Mapping[str, DataFrame],
    fact: str,
    links: Sequence[Link],
    skew: SkewPolicy | None = SkewPolicy(),
) -> DataFrame:
    """All tables of the star side by side, columns named ``table__column``.

    ``skew=None`` skips the search for hot keys.
    """

    def widened(table: str) -> DataFrame:
        frame = frames[table]
        wide = frame.select(*(frame[c].alias(_qualified(table, c)) for c in frame.columns))
        outgoing = [link for link in links if link.child == table]
        keys = list(dict.fromkeys(link.foreign_key for link in outgoing))
        hot = find_hot_keys(frame, keys, skew) if skew and keys else {}
        for link in outgoing:
            wide = salted_join(
                wide,
                widened(link.parent),
                _qualified(link.child, link.foreign_key),
                _qualified(link.parent, link.key),
                hot.get(link.foreign_key, HotKeys({})),
                link.how,
            )
        return wide

    return widened(fact)


def flatten(
    frames: Mapping[str, DataFrame],
    star: Star,
    skew: SkewPolicy | None = SkewPolicy(),
) -> DataFrame:
    """The flat table: one row per fact row that finds all its dimensions.

    The frame is lazy, but the search for hot keys runs now: one narrow job per
    table that refers to others.
    """
    return finish(join_needed(frames, star, skew), star)


def join_needed(
    frames: Mapping[str, DataFrame],
    star: Star,
    skew: SkewPolicy | None = SkewPolicy(),
) -> DataFrame:
    """The joined columns that the outputs are built from, for :func:`finish`.

    They are narrower than masked and hashed outputs: what stores or shuffles the joined rows
    takes these.
    """
    ready = dict(frames)
    for column in star.derived:
        ready[column.table] = ready[column.table].withColumn(column.name, column.build())
    joined = join_star(ready, star.fact, star.links, skew)
    needed: dict[str, None] = {}

    def noted(table: str, column: str) -> Column:
        needed[_qualified(table, column)] = None
        return ref(table, column)

    for out in star.outputs:
        out.build(noted)
    return joined.select(*needed)


def finish(joined: DataFrame, star: Star) -> DataFrame:
    """The outputs of the star from its joined columns."""
    return joined.select(*(out.build(ref).alias(out.name) for out in star.outputs))


def _qualified(table: str, column: str) -> str:
    return f"{table}__{column}"
