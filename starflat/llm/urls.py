"""URL filter: host and path rules, and gradient-boosted trees on lexical features for the rest."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starflat.llm.common import staged

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Labelled URLs that the trees are fitted on: at most so many of either verdict.
LABELLED_ROWS = 10_000
# Suffixes are counted in so many hash buckets, which bounds the table sent to every task.
SUFFIX_BUCKETS = 4096
# A suffix's share of blocked URLs counts this many URLs of the general share beside its own.
PRIOR_ROWS = 20
TREES, DEPTH, SEED = 20, 4, 13
BLOCK_FROM = 0.5


@dataclass(frozen=True)
class UrlRule:
    """URLs whose host is ``host`` or below it and whose path starts with ``path``."""

    verdict: str
    host: str
    path: str = "/"

    @property
    def name(self) -> str:
        return self.host + self.path

    def fits(self, host: Column, path: Column) -> Column:
        below = (host == self.host) | F.endswith(host, F.lit("." + self.host))
        return below & F.startswith(path, F.lit(self.path))


# Fixed values of the contract.
RULES = (
    UrlRule("allow", "org", "/"),
    UrlRule("block", "example.org", "/es/"),
    UrlRule("block", "example.org", "/en/1"),
    UrlRule("allow", "com", "/fr/"),
    UrlRule("block", "com", "/de/"),
)


def _rest(url: Column) -> Column:
    """What follows the first ``://``; empty without one."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3)).otherwise("")


def host_of(url: Column) -> Column:
    rest = F.regexp_extract(_rest(F.coalesce(url, F.lit(""))), r"^([^/?#]*)", 1)
    return F.translate(rest, UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(_rest(F.coalesce(url, F.lit(""))), r"^[^/?#]*([^?#]*)", 1)


def ruled(host: Column, path: Column, rules: Sequence[UrlRule], value: str) -> Column:
    """``name`` or ``verdict`` of the longest rule that fits, equally long ones in their given order; else NULL."""
    longest = sorted(rules, key=lambda rule: -len(rule.name))
    found = [F.when(rule.fits(host, path), F.lit(getattr(rule, value))) for rule in longest]
    return F.coalesce(*found, F.lit(None).cast("string"))


# -- lexical features --------------------------------------------------------------


def entropy(text: Column) -> Column:
    """Bits a character of the distribution of characters; 0 for an empty text. Sorted
    characters are read once, so effort grows with the length and no more."""
    letters = F.array_sort(F.filter(F.split(text, ""), lambda c: c != ""))
    n = F.size(letters).cast("double")
    weight = lambda run: run * F.log2(F.greatest(run, F.lit(1.0)))
    runs = F.aggregate(
        letters,
        F.struct(F.lit("").alias("letter"), F.lit(0.0).alias("run"), F.lit(0.0).alias("sum")),
        lambda s, c: F.when(
            s["letter"] == c, F.struct(c.alias("letter"), (s["run"] + 1).alias("run"), s["sum"].alias("sum"))
        ).otherwise(F.struct(c.alias("letter"), F.lit(1.0).alias("run"), (s["sum"] + weight(s["run"])).alias("sum"))),
        lambda s: s["sum"] + weight(s["run"]),
    )
    return F.when(n > 0, F.log2(n) - runs / n).otherwise(0.0)


def _share(text: Column, pattern: str) -> Column:
    n = F.char_length(text)
    kept = F.char_length(F.regexp_replace(text, pattern, ""))
    return F.when(n > 0, (n - kept) / n).otherwise(0.0)


def lexical(url: Column, host: Column, path: Column) -> dict[str, Column]:
    """Length, depth, digit ratio, entropy and parameter counts, from the characters alone."""
    whole = F.coalesce(url, F.lit(""))
    query = F.regexp_extract(whole, r"\?([^#]*)", 1)
    last = F.element_at(F.split(path, "/"), -1)
    return {
        "url_length": F.char_length(whole),
        "host_length": F.char_length(host),
        "path_length": F.char_length(path),
        "query_length": F.char_length(query),
        "host_labels": F.size(F.filter(F.split(host, r"\."), lambda x: x != "")),
        "path_depth": F.size(F.filter(F.split(path, "/"), lambda x: x != "")),
        "parameters": F.size(F.filter(F.split(query, "[&;]"), lambda x: x != "")),
        "host_digits": _share(host, "[0-9]"),
        "path_digits": _share(path, "[0-9]"),
        "host_marks": _share(host, "[-_]"),
        "last_length": F.char_length(last),
        "host_entropy": entropy(host),
        "path_entropy": entropy(path),
        "secure": F.startswith(whole, F.lit("https:")).cast("int"),
        "fragment": F.contains(whole, F.lit("#")).cast("int"),
    }


def suffixes(host: Column, path: Column) -> dict[str, Column]:
    """The ends by which URLs are counted: last label and last two labels of the host, and the path's extension."""
    return {
        "domain": F.substring_index(host, ".", -1),
        "site": F.substring_index(host, ".", -2),
        "extension": F.lower(F.regexp_extract(path, r"\.([A-Za-z0-9]{1,8})/?$", 1)),
    }


def _bucket(kind: str, suffix: Column) -> Column:
    return F.pmod(F.xxhash64(F.lit(kind), suffix), F.lit(SUFFIX_BUCKETS)).cast("int")


def described(pages: DataFrame, rules: Sequence[UrlRule]) -> DataFrame:
    """Host, path, rule and verdict of each URL, its lexical features and its suffix buckets."""
    url = F.col("url").cast("string")
    split = pages.select("page_id", url.alias("url"), host_of(url).alias("host"), path_of(url).alias("path"))
    host, path = F.col("host"), F.col("path")
    return split.select(
        "*",
        ruled(host, path, rules, "name").alias("rule"),
        ruled(host, path, rules, "verdict").alias("ruled"),
        *(c.cast("double").alias(f"x_{name}") for name, c in lexical(F.col("url"), host, path).items()),
        *(_bucket(kind, c).alias(f"b_{kind}") for kind, c in suffixes(host, path).items()),
    )


def suffix_counts(rows: DataFrame) -> DataFrame:
    """``(kind, bucket, rows, labelled, blocked)`` over all URLs; at most ``SUFFIX_BUCKETS`` rows a kind."""
    kinds = [c for c in rows.columns if c.startswith("b_")]
    each = F.array(*(F.struct(F.lit(c[2:]).alias("kind"), F.col(c).alias("bucket")) for c in kinds))
    blocked = F.col("ruled") == "block"
    return (
        rows.select(F.inline(each), "ruled")
        .groupBy("kind", "bucket")
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.count("ruled").alias("labelled"),
            F.count_if(blocked).alias("blocked"),
        )
    )


def with_statistics(rows: DataFrame, counts: DataFrame, general: float) -> DataFrame:
    """Adds how many URLs share a suffix and which share of the labelled ones is blocked."""
    for kind in [c[2:] for c in rows.columns if c.startswith("b_")]:
        share = (F.col("blocked") + PRIOR_ROWS * general) / (F.col("labelled") + PRIOR_ROWS)
        mine = counts.filter(F.col("kind") == kind).select(
            F.col("bucket").alias(f"b_{kind}"),
            F.log1p("rows").alias(f"x_{kind}_rows"),
            share.alias(f"x_{kind}_blocked"),
        )
        rows = rows.join(F.broadcast(mine), f"b_{kind}")
    return rows


def fit(rows: DataFrame, counts: DataFrame, general: float):
    """Boosted trees over at most ``LABELLED_ROWS`` URLs of either verdict, drawn by hash; a
    function from described rows to the same rows with ``score``."""
    drawn = [
        rows.filter(F.col("ruled") == verdict).orderBy(F.xxhash64("url", "page_id"), "url", "page_id").limit(LABELLED_ROWS)
        for verdict in ("allow", "block")
    ]
    label = (F.col("ruled") == "block").cast("double").alias("label")
    sample = staged(with_statistics(drawn[0].unionByName(drawn[1]), counts, general).select("*", label), "labelled")
    names = [c for c in sample.columns if c.startswith("x_")]
    assembler = VectorAssembler(inputCols=names, outputCol="features")
    trees = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, seed=SEED).fit(assembler.transform(sample.coalesce(1)))

    def scored(described_rows: DataFrame) -> DataFrame:
        ready = assembler.transform(with_statistics(described_rows, counts, general))
        return trees.transform(ready).withColumn("score", vector_to_array("probability")[1])

    return scored


def judge(pages: DataFrame, rules: Sequence[UrlRule] = RULES) -> DataFrame:
    """``(page_id, host, path, rule, verdict, score)`` for every row of ``pages``.

    The longest rule that fits decides; its name is ``rule``, and ``score`` is NULL.
    For all other URLs ``score`` is the probability of ``block`` by gradient-boosted
    trees, ``verdict`` is ``block`` from ``BLOCK_FROM`` on. The trees see lexical
    features only: lengths, depth, shares of digits, entropies, number of parameters,
    and how common and how often blocked the URL's suffixes are among all URLs.
    They are fitted on URLs that a rule labels, ``LABELLED_ROWS`` of either verdict.
    Rules are a list on the driver: they become one expression.

    A NULL URL, or one without ``://``, has an empty host and path and no rule; its
    features are those of an empty text, or of the text as it is. Where only one
    verdict or none is labelled, every score is the share of blocked labels (0
    without any). Very long URLs take time in proportion. Repeated rows stay rows;
    columns other than ``page_id`` and ``url`` do not matter; an empty table gives no rows.
    """
    rows = staged(described(pages, rules), "urls")
    counts = staged(suffix_counts(rows), "suffixes")
    labelled, blocked = rows.agg(F.count("ruled"), F.count_if(F.col("ruled") == "block")).first()
    general = blocked / labelled if labelled else 0.0
    open_ = rows.filter(F.col("ruled").isNull())
    if 0 < blocked < labelled:
        open_ = fit(rows, counts, general)(open_)
    else:
        open_ = open_.withColumn("score", F.lit(general))
    verdict = F.when(F.col("score") >= BLOCK_FROM, "block").otherwise("allow")
    columns = ["page_id", "host", "path", "rule"]
    decided = rows.filter(F.col("ruled").isNotNull())
    return decided.select(*columns, F.col("ruled").alias("verdict"), F.lit(None).cast("double").alias("score")).unionByName(
        open_.select(*columns, verdict.alias("verdict"), "score")
    )
