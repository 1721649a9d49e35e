"""Secrets in texts, told apart by how many owners share them, in SQL functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starflat.llm.common import fresh, staged

# The patterns of the three base kinds, in their order.
ASSIGN = (
    r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
KINDS = ("assign", "access", "hex")
PATTERNS = {
    "assign": ASSIGN,
    # A run is matched whole, so a shorter match never hides a longer one:
    # the least lengths (16 and 32) can stand in the patterns.
    "access": r"AKIA[A-Z0-9]{12,}",
    "hex": r"[0-9a-f]{32,}",
    # The method's own kind: a long token of mixed characters without any name.
    "bare": r"[A-Za-z0-9+/_-]{20,}",
}
MIN_VALUE = 8
COPIED_FROM = 3

_SPAN = "array<struct<start:bigint,rank:int,kind:string,end:bigint,value:string>>"


def _spans(kind: str) -> Column:
    """All leftmost non-overlapping matches of a kind, as structs with places in code points.

    A marker goes before and after each match; between the markers, lengths add
    up to places. ``plain`` is the text with any such markers of its own
    replaced by another control character, which no pattern takes in.
    """
    pattern = PATTERNS[kind]
    rank = [*KINDS, "bare"].index(kind)
    marked = F.split(F.regexp_replace("plain", f"(?:{pattern})", "\u0001$0\u0002"), "\u0001")
    start = F.struct(
        F.char_length(F.element_at(marked, 1)).cast("long").alias("at"),
        F.array().cast(_SPAN).alias("found"),
    )

    def add(state: Column, part: Column) -> Column:
        match = F.substring_index(part, "\u0002", 1)
        end = state["at"] + F.char_length(match)
        value = F.regexp_extract(match, f"^{pattern}$", 2) if kind == "assign" else match
        span = F.struct(
            state["at"].alias("start"),
            F.lit(rank).alias("rank"),
            F.lit(kind).alias("kind"),
            end.cast("long").alias("end"),
            value.alias("value"),
        )
        after = state["at"] + F.char_length(part) - 1
        return F.struct(after.cast("long").alias("at"), F.concat(state["found"], F.array(span)).alias("found"))

    rest = F.slice(marked, 2, F.greatest(F.size(marked) - 1, F.lit(0)))
    found = F.aggregate(rest, start, add, lambda state: state["found"])
    if kind == "assign":
        found = F.filter(found, lambda s: F.char_length(s["value"]) >= MIN_VALUE)
    if kind == "bare":
        found = F.filter(
            found,
            lambda s: s["value"].rlike("[0-9]") & s["value"].rlike("[a-z]") & s["value"].rlike("[A-Z]"),
        )
    return F.when(F.col("plain").rlike(pattern), found).otherwise(F.array().cast(_SPAN))


def candidates(docs: DataFrame, owner: str, repository: list[str]) -> DataFrame:
    """One row per document: a row number, its owner and repository, and all candidate spans."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    unknown = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    narrow = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col("doc_id").cast("long").alias("doc_id"),
        unknown(owner).alias("owner"),
        F.to_json(F.array(*map(unknown, repository))).alias("repository"),
        F.translate(text, "\u0001\u0002", "\u0003\u0003").alias("plain"),
    )
    found = narrow.select(
        "row", "doc_id", "owner", "repository", *[_spans(kind).alias(kind) for kind in PATTERNS]
    )
    base = F.concat(*[F.col(kind) for kind in KINDS])
    # A bare token that touches a base span is that secret again.
    bare = F.filter(
        "bare",
        lambda b: ~F.exists(base, lambda s: (s["start"] < b["end"]) & (b["start"] < s["end"])),
    )
    hashed = F.transform(
        F.array_sort(F.concat(base, bare)),
        lambda s: F.struct(
            s["start"].alias("start"), s["rank"].alias("rank"), s["kind"].alias("kind"),
            s["end"].alias("end"), F.sha2(s["value"], 256).alias("hash"),
        ),
    )
    return found.select("row", "doc_id", "owner", "repository", hashed.alias("spans"))


def ownership(found: DataFrame) -> DataFrame:
    """``(hash, owners, repositories, places)`` of every candidate of the corpus.

    Copies within an owner's repository meet in the first aggregate, which runs
    before the shuffle, so a secret in a third of all rows sends a few rows.
    """
    spread = (
        found.select("owner", "repository", F.explode("spans").alias("s"))
        .groupBy(F.col("s.hash").alias("hash"), "owner", "repository")
        .agg(F.count(F.lit(1)).alias("places"))
    )
    owners = spread.groupBy("hash", "owner").agg(
        F.count(F.lit(1)).alias("repositories"), F.sum("places").alias("places")
    )
    return owners.groupBy("hash").agg(
        F.count(F.lit(1)).alias("owners"),
        F.sum("repositories").alias("repositories"),
        F.sum("places").alias("places"),
    )


def scan(
    docs: DataFrame,
    owner: str = "source",
    repository: tuple[str, ...] = ("source", "lang"),
    copied_from: int = COPIED_FROM,
) -> DataFrame:
    """Every document with the secrets found in its whole text.

    Values are hashed and counted over the corpus by distinct owners and
    repositories. A value that ``copied_from`` owners or more share is a widely
    copied example (``copied``), any other looks live. Spans of the base kinds
    always stay; unnamed tokens (``bare``) are added where they look live only.

    Gives ``row`` (a number of the row), ``doc_id`` and ``spans``: structs of
    ``start``, ``rank``, ``kind``, ``end`` (code points, end exclusive), ``hash``,
    ``owners``, ``repositories`` and ``copied``, in order of start, then kind.
    NULL texts are empty; a NULL owner counts as one unknown owner; rows with
    NULL or repeated ids are kept apart; an empty table gives no rows.
    """
    found = staged(candidates(docs, owner, list(repository)), "secret-spans")
    frequency = ownership(found)
    spans = found.select("row", F.explode("spans").alias("s")).select("row", "s.*")
    judged = spans.join(frequency, "hash").withColumn("copied", F.col("owners") >= copied_from)
    kept = judged.filter("kind <> 'bare' OR NOT copied")
    members = ["start", "rank", "kind", "end", "hash", "owners", "repositories", "copied"]
    of_row = kept.groupBy("row").agg(F.array_sort(F.collect_list(F.struct(*members))).alias("kept"))
    rows = found.select("row", "doc_id").join(of_row, "row", "left")
    nothing = F.from_json(F.lit("[]"), of_row.schema["kept"].dataType)
    return rows.select("row", "doc_id", F.coalesce("kept", nothing).alias("spans"))


def digest(scanned: DataFrame) -> DataFrame:
    """The counts and span lists of a scan, as text."""

    def listed(spans: Column) -> Column:
        return F.array_join(
            F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
        )

    def number(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"] != "bare")
    return scanned.select(
        "doc_id",
        *[number(kind) for kind in KINDS],
        F.sha2(listed(base), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
        number("bare"),
        F.size(F.filter("spans", lambda s: s["copied"])).cast("long").alias("n_copied"),
        F.size(F.filter("spans", lambda s: ~s["copied"])).cast("long").alias("n_live"),
    )


def redact(docs: DataFrame, live: str = "<SECRET>", copied: str = "<EXAMPLE_SECRET>", **options) -> DataFrame:
    """``docs`` with each found span replaced; every row and column stays.

    Overlapping spans are replaced together, as live if one of them is.
    ``n_chars``, where there is one, follows the new text. Only rows with some
    candidate are written aside, numbered and joined; all others pass as they are.
    """
    anything = "|".join(f"(?:{p})" for p in PATTERNS.values())
    some = F.coalesce(F.col("text").cast("string").rlike(anything), F.lit(False))
    row, spans = fresh(docs, "secret_row"), fresh(docs, "secret_spans")
    rows = staged(docs.filter(some).withColumn(row, F.monotonically_increasing_id()), "secret-docs")
    found = scan(rows.withColumn("doc_id", F.col(row)), **options).select(
        F.col("doc_id").alias(row), F.col("spans").alias(spans)
    )
    text = F.col("text").cast("string")

    def merge(done: Column, s: Column) -> Column:
        last = F.element_at(done, -1)
        one = F.array(F.struct(s["start"].alias("start"), s["end"].alias("end"), s["copied"].alias("copied")))
        wider = F.array(
            F.struct(
                last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end"),
                (last["copied"] & s["copied"]).alias("copied"),
            )
        )
        return (
            F.when(F.size(done) == 0, one)
            .when(s["start"] < last["end"], F.concat(F.slice(done, 1, F.size(done) - 1), wider))
            .otherwise(F.concat(done, one))
        )

    nothing = F.array().cast("array<struct<start:bigint,end:bigint,copied:boolean>>")
    merged = F.aggregate(spans, nothing, merge)

    def write(state: Column, s: Column) -> Column:
        before = F.substring(text, (state["at"] + 1).cast("int"), (s["start"] - state["at"]).cast("int"))
        mark = F.when(s["copied"], copied).otherwise(live)
        return F.struct(s["end"].alias("at"), F.concat(state["out"], before, mark).alias("out"))

    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))
    def rest(state: Column) -> Column:
        tail = F.substring(text, (state["at"] + 1).cast("int"), F.char_length(text))
        return F.concat(state["out"], tail)

    clean = F.when(F.size(spans) > 0, F.aggregate(merged, start, write, rest)).otherwise(text)
    out = rows.join(found, row).withColumn("text", clean)
    if "n_chars" in docs.columns:
        length = F.char_length("text").cast(docs.schema["n_chars"].dataType)
        out = out.withColumn("n_chars", F.when(F.size(spans) > 0, length).otherwise(F.col("n_chars")))
    return docs.filter(~some).unionByName(out.select(*docs.columns))
