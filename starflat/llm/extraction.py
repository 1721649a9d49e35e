"""Main text of web pages by scoring the element tree."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starflat.llm.common import byte_rows

# Elements that begin and end a block of text.
BLOCKS = frozenset(
    """address article aside blockquote body caption center dd details dialog dir div dl dt fieldset
    figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav
    ol optgroup option p pre section summary table tbody td tfoot th thead tr ul""".split()
)
VOID = frozenset({"hr"})
# What an element of the key closes when it begins, up to the elements of the value.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"optgroup"}),
}
# Elements whose content is never text of the page; the first ones run to the end if open.
SKIPPED = r"script|style|title|textarea"
SKIPPED_IF_CLOSED = r"noscript|template|select|button|svg|iframe|object|audio|video|canvas|head"
MARKUP = re.compile(
    rf"<!--.*?(?:-->|$)"
    rf"|<({SKIPPED})\b[^>]*>.*?(?:</\1\s*>|$)"
    rf"|<({SKIPPED_IF_CLOSED})\b[^>]*>.*?</\2\s*>"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|</?([a-zA-Z][^\s/>]*)[^>]*(?:>|$)"
    r"|<[!?/][^>]*(?:>|$)",
    re.S | re.I,
)
ATTRIBUTE = re.compile(r"([a-zA-Z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+")

# Parts of a page that are not its article, by element, role, or word in class or id.
OTHER_ELEMENTS = frozenset({"nav", "footer", "aside", "form", "menu", "dialog", "header", "fieldset"})
OTHER_ROLES = frozenset(
    "navigation banner contentinfo complementary search dialog alert alertdialog form menu menubar toolbar".split()
)
OTHER_WORDS = frozenset(
    """nav navbar navigation menu sidebar sidenav footer header masthead breadcrumb breadcrumbs ad ads
    adv advert adverts advertisement advertising adsense banner sponsor sponsored promo promoted
    promotion cookie cookies consent gdpr notice notices alert newsletter subscribe subscription
    signup login comment comments commentlist disqus reply replies respond discussion social share
    sharing related recommended popup modal overlay toolbar pagination pager skip form hidden
    offscreen topbar""".split()
)
COMMENT_WORDS = frozenset("comment comments reply replies respond discussion".split())
ARTICLE_OUT = COMMENT_WORDS | frozenset(
    "ad ads advert advertisement sponsor sponsored promo promoted related recommended teaser".split()
)
# "has-sidebar" names what a container holds, not what it is.
NAMES_ANOTHER = frozenset({"has", "with", "no", "without", "is", "not"})
KEPT_ELEMENTS = frozenset({"html", "body", "main"})
HEADINGS = frozenset({"h1", "h2", "h3", "h4", "h5", "h6"})

SIBLING_SHARE = 0.2
MENU_LINKS, MENU_DENSITY = 3, 0.8


class Node:
    """An element that holds blocks: its scores and what it contains."""

    __slots__ = ("tag", "parent", "depth", "kind", "out", "inside", "points", "chars", "linked", "links")

    def __init__(self, tag: str, parent: Node | None, kind: str, out: bool, inside: bool) -> None:
        self.tag, self.parent, self.kind, self.out, self.inside = tag, parent, kind, out, inside
        self.depth = parent.depth + 1 if parent else 0
        self.points, self.chars, self.linked, self.links = 0.0, 0, 0, 0

    def density(self) -> float:
        return self.linked / self.chars if self.chars else 0.0

    def score(self) -> float:
        return self.points * (1 - self.density())


def _other(tag: str, attributes: str, in_article: bool) -> tuple[bool, str]:
    """Whether an element with its attributes is no part of an article, and its class words."""
    if not attributes.strip():
        return tag in OTHER_ELEMENTS and not (tag == "header" and in_article), ""
    found = {
        m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in ATTRIBUTE.finditer(attributes)
    }
    named = f"{found.get('class', '')} {found.get('id', '')}"
    if found.get("itemprop", "").lower() == "articlebody":
        return False, "articlebody"
    if tag in KEPT_ELEMENTS:
        return False, named
    if found.get("aria-hidden") == "true" or re.search(r"(?:^|\s)hidden(?:\s|$|=)", re.sub(r"\"[^\"]*\"|'[^']*'", "", attributes)):
        return True, named
    if re.search(r"display\s*:\s*none", found.get("style", ""), re.I):
        return True, named
    words: set[str] = set()
    for name in named.split():
        parts = [w.lower() for w in WORD.findall(name)]
        words.update(w for i, w in enumerate(parts) if i == 0 or parts[i - 1] not in NAMES_ANOTHER)
    if tag == "article":
        return bool(words & ARTICLE_OUT), named
    out = found.get("role", "").lower() in OTHER_ROLES or bool(words & OTHER_WORDS)
    if tag in HEADINGS or (tag == "header" and in_article):
        return bool(words & (OTHER_WORDS - {"header", "banner"})), named
    return out or tag in OTHER_ELEMENTS, named


def parse(page: str) -> list[tuple[Node, str, int]]:
    """The page's blocks in order: holding element, text, and characters of it in links."""
    root = Node("html", None, "", False, False)
    node, blocks = root, []
    runs: list[str] = []
    linked: list[str] = []
    in_link = False

    def flush() -> None:
        text = " ".join("".join(runs).split())
        if text:
            inside = min(len(" ".join("".join(linked).split())), len(text))
            blocks.append((node, text, inside))
        runs.clear()
        linked.clear()

    def run(raw: str) -> None:
        if raw:
            text = html.unescape(raw) if "&" in raw else raw
            runs.append(text)
            if in_link:
                linked.append(text)

    at = 0
    for m in MARKUP.finditer(page):
        run(page[at : m.start()])
        at = m.end()
        name = m[4] or m[6]
        if not name:
            if m[1] or m[2]:  # skipped content separates words
                runs.append(" ")
            continue
        tag = name.lower()
        closing = m[3] == "/" or page.startswith("</", m.start())
        if tag == "a":
            in_link = not closing
            if in_link:
                node.links += 1
        elif tag == "br":
            runs.append(" ")
        elif tag in BLOCKS:
            flush()
            in_link = False
            if closing:
                node = _close(node, tag)
                continue
            while node.tag == "p":
                node = node.parent
            if tag in CLOSES:
                node = _close_before(node, *CLOSES[tag])
            elif tag in HEADINGS and node.tag in HEADINGS:
                node = node.parent
            if tag in VOID or tag == "html" or (tag == "body" and node is root):
                continue
            out, kind = _other(tag, m[5] or "", node.inside)
            node = Node(tag, node, kind, node.out or out, node.inside or tag in ("article", "main"))
    run(page[at:])
    flush()
    return blocks


def _close(node: Node, tag: str) -> Node:
    """The parent of the nearest open element of a name; without one nothing closes."""
    at = node
    while at.parent is not None:
        if at.tag == tag:
            return at.parent
        if tag == "p":  # only an innermost paragraph can end here
            return node
        at = at.parent
    return node


def _close_before(node: Node, closed: set[str], within: set[str]) -> Node:
    at = node
    while at.parent is not None and at.tag not in within:
        if at.tag in closed:
            return at.parent
        at = at.parent
    return node


def main_text(page: str) -> str:
    """The article of a page, one block a line."""
    blocks = parse(page)
    kept = [b for b in blocks if not b[0].out]
    if not kept:
        return ""
    _score(kept)
    best = _best(kept)
    chosen = _with_siblings(best, kept)
    lines = []
    for node, text, _ in kept:
        at = node
        menu = False
        while at is not None and at not in chosen:
            if at.tag != "p" and at.links >= MENU_LINKS and at.density() >= MENU_DENSITY:
                menu = True
            at = at.parent
        if at is not None and not menu:
            if node.tag in HEADINGS or not _in_header(node):
                lines.append(text)
    return "\n".join(lines)


def _in_header(node: Node | None) -> bool:
    """An article's own header gives its headings only."""
    while node is not None:
        if node.tag == "header":
            return True
        node = node.parent
    return False


def _score(blocks: list[tuple[Node, str, int]]) -> None:
    """Paragraphs pass points for length and commas to their ancestors, less with distance."""
    for node, text, linked in blocks:
        points = 1 + text.count(",") + len(text) / 100
        holder = node.parent if node.tag in ("p", "pre", *HEADINGS) and node.parent else node
        at: Node | None = node
        links = node.links
        while at is not None:
            at.chars += len(text)
            at.linked += linked
            if at is not node:
                at.links += links
            up = holder.depth - at.depth
            if up >= 0:
                at.points += points / (1 if up == 0 else 2 if up == 1 else 3 * up)
            at = at.parent
        node.links = links


def _best(blocks: list[tuple[Node, str, int]]) -> Node:
    """The container with the best score, or the article that it is a part of."""
    nodes: dict[int, Node] = {}
    for node, _, _ in blocks:
        at = node
        while at is not None and id(at) not in nodes:
            nodes[id(at)] = at
            at = at.parent
    best = max(nodes.values(), key=lambda n: (n.score(), -n.depth))
    at: Node | None = best
    lifted = best
    while at is not None:
        if at.tag == "article" or at.kind == "articlebody":
            lifted = at
        at = at.parent
    return lifted


def _with_siblings(best: Node, blocks: list[tuple[Node, str, int]]) -> set[Node]:
    """The best container and those beside it that read like more of the same."""
    chosen = {best}
    if best.parent is None or best.kind == "articlebody":
        return chosen
    least = max(3.0, SIBLING_SHARE * best.score())
    beside: dict[int, list] = {}
    for node, text, linked in blocks:
        at, below = node, None
        while at is not None and at is not best.parent:
            below, at = at, at.parent
        if at is not None and below is not None and below is not best:
            beside.setdefault(id(below), [below, 0, False])
            beside[id(below)][1] += len(text)
            beside[id(below)][2] |= text.endswith((".", "!", "?"))
    for sibling, size, sentence in beside.values():
        if best.tag == "article":
            same = sibling.tag == "article" and sibling.score() >= least
        else:
            same = sibling.score() >= least and (sibling.tag == best.tag or sibling.kind == best.kind)
            if sibling.tag in ("p", *HEADINGS):
                same = sibling.density() < 0.25 and (size > 80 or sentence or sibling.tag in HEADINGS)
        if same:
            chosen.add(sibling)
    return chosen


def extract(pages: DataFrame) -> DataFrame:
    """``(page_id, url, text, n_chars)`` for every page, from its whole html.

    NULL or empty html gives an empty text, so does a page without any text
    outside menus and the like. Broken markup is read as browsers do: elements
    end where others begin, end tags without a start are ignored. Repeated rows
    stay repeated; an empty table gives no rows; nothing is shuffled.
    """

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, rows in byte_rows(batches):
            found = [main_text(row.decode("utf-8", "replace")) for row in rows]
            yield pa.RecordBatch.from_arrays(
                [
                    keys.field("page_id"),
                    keys.field("url"),
                    pa.array(found, pa.string()),
                    pa.array([len(t) for t in found], pa.int64()),
                ],
                ["page_id", "url", "text", "n_chars"],
            )

    given = pages.select(
        F.struct(
            F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url")
        ).alias("keys"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"),
    )
    return given.mapInArrow(apply, "page_id long, url string, text string, n_chars long")
