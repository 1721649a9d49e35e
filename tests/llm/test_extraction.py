from __future__ import annotations

import time

import pytest

from starflat.llm import extraction
from starflat.llm.extraction import main_text

LONG = "A first paragraph, with commas, and enough words to read like one of an article."
MORE = "Another one, also with commas, that goes on for a while, as articles do."

PAGES = {
    "article": (
        f"<body><nav><a href=/>Home</a></nav><div class='ad'>Buy, buy, buy</div><article><h1>T &amp; U</h1>"
        f"<p>{LONG}<p>{MORE}</article><footer>(c) us</footer></body>",
        f"T & U\n{LONG}\n{MORE}",
    ),
    "no article element": (
        f"<body class='has-sidebar'><header class=top><h1>Site</h1></header><div id=content><h2>T</h2><p>{LONG}</p>"
        f"<ul><li>one<li>two</ul><p>{MORE}</p></div><div class='side-bar sidebar'><p>Other, stuff, here</p></div>"
        f"<div id='comments'><p>Reader, says, a, lot, of, things, here, and, there</p></div></body>",
        f"T\n{LONG}\none\ntwo\n{MORE}",
    ),
    "sections": (
        f"<main><section><h2>A</h2><p>{LONG}</p></section><section><h2>B</h2><p>{MORE}</p></section>"
        f"<section><p>{LONG}</p></section></main><aside>{MORE}</aside>",
        f"A\n{LONG}\nB\n{MORE}\n{LONG}",
    ),
    "form, notice and menu inside": (
        f"<div class=post><div class='cookie-notice'>We, use, cookies</div><p>{LONG}</p><form><p>Name, mail</p></form>"
        "<ul><li><a href=1>x y</a><li><a href=2>z w</a><li><a href=3>u v</a></ul>"
        f"<p>{MORE}</p></div>",
        f"{LONG}\n{MORE}",
    ),
    "script and comment": (
        f"<p>{LONG}<script>var t='</p><p>no';</script><!-- <p>no --><style>p</style><p>a&nbsp; b&#8212;c\n d &am</p>",
        f"{LONG}\na b—c d &am",
    ),
    "plain": ("just &lt;text&gt;", "just <text>"),
    "nothing": ("<nav><a href=x>y</a></nav>", ""),
    "empty": ("", ""),
    "broken": (f"</div></p><b><div><p>{LONG}<br>{MORE}<a href=\"x", f"{LONG} {MORE}"),
}


@pytest.mark.parametrize("name", list(PAGES))
def test_layouts(name):
    page, want = PAGES[name]
    assert main_text(page) == want


def test_given_pages_equal_their_article(spark):
    import html
    import re

    rows = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect()
    found = {r["page_id"]: r for r in extraction.extract(spark.createDataFrame(rows)).collect()}
    assert len(found) == len(rows)
    for r in rows:
        inside = re.search(r"<article>(.*?)(?:</article>|$)", r["html"], re.S)[1]
        parts = re.split(r"</?(?:p|h1)>", inside.replace("<br>", " ").replace("<b>", "").replace("</b>", ""))
        blocks = [" ".join(html.unescape(p).split()) for p in parts]
        want = "\n".join(b for b in blocks if b)
        assert found[r["page_id"]]["text"] == want
        assert found[r["page_id"]]["n_chars"] == len(want)


def test_odd_and_empty_tables(spark):
    schema = "page_id LONG, url STRING, html STRING, text STRING, keys INT"
    rows = [(None, None, None, "x", 1), (1, "u", "", "x", 1), (2, "u", "<p>a", "x", 1), (2, "u", "<p>a", "x", 1)]
    found = extraction.extract(spark.createDataFrame(rows, schema)).collect()
    assert sorted((str(r["page_id"]), r["text"], r["n_chars"]) for r in found) == [
        ("1", "", 0), ("2", "a", 1), ("2", "a", 1), ("None", "", 0)
    ]
    assert extraction.extract(spark.createDataFrame([], schema)).count() == 0


def test_very_long_and_deep_pages_take_linear_time():
    started = time.monotonic()
    assert main_text("<div>" * 2000 + f"<p>{LONG}") == LONG
    assert len(main_text(f"<p>{LONG}" * 20000).split("\n")) == 20000
    assert time.monotonic() - started < 20
