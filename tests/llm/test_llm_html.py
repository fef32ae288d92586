import re

import duckdb
import pyarrow as pa
import pytest

from tallyrec.llm.html import extract_pages, main_text

ONE = "First paragraph of the story, with some commas, and enough words to count."
TWO = "Second paragraph, which goes on a little longer than the first, as they do."
OTHER = "Something long, very long, that a reader or an advertiser, or both, wrote here."

CASES = {
    "article": (f"<nav>x</nav><article><h1>T</h1><p>{ONE}<p>{TWO}</article><footer>f</footer>", ["T", ONE, TWO]),
    "divs": (f'<div id="menu"><a>x</a></div><div class="post"><div>{ONE}</div><div>{TWO}</div></div>', [ONE, TWO]),
    "comments": (f'<div class="c"><p>{ONE}</p><p>{TWO}</p></div><div class="comments">{f"<p>{OTHER}</p>" * 9}</div>', [ONE, TWO]),
    "titled comments": (f"<main><p>{ONE}</p><section><h3>Comments (2)</h3><p>{OTHER}</p></section></main>", [ONE]),
    "header": (f"<header><h1>Site</h1></header><main><h1>T</h1><p>{ONE}</p><aside>{OTHER}</aside></main>", ["T", ONE]),
    "form": (f"<form id=aspnet><h1>T</h1><div><p>{ONE}</p></div></form><form><p>{OTHER}</p></form>", ["T", ONE]),
    "links": (f"<article><p>{ONE}</p><ul><li><a>one link</a><li><a>another</a></ul><p>{TWO}</p></article>", [ONE, "one link", "another", TWO]),
    "list": (f"<article><p>{ONE}</p><ul><li>an item<li>another</ul></article>", [ONE, "an item", "another"]),
    "script": (f'<script>var t="</p><p>";</script><article><p>{ONE}</p><style>p{{}}</style></article>', [ONE]),
    "entities": ("<article><p>a &lt;b&gt; &amp;amp; caf&eacute;&nbsp; &#x41;&copy</p></article>", ["a <b> &amp; café A©"]),
    "inline": ("<article><p>so<b>me</b> <i>in</i>line\n\t text<br>here</p></article>", ["some inline text here"]),
    "unclosed": (f"<article><h1>T</h1><p><b>{ONE}<br><p>{TWO}</p></article><footer>f", ["T", ONE, TWO]),
    "hidden": (f'<article><p>{ONE}</p><p hidden>{TWO}</p><div style="display: none">{TWO}</div></article>', [ONE]),
    "notice": (f'<div class="cookie-notice"><p>{OTHER}</p></div><div><p>{ONE}</p><p>{TWO}</p></div>', [ONE, TWO]),
    "comment markup": (f"<!-- <p>{OTHER}</p> --><article><p>{ONE}</p><!-- open", [ONE]),
    "plain": ("just  text &amp; more", ["just text & more"]),
    "short": ("<nav><a>menu, menu</a></nav><article><h1>Hi</h1><p>Yes.</p></article>", ["Hi", "Yes."]),
    "nested": ("<div>" * 3000 + "x" + "</div>" * 10, ["x"]),
    "stray": ("</p></div></article>text</b>", ["text"]),
    "broken": ("<article><p>1 < 2 and <3</p><p a='", ["1 < 2 and <3", "<p a='"]),
    "nothing": ("<nav>a</nav><script>x</script>", []),
    "empty": ("", []),
}


@pytest.mark.parametrize("name", CASES)
def test_cases(name):
    page, blocks = CASES[name]
    assert main_text(page) == "\n".join(blocks)


SHORT = "A short closing paragraph of the second part, some words."
WHOLE = {
    "sections": (f"<div><section><p>{ONE * 9}</p></section><section><h2>B</h2><p>{SHORT}</p></section></div>", [ONE * 9, "B", SHORT]),
    "nested sections": (f"<div><section><div><p>{ONE * 9}</p></div></section><section><div><p>{SHORT}</p></div></section></div>", [ONE * 9, SHORT]),
    "between": (f"<div>intro<section><p>{ONE * 9}</p></section><h2>B</h2><p>Yes.</p><ul><li>item</ul><table><tr><td>cell</table></div>", ["intro", ONE * 9, "B", "Yes.", "item", "cell"]),
    "link box outside": (f"<div><div><a>{OTHER}</a><a>{OTHER}</a> more</div><div><p>{ONE}</p><p>{TWO}</p></div></div>", [ONE, TWO]),
    "box around": (f"<div><div><a>{OTHER * 9}</a></div><div><p>{ONE}</p><p>{TWO}</p></div></div>", [ONE, TWO]),
    "sources": (f"<article><p>{ONE}</p><ol><li>A, <a>{TWO}</a></li></ol><ul><li>B, <a>{TWO}</a></li></ul></article>", [ONE, f"A, {TWO}", f"B, {TWO}"]),
    "discussion": (f"<main><p>{ONE}</p><section><h3>Discussion of results</h3><p>{TWO}</p></section></main>", [ONE, "Discussion of results", TWO]),
    "counted comments": (f"<main><p>{ONE}</p><section><h3>1,204 Comments:</h3><p>{OTHER}</p></section></main>", [ONE]),
}

for box in ("market-share", "social-history", "search-results", "skip-intro"):
    WHOLE[box] = (f'<article><p>{ONE}</p><div class="{box}"><p>{TWO}</p></div></article>', [ONE, TWO])
WHOLE["lead"] = (f'<article><p class="teaser">{ONE}</p><p>{TWO}</p></article>', [ONE, TWO])
WHOLE["teaser box"] = (f'<div><p>{ONE}</p><p>{TWO}</p></div><div class="teaser"><p>Other, news.</p><a>more</a></div>', [ONE, TWO])

# Pages without article or main: what stands around the story goes, the story stays whole.
BLURB = "This portal has brought you news from the region, day by day, since 1990."
RIGHTS = "All rights reserved, in all countries, by the publisher."
LINKS = "<ul><li><a>Home, sweet home</a></li><li><a>About us, all of us</a></li></ul>"
STORY = f"<p>{ONE * 3}</p><p>{TWO * 3}</p><h2>B</h2><p>Yes.</p><ul><li><a>A source</a></li></ul>"
TOLD = [ONE * 3, TWO * 3, "B", "Yes.", "A source"]
WHOLE |= {
    "boxes beside": (f'<body><div class="intro">{BLURB}</div><div class="weather"><b>Rain</b> 12 degrees</div><div id="content"><h1>T</h1>{STORY}</div><div>{RIGHTS}</div></body>', ["T", *TOLD]),
    "paragraphs beside": (f"<nav>{LINKS}</nav><p>{BLURB}</p><div>{STORY}</div><p>{RIGHTS}</p>", TOLD),
    "masthead": (f"<header><h1>The Site</h1><p>{BLURB}</p></header><div><h1>T</h1>{STORY}</div>", ["T", *TOLD]),
    "masthead of a story with a heading": (f"<header><h1>The Site</h1></header><div><h2>T</h2>{STORY}</div>", ["T", *TOLD]),
    "title in a header": (f"<div id=site><header><h1>T</h1></header><p>{ONE}</p><div>{STORY}</div><div>{RIGHTS}</div></div>", ["T", ONE, *TOLD]),
    "frame in a frame": (f'<div id="page"><div class="nav">{LINKS}</div><div>{BLURB}</div><div><div>{STORY}</div></div><div>{RIGHTS}</div></div><div>{RIGHTS}</div>', TOLD),
    "text in the container's parent": (f"<div><div class=post><h1>T</h1><p>By A</p><div>{STORY}</div><p>End.</p></div><div>{BLURB}</div></div>", ["T", "By A", *TOLD, "End."]),
    "boxes of one class": (f'<div><div class="part"><p>{ONE * 3}</p></div><div class="part"><p>Short.</p></div></div><div>{RIGHTS}</div>', [ONE * 3, "Short."]),
    "links outside": (f"<div>{LINKS}</div><div>{STORY}</div>{LINKS}", TOLD),
}


@pytest.mark.parametrize("name", WHOLE)
def test_nothing_else_is_dropped(name):
    page, blocks = WHOLE[name]
    assert main_text(page) == "\n".join(blocks)


def test_given_pages():
    pages = duckdb.sql("select html from '/root/testdata/sf0.01/pages.parquet'").fetchall()
    from html import unescape

    for (page,) in pages:
        inner = re.search(r"<article>(.*?)</article>", page, re.S).group(1)
        parts = re.split(r"</?(?:p|h1)>|<br>", inner)
        blocks = [" ".join(unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in parts]
        assert main_text(page) == "\n".join(b for b in blocks if b)


def test_table(spark):
    rows = [(1, "u", "<p>one</p>"), (1, "u", "<p>one</p>"), (None, None, None), (2, "v", ""), (3, "w", "<p>é" * 3000)]
    table = pa.table(
        {
            "page_id": pa.array([r[0] for r in rows], pa.int64()),
            "url": pa.array([r[1] for r in rows], pa.string()),
            "html": pa.array([r[2] for r in rows], pa.string()),
            "text": pa.array(["clash"] * len(rows), pa.string()),
        }
    )
    df = spark.createDataFrame(table)
    found = [tuple(r) for r in extract_pages(df).collect()]
    long = "\n".join(["é"] * 3000)
    wanted = [(1, "u", "one", 3)] * 2 + [(None, None, "", 0), (2, "v", "", 0), (3, "w", long, 5999)]
    assert sorted(found, key=repr) == sorted(wanted, key=repr)
    assert extract_pages(df.limit(0)).count() == 0
