"""Main text of web pages by tree scoring.

A page becomes a tree of elements. Every paragraph has points for its length and its commas, less the
share of its text that is links, and passes them on to its ancestors, less the farther up. The
container with the most points, again discounted by its links, is the article; if it lies in an
``article`` or ``main`` element, that element is, and siblings with a fair share of points stay, too.
Elsewhere the article grows upwards from that container: a parent in whose like sections or boxes lies
most of its text is kept whole, and so are headings, paragraphs, lists and tables beside the container,
unless the parent frames the page (it is the body, or holds menus and the like). There only the title
before the container stays, what stands between, and siblings with a fair share of points.

Elements that are no article by their kind or name (menus, footers, sidebars, notices, adverts,
forms, comments and the like) are left out wherever they stand. A name counts as a whole, beside words
that only tell of a box or its place; names that an article may bear, too, count only for
boxes with little text or mostly links. Links alone cut nothing inside the article.

Each page is parsed on its own inside an Arrow batch; there is no shuffle.
"""

from __future__ import annotations

import html
import re
from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyrec.llm.batches import slices, texts

MIN_PARAGRAPH = 25  # characters that earn a paragraph its first point
POINT_CHARS, MOST_LENGTH_POINTS = 100, 3
LEVELS = 5
SEMANTIC_BONUS = 25
SIBLING_SHARE = 0.2
MAX_LINK_DENSITY = 0.5  # of lists and boxes outside the article
LITTLE_TEXT, LITTLE_PARAGRAPH = 400, 40  # characters of a box, or a paragraph, of a doubtful name

# Elements of the HTML standard by how they are treated.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = "script|style|title|textarea|noscript|template|iframe|svg|math|object|audio|video|canvas"
NEVER = set("nav footer aside button select menu dialog head datalist".split())
MAYBE = {"form", "header"}  # kept where they hold the article's heading
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
PARAGRAPHS = {"p", "pre", "li", *HEADINGS}
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s "
    "samp small span strike strong sub sup time tt u var wbr br img input".split()
)
IN_HEAD = set("meta link base title script style noscript template".split())
CLOSES_P = set(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split()
)
CLOSED_BY = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
SCOPES = {"html", "table", "td", "th", "button", "object", "article", "section", "div", "li", "body"}

# Words in class, id or role that tell of something other than the article.
OTHER_NAMES = set(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored sponsors "
    "cookie cookies consent gdpr newsletter subscribe subscription signup popup modal overlay "
    "lightbox menu nav navbar navigation breadcrumb breadcrumbs sidebar sidebars complementary "
    "related footer contentinfo masthead comment comments respond replies disqus pagination pager "
    "copyright hidden outbrain taboola paywall".split()
)
# Words that an article may bear, too.
DOUBTFUL_NAMES = set(
    "alert banner disclaimer discussion login notice notices promo promotion recommended "
    "recommendations search share sharing skip social tags teaser teasers toolbar widget widgets "
    "header topbar top".split()
)
# Words beside such a name that only tell of a box, its place or its contents.
PLAIN_WORDS = set(
    "area bar block body bottom box button buttons col column container content form group head "
    "holder icon icons inline inner item items left link links list main message outer page panel "
    "posts primary right row secondary section site slot space text title unit user wrap wrapper "
    "articles stories".split()
)
COMMENT_TITLES = set("comments kommentare commentaires comentarios discussion".split())
_FLOW = {"p", "pre", "ul", "ol", "dl", "table", "blockquote", "figure", "hr", *HEADINGS}
_BOXES = ("ul", "ol", "div", "section", "table", "dl")

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)"
    rf"|<({RAW})\b(?:\"[^\"]*\"|'[^']*'|[^'\">])*>(?:.*?</\1\s*>|.*\Z)"
    r"|<[!?][^>]*>"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*)>",
    re.S | re.I,
)
_NAMES = re.compile(
    r"\s(class|id|role|hidden|aria-hidden|style)(?=[\s=/]|\Z)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?",
    re.I,
)
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
_COMMAS = re.compile("[,،、，]")


class _Node:
    __slots__ = (
        *("bonus", "commas", "doubtful", "given", "inline", "items", "leaf", "left_out", "links"),
        *("name", "own", "parent", "points", "tag", "text"),
    )

    def __init__(self, tag: str, parent: _Node | None) -> None:
        self.tag, self.parent = tag, parent
        self.items: list = []
        self.left_out = self.doubtful = False
        self.name = ""  # its class
        self.inline = tag in INLINE
        self.leaf = True  # no block inside
        self.own = 0  # characters of its paragraph: own text and that of inline children
        self.commas = self.text = self.links = 0
        self.points = self.bonus = 0.0
        self.given = 0.0  # the points of its own paragraph


def _read_attributes(node: _Node, attributes: str) -> None:
    """Its class, and whether it is, or may be, something other than the article."""
    for name, value in _NAMES.findall(attributes):
        name, value = name.lower(), value.strip("\"'")
        if name == "hidden" or name == "aria-hidden" and value.lower() == "true":
            node.left_out = True
        elif name == "style":
            node.left_out |= "display:none" in value.replace(" ", "").lower()
        elif name != "aria-hidden":
            if name == "class":
                node.name = value
            for token in value.split():
                words = {w.lower() for w in _WORDS.findall(token)}
                words = {w for w in words if not w.isdigit() and len(w) > 1}
                if words <= OTHER_NAMES | DOUBTFUL_NAMES | PLAIN_WORDS:
                    sure = words & OTHER_NAMES or name == "role" and words & DOUBTFUL_NAMES
                    node.left_out |= bool(sure)
                    node.doubtful |= bool(words & DOUBTFUL_NAMES)


def _parse(page: str) -> list[_Node]:
    """The elements in page order; the first is the root."""
    root = _Node("html", None)
    nodes, node, at = [root], root, 0
    titles: list[_Node] = []
    for token in _TOKEN.finditer(page):
        start = token.start()
        if start > at:
            _add_text(node, page[at:start])
        at = token.end()
        tag = token.group(3)
        if tag is None:
            continue
        tag = tag.lower()
        if token.group(2):
            node = _close(node, tag)
            continue
        if tag in ("html", "body"):
            while node.tag == "head":
                node = node.parent
            continue
        if tag == "br":
            node.items.append(" ")
            continue
        if tag in VOID:
            if tag == "hr":
                node = _implied_end(node, tag)
                node.items.append(_Node(tag, node))
            continue
        node = _implied_end(node, tag)
        child = _Node(tag, node)
        attributes = token.group(4)
        if tag in NEVER or tag in MAYBE:
            child.left_out = True
        elif len(attributes) > 2 and (tag not in INLINE or tag == "span"):
            _read_attributes(child, attributes)
        if tag in ("h1", "main"):
            titles.append(child)
        if tag in ("article", "main"):
            child.bonus = SEMANTIC_BONUS
        node.items.append(child)
        nodes.append(child)
        above = None if child.inline else node
        while above is not None:
            above.leaf = False
            above = above.parent if above.inline else None
        if not attributes.endswith("/") or tag not in ("path", "use"):
            node = child
    if at < len(page):
        _add_text(node, page[at:])
    _keep_titles(titles)
    return nodes


def _keep_titles(titles: list[_Node]) -> None:
    """Whatever the boxes around a title are called, they hold the article; only a header does not if
    another title stands outside of headers."""
    headed = [any(a.tag == "header" for a in _above(title)) for title in titles]
    for title, inside in zip(titles, headed, strict=True):
        if title.tag == "h1" and inside and not all(headed):
            continue
        for above in _above(title):
            if above.tag not in NEVER:
                above.left_out = above.doubtful = False


def _above(node: _Node) -> Iterator[_Node]:
    while node.parent is not None:
        node = node.parent
        yield node


def _add_text(node: _Node, raw: str) -> None:
    if "&" in raw:
        raw = html.unescape(raw)
    node.items.append(raw)
    if not raw.isspace():
        node.own += len(raw.strip())
        node.commas += len(_COMMAS.findall(raw))


def _implied_end(node: _Node, tag: str) -> _Node:
    """Where an element that opens at ``node`` belongs."""
    if node.tag == "head" and tag not in IN_HEAD:
        node = node.parent
    if tag in CLOSES_P:
        above = node
        while above is not None and (above.inline or above.tag == "p"):
            if above.tag == "p":
                return above.parent
            above = above.parent
    if tag in CLOSED_BY:
        ended, scope = CLOSED_BY[tag]
        above, found = node, None
        while above is not None and above.tag not in scope:
            if above.tag in ended:
                found = above
            above = above.parent
        if found is not None:
            return found.parent
    return node


def _close(node: _Node, tag: str) -> _Node:
    above = node
    while above is not None and above.tag != tag:
        if tag in INLINE and not above.inline and above.tag in SCOPES | {"p"}:
            return node
        if tag == "p" and above.tag in SCOPES:
            return node
        above = above.parent
    return node if above is None or above.parent is None else above.parent


def _score(nodes: list[_Node]) -> None:
    for node in reversed(nodes):  # children come after their parents
        above = node.parent
        node.text += node.own if not node.inline else 0
        if above is None:
            continue
        if node.doubtful and not node.left_out:
            little = LITTLE_PARAGRAPH if node.tag in PARAGRAPHS or node.inline else LITTLE_TEXT
            size = node.own if node.inline else node.text
            node.left_out = size < little or node.links > MAX_LINK_DENSITY * size
        if node.left_out:
            continue
        if node.inline:
            # its text is a part of the paragraph around it
            above.own += node.own
            above.commas += node.commas
            above.links += node.own if node.tag == "a" else node.links
            above.text += node.text
        else:
            above.text += node.text
            above.links += node.links
    for node in nodes:
        if not node.inline and node.own and not _is_left_out(node):
            points = (node.own >= MIN_PARAGRAPH) + node.commas
            points += min(node.own / POINT_CHARS, MOST_LENGTH_POINTS)
            points *= 1 - min(node.links / max(node.text, 1), 1)
            node.given = points
            above = node.parent if node.leaf or node.tag in PARAGRAPHS else node
            for level in range(LEVELS):
                if above is None:
                    break
                above.points += points / (1, 2, 6, 9, 12)[level]
                above = above.parent


def _is_left_out(node: _Node | None) -> bool:
    while node is not None:
        if node.left_out:
            return True
        node = node.parent
    return False


def _density(node: _Node) -> float:
    return min(node.links / node.text, 1.0) if node.text else 0.0


def _final(node: _Node) -> float:
    return (node.points + node.bonus) * (1 - _density(node)) if node.points > 0 else 0.0


def _containers(nodes: list[_Node]) -> tuple[_Node, list]:
    """The article, and what to show in page order: it and what beside it belongs to it."""
    best, most = nodes[0], 0.0
    for node in nodes[1:]:
        if not node.inline and node.tag not in PARAGRAPHS and node.points > 0:
            score = _final(node)
            if score > most and not _is_left_out(node):
                best, most = node, score
    above, article = best, None
    while above is not None:
        if above.tag in ("article", "main"):
            article = above
            if above.tag == "article":
                break
        above = above.parent
    if article is None:
        return _grown(best, most)
    best = article
    most = _final(best)
    kept = []
    for item in best.parent.items:
        if item is best:
            kept.append(item)
        elif isinstance(item, _Node) and not item.left_out and not item.inline:
            is_heading = item.tag == "h1"
            is_text = item.tag == "p" and item.own > 80 and _density(item) < 0.25
            if is_heading or is_text or _has_share(item, most):
                kept.append(item)
    return best, kept


def _has_share(node: _Node, most: float) -> bool:
    share = max(10, SIBLING_SHARE * most)
    return _final(node) - node.bonus >= share or node.given >= share


def _grown(best: _Node, most: float) -> tuple[_Node, list]:
    """The article around the best container of a page without ``article`` and ``main``."""
    node, kept = best, deque([best])
    while node.parent is not None:
        parent, here = node.parent, 0
        while parent.items[here] is not node:
            here += 1
        boxes = [i for i in parent.items if isinstance(i, _Node) and not i.inline and not i.left_out]
        alike = [i for i in boxes if i is not node and _is_like(i, node)]
        in_alike = node.text + sum(i.text for i in alike)
        is_frame = parent.parent is None or any(
            i.left_out and not i.inline for i in parent.items if isinstance(i, _Node)
        )
        if alike and 2 * in_alike > parent.text:
            best, kept = parent, deque([parent])
        else:
            title = _title_before(parent, here)
            if title < here and _has_title(kept):
                title = here
            strict = is_frame and node.tag != "section"  # only what has a share of the points
            for i in range(here - 1, -1, -1):
                item = parent.items[i]
                inside = not strict or i >= title
                if i == title or inside and _is_flow(item) or _is_box_of(item, most):
                    kept.appendleft(item)
            for item in parent.items[here + 1 :]:
                if not strict and _is_flow(item) or _is_box_of(item, most):
                    kept.append(item)
        node = parent
    return best, list(kept)


def _is_like(one: _Node, other: _Node) -> bool:
    """Whether both are sections, or boxes of one class."""
    if one.tag != other.tag or _density(one) > MAX_LINK_DENSITY:
        return False
    return one.tag == "section" or bool(one.name) and one.name == other.name


def _is_flow(item: str | _Node) -> bool:
    """Text, inline elements, headings, paragraphs, lists and the like, unless they are mostly links."""
    if isinstance(item, str) or item.inline:
        return True
    return item.tag in _FLOW and not item.left_out and _density(item) <= MAX_LINK_DENSITY


def _is_box_of(item: str | _Node, most: float) -> bool:
    if isinstance(item, str) or item.inline or item.left_out:
        return False
    return _has_share(item, most)


def _holds_title(item: str | _Node) -> bool:
    """Whether it is the page's title, or a box that has one and little else."""
    todo, size, found = [item], 0, False
    while todo:
        one = todo.pop()
        if isinstance(one, _Node) and not one.left_out:
            found |= one.tag == "h1"
            size += one.text if one.tag == "h1" else 0
            todo.extend(one.items)
    return found and item.text <= LITTLE_TEXT + size


def _has_title(kept: deque) -> bool:
    """Whether the first heading of what is kept is a title of its own."""
    todo = list(reversed(kept))
    while todo:
        item = todo.pop()
        if isinstance(item, _Node) and not item.left_out:
            if item.tag in HEADINGS:
                return item.tag in ("h1", "h2")
            if item.tag in PARAGRAPHS and item.own >= MIN_PARAGRAPH:
                return False
            todo.extend(reversed(item.items))
    return False


def _title_before(parent: _Node, here: int) -> int:
    """The place of the last title before a place, or that place."""
    for at in range(here - 1, -1, -1):
        if isinstance(parent.items[at], _Node) and _holds_title(parent.items[at]):
            return at
    return here


def _is_link_list(node: _Node, article: _Node) -> bool:
    """Whether a box outside the article is mostly links, or a plain list of a page that is all
    article nothing else."""
    if _density(node) <= MAX_LINK_DENSITY:
        return False
    if article.parent is None:
        return node.tag == "ul" and node.links >= node.text
    above = node
    while above is not None and above is not article:
        above = above.parent
    if above is article:
        return False
    above = article
    while above is not None and above is not node:
        above = above.parent
    return above is None  # a box around the article stays


def _is_comment_box(node: _Node) -> bool:
    """Whether the first thing in it is a heading of no more than a title of comments and a count."""
    for item in node.items:
        if isinstance(item, _Node):
            if item.tag not in HEADINGS:
                return False
            words = "".join(i for i in item.items if isinstance(i, str)).lower().split()
            titles = [w for w in (w.strip("():") for w in words) if not re.fullmatch(r"[\d.,]*", w)]
            return len(titles) == 1 and titles[0] in COMMENT_TITLES
        if not item.isspace():
            return False
    return False


def _blocks(article: _Node, containers: list[_Node]) -> list[str]:
    out: list[str] = []
    run: list[str] = []

    def end_block() -> None:
        block = " ".join("".join(run).split())
        if block:
            out.append(block)
        run.clear()

    # an element is visited twice: the second time, as None, to end its block
    todo: list = []
    for container in reversed(containers):
        todo += [container] if isinstance(container, str) or container.inline else [None, container]
    tops = set(map(id, containers))
    while todo:
        item = todo.pop()
        if item is None:
            end_block()
        elif isinstance(item, str):
            run.append(item)
        elif item.inline:
            if not item.left_out:
                todo.extend(reversed(item.items))
        else:
            end_block()
            box = item.tag in _BOXES
            linked = box and item.links and _is_link_list(item, article)
            other = item.left_out or linked or box and _is_comment_box(item)
            if not other or id(item) in tops:
                todo.append(None)
                todo.extend(reversed(item.items))
    end_block()
    return out


def main_text(page: str) -> str:
    """The blocks of the article, joined by newlines; empty if the page has no text."""
    nodes = _parse(page)
    _score(nodes)
    return "\n".join(_blocks(*_containers(nodes)))


_RESULT = "page_id long, url string, text string, n_chars long"


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "html"):
        found = [main_text(t.decode()) for t in texts(batch, "html")]
        columns = [pa.array(found, pa.string()), pa.array([len(t) for t in found], pa.int64())]
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), *columns],
            ["page_id", "url", "text", "n_chars"],
        )


def extract_pages(pages: DataFrame) -> DataFrame:
    """``page_id``, ``url``, ``text`` (the main text) and ``n_chars`` (its code points).

    White space inside a block is one space, blocks are joined by newlines in page order,
    character references are decoded. One row per row of ``pages``, whatever repeats; null and empty
    pages and pages without text have an empty text. Any markup gives a result: what is not
    closed ends with its container, a stray end tag is passed over. Other columns are ignored; an
    empty table gives an empty result.
    """
    slim = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.col("html").cast("string").alias("html"),
    )
    return slim.mapInArrow(_extract, _RESULT)
