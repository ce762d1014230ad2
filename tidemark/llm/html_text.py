"""HTML extraction by tree scoring.

A tolerant parser builds the element tree of a page.  Subtrees that are never article text (scripts, navigation,
forms, adverts, comments, hidden parts) are left out.  Each paragraph then passes points for its length and its
commas to its ancestors, less with each level; a container's points are discounted by its share of link text.
The best container, widened to the article around it, is kept with those siblings that look like its continuation.
"""

from __future__ import annotations

import re
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textbuf as tb

_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"""
    r"""|<(?P<raw>script|style|textarea|noscript|template|iframe|svg|math|title|object|select)\b(?>[^>"']*(?:(?:"[^"]*"|'[^']*')[^>"']*)*)(?:(?<=/)>|>.*?(?:</(?P=raw)\s*>|\Z))"""
    r"""|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<more>(?>[^>"']*(?:(?:"[^"]*"|'[^']*')[^>"']*)*)>|[^>]*(?:>|\Z))""",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"""(class|id|role|style|hidden|aria-hidden|itemprop)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?(?=[\s/>]|\Z)""", re.I)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "head header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead tr ul br".split()
)
_HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
_NEVER = frozenset("head nav footer aside form button label input fieldset dialog menu canvas audio video applet map".split())
_UNLIKELY = frozenset(
    "ad ads advert advertisement adverts advertising adsense banner breadcrumb breadcrumbs comment comments commentlist consent cookie cookies copyright disclaimer disqus "
    "footer gdpr header hidden masthead menu modal nav navbar navigation newsletter notice notices notification overlay pager pagination popup popular promo promotion recommended "
    "related replies reply respond rss search share sharing sidebar signup skip social sponsor sponsored sponsors subscribe subscription tags teaser toolbar widget widgets "
    "complementary contentinfo search alert".split()
)
#: Words of _UNLIKELY that other names hold too ("popular-science"): a page whose text would go with them is read again without them.
_AMBIGUOUS = frozenset("alert banner copyright header hidden notice notices notification overlay popular promotion reply respond search share sharing skip social sponsor subscription tags".split())
#: A page is read again where ambiguous names hold so many times the text that was found.
FAR_MORE = 5
_LIKELY = frozenset("article articlebody body content entry main post story text".split())
#: An end tag closes no element beyond one of these.
_WALL = {"li": frozenset(("ul", "ol", "menu")), "td": frozenset(("table",)), "th": frozenset(("table",)), "tr": frozenset(("table",)), "dd": frozenset(("dl",)), "dt": frozenset(("dl",)), "p": frozenset(("td", "th", "button", "object"))}
_CLOSES = {"li": ("li",), "dd": ("dd", "dt"), "dt": ("dd", "dt"), "td": ("td", "th"), "th": ("td", "th"), "tr": ("tr", "td", "th"), "option": ("option",)}
_NAME, _WORD = re.compile(r"\S+"), re.compile(r"[A-Za-z]+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


class _Node:
    __slots__ = ("tag", "parent", "out", "soft", "likely", "size", "linked", "points", "link")

    def __init__(self, tag: str, parent: "_Node | None", out: bool, soft: bool, likely: bool):
        self.tag, self.parent, self.out, self.soft, self.likely = tag, parent, out, soft, likely
        self.size = self.linked = 0
        self.points = 0.0
        self.link = tag == "a" or (parent is not None and parent.link)


#: Words by which a name tells what an element has beside it, not what it is ("has-sidebar", "comments-open").
_BESIDE = frozenset("enabled has layout no open with without".split())
#: How names count against an element: not at all, by an ambiguous word as part of a name, by another one in a name of what is beside it, by an
#: ambiguous word as the whole name, or surely (another word, or hidden).
_NO, _MAYBE, _PART, _WHOLE, _SURELY = range(5)


def _marks(tag: str, more: str) -> tuple[int, bool]:
    """(how unlikely, likely) by the attributes of a start tag."""
    unlikely, likely = _NO, False
    for name, *values in _ATTRIBUTE.findall(more):
        value, name = "".join(values), name.lower()
        if name == "hidden" or name == "aria-hidden" and value.lower() == "true" or name == "style" and _HIDDEN.search(value):
            unlikely = _SURELY
        elif name in ("class", "id", "role", "itemprop"):
            words = {w.lower() for w in _WORD.findall(value)}
            likely |= not _LIKELY.isdisjoint(words)
            if tag in _HEADING or tag != "header" and not _LIKELY.isdisjoint(words):
                words.discard("header")  # of an article, not of the page
            words &= _UNLIKELY
            for name_ in _NAME.findall(value.lower()) if words else ():
                parts = set(_WORD.findall(name_))
                for w in parts & words:
                    if w in _AMBIGUOUS:
                        unlikely = max(unlikely, _WHOLE if w == name_ else _MAYBE)
                    else:
                        unlikely = max(unlikely, _SURELY if parts.isdisjoint(_BESIDE) else _PART)
    return _NO if tag in ("html", "body", "article", "main") else unlikely, likely


class _Open:
    """The open elements: a stack, and the depths at which each tag and any block stands in it, so that no tag makes it be searched."""

    def __init__(self, root: _Node):
        self.stack, self.blocks, self.depths = [root], [0], {}

    def push(self, node: _Node) -> None:
        self.depths.setdefault(node.tag, []).append(len(self.stack))
        if node.tag in _BLOCK:
            self.blocks.append(len(self.stack))
        self.stack.append(node)

    def cut(self, depth: int) -> None:
        """Closes the element at a depth and all in it."""
        while len(self.stack) > depth:
            self.depths[self.stack.pop().tag].pop()
        while self.blocks[-1] >= depth:
            self.blocks.pop()

    def last(self, tags) -> int:
        """The greatest depth of an open element with one of the tags, or 0."""
        return max((at[-1] for t in tags if (at := self.depths.get(t))), default=0)


def _parse(html: str, trust: int) -> tuple[_Node, list[_Node], list[tuple[_Node, str, int, int]], int]:
    """(root, elements, blocks, characters passed over for ambiguous names): a block is (its element, text, characters, characters in links).

    Elements go whose names are as unlikely as `trust` or more.
    """
    root = _Node("#", None, False, False, False)
    nodes, blocks, opened = [root], [], _Open(root)
    stack = opened.stack
    run: list[str] = []
    linked = passed = 0
    owner = root

    def flush() -> None:
        nonlocal run, linked
        if run:
            text = " ".join("".join(run).split())
            if text:
                whole = len(text)
                blocks.append((owner, text, whole, min(whole, linked)))
            run, linked = [], 0

    def add(raw: str) -> None:
        nonlocal linked, owner, passed
        top = stack[-1]
        if top.out:
            if top.soft and not top.link:
                passed += len(raw.strip())
            return
        text = unescape(raw) if "&" in raw else raw
        if not run:
            owner = stack[opened.blocks[-1]]
        if top.link:
            linked += len(text.strip())
        run.append(text)

    at = 0
    for m in _TOKEN.finditer(html):
        if m.start() > at:
            add(html[at : m.start()])
        at = m.end()
        tag = m["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        block = tag in _BLOCK
        if block:
            flush()
        if m["end"]:
            depth = opened.last((tag,))
            if depth > (opened.last(_WALL.get(tag, ())) if block else opened.blocks[-1]):
                opened.cut(depth)
            continue
        if tag in _VOID:
            continue
        if block:  # a paragraph ends where another block begins
            x = stack[opened.blocks[-1]].tag
            if x == "p" or x in _HEADING and tag in _HEADING:
                opened.cut(opened.blocks[-1])
        if tag in _CLOSES:
            depth = opened.last(_CLOSES[tag])
            if depth > opened.last(_WALL.get(tag, ())):
                opened.cut(depth)
        elif tag == "body" and opened.depths.get("head"):
            opened.cut(opened.depths["head"][0])
        top = stack[-1]
        more = m["more"]
        unlikely, likely = _marks(tag, more) if len(more) > 1 else (_NO, False)
        soft = unlikely == _MAYBE and trust == _MAYBE and tag not in _NEVER
        out = top.out or unlikely >= trust or tag in _NEVER
        if tag == "header" and not top.out:  # the head of an article keeps its headings
            out, soft = not opened.last(("article", "main")), False
        elif not out and top.tag == "header":
            out = tag not in _HEADING and tag not in ("div", "hgroup", "header")
        node = _Node(tag, top, out, (top.soft or not top.out and soft) and (not top.soft or unlikely <= _MAYBE and tag not in _NEVER), likely)
        nodes.append(node)
        if not (more.endswith("/>") and tag not in _BLOCK):
            opened.push(node)
    if at < len(html):
        add(html[at:])
    flush()
    return root, nodes, blocks, passed


#: Levels of ancestors that a paragraph passes points to.
LEVELS = 10
_LIST = frozenset(("ul", "ol", "table", "dl"))
_PARAGRAPH = frozenset("p pre td blockquote div section article li dd main body".split())


def extract(html: str | None) -> list[str]:
    """The blocks of the main text of a page, in page order; none for a null, empty or textless page.

    A page is read again without regard to ambiguous parts of names where these hold far more text than was found, and with ever
    less regard to names where nothing is left.
    """
    found: list[str] = []
    for trust in (_MAYBE, _PART, _WHOLE, _SURELY) if html else ():
        root, nodes, blocks, passed = _parse(html, trust)
        found = _best(root, nodes, blocks) if blocks else []
        if found and FAR_MORE * sum(map(len, found)) >= passed:
            break
    return found


def _best(root: _Node, nodes: list[_Node], blocks: list[tuple[_Node, str, int, int]]) -> list[str]:
    """The blocks of the best container and of what belongs to it."""
    for own, _, size, linked in blocks:
        own.size += size
        own.linked += linked
    for x in reversed(nodes[1:]):  # children stand after their parents
        x.parent.size += x.size
        x.parent.linked += x.linked
    for own, text, size, linked in blocks:
        if own.tag not in _PARAGRAPH and own is not root or size < 25 and own.tag != "p":
            continue
        points = (1 + text.count(",") + text.count("，") + min(size / 100, 3)) * (1 - linked / size)
        x, level = own if own.tag not in ("p", "pre", "blockquote", "li", "dd", "td") else own.parent, 0
        while x is not None and level <= LEVELS:
            x.points += points / (1 if level == 0 else 2 if level == 1 else 3 * level)
            x, level = x.parent, level + 1

    def worth(x: _Node) -> float:
        return (x.points + (5 if x.likely or x.tag in ("article", "main") else 0)) * (1 - x.linked / x.size) if x.size else 0.0

    scored = [x for x in nodes if x.points > 0 and not x.out]
    if not scored:
        return [text for own, text, size, linked in blocks if linked < 0.5 * size]
    best = max(scored, key=worth)  # the first of equals
    around = best
    for tag in ("article", "main"):
        x = best
        while x is not None and x.tag != tag:
            x = x.parent
        if x is not None:
            around = x
            break
    keep = {id(around)}
    if around.tag not in ("article", "main") and around.parent is not None:
        least = max(10.0, 0.2 * worth(best))
        for x in nodes:
            if x.parent is around.parent and x is not around and x.size:
                density = x.linked / x.size
                if worth(x) >= least or x.tag in _HEADING and density < 0.3 or x.tag == "p" and (x.size > 80 and density < 0.25 or density == 0):
                    keep.add(id(x))
    inside = set()  # elements of which the own text is kept
    for x in nodes:
        if (id(x) in keep or x.parent is not None and id(x.parent) in inside) and not (x.tag in _LIST and x.linked > 0.66 * x.size):
            inside.add(id(x))
    return [text for own, text, size, linked in blocks if id(own) in inside or own is around.parent and linked < 0.25 * size]


def extracted(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) for each row of pages: the blocks of the main text joined by one newline.

    White space inside a block is one space, character references are decoded, nothing is cut.  A null or empty
    page, or one without text, gives an empty text.  Broken markup is read as browsers do, roughly: paragraphs end where
    a block begins, stray end tags are passed over, open elements end with the page.  Time grows with the page's length,
    however deep it is nested.
    """

    def run(batches):
        for batch in batches:
            for part in tb.slices(batch, "html"):
                texts = ["\n".join(extract(h)) for h in part.column("html").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("page_id"), part.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    return pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html").mapInArrow(run, "page_id long, url string, text string, n_chars long")


def op10_tree_scoring(spark, sf_dir: str) -> DataFrame:
    """extracted() of all pages."""
    return extracted(spark.read.parquet(f"{sf_dir}/pages.parquet"))
