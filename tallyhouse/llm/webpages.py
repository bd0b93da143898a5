"""Main text of web pages by consensus paths of their hosts.

1. Each page is cut into blocks of text, and the containers of the blocks are scored: a
   block counts for its container and half for the next one, less its link text. Lists, quotes,
   figures, tables of data and sections are parts of the container around them.
2. Pages vote, in Spark, on the generalised path (tags and classes without digits) of the
   best container of their host.
3. Pages are extracted again with the winning path of the host; a page without it uses its own
   best container. An article around the container is taken whole, else the container grows to
   the next one while that adds headings, text or sections of its own. Menus, headers, footers,
   sidebars, notices, adverts, forms, scripts, styles and comments are left out by tag, role
   and class, hidden elements by their attribute. A class word does not leave out the element that
   holds the article or most of the page's text; one that only begins a name ("social-science") leaves
   out no paragraph, and in an article no text that runs on without links. The header of an
   article keeps its headings.

Character references are decoded, white space inside a block becomes one space, and blocks
are joined by one space. A null or empty page, and one without text, gives an empty text. A
null url counts as the empty host. Names that clash are replaced.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .frames import enrich, map_arrow, without
from .text import slices

VOTES = 3  # containers that a page votes for
ENOUGH = 200  # letters of unmarked text that can be a whole article
SENTENCE = 40  # letters of a block that is running text

# fixed values: what HTML says of its elements
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var wbr".split()
)
_CLOSES = {
    "li": frozenset(["li"]),
    "dt": frozenset(["dt", "dd"]),
    "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr", "td", "th"]),
    "td": frozenset(["td", "th"]),
    "th": frozenset(["td", "th"]),
    "option": frozenset(["option"]),
}
_SCOPE = frozenset("table ul ol dl select article section div main body html td th blockquote".split())
#: fixed values: elements, roles and class words that are not the article
_NOISE_TAGS = frozenset(
    "head title script style noscript template nav header footer aside form button select textarea iframe object svg "
    "canvas dialog menu".split()
)
_NOISE_ROLES = frozenset("navigation banner complementary contentinfo search dialog alert form menu".split())
_NOISE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner sidebar menu "
    "nav navbar navigation breadcrumb breadcrumbs cookie cookies consent gdpr notice notices alert newsletter "
    "subscribe subscription signup popup modal overlay comment comments disqus replies share sharing social "
    "related recommended footer header masthead toolbar pagination pager search login skip discussion responses".split()
)
#: fixed values: words that also begin names of content ("social-science", "ad-hoc")
_OPEN_WORDS = frozenset("ad ads social search share sharing skip notice alert menu promotion header responses discussion".split())

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style|noscript|template|textarea|svg|iframe)\b[^>]*+>.*?(?:</\1\s*>|\Z)|<[!?][^>]*+>"
    r"|<(/?)([a-zA-Z][^\s/>]*+)([^>\"']*+(?:(?:\"[^\"]*+\"|'[^']*+')[^>\"']*+)*+)>",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_CLASS_WORD = re.compile(r"[a-z]+")
_QUOTED = re.compile(r"\"[^\"]*\"|'[^']*'")
_HIDDEN = re.compile(r"(?<![\w-])hidden(?![\w-])", re.I)
#: fixed values: elements that are parts of the text around them
_PARTS = frozenset(
    "ul ol dl dt dd blockquote table caption colgroup thead tbody tfoot tr td th figure figcaption details summary address".split()
)
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_RUNNING = _HEADINGS | frozenset("p blockquote pre li dd td figure".split())


@dataclass
class Element:
    tag: str
    path: str
    noise: bool
    container: bool
    number: int = 0
    #: left out by a class word, unless it holds the article
    marked: bool = False
    anchor: bool = False


@dataclass
class Block:
    text: str
    links: int
    #: (number, path) of the containers around the block, outermost first
    around: list[tuple[int, str]] = field(default_factory=list)
    #: the innermost element that is not inline
    tag: str = ""
    #: the containers around that the block is credited to
    owners: list[tuple[int, str]] = field(default_factory=list)
    #: numbers of the marked elements around, and of articles, mains and main headings
    marks: list[int] = field(default_factory=list)
    anchors: list[int] = field(default_factory=list)

    @property
    def weight(self) -> int:
        return len(self.text) - self.links

    def within(self, path: str) -> bool:
        return any(p == path for _, p in self.around)


def _named(value: str) -> tuple[bool, bool]:
    """Whether a class or id names something that is no article, and whether that is unsure."""
    sure = unsure = False
    for one in value.split():
        if one.startswith(("has-", "no-", "with-", "without-")):
            continue
        words = _CLASS_WORD.findall(one)
        for i, word in enumerate(words):
            if word in _NOISE_WORDS:
                # the last word of a name says what it is
                doubtful = word in _OPEN_WORDS and i < len(words) - 1
                sure, unsure = sure or not doubtful, unsure or doubtful
    return sure or unsure, unsure and not sure


def _described(tag: str, attributes: str) -> tuple[str, bool, bool, bool]:
    """The generalised step of an element, whether it is left out, whether a class word says so, and whether that is unsure."""
    noise, marked, unsure = tag in _NOISE_TAGS, False, True
    classes = ""
    for name, *values in _ATTRIBUTE.findall(attributes) if attributes else ():
        value, name = "".join(values).lower(), name.lower()
        if name == "role":
            noise = noise or value in _NOISE_ROLES
        else:
            named, doubtful = _named(value)
            marked, unsure = marked or named, unsure and (doubtful or not named)
        if name == "class":
            classes = "".join(sorted({"." + re.sub(r"[\d/]+", "", one) for one in value.split()}))
    if "hidden" in attributes and _HIDDEN.search(_QUOTED.sub("", attributes)):
        noise = True
    return tag + classes, noise, marked, marked and unsure


def blocks_of(html: str) -> list[Block]:
    """The blocks of text outside what is left out, in page order."""
    stack: list[Element] = []
    blocks: list[Block] = []
    #: anchors around each marked element, and the tags of anchors
    outside: dict[int, list[int]] = {}
    anchors: dict[int, str] = {}
    doubts: set[int] = set()
    pieces: list[str] = []
    state = {"links": 0, "seen": 0}

    def flush() -> None:
        if pieces:
            text = " ".join("".join(pieces).split())
            tag = next((e.tag for e in reversed(stack) if e.tag not in _INLINE), "")
            if text and not any(e.noise and not _is_title(stack, i, tag) for i, e in enumerate(stack)):
                around = [(e.number, e.path) for e in stack if e.container]
                block = Block(text, min(state["links"], len(text)), around, tag)
                block.marks = [e.number for e in stack if e.marked]
                block.anchors = [e.number for e in stack if e.anchor]
                blocks.append(block)
            pieces.clear()
        state["links"] = 0

    def close(down_to: int) -> None:
        if any(e.tag not in _INLINE for e in stack[down_to:]):
            flush()
        del stack[down_to:]

    def text(raw: str) -> None:
        if raw:
            own = unescape(raw)
            pieces.append(own)
            if any(e.tag == "a" for e in stack):
                state["links"] += len(own)

    at = 0
    for found in _TAG.finditer(html):
        text(html[at : found.start()])
        at = found.end()
        tag = found.group(3)
        if tag is None:
            continue
        tag, closing = tag.lower(), found.group(2)
        if closing:
            match = next((i for i in range(len(stack) - 1, -1, -1) if stack[i].tag == tag), None)
            if match is not None:
                close(match)
            elif tag not in _INLINE:
                flush()
            continue
        if tag == "br" or tag == "hr":
            pieces.append(" ")
        if tag in _VOID:
            continue
        if tag not in _INLINE:
            flush()
            # a block ends an open paragraph; items end items of their own list
            ends = _CLOSES.get(tag, frozenset())
            for i in range(len(stack) - 1, -1, -1):
                if stack[i].tag == "p" or stack[i].tag in ends:
                    close(i)
                    break
                if stack[i].tag in _SCOPE:
                    break
        if found.group(4).endswith("/") and tag in ("svg", "path", "use"):
            continue
        step, noise, word, unsure = _described(tag, found.group(4))
        container = tag not in _INLINE and tag not in ("p", "h1", "h2", "h3", "h4", "h5", "h6", "pre", "li", "html")
        state["seen"] += 1
        path = next((e.path for e in reversed(stack) if e.container), "")
        # a paragraph or heading is one of the text unless it is named for certain
        marked = word and tag not in ("html", "body", "article", "main") and not (unsure and tag in _RUNNING)
        anchor = tag in ("article", "main", "h1") and not word
        if marked:
            outside[state["seen"]] = [e.number for e in stack if e.anchor]
            if unsure:
                doubts.add(state["seen"])
        if anchor:
            anchors[state["seen"]] = tag
        stack.append(Element(tag, f"{path}/{step}" if container else path, noise, container, state["seen"], marked, anchor))
    text(html[at:])
    flush()
    blocks = _unmarked(blocks, outside, anchors, doubts)
    _credit(blocks)
    return blocks


def _is_title(stack: list[Element], i: int, tag: str) -> bool:
    """A heading in the header of an article."""
    return stack[i].tag == "header" and tag in _HEADINGS and any(e.tag == "article" for e in stack[:i])


def _unmarked(blocks: list[Block], outside: dict[int, list[int]], anchors: dict[int, str], doubts: set[int]) -> list[Block]:
    """The blocks outside marked elements. Marks of elements that hold the article are lifted, outermost first.

    So are unsure marks of elements inside an article whose text runs on without a link.
    """
    if not any(b.marks for b in blocks):
        return blocks
    total = sum(b.weight for b in blocks)
    held: dict[int, int] = {}
    holds: dict[int, set[str]] = {}
    for block in blocks:
        for mark in block.marks:
            held[mark] = held.get(mark, 0) + block.weight
            if block.weight and block.anchors:
                inside = [a for a in block.anchors if a > mark and a not in outside[mark]]
                holds.setdefault(mark, set()).update(anchors[a] for a in inside)
    linked = {mark for b in blocks if b.links for mark in b.marks}
    longest: dict[int, int] = {}
    for block in blocks:
        for mark in block.marks:
            longest[mark] = max(longest.get(mark, 0), block.weight)
    in_article = {m for m in held if any(anchors[a] != "h1" for a in outside[m])}
    lifted = {m for m in doubts & in_article if m not in linked and longest[m] >= SENTENCE}
    for mark in sorted(held):
        if mark in lifted:
            continue
        most = held[mark] > 0 and 2 * held[mark] >= total
        own = holds.get(mark, set())
        if not (most or own):
            continue
        kept = [b for b in blocks if lifted.issuperset(b.marks)]
        body: dict[int, int] = {}
        for block in kept:
            for a in block.anchors:
                body[a] = body.get(a, 0) + (0 if block.tag in _HEADINGS else block.weight)
        # an article elsewhere, or around the element with text of its own
        other = any(anchors[a] != "h1" and (a not in outside[mark] or n >= ENOUGH) for a, n in body.items())
        title = any(anchors[a] == "h1" for a in body)
        little = sum(b.weight for b in kept if b.tag not in _HEADINGS) < ENOUGH
        if not other and ((own and not title) or (most and (not title or little or own & {"article", "main"}))):
            lifted.add(mark)
    return [b for b in blocks if lifted.issuperset(b.marks)]


def _tag(path: str) -> str:
    return path.rsplit("/", 1)[1].split(".")[0]


def _layouts(blocks: list[Block]) -> set[int]:
    """Tables that lay out the page: a cell with a heading or paragraphs has half of their text."""
    size: dict[int, int] = {}
    prose: dict[int, int] = {}
    table_of: dict[int, int] = {}
    for block in blocks:
        table = None
        for number, path in block.around:
            tag = _tag(path)
            if tag == "table":
                table = number
            elif tag not in ("td", "th") or table is None:
                continue
            else:
                table_of[number] = table
                prose[number] = prose.get(number, 0) + (2 if block.tag in _HEADINGS else block.tag == "p")
            size[number] = size.get(number, 0) + block.weight
    return {table for cell, table in table_of.items() if prose[cell] > 1 and 2 * size[cell] >= size[table]}


def _credit(blocks: list[Block]) -> None:
    """Set the owners: containers that are no part of the text of a container around them."""
    layouts = _layouts(blocks)
    for block in blocks:
        table = None
        for number, path in block.around:
            tag = _tag(path)
            boxed = any(_tag(p) != "body" for _, p in block.owners)
            if tag == "table":
                table = number
            laid = table in layouts and tag in ("table", "caption", "colgroup", "thead", "tbody", "tfoot", "tr", "td", "th")
            if tag in _PARTS and not laid:
                if boxed:
                    break
            elif tag not in _PARTS or tag in ("td", "th"):
                if tag != "section" or not boxed:
                    block.owners.append((number, path))
        block.owners = block.owners or block.around[:1]


def scores(blocks: list[Block]) -> dict[str, float]:
    """The score of each container path of a page."""
    out: dict[str, float] = {}
    for block in blocks:
        weight = 1.0
        for _, path in reversed(block.owners[-2:]):
            likely = 2.0 if _tag(path) in ("article", "main") else 1.0
            out[path] = out.get(path, 0.0) + weight * likely * block.weight
            weight /= 2
    return {path: score for path, score in out.items() if score > 0}


def widened(path: str) -> str:
    """The path of the outermost article (else main) element around a container."""
    steps = path.split("/")
    for tag in ("article", "main"):
        for i, step in enumerate(steps):
            if step.split(".")[0] == tag:
                return "/".join(steps[: i + 1])
    return path


def holding(blocks: list[Block], path: str, alone: bool) -> str:
    """The path of the container that holds the whole article of the container of ``path``.

    A container around takes over if it has a heading or text of its own, or if what it adds is
    text beside several containers of the path. ``alone``, without votes of other pages, also if the
    path has less than half of the page's text. The body takes over for a main heading or a tenth of the text.
    """
    whole = widened(path)
    if any(step.split(".")[0] in ("article", "main") for step in whole.split("/")):
        return whole
    inner = [b for b in blocks if b.within(path)]
    first = next((b for b in inner if any(p == path for _, p in b.owners)), None)
    if first is None:
        return path
    outer = [p for _, p in first.owners]
    total = sum(b.weight for b in blocks)
    for parent in reversed(outer[: outer.index(path)]):
        around = [b for b in blocks if b.within(parent)]
        added = [b for b in around if not b.within(path)]
        inner = [b for b in around if b.within(path)]
        own = [b for b in added if b.owners[-1][1] == parent]
        text, links, size = sum(b.weight for b in own), sum(b.links for b in own), sum(b.weight for b in inner)
        body = _tag(parent) == "body"
        headings = ("h1", "h2") if body else _HEADINGS
        takes = any(b.tag in headings and b.weight for b in own)
        takes = takes or (text > links and (not body or 10 * text >= size))
        if not takes and not body and sum(b.weight for b in added) > sum(b.links for b in added):
            boxes = {(_number(b, parent), _number(b, path)) for b in inner}
            takes = len(boxes) > len({box for box, _ in boxes}) or (alone and 2 * size < total)
        if takes:
            path = parent
    return path


def _number(block: Block, path: str) -> int:
    return next(number for number, p in block.around if p == path)


def extract(html: str, path: str | None) -> str:
    """The blocks inside the elements of the path, or of the page's own best container."""
    blocks = blocks_of(html)
    alone = path is None or not any(b.within(path) for b in blocks)
    if alone:
        own = scores(blocks)
        if not own:
            return " ".join(b.text for b in blocks)
        path = max(sorted(own), key=own.get)
    path = holding(blocks, path, alone)
    return " ".join(b.text for b in blocks if b.within(path))


def host_of(url) -> F.col:
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]*)", 1)), F.lit(""))


def votes(pages: DataFrame, html_col: str = "html", url_col: str = "url") -> DataFrame:
    """``host``, ``path``, ``votes``: summed shares of the best containers of the host's pages."""

    def run(batches):
        for batch in batches:
            for part in slices(batch, "html"):
                hosts, paths, shares = [], [], []
                for host, html in zip(part.column("host").to_pylist(), part.column("html").to_pylist()):
                    blocks = blocks_of(html or "")
                    own = scores(blocks)
                    total = sum(own.values())
                    for path in sorted(own, key=lambda p: (-own[p], p))[:VOTES]:
                        hosts.append(host)
                        paths.append(holding(blocks, path, True))
                        # in whole thousandths: sums do not depend on their order
                        shares.append(int(1000 * own[path] / total))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(hosts, pa.string()), pa.array(paths, pa.string()), pa.array(shares, pa.int64())],
                    ["host", "path", "votes"],
                )

    rows = pages.select(host_of(pages[url_col]).alias("host"), pages[html_col].alias("html"))
    cast = map_arrow(rows, run, "host string, path string, votes bigint")
    return cast.groupBy("host", "path").agg(F.sum("votes").alias("votes"))


def extract_pages(pages: DataFrame, html_col: str = "html", url_col: str = "url") -> DataFrame:
    """The pages with ``text`` and ``n_chars``; the html is not carried on."""
    spark = pages.sparkSession
    path = scratch_path(spark, "host-votes")
    votes(pages, html_col, url_col).write.parquet(path)
    cast = spark.read.parquet(path)
    # the path that most votes go to is the rule; only hosts that differ are joined
    best = cast.groupBy("path").agg(F.sum("votes").alias("v")).orderBy(F.desc("v"), "path").first()
    common = best["path"] if best else None
    winner = cast.groupBy("host").agg(F.max_by("path", F.struct("votes", "path")).alias("_path"))
    other = scratch_path(spark, "host-paths")
    winner.where(F.col("_path") != F.lit(common)).withColumnRenamed("host", "_host").write.parquet(other)

    kept = without(pages, ["text", "n_chars", "_host", "_path", html_col]).columns
    rows = pages.select(*(pages[c] for c in kept), pages[html_col].alias("_html"), host_of(pages[url_col]).alias("_host"))
    rows = rows.join(spark.read.parquet(other), "_host", "left")

    def run(part: pa.RecordBatch) -> dict:
        html, paths = part.column("_html").to_pylist(), part.column("_path").to_pylist()
        texts = [extract(h, p or common) if h else "" for h, p in zip(html, paths)]
        return {"text": pa.array(texts, pa.string()), "n_chars": np.array([len(t) for t in texts], np.int64)}

    out = enrich(rows, "text string, n_chars bigint", run, "_html")
    return out.select(*kept, "text", "n_chars")
