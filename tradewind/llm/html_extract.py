"""Main text of web pages by tag-path ratios.

A page becomes blocks of text in page order, each with its path of block elements from the root. Per distinct path
the text outside links and its punctuation are summed and divided by the number of blocks on the path. Both ratios are
smoothed along the page, fused as a geometric mean, and the paths above a threshold relative to the page's mean are
content. A content block brings in its surroundings: the article it stands in, or else what is below its parent, where
headings and paths above a lower threshold stay, so short paragraphs do and lists of links do not. Elements that are not
content by their tag (menus, sidebars, scripts, hidden parts) never count. Those whose role or whole class or id says so
(adverts, notices, reader comments; forms and page headers too) don't count either, unless they hold an article or most of
the page's text outside links: then the ratios alone decide.

Inline markup does not end a block; a line break is white space. Unclosed and misnested tags are tolerated: a new block ends an open
paragraph, an end tag closes what is open inside it. Null or empty html gives an empty text. Every row is kept.
"""

from __future__ import annotations

import math
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame

from tradewind.llm.frames import map_batches, quoted

INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small "
                   "span strike strong sub sup time tt u var wbr br img".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BREAKS = frozenset("br hr img wbr".split())
SILENT = frozenset("script style noscript template iframe svg math head title object canvas audio video select option "
                   "textarea button datalist nav aside footer dialog menu".split())
ARTICLE = frozenset("article main".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
CLOSES_ITSELF = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr", "table"),
                 "th": ("tr", "table"), "option": ("select",)}
ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split())
#: classes and ids that name parts which are not the article
NAMES = frozenset("ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion sidebar aside menu nav "
                  "navbar navigation breadcrumb breadcrumbs footer comment comments disqus respond reply replies cookie cookies consent "
                  "gdpr notice notices notification banner popup modal overlay newsletter subscribe subscription signup login share "
                  "sharing social related recommended pagination pager toolbar widget copyright skip search masthead "
                  "ad-banner cookie-banner cookie-notice cookie-consent site-footer page-footer main-nav site-nav comment-list comment-body "
                  "related-posts social-share share-buttons newsletter-signup".split())
COMMENT_NAMES = frozenset("comment comments disqus respond reply replies comment-list comment-body".split())
OUTSIDE_NAMES = frozenset("header topbar".split())  # parts of an article too, if they stand inside one
PUNCTUATION = frozenset(".,;:!?…。，、；：！？¿¡")
THRESHOLD = 0.25
INSIDE = 0.05  # the threshold in what a content block brings in
RADIUS = 1


def names_of(value: str | None) -> set[str]:
    return set((value or "").lower().split())


class Element:
    __slots__ = ("tag", "parent", "path", "silent", "article", "named", "doubtful", "plain", "holds", "dropped")

    def __init__(self, tag: str, parent: "Element | None", silent: bool, paths: dict, named: bool = False):
        self.tag, self.parent = tag, parent
        self.path = paths.setdefault((parent.path if parent else -1, tag), len(paths))  # a number for each distinct path
        self.silent = silent or bool(parent and parent.silent)
        self.article = self if tag in ARTICLE else parent.article if parent else None
        self.named = named
        self.doubtful = self if named else parent.doubtful if parent else None  # the nearest named element
        self.plain, self.holds, self.dropped = 0, False, False

    def around(self) -> "Element | None":
        """The nearest named element around a named one."""
        return self.parent.doubtful if self.parent else None


class Block:
    __slots__ = ("parent", "path", "text", "plain", "marks")

    def __init__(self, element: Element, text: str, linked: int):
        self.parent, self.path, self.text = element, element.path, text
        self.plain = max(0, len(text) - linked)
        self.marks = sum(c in PUNCTUATION for c in text)


class Page(HTMLParser):
    """Collects a page's blocks. Silent elements give no text, named ones only if they are not dropped at the end; inline ones
    stand on the stack only while they are either."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.paths: dict[tuple[int, str], int] = {}
        self.open = [Element("", None, False, self.paths)]
        self.links = 0
        self.pieces: list[tuple[Element | None, str, int]] = []  # where, text, characters in links
        self.parts: list[list[tuple[Element | None, str, int]]] = []
        self.doubts: list[Element] = []  # named elements, outer ones first
        self.blocks: list[Block] = []

    def end_block(self):
        if self.pieces:
            self.parts.append(self.pieces)
        self.pieces = []

    def close(self):
        super().close()
        self.end_block()
        self.drop_named()
        for part in self.parts:
            kept = [p for p in part if not (p[0] and p[0].doubtful and p[0].doubtful.dropped)]
            text = " ".join("".join(p[1] for p in kept).split())
            if text:
                owner = next((p[0] for p in kept if p[0]), self.open[0])
                while owner.tag in INLINE:
                    owner = owner.parent
                self.blocks.append(Block(owner, text, sum(p[2] for p in kept)))

    def drop_named(self):
        """A named element goes, unless it holds an article or most of the page's text outside links. Comments may be
        articles themselves: around them, only the page's single articles count."""
        total, elsewhere = 0, False
        for element, data, linked in (p for part in self.parts for p in part if p[0] and p[1].strip()):
            plain = 0 if linked else len(data.strip())
            total += plain
            if element.doubtful:
                element.doubtful.plain += plain
            if element.article and not element.article.named:
                outside = element.article.parent.doubtful
                if outside:
                    outside.holds = True
                else:
                    elsewhere = True
        for e in reversed(self.doubts):
            outer = e.around()
            if outer:
                outer.plain += e.plain
                outer.holds |= e.holds
        for e in self.doubts:
            outer = e.around()
            mine = e.holds and not (e.dropped and elsewhere)  # comments come marked
            e.dropped = bool(outer and outer.dropped) or not mine and 2 * e.plain <= total

    def opened(self, tag, attrs) -> Element:
        named, comments = self.is_named(tag, attrs)
        element = Element(tag, self.open[-1], self.is_silent(tag, attrs), self.paths, named)
        if named:
            element.dropped = comments
            self.doubts.append(element)
        return element

    def handle_starttag(self, tag, attrs):
        if tag == "a":
            self.links += 1
        if tag in BREAKS and self.pieces:
            self.pieces.append((None, " ", 0))
        if tag in INLINE:
            if tag not in VOID and (self.is_silent(tag, attrs) or self.is_named(tag, attrs)[0]):
                self.open.append(self.opened(tag, attrs))
            return
        if tag in VOID:
            if tag == "hr":
                self.end_block()
            return
        self.end_block()
        while self.open[-1].tag in INLINE or self.open[-1].tag == "p":
            self.open.pop()
        if tag in CLOSES_ITSELF:
            for k in range(len(self.open) - 1, 0, -1):
                if self.open[k].tag in CLOSES_ITSELF[tag]:
                    break
                if self.open[k].tag == tag:
                    del self.open[k:]
                    break
        self.open.append(self.opened(tag, attrs))

    def is_silent(self, tag, attrs) -> bool:
        given = dict(attrs)
        if tag in SILENT or "hidden" in given or given.get("aria-hidden") == "true":
            return True
        return "display:none" in (given.get("style") or "").replace(" ", "").lower()

    def is_named(self, tag, attrs) -> tuple[bool, bool]:
        """Is the element named as a part which is not the article, and as comments?"""
        given = dict(attrs)
        if tag in ("html", "body"):
            return False, False
        outside = self.open[-1].article is None
        names = names_of(given.get("class")) | names_of(given.get("id"))
        comments = bool(names & COMMENT_NAMES)
        if tag in ARTICLE:
            return comments, comments
        named = (tag == "form" or tag == "header" and outside or (given.get("role") or "").lower() in ROLES or bool(names & NAMES)
                 or bool(names & OUTSIDE_NAMES) and outside)
        return named, comments

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if tag == "a":
            self.links = max(0, self.links - 1)
        if tag in INLINE:
            if self.open[-1].tag == tag:
                self.open.pop()
            return
        self.end_block()
        for k in range(len(self.open) - 1, 0, -1):
            if self.open[k].tag == tag:
                del self.open[k:]
                return

    def handle_data(self, data):
        if self.open[-1].silent:
            return
        self.pieces.append((self.open[-1], data, len(data.strip()) if self.links else 0))


def smooth(values: list[float]) -> list[float]:
    """Mean over the neighbours within RADIUS blocks."""
    out = []
    for k in range(len(values)):
        near = values[max(0, k - RADIUS):k + RADIUS + 1]
        out.append(sum(near) / len(near))
    return out


def content_paths(blocks: list[Block]) -> tuple[set[int], set[int]]:
    """Paths whose fused, smoothed ratios of text and punctuation lie above the threshold, and above the one inside regions."""
    count: dict[int, int] = {}
    chars: dict[int, int] = {}
    marks: dict[int, int] = {}
    for b in blocks:
        count[b.path] = count.get(b.path, 0) + 1
        chars[b.path] = chars.get(b.path, 0) + b.plain
        marks[b.path] = marks.get(b.path, 0) + (b.marks if b.plain else 0)
    text_ratio = smooth([chars[b.path] / count[b.path] for b in blocks])
    mark_ratio = smooth([(marks[b.path] + 1) / count[b.path] for b in blocks])
    fused: dict[int, float] = {}
    for b, t, m in zip(blocks, text_ratio, mark_ratio, strict=True):
        if b.plain:
            fused[b.path] = fused.get(b.path, 0.0) + math.sqrt(t * m) / count[b.path]
    # the page's level: the fused ratio of its characters, not of its blocks, so that many short menus don't lower it
    total = sum(chars[p] for p in fused)
    level = sum(fused[p] * chars[p] for p in fused) / total if total else 0.0
    return {p for p, f in fused.items() if f >= THRESHOLD * level}, {p for p, f in fused.items() if f >= INSIDE * level}


def region(block: Block) -> Element:
    """Where a content block brings in more: its article, or its parent's whole inside."""
    return block.parent.article or (block.parent.parent or block.parent)


def extract(html: str | None) -> str:
    """The main text: blocks in page order, two line breaks between."""
    if not html:
        return ""
    page = Page()
    page.feed(html)
    page.close()
    blocks = page.blocks
    if not blocks:
        return ""
    paths, fair = content_paths(blocks)
    chosen = [b for b in blocks if b.path in paths]
    # text inside articles settles where the content is; elsewhere parts of the page compete by their ratios alone
    if any(b.parent.article for b in chosen):
        chosen = [b for b in chosen if b.parent.article]
    regions = {id(region(b)): region(b) for b in chosen}
    wide = {key for key, r in regions.items() if r.tag in ("", "html", "body")}

    inside: dict[int, bool] = {id(None): False}

    def within(element: Element | None) -> bool:
        """Is it, or does it stand in, a region narrower than the page?"""
        chain = []
        while id(element) not in inside:
            chain.append(element)
            if id(element) in regions and id(element) not in wide:
                inside[id(element)] = True
                break
            element = element.parent
        for e in chain:
            inside[id(e)] = inside[id(element)]
        return inside[id(element)]

    def kept(b: Block) -> bool:
        if b.path in paths and id(region(b)) in regions:
            return True
        if within(b.parent):
            return b.path in fair or b.parent.tag in HEADINGS
        return b.parent.tag in HEADINGS and id(b.parent.parent) in wide

    return "\n\n".join(b.text for b in blocks if kept(b))


def extract_main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""
    narrow = pages.select(quoted(id_col).cast("long").alias("page_id"), quoted(url_col).cast("string").alias("url"),
                          quoted(html_col).cast("string").alias("html"))

    def run(batch):
        for lo in range(0, batch.num_rows, 256):
            some = batch.slice(lo, 256)
            texts = [extract(h) for h in some.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [some.column(0), some.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars"])

    return map_batches(narrow, run, "page_id long, url string, text string, n_chars long")
