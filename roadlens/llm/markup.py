"""A forgiving HTML reader: text blocks of a page with the path and the role of where they stand.

Not a full HTML parser: it follows open elements closely enough for damaged pages (unclosed and
stray tags, cut ends, raw script and style) and yields blocks of visible text in page order.
"""

from __future__ import annotations

import hashlib
import html
import re
from dataclasses import dataclass, field
from functools import lru_cache

TAGS = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([A-Za-z][A-Za-z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<(/?)([A-Za-z][A-Za-z0-9:-]*)([^>]*)(?:>|\Z)",
    re.S,
)
ATTRIBUTES = re.compile(r"([A-Za-z_:][\w:.-]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
NAME_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+")

RAW = {"script", "style", "textarea", "title", "iframe", "noframes", "xmp"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
BLOCK = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "head header hgroup hr html li main menu nav ol option p pre section select summary table tbody tfoot thead tr ul".split()
)
SPACED = {"br", "td", "th", "img", "input", "wbr"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
MAIN = {"article", "main"}
# elements that hold no text of an article, unless the article or the main slot stands in them
OUT = set("aside audio button canvas dialog embed fieldset footer form head iframe input label map menu nav noscript object option script select style svg template textarea title video".split())
# class, id and role names of such containers: a name counts if all its parts are among these or plain ones
OUT_NAMES = set(
    "ad ads advert adverts advertisement advertisements advertising adbox sponsor sponsored sponsors promo promotion banner sidebar sidebars comment comments "
    "commentlist reply replies respond responses discussion disqus cookie cookies consent gdpr notice notices alert popup popover modal overlay newsletter subscribe "
    "subscription signup signin login nav navbar navigation menu menubar breadcrumb breadcrumbs pagination pager footer masthead topbar related recommended "
    "recommendations share sharing social widget widgets toolbar search form contentinfo complementary dialog copyright disclaimer skip teaser teasers tags hidden".split()
)
HEADER_NAMES = {"header"}
PLAIN_NAMES = set(
    "area article articles bar block body bottom box button buttons center col column container content div fixed global group head holder icons inner item "
    "items js layout left link links list main mobile more outer page panel pane post posts primary reader region right row secondary section site slot space "
    "stories sticky story text thread title top unit user users view wrap wrapper zone".split()
)
# names that an article's own sections have as anchors; as the id of a section they mark nothing
TOPICS = set("advertising alert copyright disclaimer discussion form navigation notice notices promotion recommendations replies reply responses search".split())
CLOSES_P = BLOCK - {"html", "body", "head", "caption", "tbody", "thead", "tfoot", "tr", "option"}
SAME = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPE = {"li": {"ul", "ol", "menu", "dir"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}, "option": {"select"}}
PATH = 1_000  # characters of a path from which on a digest stands for what is above


@dataclass
class Element:
    tag: str
    parent: Element | None
    path: str  # tags with class and id from the page on; different for every place in the tree
    out: bool  # tag or names mark it as a container of no article's text
    header: bool
    main: bool
    closed: bool = False
    has_main: bool = False
    marks: int = 0  # marked containers from here up
    depth: int = 0
    top: Element | None = None  # the outermost article or main element from here up
    in_article: bool = False

    @property
    def marked(self) -> bool:
        return self.out or self.header


@dataclass
class Block:
    element: Element
    text: str
    heading: bool

    def left_out(self, opened: set[str] = frozenset(), known: dict | None = None) -> bool:
        """Below a marked container, other than those with a path in ``opened``.

        ``known`` carries answers from block to block of a page, so that each element is asked a few times only.
        """
        known = {} if known is None else known
        at, below_main, out = self.element, False, False
        asked = []
        while at is not None:
            key = id(at), below_main, self.heading
            if key in known:
                out = known[key]
                break
            asked.append(key)
            if at.marked and at.path not in opened:
                if at.out and not (at.tag in ("nav", "aside", "footer") and not at.closed and at.has_main and below_main):
                    out = True
                    break
                if at.header and not (self.heading and at.top is not None) and not (not at.closed and below_main):
                    out = True
                    break
            below_main = below_main or at.main
            at = at.parent
        known.update(dict.fromkeys(asked, out))
        return out

    def in_main(self) -> bool:
        return self.element.top is not None

    def main(self) -> Element | None:
        """The outermost article or main element above the block."""
        return self.element.top


@dataclass
class Page:
    blocks: list[Block] = field(default_factory=list)
    paths: dict[str, int] = field(default_factory=dict)  # element paths and how often each occurs


@lru_cache(maxsize=50_000)
def _named(name: str, wanted: frozenset[str]) -> bool:
    """Whether the whole name says so: ``ad-box`` is an advert, ``ad-hoc-networks`` is not."""
    parts = {x.lower() for x in NAME_PARTS.findall(name) if not x.isdigit()}
    return bool(parts & wanted) and parts <= OUT_NAMES | HEADER_NAMES | PLAIN_NAMES


MARKS, HEADER_MARKS = frozenset(OUT_NAMES), frozenset(HEADER_NAMES)


def _element(tag: str, raw: str, parent: Element) -> Element:
    label, hidden, named, header = tag, False, False, tag == "header"
    if raw.strip(" /\t\r\n\f"):
        for m in ATTRIBUTES.finditer(raw):
            key, value = m[1].lower(), m[2] or m[3] or m[4] or ""
            if key in ("class", "id", "role"):
                if tag not in HEADINGS and not (tag == "p" and key == "id"):
                    names = [x for x in value.split() if not (tag == "section" and key == "id" and x.lower() in TOPICS)]
                    named = named or any(_named(x, MARKS) for x in names)
                    header = header or (tag != "article" and any(_named(x, HEADER_MARKS) for x in names))
                if key != "role":
                    label += {"class": ".", "id": "#"}[key] + re.sub(r"\d+", "0", value.strip().replace("/", "_"))
            elif key == "hidden" or (key == "style" and re.search(r"display\s*:\s*none", value)) or (key == "aria-hidden" and value == "true"):
                hidden = True
    above = parent.path
    if len(above) > PATH:
        above = "~" + hashlib.blake2b(above.encode("utf-8", "surrogatepass"), digest_size=8).hexdigest()
    whole = tag in ("html", "body")
    header = header and (tag == "header" or not whole and tag != "main")
    # an article in an article is a reader's comment or another story
    inner = tag == "article" and parent.in_article
    out = tag in OUT or (named and not whole and tag != "main") or (hidden and not whole) or inner
    element = Element(tag, parent, f"{above}/{label}", out, header, tag in MAIN, marks=parent.marks + (out or header), depth=parent.depth + 1)
    element.in_article = parent.in_article or tag == "article"
    element.top = parent.top or (element if element.main else None)
    return element


def read_page(source: str) -> Page:
    page = Page()
    stack: list[Element] = [Element("", None, "", False, False, False)]
    words: list[str] = []

    def flush() -> None:
        if words:
            text = " ".join(html.unescape("".join(words)).split())
            words.clear()
            if text:
                page.blocks.append(Block(stack[-1], text, any(e.tag in HEADINGS for e in stack[-3:])))

    def pop_to(n: int) -> None:
        del stack[n:]

    at = 0
    while at < len(source):
        m = TAGS.search(source, at)
        if m is None:
            words.append(source[at:])
            break
        if m.start() > at:
            words.append(source[at : m.start()])
        at = m.end()
        tag = m[2] or m[5]
        if tag is None:
            continue
        tag = tag.lower()
        closing = m[1] if m[2] else m[4]
        raw = (m[3] if m[2] else m[6]) or ""
        if closing:
            if tag in BLOCK:
                flush()
            elif tag in SPACED:
                words.append(" ")
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    stack[i].closed = True
                    pop_to(i)
                    break
                if stack[i].main and tag not in ("body", "html", "main", "article"):
                    break  # a stray end tag does not end the article
            continue
        if tag in BLOCK:
            flush()
        elif tag in SPACED:
            words.append(" ")
        if tag in CLOSES_P:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == "p":
                    pop_to(i)
                    break
                if stack[i].tag in BLOCK:
                    break
        if tag in SAME:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag in SAME[tag]:
                    pop_to(i)
                    break
                if stack[i].tag in SCOPE[tag]:
                    break
        element = _element(tag, raw, stack[-1])
        page.paths[element.path] = page.paths.get(element.path, 0) + 1
        if element.main:
            up = element.parent
            while up is not None and not up.has_main:
                up.has_main = True
                up = up.parent
        if tag in VOID or raw.rstrip().endswith("/") and tag not in BLOCK and tag not in RAW:
            if tag in BLOCK:
                flush()
            continue
        if tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>]|\Z)", re.I).search(source, at)
            at = end.start() if end else len(source)
            close = source.find(">", at)
            at = len(source) if close < 0 else close + 1
            continue
        stack.append(element)
    flush()
    return page
