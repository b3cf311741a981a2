"""Main text of web pages by equivalence-class template deduction.

Pages of one host come from few templates. Tokens of a page are its elements (by path: tags
with class and id from the root) and its text blocks (by path and text). Over the pages of a
host each token has an occurrence vector, how often it stands on each page; tokens with equal
vectors form an equivalence class, held as an order-free hash of the vector (sums of page hashes), so Spark combines
it on the map side and a host with a third of all pages is never gathered in one task.

A class is valid if it stands on most of the host's pages. The class of the page skeleton (once
on every page) is the template's root; other valid classes nest below the class that holds
their parent path. Text blocks in a class that also has elements are the template's own words,
everything else is filling: slots, told apart by path. Text is summed up over all containers
above it; the main slot of a host is the lowest container that holds more than half of it.

A page's text is its filling inside ``article`` or ``main``, else all its filling, whatever
container it stands in. Containers that their tag, class, id or role marks as menu, header,
footer, sidebar, notice, advert, form or comments are left out. Marks are hints: one of them
makes text count a tenth, and those of the main slot (of the largest article's own, if there
are articles) and of all above it do not hold; articles with less than a tenth of the weight
outside them do not decide; an article inside an article is marked too. A name marks only if all its
parts say so, and never a heading. The template's words are left out, inside articles too, but only
in containers without filling; a page that has over ``COPIES`` times as much of them as of all
else is one of near copies, and they are its text.

Edge cases: null html is an empty page with an empty text; a null or odd url is the host "";
repeated rows are pages of their own; hosts with fewer than ``PAGES`` pages have no template
words; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadlens.llm.common import settle, sized
from roadlens.llm.markup import Block, Element, Page, read_page

PAGES = 3  # a host's words count as its template's from here on
SUPPORT = 0.8  # share of the host's pages that a valid class stands on
SCALE = 4
COPIES = 5  # a page with more than so many times its filling in words of the template is a copy
HALF = (1 << 31) - 1  # of a page hash: sums stay in a long for billions of pages
HOSTS = 20_000  # templates of up to this many hosts are broadcast


def host_of(url: str | None) -> str:
    try:
        return (urlsplit(url or "").netloc or "").lower()
    except ValueError:
        return ""


@lru_cache(maxsize=50_000)
def _hash(*parts) -> int:
    return int.from_bytes(hashlib.blake2b("\0".join(map(str, parts)).encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def _text_token(block: Block) -> int:
    return int.from_bytes(hashlib.blake2b(f"{block.element.path}\0{block.text}".encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def _container(block: Block) -> str:
    """The path of the container that a block's paragraph, list or table stands in."""
    at = block.element
    while at.parent is not None and at.parent.path and at.tag not in ("div", "section", "body", "article", "main"):
        at = at.parent
    return at.path


def _above(element: Element) -> set[str]:
    """The paths of an element and of all above it."""
    out, at = set(), element
    while at is not None:
        out.add(at.path)
        at = at.parent
    return out


def _weight(block: Block) -> int:
    """Characters, a tenth of them for each mark above the block (in units of 10**-SCALE)."""
    return len(block.text) * 10 ** (SCALE - min(block.element.marks, SCALE - 1))


class Filling:
    """Weighted text below each container of a page: blocks are summed up level by level, lowest first."""

    def __init__(self, blocks: list[Block]):
        levels: dict[int, dict[int, list]] = defaultdict(dict)
        for block in blocks:
            levels[block.element.depth].setdefault(id(block.element), [block.element, 0])[1] += _weight(block)
        self.chars: dict[str, int] = defaultdict(int)
        self.at: dict[str, Element] = {}  # some element with the path
        for depth in range(max(levels, default=-1), -1, -1):
            for element, chars in levels.pop(depth, {}).values():
                self.chars[element.path] += chars
                self.at[element.path] = element
                if element.parent is not None:
                    levels[depth - 1].setdefault(id(element.parent), [element.parent, 0])[1] += chars

    def lowest(self) -> set[str]:
        """The lowest container that holds more than half of the page's filling, and all above it."""
        half = [p for p, n in self.chars.items() if 2 * n > self.chars[""]]
        return _above(self.at[max(half, key=lambda p: self.at[p].depth)]) if half else {""}


def _tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ``host, kind, token, path, pages, high, low, chars``, combined over a batch; ``high, low`` sum the vector.

    kind 0: the host's pages; 1: an element; 2: a text block; 3: weighted text below a container (the token is its depth).
    """
    for batch in batches:
        found: dict[tuple, list] = defaultdict(lambda: [0, 0, 0, 0])
        for page_id, url, source in zip(*(c.to_pylist() for c in batch.columns)):
            host, page = host_of(url), read_page(source or "")
            found[host, 0, 0, ""][0] += 1
            seen: dict[tuple, int] = defaultdict(int)
            for path, n in page.paths.items():
                seen[1, _hash("element", path), path] = n
            for block in page.blocks:
                seen[2, _text_token(block), ""] += 1
            filling = Filling(page.blocks)
            for path, chars in filling.chars.items():
                found[host, 3, filling.at[path].depth, path][3] += chars
            for (kind, token, path), n in seen.items():
                row = found[host, kind, token, path]
                row[0] += 1
                hashed = _hash(page_id, url, n)
                row[1] += hashed >> 31 & HALF
                row[2] += hashed & HALF
        if found:
            keys, values = list(found), list(found.values())
            columns = [pa.array([k[i] for k in keys], t) for i, t in enumerate((pa.string(), pa.int32(), pa.int64(), pa.string()))]
            columns += [pa.array([v[i] for v in values], pa.int64()) for i in range(4)]
            yield pa.RecordBatch.from_arrays(columns, names=["host", "kind", "token", "path", "pages", "high", "low", "chars"])


def classes(pages: DataFrame) -> DataFrame:
    """Settled tokens that stand on most pages of their host, with class and host size, and the containers' filling.

    ``host, kind, token, path, pages, vector, chars, total``; tokens of one host with equal
    ``(pages, vector)`` are one class.
    """
    schema = "host string, kind int, token long, path string, pages long, high long, low long, chars long"
    tokens = pages.select("page_id", "url", "html").mapInArrow(_tokens, schema)
    tokens = tokens.groupBy("host", "kind", "token", "path").agg(*[F.sum(c).alias(c) for c in ("pages", "high", "low", "chars")])
    tokens = tokens.select("host", "kind", "token", "path", "pages", F.xxhash64("high", "low").alias("vector"), "chars")
    tokens = settle(tokens.where("kind in (0, 3) or pages >= 2"))
    hosts = sized(settle(tokens.where("kind = 0").select("host", F.col("pages").alias("total"))))
    tokens = tokens.where("kind > 0").join(hosts, "host")
    return settle(tokens.where((F.col("kind") == 3) | (F.col("pages") >= SUPPORT * F.col("total"))))


def templates(found: DataFrame) -> DataFrame:
    """The nested classes: ``host, pages, vector, paths, words, parent`` (the class that holds the parent path).

    ``words`` are the tokens of text blocks in the class.
    """
    one = F.when(F.col("kind") == 1, F.col("path"))
    own = found.where("kind < 3").groupBy("host", "pages", "vector").agg(
        F.sort_array(F.collect_list(one)).alias("paths"), F.sort_array(F.collect_list(F.when(F.col("kind") == 2, F.col("token")))).alias("words")
    )
    own = settle(own.where(F.size("paths") > 0))
    top = F.get("paths", F.lit(0))
    above = F.when(F.instr(top, "/") > 0, F.regexp_replace(top, r"/[^/]*$", ""))
    holders = own.select("host", F.explode("paths").alias("_above"), F.struct("pages", "vector").alias("parent"))
    return own.withColumn("_above", above).join(holders, ["host", "_above"], "left").drop("_above")


def host_templates(pages: DataFrame) -> DataFrame:
    """One settled row per host: ``host, words`` (the template's own text tokens) and ``main`` (the main slot's path)."""
    found = classes(pages)
    words = templates(found).where(F.size("words") > 0).join(found.groupBy("host").agg(F.max("total").alias("total")), "host")
    words = words.where(F.col("total") >= PAGES).groupBy("host").agg(F.flatten(F.collect_list("words")).alias("words"))
    slots = found.where("kind = 3").select("host", "path", "chars", F.col("token").alias("depth"))
    whole = slots.where("path = ''").select("host", F.col("chars").alias("whole"))
    main = slots.join(whole, "host").where("2 * chars > whole").groupBy("host").agg(F.max_by("path", "depth").alias("main"))
    return settle(main.join(words, "host", "left"))


def _opened(page: Page, main: str | None) -> tuple[bool, set[str]]:
    """Whether the page's text is that of its articles, and the paths whose marks do not count.

    These are the main slot and all above it: that of the largest article if the text is the
    articles', else the host's if the page has text there, else the page's own.
    """
    below: dict[int, list[Block]] = defaultdict(list)  # by article; 0: none
    for block in page.blocks:
        article = block.main()
        below[id(article) if article else 0].append(block)
    outside = sum(map(_weight, below.pop(0, [])))
    fillings = [Filling(blocks) for blocks in below.values()]
    if fillings and 10 * sum(f.chars[""] for f in fillings) >= outside:
        return True, max(fillings, key=lambda f: f.chars[""]).lowest()  # the first of equal ones
    whole = Filling(page.blocks)
    return False, _above(whole.at[main]) if main and main in whole.at else whole.lowest()


def main_text(page: Page, words: set[int], main: str | None) -> str:
    if not page.blocks:
        return ""
    articles, opened = _opened(page, main)
    known: dict = {}
    inside = [b for b in page.blocks if (b.in_main() or not articles) and not b.left_out(opened, known)]
    if not inside and not articles:
        _, opened = _opened(page, None)
        known = {}
        inside = [b for b in page.blocks if not b.left_out(opened, known)]
    if words:
        own = {id(b) for b in inside if _text_token(b) not in words}
        slots = {_container(b) for b in inside if id(b) in own}
        kept = [b for b in inside if id(b) in own or _container(b) in slots]
        chars = sum(len(b.text) for b in kept)
        if COPIES * chars >= sum(len(b.text) for b in inside) - chars:
            inside = kept
    return "\n\n".join(b.text for b in inside)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = []
        for source, words, main in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3))):
            texts.append(main_text(read_page(source), set(words or ()), main) if source else "")
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["_page", "text"])


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, text`` of every page."""
    named = pages.select("page_id", "url", "html").mapInArrow(_hosts, T.StructType([pages.schema[c] for c in ("page_id", "url", "html")]).add("host", "string"))
    rows = named.join(sized(host_templates(pages), HOSTS), "host", "left")
    rows = rows.select(F.struct("page_id", "url").alias("_page"), "html", "words", "main")
    out = rows.mapInArrow(_extract, T.StructType([rows.schema["_page"]]).add("text", "string"))
    return out.select("_page.page_id", "_page.url", "text")


def _hosts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        hosts = pa.array([host_of(u) for u in batch.column(1).to_pylist()], pa.string())
        yield pa.RecordBatch.from_arrays([*batch.columns, hosts], names=[*batch.schema.names, "host"])


def op1_html_extraction(pages: DataFrame) -> DataFrame:
    return extract(pages).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
