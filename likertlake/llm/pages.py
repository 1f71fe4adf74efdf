"""Main text of web pages, by removal of what a site repeats.

Every block element of a page is hashed with all below it. Spark counts on how many
different pages of a host each hash occurs; subtrees of many pages are the site's
template. What remains, without the elements that by tag, role or name are not the
article, is the text. Subtrees inside article and main are counted by the different
texts of the article around them: one that is published on many pages counts once, a
block that recurs in different articles is the site's.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import blake2b
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from likertlake.llm.share import column_udf
from likertlake.session import Workspace

#: A subtree is template if it is on so many different pages of its host. It is no share of them,
#: so that a section's menu goes whatever else the host has.
LEAST_PAGES = 5
#: Blocks that may be template inside an article: whole ones, not the rows of a list or table.
#: Paragraphs, headings, quotes and code without a class or an id are the author's, even if they recur.
WHOLE = frozenset("address center details div dl figure hgroup ol section table ul".split())
PROSE = frozenset("blockquote h1 h2 h3 h4 h5 h6 header p pre".split())
#: A subtree of so many characters, and at least half of its article, is the body of a copy with other small parts.
BODY = 1000
#: Tells hashes inside articles from those outside, where teasers repeat an article's parts.
INSIDE = 0x5BD1E9955BD1E995
#: Hashes of templates up to which their table goes to every executor.
BROADCAST_HASHES = 500_000

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 "
    "h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead tr ul".split()
)
NEVER = frozenset(
    "aside button canvas datalist dialog embed fieldset footer form head iframe input label menu nav noembed noframes noscript "
    "object script search select style svg template textarea title".split()
)
ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar tablist".split())
NAMES = re.compile(
    r"(^|[\s_-])(ads?|adverts?|advertisement|advertising|sponsor(ed)?|promos?|promotion|banner|cookies?|consent|gdpr|notices?|popup|"
    r"modal|overlay|newsletter|subscribe|subscription|sidebar|side-?bar|nav|navbar|navigation|menu|breadcrumbs?|pagination|pager|"
    r"header|footer|masthead|comments?|commentlist|respond|disqus|related|recommended|share|sharing|social|widgets?|toolbar|"
    r"copyright|login|signup|search)(?=$|[\s_-])",
    re.I,
)
#: An open element that a new one of these closes, and where the search for it stops.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "option": ({"option"}, {"select", "datalist"}),
    "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"table", "tr"}), "th": ({"td", "th"}, {"table", "tr"}),
    "tbody": ({"tbody", "thead", "tfoot"}, {"table"}), "tfoot": ({"tbody", "thead"}, {"table"}),
}
#: White space of HTML and the no-break and other spaces that a reader sees as one.
SPACE = re.compile(r"\s+")
#: A tag that the page ends in; a last bracket after text is text, one that is all there is would have been a tag.
UNFINISHED = re.compile(r"<[a-zA-Z/!?][^<>]*$|^\s*<$")


class Element:
    __slots__ = ("tag", "attrs", "children")

    def __init__(self, tag: str, attrs: dict[str, str]) -> None:
        self.tag, self.attrs = tag, attrs
        self.children: list[Element | str] = []

    def is_article(self) -> bool:
        return self.tag in ("article", "main") or self.attrs.get("role") in ("article", "main")

    def excluded(self, in_article: bool) -> bool:
        """Whether tag, role or name say that this is not the article."""
        if (self.tag in NEVER and "source" not in self.attrs) or (self.tag == "header" and not in_article):
            return True
        if self.attrs.get("role") in ROLES or "hidden" in self.attrs or self.attrs.get("aria-hidden") == "true":
            return True
        if self.tag in ("body", "html", "main") or re.fullmatch("h[1-6]", self.tag):
            return False
        names = [m[2].lower() for k in ("class", "id") for m in NAMES.finditer(self.attrs.get(k, ""))]
        return any(not in_article or n != "header" for n in names)  # an article's header has its title


class Reader(HTMLParser):
    """A tree of elements; unclosed and stray tags are mended as browsers do in the main."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = Element("html", {})
        self.stack = [self.root]

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in ("html", "body"):
            return
        if tag in BLOCKS and tag in CLOSES:
            self._close(*CLOSES[tag])
        if tag in BLOCKS:
            self._close({"p"}, BLOCKS - {"p"})
        kept = {k: v or "" for k, v in attrs if k in ("class", "id", "role", "hidden", "aria-hidden", "href")}
        if tag == "footer" and any(e.tag == "blockquote" for e in self.stack):
            kept["source"] = ""  # of the quote, and no footer of the page
        element = Element(tag, kept)
        self.stack[-1].children.append(element)
        if tag not in VOID:
            self.stack.append(element)

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)  # the slash has no meaning in HTML

    def handle_endtag(self, tag: str) -> None:
        if tag == "br":
            self.handle_starttag("br", [])
        # An inline end tag does not reach beyond the block that it stands in.
        elif tag not in ("html", "body"):
            self._close({tag}, set() if tag in BLOCKS and tag != "p" else BLOCKS - {tag})

    def handle_data(self, data: str) -> None:
        self.stack[-1].children.append(data)

    def _close(self, tags: set[str], until: set[str]) -> None:
        for k in range(len(self.stack) - 1, 0, -1):
            if self.stack[k].tag in tags:
                del self.stack[k:]
                return
            if self.stack[k].tag in until:
                return


def read(html: str) -> Element:
    """The tree of a page, which may end anywhere, even inside a tag."""
    reader = Reader()
    reader.feed(UNFINISHED.sub("", html))
    reader.close()
    return reader.root


def hashes(root: Element) -> tuple[dict[int, int], list[Element], list[str]]:
    """Hashes of elements with all below, by identity; the elements; all text of the page.

    Only elements that have text, hold no article and are in none get a hash.
    """
    order, holds, text, stack = [], set(), [], [(root, ())]
    while stack:
        e, above = stack.pop()
        order.append(e)
        path = (e, above)
        for c in e.children:
            if isinstance(c, str):
                if e.tag not in ("script", "style"):
                    text.append(c)
            elif c.is_article():
                text += _strings(c)
                up = path
                while up and id(up[0]) not in holds:
                    holds.add(id(up[0]))
                    up = up[1]
            else:
                stack.append((c, path))
    return _hashed(order, holds)[0], order, text


def _hashed(order: list[Element], holds: set[int] | frozenset[int] = frozenset()) -> tuple[dict[int, int], dict[int, int]]:
    """Hashes of the elements with text, and the length of it; ``order`` has parents first."""
    out: dict[int, int] = {}
    length: dict[int, int] = {}
    for e in reversed(order):
        if id(e) in holds:
            continue
        parts, n = [e.tag, e.attrs.get("class", ""), e.attrs.get("id", "")], 0
        for c in e.children:
            if isinstance(c, Element):
                parts.append(f"<{out[id(c)]}" if id(c) in out else f"<{c.tag}")
                n += length.get(id(c), 0)
            elif own := SPACE.sub(" ", c).strip():
                parts.append(f"'{own}")
                n += len(own)
        if n:
            out[id(e)], length[id(e)] = _digest("\0".join(parts)), n
    return out, length


def inside(top: Element) -> tuple[dict[int, int], dict[int, int], str]:
    """Hashes of what may be template inside an article or main, lengths, and all its text,
    which is left out if there are none.

    What tag, role or name exclude needs no hash and is no part of the text.
    """
    order, stack = [], [top]
    while stack:
        e = stack.pop()
        order.append(e)
        stack += [c for c in reversed(e.children) if isinstance(c, Element) and not c.excluded(True)]
    prose = not _is_main(top)
    asked = [id(e) for e in order if e is not top and _may_recur(e, prose)]
    if not asked:
        return {}, {}, ""
    h, length = _hashed(order)
    own = {k: h[k] ^ INSIDE for k in asked if k in h}
    return own, length, SPACE.sub(" ", "".join(c for e in order for c in e.children if isinstance(c, str))).strip()


def _may_recur(e: Element, prose: bool) -> bool:
    if not prose:
        return e.tag in BLOCKS
    return e.tag in WHOLE or (e.tag in PROSE and any(e.attrs.get(k) for k in ("class", "id")))


def _is_main(e: Element) -> bool:
    return e.tag == "main" or e.attrs.get("role") == "main"


def _strings(e: Element) -> list[str]:
    out, stack = [], [e]
    while stack:
        e = stack.pop()
        if isinstance(e, str):
            out.append(e)
        elif e.tag not in ("script", "style"):
            stack += reversed(e.children)
    return out


def _digest(text: str) -> int:
    return int.from_bytes(blake2b(text.encode("utf-8", "replace"), digest_size=8).digest(), "little", signed=True)


def fingerprint(root: Element) -> tuple[int, list[int], list[tuple[int, int]]]:
    """A hash of all text of the page, those of its block subtrees outside any article, and
    of those inside with a hash of the text of the article around."""
    h, order, text = hashes(root)
    out = sorted({h[id(e)] for e in order if e is not root and id(e) in h and e.tag in BLOCKS})
    within = set()
    for top in articles(root):
        own, length, around = inside(top)
        key, least = _digest(around), max(BODY, length.get(id(top), 0) / 2)
        within |= {(key, x) for k, x in own.items() if length[k] < least}
    return _digest("".join(text)), out, sorted(within)


def articles(root: Element) -> list[Element]:
    """The outermost articles of the page; main only if it holds none."""
    tops: list[Element] = []
    stack = [root]
    while stack:
        e = stack.pop()
        if e is not root and e.excluded(False):
            continue
        if e.is_article():
            tops.append(e)
            continue
        stack += [c for c in reversed(e.children) if isinstance(c, Element)]
    return [a for t in tops for a in (_articles(t) or [t])]


def main_text(root: Element, template: frozenset[int]) -> str:
    """Blocks of the article, one to a line; of the whole page if it marks no article."""
    tops = articles(root)
    blocks: list[str] = []
    for top in tops:
        _collect(top, True, inside(top)[0] if template else {}, template, blocks)
    if not tops:
        _collect(root, False, hashes(root)[0] if template else {}, template, blocks)
    return "\n".join(blocks)


def _articles(e: Element) -> list[Element]:
    if not _is_main(e):
        return [e]
    out, stack = [], [c for c in reversed(e.children) if isinstance(c, Element)]
    while stack:
        c = stack.pop()
        if c.excluded(True):
            continue
        if c.tag == "article":
            out.append(c)
        else:
            stack += [x for x in reversed(c.children) if isinstance(x, Element)]
    return out


def _collect(top: Element, in_article: bool, h: dict[int, int], template: frozenset[int], blocks: list[str]) -> None:
    """Add the text blocks of ``top`` in page order, without recursion for deep pages."""
    own: list[str] = []

    def end() -> None:
        if text := SPACE.sub(" ", "".join(own)).strip():
            blocks.append(text)
        own.clear()

    stack: list[Element | str | None] = [top]
    while stack:
        e = stack.pop()
        if e is None:
            end()
        elif isinstance(e, str):
            own.append(e)
        elif e is not top and (e.excluded(in_article) or (e.tag in BLOCKS and h.get(id(e)) in template)):
            own.append(" ")
        elif e.tag == "br":
            own.append(" ")
        else:
            if e.tag in BLOCKS:
                end()
                stack.append(None)
            stack += reversed(e.children)
    end()


def host(url: str):
    """Lower-case host of a URL column; null if there is none."""
    own = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    return F.when(own != "", own)


def templates(pages: DataFrame, url: str = "url", html: str = "html", least_pages: int = LEAST_PAGES) -> DataFrame:
    """``host`` and ``hash`` of each subtree on many different pages of its host.

    Pages that are equal in all their text count once; subtrees inside an article count
    once for each different text of it. Pages without a host or html are left out.
    """

    kind = pa.list_(pa.struct([("page", pa.int64()), ("hash", pa.int64())]))

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            found = [fingerprint(read(x or "")) for x in batch.to_pylist()]
            yield pa.array([[{"page": p, "hash": x} for p, x in [*((page, x) for x in own), *within]] for page, own, within in found], kind)

    rows = pages.select(host(f"`{url}`").alias("host"), F.col(f"`{html}`").alias("html")).where("host is not null and html is not null")
    each = rows.select("host", F.inline(column_udf(run, "array<struct<page bigint, hash bigint>>")("html"))).distinct()
    return each.groupBy("host", "hash").agg(F.count("*").alias("n")).where(F.col("n") >= least_pages).select("host", "hash")


def extract(
    pages: DataFrame, url: str = "url", html: str = "html", to: str = "text",
    least_pages: int = LEAST_PAGES, broadcast_hashes: int = BROADCAST_HASHES,
) -> DataFrame:
    """``pages`` with the main text in column ``to``; empty for null or empty html.

    The text is that of the article elements, else of main, else of the page. Character
    references are decoded, white space inside a block becomes one blank, blocks are
    trimmed and joined by line breaks. Site blocks inside article and main go too, but
    plain paragraphs and headings of an article stay however often they recur. Pages
    without a host lose no templates. Equal
    rows are treated alike. A column ``to`` of ``pages`` is replaced.
    """
    spark = pages.sparkSession
    found = templates(pages, url, html, least_pages)
    found = Workspace(spark, "pages").cut(found.groupBy("host").agg(F.collect_set("hash").alias("template")), "templates")
    n = found.agg(F.sum(F.size("template"))).first()[0] or 0

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([main_text(read(x["html"] or ""), frozenset(x["template"] or ())) for x in batch.to_pylist()], pa.string())

    rows = pages.select(F.struct(*[f"`{c}`" for c in pages.columns]).alias("_row"), host(f"`{url}`").alias("_host"), F.col(f"`{html}`").alias("html"))
    found = found.withColumnRenamed("host", "_host")
    rows = rows.join(F.broadcast(found) if n <= broadcast_hashes else found, "_host", "left")
    rows = rows.select("_row", column_udf(run, "string")(F.struct("html", "template")).alias("_out"))
    return rows.select(*[F.col("_row").getField(c).alias(c) for c in pages.columns if c != to], F.col("_out").alias(to))
