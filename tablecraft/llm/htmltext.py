"""Main text of web pages, with the help of a style tree for each site.

The pages of a host are merged into one tree: nodes of the same path of tags and classes are
one element, with counts of its presentations (the sequence of child elements) and contents
(the text that it holds itself). An element's importance is the entropy of both over the
pages that have it, divided by the logarithm of their number: 1 if every page differs, 0 if
all are alike. The entropy of all that it holds, its descendants' text included, counts if it is
greater. Elements under ``IMPORTANCE`` on ``LEAST_PAGES`` pages or more are low; they are removed
with all that they hold unless that is text of an element that is not low.

Beside that, elements whose tag, class, id or role names a menu, header, footer, sidebar,
notice, advert, form, comment list or code are removed on any page. A name counts if it is the
whole of a class, or if the rest of the class says where or what kind of box it is (ad-slot,
left-sidebar); names that can hardly mean anything else count as the last word of any class
(shop-navbar), fewer of them within articles. Names that tell of a layout (has-sidebar), headers and widgets of
an article's content, and quotations set beside the text are no such names. A form, a sidebar or
the like around the first article leaves the article, and so does a menu that is never closed. A
form that holds most of the text of a page without articles is its content.

Within an article, paragraphs and headings are its text and are left to no statistics; if a page
has an article or main element, only what it holds is taken, and if that has no heading of the
first rank, also the last such heading before it with all that stands between.

Pages are read in time proportional to their length: ends of elements that are not open are told
by counts of open ones, and what follows a tag or a number of comments that never close is not
searched again for each.

Counts are kept by (host, path, presentation or content) and summed in tasks first, so a
host with a third of all pages is not gathered anywhere; contents are counted by hash.

Defined results: a null or empty page has an empty text. Pages with a null or odd url belong
to no site and lose only what names itself. Rows that repeat give equal rows. An empty table
gives an empty table.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablecraft.shared import settled

IMPORTANCE = 0.5
LEAST_PAGES = 8
SEEN = 0  # the record that an element is on a page

# Names of elements and of their roles.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CODE = frozenset("script style noscript template svg math canvas object iframe audio video head".split())
ASIDE = frozenset("nav header footer aside form button select textarea dialog menu fieldset".split())
NAMED = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies "
    "disclaimer dialog footer form header login masthead menu menubar modal nav navbar navigation newsletter notice notices "
    "pagination popup promo promotion related replies search share sharing sidebar signup skip social sponsor sponsored "
    "subscribe subscription toolbar widget complementary contentinfo alert".split()
)
LAYOUT = frozenset("has have no not with without is hide show hidden".split())  # "has-sidebar" is on what stands beside one
CONTENT = frozenset("article content entry post story".split())  # "article-header", "post-content-widget" hold content
HOLDS = frozenset("header widget banner masthead".split())
# Names of what may stand around an article as well; comments and adverts may not.
AROUND = HOLDS | frozenset("sidebar footer form menu menubar modal dialog nav navbar navigation toolbar widget".split())
# Names that hardly mean anything else, and words that say where or what kind of box something is.
PLAIN = frozenset(
    "advert adverts advertisement breadcrumb breadcrumbs cookie cookies footer masthead menubar modal navbar navigation newsletter "
    "pagination popup sidebar signup sponsored toolbar nav menu banner header widget comments".split()
)
PLAIN_IN_MAIN = frozenset("advert adverts advertisement breadcrumbs comments footer navbar newsletter sidebar sponsored".split())
BOX = frozenset(
    "area bar block body bottom box btn button buttons col column container el first form group home icon icons id inner items item "
    "label last layout left line link links list main mobile outer page panel posts primary right row secondary section site slot "
    "sticky sub tertiary text title top unit wrap wrapper zone".split()
)
QUOTED = frozenset("pull pullquote quote quotation".split())  # an aside that repeats or sets off the text
LEAVES = frozenset("nav header footer aside menu form".split())  # elements that may hold an article all the same
HEAD = frozenset("base basefont bgsound head link meta noscript script style template title".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split()
)
TEXT = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre b i em strong a span br".split())
CLOSES = {  # an opening tag ends these, up to the nearest of the second set
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"table", "tr"}),
    "th": ({"td", "th"}, {"table", "tr"}),
    "option": ({"option"}, {"select"}),
}
_WORD = re.compile(r"[A-Za-z]+")
_PART = re.compile(r"[A-Z]?[a-z]+")  # of camelCase names
_TOKEN = re.compile(r"\S+")


def _named(tokens: list[str], in_main: bool) -> set[str]:
    """Words of classes, ids and roles that name what is no main text."""
    found: set[str] = set()
    for token in tokens:
        whole = [name.lower() for name in _WORD.findall(token)]
        parts = [w.lower() for name in _WORD.findall(token) for w in _PART.findall(name)]
        words = NAMED.intersection(whole + parts)
        if not words or not parts or parts[0] in LAYOUT:
            continue
        if not any(words.issuperset(w for w in names if w not in BOX) for names in (whole, parts) if words.intersection(names)):
            # another word is in it: only its last one can name it
            words = {parts[-1]} & words & (PLAIN_IN_MAIN if in_main else PLAIN)
        if in_main or CONTENT.intersection(parts):
            words = words - ({"header"} if in_main and not CONTENT.intersection(parts) else HOLDS)
        found |= words
    return found


def _hash(*parts: str | int) -> int:
    return int.from_bytes(hashlib.blake2b("\0".join(map(str, parts)).encode("utf-8", "replace"), digest_size=8).digest(), "little", signed=True)


class _Node:
    __slots__ = ("tag", "path", "gone", "hard", "main", "free", "low", "above", "mixed", "form", "inside", "outer", "closed", "children", "own", "whole")

    def __init__(self, tag: str, path: int, gone: bool, main: bool, free: bool, low: bool = False, above: _Node | None = None):
        self.tag, self.path, self.gone, self.main, self.free = tag, path, gone, main, free
        self.low, self.above = low, above  # the nearest low element around it
        self.hard = False  # gone, and an article in it as well
        self.mixed = False  # a low element that holds text of one that is not
        self.form = False  # gone for no other reason than a form around it
        self.inside: _Node | None = None  # the nearest menu or the like around it
        self.outer: _Node | None = None  # and, of such an element, the next one around it
        self.closed = False  # by its own end tag
        self.children: list[str] = []  # signatures, for the presentation
        self.own: list[str] = []  # text, for the content
        self.whole: list[str | int] = []  # text and hashes of what its children hold

    def near(self) -> _Node | None:
        return self if self.low else self.above


_OPEN_TAG = re.compile("<[A-Za-z/]")
_NEVER_CLOSED = 16  # comments or sections that never close, beyond which they are taken to end at the next ">"


def _readable(html: str) -> str:
    """A page without what the parser would search to its end again and again: the tag that the
    end of the page cuts off, and the starts of many comments or sections that never close."""
    body = html.rfind(">") + 1
    cut = _OPEN_TAG.search(html, body)
    html = html[: cut.start()] if cut else html
    for start, end in (("<!--", "-->"), ("<![", "]>")):
        last = html.rfind(end) + 1
        if html.count(start, last) > _NEVER_CLOSED:
            html = html[:last] + html[last:].replace(start, "<!- ")
    return html


#: A piece of text: the low element and the menu around it, and whether only a form removes it.
_Piece = tuple[_Node | None, _Node | None, bool, str]


def _inside_closed(node: _Node | None) -> bool:
    """Whether a menu or the like that does end stands around an article."""
    while node is not None:
        if node.closed:
            return True
        node = node.outer
    return False


class PageReader(HTMLParser):
    """Reads one page into blocks of text, and its elements for the site's tree."""

    def __init__(self, low: frozenset[int] = frozenset(), tree: bool = False):
        super().__init__(convert_charrefs=True)
        self.low, self.tree = low, tree
        self.stack = [_Node("", 0, False, False, False)]
        self.open: Counter = Counter()  # tags on the stack
        self.buffer: list[_Piece] = []
        self.blocks: list[tuple[bool, bool, list[_Piece]]] = []  # in an article, in a heading of the first rank
        self.records: list[tuple[int, int]] = []
        self.paths: dict[tuple[int, str], int] = {}
        self.mains: list[tuple[_Node | None, _Node | None]] = []  # low elements and menus around articles

    def updatepos(self, i: int, j: int) -> int:
        """Lines and columns are of no use here."""
        return j

    def _flush(self) -> None:
        if self.buffer:
            self.blocks.append((self.stack[-1].main, self.open["h1"] > 0, self.buffer))
            self.buffer = []

    def _pop(self) -> None:
        node = self.stack.pop()
        self.open[node.tag] -= 1
        if not self.tree or node.tag in CODE:
            return
        whole = _hash("whole", *node.whole) & ~1 if node.whole else SEEN
        if whole and self.stack:
            self.stack[-1].whole.append(whole)
        if not node.free:
            self.records.append((node.path, SEEN))
            if node.children:
                self.records.append((node.path, _hash("style", *node.children) | 1))
            if node.own and (text := " ".join("".join(node.own).split())):
                self.records.append((node.path, _hash("text", text) | 1))
            if whole:
                self.records.append((node.path, whole))

    def _pop_to(self, depth: int) -> None:
        if any(node.tag in BLOCKS for node in self.stack[depth:]):
            self._flush()
        while len(self.stack) > depth:
            self._pop()

    def _end_head(self) -> None:
        """What does not belong to a head ends it, and a noscript in it."""
        top = len(self.stack) - 1
        head = top - 1 if self.stack[top].tag == "noscript" else top
        if head > 0 and self.stack[head].tag == "head":
            self._pop_to(head)

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag not in HEAD:
            self._end_head()
        if tag in BLOCKS:
            self._flush()
            for depth in range(len(self.stack) - 1, 0, -1) if self.open["p"] else ():  # a block ends an open paragraph
                if self.stack[depth].tag == "p":
                    self._pop_to(depth)
                elif self.stack[depth].tag in BLOCKS:
                    break
        if tag in CLOSES:
            ends, until = CLOSES[tag]
            for depth in range(len(self.stack) - 1, 0, -1) if any(self.open[t] for t in ends) else ():
                if self.stack[depth].tag in until:
                    break
                if self.stack[depth].tag in ends:
                    self._pop_to(depth)
        if tag == "br":
            self.handle_data(" ")
        top = self.stack[-1]
        names: list[str] = []
        tokens: list[str] = []
        for key, value in attrs:
            if key in ("class", "id", "role") and value:
                names += _WORD.findall(value)
                tokens += _TOKEN.findall(value)
        whole = tag in ("html", "body", "article", "main")
        words = set() if whole else _named(tokens, top.main)
        signature = ".".join([tag, *sorted(names)])
        path = self.paths.get((top.path, signature))
        if path is None:
            path = self.paths[top.path, signature] = _hash(top.path, signature)
        main = top.main or tag in ("article", "main")
        article = tag in ("article", "main")
        aside = tag in ASIDE and not (tag == "header" and top.main)
        if tag == "aside" and top.main and QUOTED.intersection(w.lower() for n in names for w in _PART.findall(n)):
            aside = False
        around = aside and tag in LEAVES
        hard = top.hard or tag in CODE or aside and not around or bool(words - AROUND)
        freed = article and not hard and not any(inside is None for _, inside in self.mains)
        gone = hard or aside or bool(words) or top.gone and not (freed and not (top.main and top.gone))
        free = top.main and tag in TEXT or whole
        low = not free and path in self.low
        node = _Node(tag, path, gone, main, free, low, top.near())
        node.hard = hard
        # A form in an article is one; else it may hold the content of the page.
        formed = tag == "form" and (top.form or not top.gone) or not aside and top.form
        node.form = gone and formed and not (hard or words or main)
        # Menus and the like that are closed around an article take it with them.
        node.inside = top.inside
        if around and tag != "form":
            node.inside, node.outer = node, top.inside
        if article and not gone:
            self.mains.append((top.near(), top.inside))
        if self.tree:
            top.children.append(signature)
        if tag not in VOID:
            self.stack.append(node)
            self.open[tag] += 1

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        for depth in range(len(self.stack) - 1, 0, -1) if self.open[tag] else ():
            if self.stack[depth].tag == tag:
                self.stack[depth].closed = True
                self._pop_to(depth)
                return

    def handle_data(self, data: str) -> None:
        if self.stack[-1].tag == "head" and not data.isspace():
            self._end_head()
        top = self.stack[-1]
        if not top.gone or top.form:
            self.buffer.append((top.near(), top.inside, top.form, data))
            low = None if top.low or top.free or top.form else top.above
            while low is not None and not low.mixed and not data.isspace():
                low.mixed, low = True, low.above
        if self.tree:
            if not top.free:
                top.own.append(data)
            if text := " ".join(data.split()):
                top.whole.append(text)

    def read(self, html: str) -> PageReader:
        self.feed(_readable(html))
        self.close()
        self._pop_to(1)
        self._flush()
        return self

    def text(self) -> str:
        def kept(low: _Node | None, inside: _Node | None) -> bool:
            return (low is None or low.mixed) and not _inside_closed(inside)

        size = Counter()
        for _, _, pieces in self.blocks:
            for low, inside, form, data in pieces:
                size[form] += len(data.strip()) * kept(low, inside)
        has_main = any(kept(low, inside) for low, inside in self.mains)
        with_form = not has_main and size[True] > size[False]
        texts = []
        for main, heading, pieces in self.blocks:
            said = "".join(data for low, inside, form, data in pieces if kept(low, inside) and (with_form or not form))
            if text := " ".join(said.split()):
                texts.append((main, heading, text))
        if has_main:
            first = next((i for i, (main, _, _) in enumerate(texts) if main), len(texts))
            title = first
            if not any(main and heading for main, heading, _ in texts):
                title = next((i for i in range(first - 1, -1, -1) if texts[i][1]), first)
            texts = [t for i, t in enumerate(texts) if t[0] or title <= i < first]
        return "\n".join(text for _, _, text in texts)


def site_tree(pages: DataFrame) -> DataFrame:
    """host, path, importance, n_pages of the elements that statistics may remove."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: Counter = Counter()
            for host, html in zip(batch.column("host").to_pylist(), batch.column("html")):
                for record in set(PageReader(tree=True).read(html.as_py() or "").records):
                    counts[(host, *record)] += 1
            rows = [(*key, n) for key, n in counts.items()]
            columns = list(zip(*rows)) if rows else [(), (), (), ()]
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["host", "path", "value", "n"])

    counted = pages.where("host IS NOT NULL").select("host", "html").mapInArrow(read, "host string, path long, value long, n long")
    values = counted.groupBy("host", "path", "value").agg(F.sum("n").alias("n"))
    seen, n = F.col("value") == SEEN, F.col("n").cast("double")
    own, whole = F.col("value") % 2 != 0, (F.col("value") % 2 == 0) & ~seen
    nodes = values.groupBy("host", "path").agg(
        F.sum(F.when(seen, F.col("n"))).alias("n_pages"),
        *[F.sum(F.when(kind, n)).alias(f"m_{name}") for name, kind in (("own", own), ("whole", whole))],
        *[F.sum(F.when(kind, n * F.log(n))).alias(f"s_{name}") for name, kind in (("own", own), ("whole", whole))],
    )

    def entropy(name: str) -> Column:
        m = F.col(f"m_{name}")
        return F.when(m > 1, (F.log(m) - F.col(f"s_{name}") / m) / F.log(m))

    importance = F.greatest(F.coalesce(entropy("own"), F.lit(1.0)), entropy("whole"))
    return nodes.select("host", "path", importance.alias("importance"), "n_pages")


def main_text(pages: DataFrame, importance: float = IMPORTANCE, least_pages: int = LEAST_PAGES, key: str = "page_id") -> DataFrame:
    """key, url, text, n_removed (elements of the site's tree that its pages lose)."""
    host = F.lower(F.try_parse_url("url", F.lit("HOST")))
    sited = pages.select(F.col(key), "url", host.alias("host"), "html")
    low = site_tree(sited).where((F.col("importance") < importance) & (F.col("n_pages") >= least_pages))
    # One row per host; a host's list follows the variety of its markup, not its pages.
    lists = settled(low.groupBy("host").agg(F.collect_list("path").alias("low")), "low")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, removed = [], []
            for html, paths in zip(batch.column("html"), batch.column("low")):
                low_paths = frozenset(paths.as_py() or ())
                texts.append(PageReader(low_paths).read(html.as_py() or "").text())
                removed.append(len(low_paths))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(removed, pa.int64())],
                names=[key, "url", "text", "n_removed"],
            )

    kind = pages.schema[key].dataType.simpleString()
    joined = sited.join(lists, "host", "left").select(key, "url", "html", "low")
    return joined.mapInArrow(read, f"`{key}` {kind}, url string, text string, n_removed long")


def op7_html_text(pages: DataFrame) -> DataFrame:
    return main_text(pages).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
