"""Main text of web pages, with the site's template removed.

Every page is parsed once into text blocks and elements. An element's subtree has a hash of its tags, classes and texts; Spark counts on
how many different pages of a host each subtree occurs, and subtrees that recur on many of them are the site's template and are deleted.
Pages of a host with the same remaining text are copies of one page and count once, so a page is not its own template. What an
element says about itself decides first: menus, headers, footers, side bars, adverts, forms, scripts and reader comments go by tag, role and class;
where a page has an article, only what is in it stays. A name counts if a whole class or id says nothing else (``share-box``, not ``no-sidebar``), and
skips no element that holds an article or is one, but for reader comments beside another article's text. Names that say less are left to the counts. Paragraphs, headings, list items and cells of an article are its content, however often
a host repeats them: neither they nor what is in them nor what holds them is ever taken for template, unless it has such a name; other containers in an article are.

A page whose remaining blocks lie in no countable element is finished after parsing; only the others wait for the counts.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardloom.llm.common import joined_by_size, sent_to_tasks, written
from wardloom.llm.urlfilter import url_parts

# fixed values: element names of HTML and usual names of page parts
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea iframe noembed noframes noscript xmp template svg math".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header "
    "hgroup hr html legend li main menu nav ol optgroup option p pre section select summary table tbody td tfoot th thead tr ul".split()
)
CONTENT = frozenset("p h1 h2 h3 h4 h5 h6 li dd dt blockquote pre figcaption td th tr".split())
MAIN = frozenset(("article", "main"))
SKIPPED = frozenset("head nav header footer aside form button select menu dialog object".split())
SKIPPED_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog form menu menubar toolbar".split())
COMMENTS = frozenset("comment comments disqus respond replies reply".split())
SKIPPED_NAMES = COMMENTS | frozenset(
    "ad ads advert adverts advertisement banner breadcrumb breadcrumbs consent cookie cookies footer masthead nav navbar navigation "
    "newsletter pager pagination promo share sharing sidebar social sponsor sponsored subscribe toolbar".split()
)
# what such a name may end with, names of template as well as of content, and what makes a name one of the layout
KINDS = frozenset("area bar box buttons links list widget".split())
DOUBTFUL_NAMES = SKIPPED_NAMES | frozenset("header menu modal notice popup promotion recommended related".split())
LAYOUT = frozenset("closed content has layout main no open with without wrap wrapper".split())
# an open element of the first kind ends where one of the second begins
ENDS = {
    "p": BLOCK - {"option", "optgroup", "legend", "head", "html", "body", "td", "th", "tr", "tbody", "thead", "tfoot"},
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option", "optgroup"}, "optgroup": {"optgroup"},
    "td": {"td", "th", "tr", "tbody", "tfoot"}, "th": {"td", "th", "tr", "tbody", "tfoot"}, "tr": {"tr", "tbody", "tfoot"},
    "thead": {"tbody", "tfoot"}, "tbody": {"tbody", "tfoot"}, "head": {"body"},
}
# how far up an end is looked for
SCOPE = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "td": {"table"}, "th": {"table"}, "tr": {"table"}, "thead": {"table"}, "tbody": {"table"}}

# an attribute is a name, which may hold quotes, and perhaps a value: a quote opens one only right after the sign, and only its like closes it. So an odd
# quote ends nothing, and a tag goes on to the end of the page only if a value that was opened is never closed, or no bracket follows
BLANK = r"[ \t\n\f\r]"
NAME = r"(?:=[^ \t\n\f\r/>=]*+|[^ \t\n\f\r/>=]++)"
VALUE = rf"{BLANK}*+={BLANK}*+(?:\"[^\"]*+\"|'[^']*+'|[^ \t\n\f\r\"'>][^ \t\n\f\r>]*+|(?=>))"
MARK = re.compile(
    r"<!--(?:>|->|.*?--!?>|.*\Z)|<!\[CDATA\[.*?\]\]>|<[!?][^>]*+(?:>|\Z)|</[^a-zA-Z][^>]*+(?:>|\Z)"
    rf"|<(/?)([a-zA-Z][^ \t\n\f\r/>]*+)((?:[ \t\n\f\r/]++|{NAME}(?:{VALUE}|(?!{BLANK}*+=)))*+)>|<(?=/?[a-zA-Z])",
    re.S,
)
ATTRIBUTE = re.compile(rf"({NAME})(?:{BLANK}*+={BLANK}*+(?:\"([^\"]*+)\"|'([^']*+)'|([^ \t\n\f\r\"'>][^ \t\n\f\r>]*+)|))?")


@dataclass(frozen=True)
class Template:
    """A subtree is template on at least ``pages`` different pages and this ``share`` of the host's different pages."""

    pages: int = 10
    share: float = 0.02


def _named(names: str) -> tuple[bool, bool, bool]:
    """(skipped, comments, doubtful): what the whole classes and ids among ``names`` say."""
    skipped = comments = doubtful = False
    for name in names.lower().split():
        parts = [p for p in re.split(r"[^a-z0-9]+", name) if p]
        own = parts[:-1] if len(parts) > 1 and parts[-1] in KINDS else parts
        if own and SKIPPED_NAMES.issuperset(own):
            skipped, comments = True, comments or own[0] in COMMENTS
        doubtful |= not DOUBTFUL_NAMES.isdisjoint(parts) and LAYOUT.isdisjoint(parts)
    return skipped, comments, doubtful


class _Element:
    __slots__ = ("tag", "cut", "named", "comments", "doubtful", "around", "skipped", "main", "counted", "within", "filled", "holds", "hash", "parent", "number")

    def __init__(self, tag: str, attributes: str, parent: _Element | None):
        named: dict[str, str] = {}
        for name, a, b, c in ATTRIBUTE.findall(attributes) if attributes else ():
            named.setdefault(name.lower(), a or b or c)  # the first of a name counts
        self.tag, self.parent, self.number = tag, parent, -1
        self.named, self.comments, self.doubtful = _named(f"{named.get('class', '')} {named.get('id', '')}") if named else (False, False, False)
        self.cut = tag in SKIPPED or named.get("role", "").lower() in SKIPPED_ROLES
        self.around = False  # is an article or holds one
        self.filled = self.holds = False  # has text; has content of an article, or one, with text that stays
        self.hash = xxhash.xxh3_64(f"<{tag} {named.get('class', '')} {named.get('id', '')}>".encode("utf-8", "surrogatepass"))

    def judge(self, all_comments: bool) -> None:
        """After the element around: whether it is skipped, in an article, and counted. ``all_comments``: also those that hold articles are skipped."""
        tag, parent = self.tag, self.parent
        whole = tag in ("html", "body", "main", "article")
        named = self.named and tag not in ("html", "body") and (not self.around or (all_comments and self.comments))
        self.skipped = self.cut or named or (parent is not None and parent.skipped)
        self.main = not self.skipped and (tag in MAIN or (parent is not None and parent.main))
        inside = parent is not None and parent.main
        self.within = inside and not whole and (parent.within or parent.tag in CONTENT)  # in content of an article
        self.counted = tag in BLOCK and not whole and (not self.within or self.doubtful) and not (inside and tag in CONTENT)


class Page:
    """Blocks (text, element) of a page in order, and its counted elements."""

    def __init__(self, source: str):
        self.blocks: list[tuple[str, _Element | None]] = []
        self.elements: list[_Element] = []
        self.article = False
        self._words: list[str] = []
        self._top: _Element | None = None
        self._opened: list[_Element] = []
        self._read(source)
        while self._top is not None:
            self._close()
        self._flush()
        self._judge(True)
        held = any(e.comments and e.around for e in self._opened)
        if held and not any(e is not None and e.main for _, e in self.blocks):  # no other article's text: what is named comments is the page's own
            self._judge(False)
        self._number()

    def _judge(self, all_comments: bool) -> None:
        for element in self._opened:
            element.judge(all_comments)
        self.article = any(e.main for e in self._opened)

    def _number(self) -> None:
        for element in reversed(self._opened):  # what is in an element comes before it
            parent = element.parent
            if parent is not None and element.filled and not element.skipped:
                parent.filled = True
                parent.holds |= element.holds or (element.main and (element.tag in CONTENT or element.tag in MAIN))
            if element.counted and (not element.holds or (element.doubtful and not element.around)):
                element.number = len(self.elements)
                self.elements.append(element)

    def _flush(self) -> None:
        text = " ".join("".join(self._words).split())
        self._words = []
        if text:
            self.blocks.append((text, self._top))
            if self._top is not None:
                self._top.hash.update(text.encode("utf-8", "surrogatepass"))
                self._top.filled = True

    def _open(self, tag: str, attributes: str) -> None:
        if tag in BLOCK:
            self._flush()
        if tag == "body" or tag == "html":
            at = self._top
            while at is not None and at.tag != tag:
                at = at.parent
            if at is not None:
                return
        for kind, by in ENDS.items():
            if tag in by:
                self._end(kind, SCOPE.get(kind, {"table", "td", "th", "button", "object"}))
        self._top = at = _Element(tag, attributes, self._top)
        self._opened.append(at)
        if tag in MAIN:
            while at is not None and not at.cut and not at.around:
                at.around, at = True, at.parent

    def _close(self) -> None:
        element = self._top
        if element.tag in BLOCK:
            self._flush()
        self._top = element.parent
        if element.parent is not None:
            element.parent.hash.update(element.hash.digest())

    def _end(self, tag: str, scope: set[str] | frozenset[str] = frozenset()) -> None:
        at = self._top
        while at is not None and at.tag != tag:
            if at.tag in scope:
                return
            at = at.parent
        while at is not None and self._top is not at.parent:
            self._close()

    def _read(self, source: str) -> None:
        at, length = 0, len(source)
        while at < length:
            mark = MARK.search(source, at)
            if mark is None:
                self._words.append(html.unescape(source[at:]))
                return
            if mark.start() > at:
                self._words.append(html.unescape(source[at : mark.start()]))
            at, tag = mark.end(), mark[2]
            if tag is None:
                if mark[0] == "<":  # a tag that never ends
                    return
                if mark[0].startswith("<![CDATA["):
                    self._words.append(mark[0][9:-3])
                continue
            tag = tag.lower()
            if mark[1]:
                if tag == "p" or tag in BLOCK:
                    self._flush()
                self._end(tag, {"table"} if tag not in ("table", "body", "html") else frozenset())
            elif tag in RAW:
                end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>", re.I).search(source, at)
                at = end.end() if end else length
                self._words.append(" ")
            elif tag in VOID:
                if tag in BLOCK:
                    self._flush()
                self._words.append(" " if tag == "br" else "")
            else:
                self._open(tag, mark[3])
                if mark[3].endswith("/") and tag not in BLOCK:
                    self._close()

    def remaining(self) -> list[tuple[str, _Element | None]]:
        """Blocks that stay by what elements say about themselves."""
        left = [(t, e) for t, e in self.blocks if e is None or not e.skipped]
        return [(t, e) for t, e in left if e is not None and e.main] if self.article else left


def _counted(element: _Element | None) -> int:
    """The number of the nearest counted element around, -1 if there is none."""
    while element is not None and element.number < 0:
        element = element.parent
    return -1 if element is None else element.number


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


PARSED = "text string, texts array<string>, inside array<int>, hashes array<long>, around array<int>, content long"


def read_page(source: str) -> tuple[str | None, list[str], list[int], list[int], list[int], int]:
    """(text, texts, inside, hashes, around, content): the text if no count can change it, else null and the blocks with the number of the
    element each is in; the hash of each counted element and the number of the counted element around it; the hash of all remaining text."""
    page = Page(source)
    left = page.remaining()
    inside = [_counted(e) for _, e in left]
    hashes = [_signed(e.hash.intdigest()) for e in page.elements]
    whole = "\n".join(t for t, _ in left)
    content = _signed(xxhash.xxh3_64_intdigest(whole.encode("utf-8", "surrogatepass")))
    if max(inside, default=-1) < 0:
        return whole, [], [], hashes, [], content
    return None, [t for t, _ in left], inside, hashes, [_counted(e.parent) for e in page.elements], content


def parse_page(source: str) -> tuple[str | None, list[str], list[int], list[int], list[int]]:
    """``read_page`` without the hash of the text."""
    return read_page(source)[:5]


def without_template(texts: Sequence[str], inside: Sequence[int], hashes: Sequence[int], around: Sequence[int], template: set[int]) -> str:
    """The blocks that lie in no element of the template."""
    gone = [False] * len(hashes)
    for i in reversed(range(len(hashes))):  # elements are numbered from the inside, so those around come later
        gone[i] = hashes[i] in template or (around[i] >= 0 and gone[around[i]])
    return "\n".join(t for t, i in zip(texts, inside) if i < 0 or not gone[i])


def extract(pages: DataFrame, html_column: str = "html", url: str = "url", carry: Sequence[str] = ("page_id", "url"),
            template: Template = Template()) -> DataFrame:
    """``row`` (the carried columns) and ``text`` for every page.

    Null html is empty and has no text; pages without a host form one host; equal rows are pages of their own; an empty table
    gives an empty result. Pages are read whole, however long; columns are told apart by position, so their names never clash.
    """
    named = pages.select(
        F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row"), url_parts(F.col(f"`{url}`"))[0].alias("host"), F.col(f"`{html_column}`").alias("html")
    )

    def parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.string(), pa.list_(pa.string()), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.int64()]
        names = ["row", "host", "text", "texts", "inside", "hashes", "around", "content"]
        for batch in batches:
            found = [read_page(x or "") for x in batch.column(2).to_pylist()]
            columns = [pa.array(list(c), kind) for c, kind in zip(zip(*found) if found else [[]] * 6, kinds)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], names=names)

    schema = f"row {named.schema['row'].dataType.simpleString()}, host string, {PARSED}"
    rows = written(named.mapInArrow(parsed, schema).withColumn("number", F.monotonically_increasing_id()), "pages")
    # each page's content once: copies are no evidence of a template
    seen = rows.select("host", "content", F.explode(F.array_distinct("hashes")).alias("hash")).distinct()
    seen = seen.groupBy("host", "hash").agg(F.count(F.lit(1)).alias("n"))
    hosts = rows.select("host", "content").distinct().groupBy("host").agg(F.count(F.lit(1)).alias("pages"))
    often = seen.where(F.col("n") >= template.pages).join(hosts, "host").where(F.col("n") >= template.share * F.col("pages"))
    often = written(often.select("host", "hash"), "template")
    waiting = rows.where("text IS NULL")
    hits = joined_by_size(waiting.select("number", "host", F.explode(F.array_distinct("hashes")).alias("hash")), often, ["host", "hash"], "left_semi")
    gone = hits.groupBy("number").agg(F.collect_set("hash").alias("template"))
    judged = waiting.join(gone, "number", "left").select("row", "texts", "inside", "hashes", "around", "template")

    def cleaned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [batch.column(i).to_pylist() for i in range(1, 6)]
            texts = [without_template(*page[:4], set(page[4] or ())) for page in zip(*parts)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["row", "text"])

    late = judged.mapInArrow(cleaned, f"row {named.schema['row'].dataType.simpleString()}, text string")
    return rows.where("text IS NOT NULL").select("row", "text").unionByName(late)


sent_to_tasks(__name__)
