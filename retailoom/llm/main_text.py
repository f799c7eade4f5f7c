"""Main text of web pages with a site style tree.

The pages of a host are merged into one tree: elements with the same tags and names on their way from the root are one
node. A node's presentation importance is the entropy of its child sequences over the pages, its content importance is
how little its texts repeat from page to page. Branches that mean the same everywhere (menus, notices, footers) score
low and are cut from every page; so are elements whose tag, role or name says that they are no article.
"""

import html
import re
from collections.abc import Iterator
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retailoom.llm.store import Scratch

LEAST_IMPORTANCE = 0.2
LEAST_PAGES = 4
DECAY = 0.9
SALTS = 16

# --- fixed values: what HTML and common page templates call things --------------------------------------------------

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe noembed noframes xmp template".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody tfoot thead tr ul caption".split()
)
CELL = frozenset(("td", "th", "br", "option"))
CLOSES = {  # an opening tag ends these open ones, up to the nearest container
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
    "option": ("option",), "tbody": ("tr", "td", "th", "thead", "tbody"), "thead": ("tr",), "tfoot": ("tr", "td", "th", "tbody"),
}
CONTAINER = frozenset("ul ol menu dl table select body article section div main td th".split())
NO_ARTICLE_TAGS = frozenset("head nav footer aside form button select textarea input dialog menu svg canvas object audio video map datalist".split()) | RAW
NO_ARTICLE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar status".split())
NO_ARTICLE_NAMES = frozenset(
    "nav navbar navigation menu menus submenu breadcrumb breadcrumbs masthead banner footer foot sidebar sidebars rail ad ads adv advert adverts "
    "advertisement advertisements adsense adslot dfp sponsor sponsored sponsors promo promos promotion cookie cookies consent gdpr "
    "notice notices alert alerts popup modal overlay newsletter subscribe subscription signup login signin share sharing social comment comments "
    "commentlist disqus reply replies respond responses discussion related recommended recommendations widget widgets pagination pager toolbar search "
    "searchform skip hidden copyright disclaimer legal tags breadcrumbtrail".split()
)
# names of branches whose articles are not the page's
FOREIGN_NAMES = frozenset(
    "comment comments commentlist disqus reply replies respond responses discussion related recommended recommendations teaser promo promos".split()
)
# a name says nothing about its element if it begins, goes on or ends like this (has-sidebar, content-with-comments, ad-free)
NOT_THIS = frozenset("has no not non with without tag category cat topic term".split())
FREE_OF = frozenset("free news".split())
HEADER_NAMES = frozenset(("header", "head", "topbar"))
ARTICLE_TAGS = frozenset(("article", "main"))
PROSE = frozenset("p h1 h2 h3 article main".split())

_TAG = re.compile(
    r"<!--(?:.*?-->|.*)|<!\[CDATA\[(.*?)\]\]>|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+|[^>]*+)>", re.S
)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


def _hash(*parts) -> int:
    return int.from_bytes(blake2b("\x00".join(map(str, parts)).encode("utf-8", "replace"), digest_size=8).digest(), "big", signed=True)


def name_words(names: str) -> set[str]:
    """Words of class and id names, without names that speak of what an element has, lacks or is filed under."""
    words: set[str] = set()
    for name in names.split():
        parts = [w.lower() for w in _NAME.findall(name)]
        if not NOT_THIS.isdisjoint(parts[:-1]) or (len(parts) > 1 and parts[-1] in FREE_OF):
            continue
        words.update(parts)
    return words


class Element:
    """An open element. ``named``: only names say that it is no article, so an article inside is one; ``form``: in a form."""

    __slots__ = ("tag", "path", "node", "out", "article", "children", "fixed", "named", "form")

    def __init__(self, tag: str, path: str, node: int, out: bool, article: bool, fixed: bool, named: bool = False, form: bool = False):
        self.tag, self.path, self.node, self.out, self.article, self.fixed = tag, path, node, out, article, fixed
        self.named, self.form = named, form
        self.children: list[str] = []


class Page:
    """One page: its blocks as (text, nodes on the way, in an article), and its elements' child sequences.

    ``cut`` holds style-tree nodes whose branches are left out.
    """

    def __init__(self, source: str, cut: frozenset[int] = frozenset()):
        self.blocks: list[tuple[str, tuple[int, ...], bool]] = []
        self.sequences: list[tuple[int, int]] = []
        self.cut = cut
        self.stack = [Element("", "", 0, False, False, True)]
        self.pieces: list[str] = []
        self.in_form: list[bool] = []
        self.written = [0, 0]  # characters of headings and paragraphs outside and inside of forms
        self._read(source)
        # a form around the page (all of it is one) is no form of it
        if self.written[0] >= self.written[1]:
            self.blocks = [block for block, inside in zip(self.blocks, self.in_form, strict=True) if not inside]

    def _read(self, source: str) -> None:
        at = 0
        while True:
            match = _TAG.search(source, at)
            if match is None:
                self._text(source[at:])
                break
            if match.start() > at:
                self._text(source[at : match.start()])
            at = match.end()
            if match[1]:
                self._text(match[1], decode=False)
            if match[3] is None:
                continue
            tag = match[3].lower()
            if match[2]:
                self._close(tag)
                continue
            self._open(tag, match[4])
            if tag in RAW and not match[4].endswith("/"):
                end = re.compile(rf"</{re.escape(tag)}(?![^\s/>])[^>]*>", re.I).search(source, at)
                at = end.end() if end else len(source)
                self._close(tag)
        while len(self.stack) > 1:
            self._pop()
        self._flush()

    def _text(self, text: str, decode: bool = True) -> None:
        if not self.stack[-1].out:
            self.pieces.append(html.unescape(text) if decode and "&" in text else text)

    def _flush(self) -> None:
        if self.pieces:
            text = " ".join("".join(self.pieces).split())
            self.pieces = []
            if text:
                here = self.stack[-1]
                self.blocks.append((text, tuple(e.node for e in self.stack if e.tag in BLOCK), here.article))
                self.in_form.append(here.form)
                if any(e.tag in PROSE for e in self.stack[-3:]):
                    self.written[here.form] += len(text)

    def _open(self, tag: str, attributes: str) -> None:
        block = tag in BLOCK
        if block and tag != "hr" or tag in CLOSES:
            self._end_implied(tag)
        if block:
            self._flush()
        elif tag in CELL:
            self.pieces.append(" ")
        parent = self.stack[-1]
        names = ""
        out, article, named, form = parent.out, parent.article, parent.named, parent.form or tag == "form"
        words: set[str] = set()
        says_main = tag in ARTICLE_TAGS
        if attributes:
            found = {k.lower(): a or b or c for k, a, b, c in _ATTRIBUTE.findall(attributes)}
            names = f"{found.get('class', '')} {found.get('id', '')}".strip()
            words = name_words(names)
            role = found.get("role", "").lower()
            says_main = says_main or role == "main" or found.get("itemprop", "").lower() == "articlebody"
            hidden = "hidden" in found or found.get("aria-hidden", "").lower() == "true" or "display:none" in found.get("style", "").replace(" ", "").lower()
            if hidden or role in NO_ARTICLE_ROLES and not (role == "form" and form):
                out, named = True, False
        if tag in NO_ARTICLE_TAGS and tag != "form" or tag == "header" and not article:
            out, named = True, False
        by_name = bool(words & (NO_ARTICLE_NAMES if article else NO_ARTICLE_NAMES | HEADER_NAMES))
        if says_main and words.isdisjoint(FOREIGN_NAMES):
            if named:  # no name cuts an article, nor what holds one
                out, named = False, False
        elif by_name and not out:
            out, named = True, words.isdisjoint(FOREIGN_NAMES)
        article = article or says_main and words.isdisjoint(FOREIGN_NAMES)
        if tag in VOID:
            parent.children.append(tag)
            return
        if tag in ("html", "body"):
            out = named = False
        if block:
            style = f"{tag}.{names}" if names and not any(c.isdigit() for c in names) else tag
            parent.children.append(style)
            node = _hash(parent.node, style)
            fixed = tag in ("html", "body") or tag in ARTICLE_TAGS
            if not fixed and node in self.cut:
                out, named = True, False
        else:
            style, node, fixed = parent.path, parent.node, parent.fixed
        self.stack.append(Element(tag, style, node, out, article, fixed, named, form))

    def _end_implied(self, tag: str) -> None:
        closes = CLOSES.get(tag, ())
        for i in range(len(self.stack) - 1, 0, -1):
            found = self.stack[i].tag
            if found in closes or found == "p" and tag in BLOCK:
                while len(self.stack) > i:
                    self._pop()
                if found == "p":
                    return self._end_implied(tag) if closes else None
            elif found in CONTAINER:
                return None
        return None

    def _close(self, tag: str) -> None:
        if tag == "p" and not any(e.tag == "p" for e in self.stack):
            self._flush()
            return
        for i in range(len(self.stack) - 1, 0, -1):
            if self.stack[i].tag == tag:
                while len(self.stack) > i:
                    self._pop()
                return
            if self.stack[i].tag in CONTAINER and tag not in BLOCK:
                return  # an inline end tag doesn't reach out of its container

    def _pop(self) -> None:
        element = self.stack[-1]
        if element.tag in BLOCK:
            self._flush()
            self.sequences.append((element.node, _hash(*element.children)))
        self.stack.pop()

    def text(self) -> str:
        """The blocks of articles, or all that is left if the page marks none, or only what is short beside the rest."""
        every = [text for text, _, _ in self.blocks]
        inside = [text for text, _, article in self.blocks if article]
        return "\n\n".join(inside if 4 * sum(map(len, inside)) >= sum(map(len, every)) else every)


def main_text(source: str | None, cut: frozenset[int] = frozenset()) -> str:
    """Text of a page without the branches in ``cut``; if those were all its text, they stay."""
    if not source:
        return ""
    text = Page(source, cut).text()
    return text if text or not cut else Page(source).text()


def host_of(url: Column) -> Column:
    """Lower-cased host of an address (between :// and the next /, ? or #), null without one."""
    found = F.lower(F.regexp_extract(url, r"^[^:/?#]*://([^/?#]*)", 1))
    return F.when(found != "", found)


def style_rows(pages: DataFrame) -> DataFrame:
    """(host, page, node, kind, value, way) of pages (host, html): kind 0 is a block's text, kind 1 a child sequence."""

    def read(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {"host": [], "page": [], "node": [], "kind": [], "value": [], "way": []}
            for host, source in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                page, number = Page(source), _hash(source)
                rows = {(way[-1] if way else 0, 0, _hash(text), way) for text, way, _ in page.blocks} | {(n, 1, s, ()) for n, s in page.sequences}
                for node, kind, value, way in rows:
                    for name, x in zip(out, (host, number, node, kind, value, list(way)), strict=True):
                        out[name].append(x)
            yield pa.record_batch(
                [pa.array(out["host"], pa.string()), *(pa.array(out[c], pa.int64()) for c in ("page", "node", "kind", "value")), pa.array(out["way"], pa.list_(pa.int64()))],
                list(out),
            )

    return pages.where("host is not null and html is not null").mapInArrow(read, "host string, page long, node long, kind long, value long, way array<long>")


def low_branches(rows: DataFrame, least: float = LEAST_IMPORTANCE, pages: int = LEAST_PAGES) -> DataFrame:
    """(host, node) of branches whose importance is below ``least``, seen on at least ``pages`` different pages of the host.

    importance = (1 - DECAY**l) * presentation + DECAY**l * content, l being the node's number of different child
    sequences. Presentation is the entropy of child sequences, to the base of the number of pages. Content is 1 minus
    the mean, over the texts below the node, of log(pages with the text) / log(pages). Copies of a page count once.
    """
    once = rows.dropDuplicates(["host", "page", "node", "kind", "value"])
    sizes = rows.select("host", "page").distinct().groupBy("host").agg(F.count(F.lit(1)).alias("all")).where(F.col("all") >= pages)
    texts = once.where("kind = 0").groupBy("host", "node", "value").agg(F.count(F.lit(1)).alias("c"), F.min("way").alias("way"))
    repeats = texts.join(sizes, "host").select("host", "way", "c", (F.col("c") * F.log("c") / F.log("all")).alias("h"))
    by_way = repeats.groupBy("host", "way").agg(F.sum("c").alias("c"), F.sum("h").alias("h"))
    content = by_way.select("host", F.explode("way").alias("node"), "c", "h").groupBy("host", "node").agg((1 - F.sum("h") / F.sum("c")).alias("content"))
    shapes = once.where("kind = 1").groupBy("host", "node", "value").agg(F.count(F.lit(1)).alias("c"))
    nodes = shapes.groupBy("host", "node").agg(F.sum("c").alias("m"), F.count(F.lit(1)).alias("l"), F.sum(F.col("c") * F.log("c")).alias("s"))
    presentation = F.when(F.col("m") > 1, (F.log("m") - F.col("s") / F.col("m")) / F.log("m")).otherwise(1.0)
    weight = F.pow(F.lit(DECAY), F.col("l"))
    importance = (1 - weight) * presentation + weight * F.col("content")
    return nodes.where(F.col("m") >= pages).join(content, ["host", "node"]).where(importance < least).select("host", "node")


def main_texts(pages: DataFrame, id_column: str = "page_id", url_column: str = "url", html_column: str = "html", host: Column | None = None) -> DataFrame:
    """(id, url, text, n_chars) of every row: its article, blocks joined by two line feeds.

    Character references are decoded and white space in a block becomes one space. Null html gives an empty text; a null
    url, or one without host, leaves the page without a site: it is cut by what tags, roles and names say alone. If the
    style tree would leave a page without any text, the page is cut by those alone too. Copies of a page count once in
    the tree, repeated rows come out repeated, and an empty table gives an empty result. Columns besides the named ones
    are not read.
    """
    scratch = Scratch(pages.sparkSession, "pages")
    site = host_of(F.col(url_column).cast("string")) if host is None else host
    sources = pages.select(site.alias("host"), F.col(html_column).cast("string").alias("html"))
    low = low_branches(scratch.settle(style_rows(sources), "styles"))
    # a list of a host's branches: as long as its templates are different, not as its pages are many
    lists = scratch.settle(low.groupBy("host").agg(F.sort_array(F.collect_set("node")).alias("cut")), "cut")
    # stored, so Spark knows its size: small enough it is broadcast, else a hot host is spread over SALTS keys
    salted = lists.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    rows = pages.select(
        F.col(id_column).alias("id"), F.col(url_column).alias("url"), F.col(html_column).cast("string").alias("html"), site.alias("host"),
        F.pmod(F.xxhash64(html_column, id_column), F.lit(SALTS)).cast("int").alias("salt"),
    )
    joined = rows.join(salted, ["host", "salt"], "left").select("id", "url", "html", "cut")
    schema = f"id {rows.schema['id'].dataType.simpleString()}, url {rows.schema['url'].dataType.simpleString()}, text string, n_chars long"

    def extract(batches):
        for batch in batches:
            texts = [main_text(s, frozenset(c or ())) for s, c in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
            yield pa.record_batch(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["id", "url", "text", "n_chars"]
            )

    return joined.mapInArrow(extract, schema).withColumnRenamed("id", id_column).withColumnRenamed("url", url_column)
