"""Operator 7: main text of web pages by a site style tree.

The DOMs of a host's pages are merged by path of block tags and classes; every block element of every
page is a node. A node is as important as its presentations (the sequences of child tags) or its contents
(the texts) differ between pages: the entropy of their distribution over the host's pages, near 1 where
each page has its own and near 0 where all share one, with one unseen page that differs added, so that
few pages prove little. A branch in which no node reaches MIN_IMPORTANCE is boilerplate and goes.

Tags, roles and names are priors to that. What they mark as menu, header, footer, sidebar, notice, advert,
form, script, style or comment goes though it may differ from page to page; names that prose has, too
(WEAK_NAMES), count outside `article` and `main` only. Of prose in such a landmark (paragraphs, headings)
the tree doesn't judge single elements, only containers. Where landmarks hold most of a page's text, the
rest goes; where they hold less, as teasers do, what is outside stays.

Cases: null and empty html give an empty text; tags that are never closed end where an outer one ends;
pages without a host form one host; pages of a host with the same unmarked text count once, so that
copies don't look like boilerplate; null ids and repeated rows keep their rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import html as entities
import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from klangwerk.llm.store import hot_join, materialise, table

MIN_IMPORTANCE = 0.2
#: The share of a page's unmarked text that landmarks must hold to stand for the page.
MOST = 0.5
#: Low nodes of all hosts together that executors get at once (16 MiB); of more, each host's go to its pages.
LOW_NODES = 2 << 20

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style|noscript|textarea|iframe|title)\b[^>]*>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^<>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^<>]*)>|<[!?][^>]*>",
    re.S | re.I,
)
_ATTR = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_SPACE = re.compile(r"\s+")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
CLOSES_P = BLOCK - {"body", "html", "li", "td", "th", "tr", "tbody", "thead", "tfoot", "caption", "dd", "dt"}
SIBLINGS = {"li": {"li"}, "dd": {"dd", "dt"}, "dt": {"dd", "dt"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPES = frozenset("ul ol menu dl table article main section div body".split())
NOISE_TAGS = frozenset("nav aside footer form button dialog menu input label fieldset template select svg object head".split())
#: What may stand in a head; another tag ends one that is not closed.
HEAD = frozenset("base link meta script style title noscript template object svg".split())
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
NOISE_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation menu menubar breadcrumb breadcrumbs"
    " header masthead topbar footer sidebar aside widget widgets related recommended cookie cookies consent notice alert popup modal overlay"
    " newsletter subscribe subscription signup login search share sharing social comment comments disqus reply replies respond discussion form".split()
)
#: Of these names, those that prose may have, too: inside a landmark they mark nothing.
WEAK_NAMES = frozenset("header alert search discussion form promotion banner aside".split())
LANDMARKS = frozenset(("article", "main"))
CONTAINERS = frozenset("div section ul ol dl table figure blockquote details".split())
_HOST = r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)"


def _noise(tag: str, attrs: str, inside: bool) -> bool:
    if tag in NOISE_TAGS or (tag == "header" and not inside):
        return True
    for name, a, b, c in _ATTR.findall(attrs) if attrs else ():
        name, value = name.lower(), (a or b or c).lower()
        if name in ("class", "id"):
            words = set(re.split(r"[^a-z0-9]+", value))
            if words & (NOISE_NAMES - WEAK_NAMES if inside else NOISE_NAMES):
                return True
        elif name == "role" and value in NOISE_ROLES or name == "hidden" and value != "until-found" or name == "aria-hidden" and value == "true":
            return True
        elif name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            return True
    return False


def _name(tag: str, attrs: str) -> str:
    names = [(a or b or c).lower() for name, a, b, c in _ATTR.findall(attrs) if name.lower() == "class"] if attrs else []
    return f"{tag}.{'.'.join(sorted(names[0].split()))}" if names and names[0] else tag


class Node(NamedTuple):
    tag: str
    marked: bool  # it or what it lies in is marked
    hidden: bool  # of these, it or what it lies in is no block: its text belongs to nothing
    low: bool  # the tree says that the branch is boilerplate
    inside: bool  # a landmark holds it
    path: str  # of block elements


class Page:
    """One walk over a page: its blocks of text, and the block elements with their children and texts."""

    def __init__(self, html: str, low: frozenset[int] = frozenset()):
        self.blocks: list[tuple[bool, bool, str]] = []  # gone, inside a landmark, text
        self.children: dict[str, list[str]] = {}
        self.texts: dict[str, list[str]] = {}
        self.judged: dict[str, bool] = {}  # whether the tree may judge the path
        self.low = low
        self.stack = [Node("", False, False, False, False, "")]
        self.text: list[str] = []
        at = 0
        for m in _TOKEN.finditer(html):
            if m.start() > at:
                self._data(html[at : m.start()])
            at = m.end()
            if m[1]:
                continue
            close, tag, attrs = (m[2], m[3], m[4]) if m[3] else (m[5], m[6], m[7])
            if tag:
                self._tag(close, tag.lower(), attrs.strip())
        if at < len(html):
            self._data(html[at:])
        self._flush()

    def _data(self, raw: str) -> None:
        if self.stack[-1].tag == "head" and not raw.isspace():
            self._pop(len(self.stack) - 1)
        if not self.stack[-1].hidden:
            self.text.append(entities.unescape(raw) if "&" in raw else raw)

    def _flush(self) -> None:
        if self.text:
            if text := _SPACE.sub(" ", "".join(self.text)).strip():
                top = self.stack[-1]
                self.blocks.append((top.marked or top.low, top.inside, text))
                self.texts.setdefault(top.path, []).append(text)
            self.text = []

    def _pop(self, to: int) -> None:
        if any(t.tag in BLOCK for t in self.stack[to:]):
            self._flush()
        del self.stack[to:]

    def _tag(self, close: str, tag: str, attrs: str) -> None:
        if close:
            if tag == "p" and not any(t.tag == "p" for t in self.stack):
                self._flush()
            for i in range(len(self.stack) - 1, 0, -1):
                if self.stack[i].tag == tag:
                    self._pop(i)
                    break
            return
        if any(t.tag == "head" for t in self.stack) and tag not in HEAD and not any(t.tag in HEAD for t in self.stack):
            self._pop(next(i for i, t in enumerate(self.stack) if t.tag == "head"))
        if tag in BLOCK:
            # markup that was not closed and holds no blocks ends at the next one
            for i in range(len(self.stack) - 1, 0, -1):
                if self.stack[i].tag in ("svg", "select"):
                    self._pop(i)
                    break
        if tag == "br" or tag == "wbr":
            if tag == "br" and not self.stack[-1].hidden:
                self.text.append(" ")
            return
        if tag in ("body", "html") and any(t.tag == tag for t in self.stack):
            return
        if tag in CLOSES_P or tag in SIBLINGS:
            ends = SIBLINGS.get(tag, {"p"})
            for i in range(len(self.stack) - 1, 0, -1):
                if self.stack[i].tag in ends:
                    self._pop(i)
                    break
                if self.stack[i].tag in SCOPES:
                    break
        if tag in BLOCK:
            self._flush()
        if tag in VOID:
            return
        top = self.stack[-1]
        marked, path, low = top.marked or _noise(tag, attrs, top.inside), top.path, top.low
        hidden = top.hidden or (marked and not top.marked and tag not in BLOCK)
        if tag in BLOCK and not hidden:
            path = f"{path}>{_name(tag, attrs)}"
            self.children.setdefault(top.path, []).append(tag)
            self.children.setdefault(path, [])
            may = tag not in ("html", "body") and (not top.inside or tag in CONTAINERS)
            self.judged[path] = may
            low = low or (may and bool(self.low) and _digest(path.encode("utf-8", "surrogatepass")) in self.low)
        inside = top.inside or (not marked and (tag in LANDMARKS or bool(attrs) and 'role="main"' in attrs))
        if not attrs.endswith("/") or tag in BLOCK:
            self.stack.append(Node(tag, marked, hidden, low, inside, path))

    def main_text(self) -> str:
        kept = [(inside, text) for gone, inside, text in self.blocks if not gone]
        own = sum(len(text) for inside, text in kept if inside)
        if own and own >= MOST * sum(len(text) for _, text in kept):
            kept = [x for x in kept if x[0]]
        return "\n\n".join(text for _, text in kept)

    def features(self) -> Iterator[tuple[str, bytes, bytes]]:
        """(path, presentation, content) of every block element of the page, merged by path."""
        for path, children in self.children.items():
            if path:
                yield path, "\0".join(children).encode(), "\0".join(self.texts.get(path, [])).encode("utf-8", "surrogatepass")

    def unmarked(self) -> bytes:
        return "\0".join(text for gone, _, text in self.blocks if not gone).encode("utf-8", "surrogatepass")


def _digest(data: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(data, digest_size=8).digest(), "big", signed=True)


NODE = "host string, page long, node long, parent long, judged boolean, style long, content long, no_style boolean, no_content boolean"


def site_nodes(pages: DataFrame) -> DataFrame:
    """A row a node of a page: the digests of its path, its parent's, its presentation and its content."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for host, html in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist()):
                if html:
                    page = Page(html)
                    whole = _digest(page.unmarked())
                    told = [(p, _digest(p.encode("utf-8", "surrogatepass")), s, c) for p, s, c in page.features()]
                    ids = {p: d for p, d, _, _ in told}
                    rows += [(host, whole, d, ids.get(p.rpartition(">")[0], 0), page.judged.get(p, False), _digest(s), _digest(c), not s, not c) for p, d, s, c in told]
            kinds = (pa.string(), *(pa.int64(),) * 3, pa.bool_(), *(pa.int64(),) * 2, *(pa.bool_(),) * 2)
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], [c.split()[0] for c in NODE.split(", ")])

    return pages.mapInArrow(run, NODE)


def importance(nodes: DataFrame) -> DataFrame:
    """(host, node, parent, judged, importance) of the merged tree; equal pages count once."""
    own = nodes.groupBy("host", "node", "page").agg(
        F.min("parent").alias("parent"), F.max("judged").alias("judged"), *[F.min(F.when(~F.col(f"no_{c}"), F.col(c))).alias(c) for c in ("style", "content")]
    )
    own = materialise(own, "site-nodes")
    known = own.groupBy("host", "node").agg(F.min("parent").alias("parent"), F.max("judged").alias("judged"), F.count("*").alias("m"))
    for c in ("style", "content"):
        each = own.where(F.col(c).isNotNull()).groupBy("host", "node", c).agg(F.count("*").alias("c"))
        sums = each.groupBy("host", "node").agg(F.sum("c").alias("n"), F.sum(F.col("c") * F.log("c")).alias("s"))
        h = F.when(F.col("n") > 1, (F.log("n") - F.col("s") / F.col("n")) / F.log("n")).otherwise(1.0)
        known = known.join(sums.select("host", "node", h.alias(f"{c}_entropy")), ["host", "node"], "left")
    most = F.greatest(F.coalesce("style_entropy", F.lit(0.0)), F.coalesce("content_entropy", F.lit(0.0)))
    return known.select("host", "node", "parent", "judged", ((1 + F.col("m") * most) / (1 + F.col("m"))).alias("importance"))


def low_branches(pages: DataFrame, min_importance: float = MIN_IMPORTANCE) -> DataFrame:
    """(host, low): the nodes of each host whose branches hold no important node, as far as the tree may judge them.

    A node with an important child is important: as many rounds as the highest branch without one is deep.
    """
    tree = materialise(importance(site_nodes(pages)), "site-tree")
    high = tree.where(F.col("importance") >= min_importance).select("host", "node", "parent")
    found = materialise(high, "site-high")
    last = found
    while True:
        up = last.select("host", F.col("parent").alias("node")).where("node <> 0").distinct()
        more = up.join(tree.select("host", "node", "parent"), ["host", "node"]).join(found.select("host", "node"), ["host", "node"], "left_anti")
        last = materialise(more.select("host", "node", "parent"), "site-high")
        if not last.limit(1).count():
            break
        found = found.union(last)
    low = tree.where("judged").join(found.select("host", "node"), ["host", "node"], "left_anti")
    return low.groupBy("host").agg(F.collect_set("node").alias("low"))


def extract(pages: DataFrame, id_col: str = "page_id", low_nodes: int = LOW_NODES) -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""
    base = pages.select(F.col(id_col).alias("page_id"), "url", "html", F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), _HOST, 1)).alias("host"))
    low = materialise(low_branches(base.select("host", "html")), "site-low")
    kind = pages.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [Page(h, frozenset(p or ())).main_text() if h else "" for h, p in zip(batch.column("html").to_pylist(), batch.column("low").to_pylist())]
            cols = [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays(cols, ["page_id", "url", "text", "n_chars"])

    if total := low.agg(F.sum(F.size("low") + F.octet_length("host") / 8)).first()[0]:
        base = base.join(F.broadcast(low), "host", "left") if total <= low_nodes else hot_join(base, low, "host")
    else:
        base = base.withColumn("low", F.lit(None).cast("array<long>"))
    return base.select("page_id", "url", "html", "low").mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))
