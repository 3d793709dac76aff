"""Main text of web pages by a site style tree.

The whole DOMs of a host's pages, menus and articles alike, are merged by style path
(tags and classes from the root). A presentation node's importance is the entropy of the child sequences that pages have
there, a content node's that of its texts, both to the base of the number of pages
that have the node, so what a host repeats is near 0 and what differs is near 1; a
node on one page is important. A branch combines its own with the mean of its leaves,
as in composite importance. Branches below ``THRESHOLD`` on at least ``PAGES`` pages
are removed from each page of the host, unless nothing would be left.

Importance cannot tell that a menu or an advert that differs from page to page is none
of the article, and would drop a paragraph that many pages quote. Two ties are therefore
broken by what the markup says. A branch whose element or class names it (``navigation``,
``advert``, ...) has no importance. Where that would leave nothing of a page's articles,
the names of branches that hold them do not count: a wrapper called ``has-sidebar`` or a
form around the page is no sidebar and no form. Names never judge a paragraph, heading,
list item or cell inside an article. And plain blocks inside
``article`` or ``main`` have full importance. Where a page has such an element, only its
content counts.

Defined cases: null html is empty; broken markup is read as browsers do in the simple
cases (unclosed blocks, stray end tags, ``<`` as text); a page without text gives "";
pages without a host are one host; repeated rows are pages of their own; tables without
rows give none; of other columns nothing is read, whatever their names. A page is read
whole in one task, in time and memory that grow with its length.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewright.llm.common import materialize
from ratewright.llm.urlrank import host_of

THRESHOLD = 0.25
PAGES = 6
DECAY = 0.9

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<[!?][^>]*+>"
    r"""|<(/?)([a-zA-Z][^\s/>]*+)((?>[^>"']++|"[^"]*+"|'[^']*+')*+)>"""
    r"""|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>"""
    r"|[^<]++|<",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"""([^\s=/"']+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")

VOID = frozenset(
    ["area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"]
)
RAW = frozenset(["script", "style", "noscript", "template", "iframe", "textarea", "title", "xmp", "svg"])
#: these may stand in the middle of a paragraph without ending it
INLINE_RAW = frozenset(["script", "style", "noscript", "template", "iframe", "svg"])
INLINE = frozenset(
    ["a", "abbr", "b", "bdi", "bdo", "big", "br", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img"]
    + ["ins", "kbd", "label", "mark", "math", "mfrac", "mi", "mn", "mo", "mrow", "msqrt", "msub", "msup", "mtext", "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "td", "th"]
    + ["time", "tt", "u", "var", "wbr"]
)
BOILERPLATE_TAGS = frozenset(
    ["aside", "button", "datalist", "dialog", "footer", "form", "head", "header", "menu", "nav", "select"]
    + ["audio", "canvas", "fieldset", "legend", "object", "option", "video"]
) | RAW
BOILERPLATE_ROLES = frozenset(
    ["alert", "alertdialog", "banner", "complementary", "contentinfo", "dialog", "form", "menu", "menubar"]
    + ["navigation", "search", "status", "toolbar"]
)
BOILERPLATE_WORDS = frozenset(
    ["ad", "ads", "advert", "advertisement", "advertising", "adverts", "adbox", "banner", "breadcrumb", "breadcrumbs"]
    + ["comment", "comments", "consent", "cookie", "cookies", "disqus", "footer", "gdpr", "login", "menu", "modal"]
    + ["nav", "navbar", "navigation", "newsletter", "notice", "notices", "pagination", "popup", "promo", "related"]
    + ["reply", "replies", "respond", "share", "sharing", "sidebar", "signup", "social", "sponsor", "sponsored"]
    + ["subscribe", "toolbar", "widget"]
)
#: blocks with these elements only, below an article, are article text
PLAIN = frozenset(
    ["article", "blockquote", "body", "center", "dd", "dl", "dt", "figcaption", "figure", "h1", "h2", "h3", "h4"]
    + ["h5", "h6", "header", "hgroup", "html", "li", "main", "ol", "p", "pre", "section", "table", "tbody", "tfoot"]
    + ["thead", "tr", "ul"]
)
#: elements of running text, which names do not judge inside an article
TEXT = frozenset(
    ["blockquote", "dd", "dt", "figcaption", "h1", "h2", "h3", "h4", "h5", "h6", "li", "ol", "p", "pre", "table", "tbody"]
    + ["tfoot", "thead", "tr", "ul"]
)
#: an opening tag ends an open one of these
ENDS = {
    "li": frozenset(["li", "p"]),
    "dt": frozenset(["dt", "dd", "p"]),
    "dd": frozenset(["dt", "dd", "p"]),
    "tr": frozenset(["tr", "td", "th", "p"]),
    "td": frozenset(["td", "th", "p"]),
    "th": frozenset(["td", "th", "p"]),
    "option": frozenset(["option"]),
}
HEADINGS = frozenset(["h1", "h2", "h3", "h4", "h5", "h6"])


@dataclass
class Block:
    """A run of text without a block boundary, and the style path of its element."""

    path: str
    text: str
    in_article: bool
    plain: bool
    element: _Open

    def boilerplate(self, lift: bool = False) -> bool:
        """Hidden, or below an element named as something else; ``lift`` names of wrappers around an article."""
        return self.element.is_boilerplate(lift)


@dataclass
class _Open:
    tag: str
    path: str
    in_article: bool
    plain: bool
    hidden: bool
    named: bool
    above: _Open | None
    children: list[str]
    holds_article: bool = False

    def is_boilerplate(self, lift: bool) -> bool:
        at: _Open | None = self
        while at is not None:
            wrapper = lift and at.holds_article and (at.tag == "form" or at.tag not in BOILERPLATE_TAGS)
            if at.hidden or (at.named and not wrapper):
                return True
            at = at.above
        return False


def _is_hidden(attributes: dict[str, str]) -> bool:
    return "hidden" in attributes or attributes.get("aria-hidden", "").lower() == "true"


def _is_named(tag: str, attributes: dict[str, str], in_article: bool) -> bool:
    if tag in ("body", "html", "article", "main"):
        # a reader's comment is an article too; a class that only has such a word in it says nothing
        own = set(attributes.get("class", "").lower().split()) if tag == "article" else set()
        return bool(own & {"comment", "comments", "ad", "advert", "related"})
    if tag == "header" and in_article:  # the article's own head
        return False
    if tag in BOILERPLATE_TAGS or attributes.get("role", "").lower() in BOILERPLATE_ROLES:
        return True
    if in_article and tag in TEXT:
        return False
    named = f"{attributes.get('class', '')} {attributes.get('id', '')}"
    return bool(set(re.split(r"[\s_-]+", named.lower())) & BOILERPLATE_WORDS)


def parse(page: str) -> tuple[list[Block], list[tuple[str, str]]]:
    """Text blocks in page order, and (path, child sequence) of every element with children."""
    blocks: list[Block] = []
    styles: list[tuple[str, str]] = []
    stack = [_Open("", "", False, True, False, False, None, [])]
    run: list[str] = []
    at = 0

    def close_block() -> None:
        text = " ".join(entities.unescape("".join(run)).split())
        run.clear()
        if text:
            top = stack[-1]
            blocks.append(Block(top.path, text, top.in_article, top.plain, top))

    def pop() -> None:
        done = stack.pop()
        if done.children:
            styles.append((done.path, ",".join(done.children)))

    while match := _TOKEN.match(page, at):
        at = match.end()
        tag = match[2] or match[5]
        if tag is None:
            if match[0][0] != "<" or match[0] == "<":
                run.append(match[0])
            continue
        tag = tag.lower()
        closing = match[1] or match[4]
        if tag not in INLINE and tag not in INLINE_RAW:
            close_block()
        elif tag in ("br", "td", "th"):
            run.append(" ")
        if closing:
            # inline elements carry no style of their own and are not on the stack
            if tag not in INLINE and any(e.tag == tag for e in stack[1:]):
                while stack[-1].tag != tag:
                    pop()
                pop()
            continue
        rest = match[3] if match[2] else match[6]
        if tag in RAW:
            end = re.compile(rf"</{tag}\b", re.IGNORECASE).search(page, at)
            if not rest.rstrip().endswith("/"):
                at = end.start() if end else len(page)
                close = page.find(">", at) if end else -1
                at = close + 1 if close >= 0 else len(page)
            stack[-1].children.append(tag)
            continue
        if tag in INLINE or tag in VOID:
            continue
        ends = ENDS.get(tag, frozenset(["p"]) if tag not in ("html", "body", "head") else frozenset())
        while stack[-1].tag in ends:
            pop()
        if tag in ("body", "article", "main", "div", "p", "nav") and stack[-1].tag == "head":
            pop()
        above = stack[-1]
        attributes = {
            name.lower(): value.strip("\"'") for name, value in _ATTRIBUTE.findall(rest)
        } if rest.strip(" /") else {}
        name = tag + "".join(f".{c}" for c in sorted(attributes.get("class", "").split()))
        above.children.append(name)
        in_article = above.in_article or tag in ("article", "main") or attributes.get("role") == "main"
        opened = _Open(
            tag,
            f"{above.path}/{name}",
            in_article,
            above.plain and tag in PLAIN if above.in_article else tag in PLAIN or not in_article,
            _is_hidden(attributes),
            _is_named(tag, attributes, above.in_article),
            above,
            [],
        )
        if in_article and not above.in_article and not opened.named:
            for element in stack:
                element.holds_article = True
        stack.append(opened)
    close_block()
    while len(stack) > 1:
        pop()
    return blocks, styles


def branches(path: str) -> list[str]:
    """A style path and the paths above it, without the root."""
    parts = path.split("/")[1:]
    return ["/" + "/".join(parts[:n]) for n in range(1, len(parts) + 1)]


def main_text(page: str | None, removed: frozenset[str] = frozenset()) -> str:
    """The text of a page without boilerplate and the removed branches of its host."""
    blocks = parse(page or "")[0]
    found = [b for b in blocks if not b.boilerplate()]
    if not any(b.in_article for b in found) and any(b.in_article for b in blocks):
        found = [b for b in blocks if not b.boilerplate(lift=True)]
    if any(b.in_article for b in found):
        found = [b for b in found if b.in_article]
    kept = [
        b for b in found if (b.in_article and b.plain) or not removed or removed.isdisjoint(branches(b.path))
    ]
    return "\n".join(b.text for b in kept or found)


_NODES_HELD = 100_000  # counted nodes a task holds before it passes them on


def page_nodes(page: str | None) -> set[tuple[str, int, str]]:
    """(path, kind, feature) of one page: kind 0 with child sequences, kind 1 with texts."""
    blocks, styles = parse(page or "")
    return {(b.path, 1, b.text) for b in blocks} | {(path, 0, style) for path, style in styles}


def _nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(host, path, kind, feature, n): on how many pages of a task a node has a feature, hashed."""
    counts: dict[tuple[str, str, int, int], int] = {}

    def rows() -> pa.RecordBatch:
        hosts, paths, kinds, features = zip(*counts) if counts else ((), (), (), ())
        arrays = [
            pa.array(hosts, pa.string()), pa.array(paths, pa.string()), pa.array(kinds, pa.int32()),
            pa.array(np.array(features, dtype=np.uint64).view(np.int64)), pa.array(list(counts.values()), pa.int64()),
        ]
        counts.clear()
        return pa.RecordBatch.from_arrays(arrays, names=["host", "path", "kind", "feature", "n"])

    for batch in batches:
        for host, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            for path, kind, feature in page_nodes(page):
                key = (host, path, kind, xxhash.xxh3_64_intdigest(feature))
                counts[key] = counts.get(key, 0) + 1
            if len(counts) > _NODES_HELD:
                yield rows()
    yield rows()


def node_importance(pages: DataFrame) -> DataFrame:
    """(host, path, kind, pages, importance) of the merged nodes of every host."""
    nodes = pages.select(host_of(F.col("url")).alias("host"), F.col("html").cast("string").alias("html")).mapInArrow(
        _nodes, "host string, path string, kind int, feature bigint, n bigint"
    )
    counts = nodes.groupBy("host", "path", "kind", "feature").agg(F.sum("n").alias("n"))
    # - sum p log p with p = n / m is log m - (sum n log n) / m
    return (
        counts.groupBy("host", "path", "kind")
        .agg(F.sum("n").alias("pages"), F.sum(F.col("n") * F.log("n")).alias("nlogn"))
        .select(
            "host",
            "path",
            "kind",
            "pages",
            F.when(F.col("pages") > 1, (F.log("pages") - F.col("nlogn") / F.col("pages")) / F.log("pages"))
            .otherwise(1.0)
            .alias("importance"),
        )
    )


def low_branches(pages: DataFrame) -> DataFrame:
    """(host, removed): style paths of low composite importance, for hosts that have any."""
    nodes = materialize(node_importance(pages), "style_nodes")
    above = F.expr(
        "transform(filter(sequence(1, length(path)), i -> i = length(path) OR substring(path, i + 1, 1) = '/'),"
        " i -> substring(path, 1, i))"
    )
    leaves = (
        nodes.where("kind = 1")
        .select("host", F.explode(above).alias("branch"), "pages", "importance")
        .groupBy("host", "branch")
        .agg(
            (F.sum(F.col("importance") * F.col("pages")) / F.sum("pages")).alias("content"),
            F.max("pages").alias("pages"),
        )
    )
    own = nodes.where("kind = 0").select("host", F.col("path").alias("branch"), F.col("importance").alias("style"))
    scored = leaves.join(own, ["host", "branch"], "left").withColumn(
        "importance",
        F.when(F.col("style").isNull(), F.col("content")).otherwise(
            (1 - DECAY) * F.col("style") + DECAY * F.col("content")
        ),
    )
    return (
        scored.where((F.col("pages") >= PAGES) & (F.col("importance") < THRESHOLD))
        .groupBy("host")
        .agg(F.sort_array(F.collect_set("branch")).alias("removed"))
    )


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [
            main_text(page, frozenset(removed or ()))
            for page, removed in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())
        ]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(texts, pa.string())], names=["page_id", "url", "text"]
        )


def extract_main_text(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars), one row per row of ``pages(page_id, url, html)``."""
    removed = materialize(low_branches(pages), "low_branches")
    given = pages.select(
        "page_id",
        F.col("url").cast("string").alias("url"),
        F.col("html").cast("string").alias("html"),
        host_of(F.col("url")).alias("_host"),
    )
    joined = given.join(removed, F.col("_host") == F.col("host"), "left").select("page_id", "url", "html", "removed")
    kind = pages.schema["page_id"].dataType.simpleString()
    return joined.mapInArrow(_texts, f"page_id {kind}, url string, text string").withColumn(
        "n_chars", F.length("text").cast("bigint")
    )
