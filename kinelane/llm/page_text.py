"""Main text of web pages, with a style tree per site.

Each page is read into a light tree of elements with blocks of text. Menus, forms,
scripts, adverts, notices, comments and the like go by what they say of themselves. All
other branches the site judges. The pages of a host are merged into one tree: for each
path of elements it counts the layouts (sequences of children) and the contents (text
blocks) seen there. A branch whose layouts and contents repeat from page to page has low
importance by entropy, and is removed from each page. A stated article speaks for what it
holds and against what stands beside it: it lowers the bar within, and raises it outside,
where a branch that too few pages have to be judged goes.

The tree exists only as counts by host, path and value, which Spark sums; no task holds
the pages of a host.
"""

from __future__ import annotations

import html as markup
import re
from collections.abc import Collection, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinelane.llm.common import stored
from kinelane.llm.url_rules import host

#: Branches below this importance go, if this many different pages of a host have them.
LEAST_IMPORTANCE, LEAST_PAGES = 0.35, 5
#: How much a stated article lowers the bar for its branches and raises that of others.
EVIDENCE = 0.2
#: Pages whose branches are held at once.
PAGES_AT_ONCE = 500
#: A hot host's branches meet its pages in so many parts.
PARTS = 8
#: Weight of contents against layouts falls with the number of layouts seen.
LAYOUT_DECAY = 0.9

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main "
    "menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead tr ul".split()
)
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
#: Elements that hold no main text, whatever they are called.
NOISE = frozenset(
    "head nav footer aside form script style noscript template button select option input textarea "
    "iframe noframes noembed object embed applet audio video canvas svg math map dialog menu search title".split()
)
NOISE_ROLES = frozenset(
    "navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar "
    "toolbar tablist".split()
)
#: Words of a class or id that name what is not main text.
NOISE_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising adbox adsense sponsor sponsored promo promotion "
    "banner cookie cookies consent gdpr notice notices notification alert popup modal overlay newsletter "
    "subscribe subscription signup login paywall sidebar sidebars sidenav widget widgets related "
    "recommended recommendations recirculation share sharing social breadcrumb breadcrumbs menu menus "
    "nav navbar navigation topnav footer masthead comment comments commentlist disqus reply replies "
    "respond pagination pager toolbar skip skiplink".split()
)
#: What opening one of these closes, if it is open.
_CLOSES = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"),
    "td": ("td", "th"), "th": ("td", "th"), "option": ("option",), "body": ("head",),
    "tbody": ("thead", "tbody", "tr", "td", "th"), "tfoot": ("thead", "tbody", "tr", "td", "th"),
}
_SCOPES = frozenset("ul ol dl table body html td th div section article main".split())
_CLOSE_P = BLOCKS - {"body", "html", "caption", "legend", "option", "optgroup", "td", "th", "tr", "tbody", "thead", "tfoot", "frameset"}

_TAG = re.compile(
    r"<!--(?:.*?-->|.*\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"<]*\"|'[^'<]*'|[^>\"'])*)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|<[!?/][^>]*>",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))|([^\s=/\"'>]+)")
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|[0-9]+")


class Node(NamedTuple):
    """An element: the one around it, its tag with classes, what it says of itself."""

    parent: int
    tag: str
    label: str
    noise: bool
    named: bool
    stated: bool


class Page(NamedTuple):
    nodes: list[Node]
    #: (node, text) in page order.
    blocks: list[tuple[int, str]]


def _described(tag: str, attributes: str) -> tuple[str, bool, bool, bool]:
    """Label, noise by tag or role, noise by name, and whether it is stated main text."""
    noise, named, stated = tag in NOISE, False, tag in ("article", "main")
    label = tag
    if attributes and "=" in attributes or "hidden" in attributes:
        found = {}
        for name, double, single, bare, alone in _ATTRIBUTE.findall(attributes):
            found.setdefault((name or alone).lower(), double or single or bare)
        names = f"{found.get('class', '')} {found.get('id', '')}"
        if names.strip():
            label = f"{tag}.{'.'.join(sorted(found.get('class', '').split()))}"
            named = not NOISE_NAMES.isdisjoint(w.lower() for w in _NAME.findall(names))
        role = found.get("role", "").lower()
        noise |= role in NOISE_ROLES or "hidden" in found or found.get("aria-hidden") == "true"
        noise |= "display:none" in found.get("style", "").replace(" ", "").lower()
        stated |= role in ("main", "article") or "articleBody" in found.get("itemprop", "")
    return label, noise, named, stated


def parse(text: str) -> Page:
    """The elements and blocks of a page, closing what it leaves open.

    Text in elements that hold no main text by their tag or role is left out.
    """
    nodes = [Node(-1, "", "", False, False, False)]
    quiet = [False]
    open_nodes = [0]
    blocks: list[tuple[int, str]] = []
    held: list[str] = []
    at_block = 0
    raw = ""

    def end_block() -> None:
        if held:
            joined = " ".join(markup.unescape("".join(held)).split())
            if joined:
                blocks.append((at_block, joined))
            held.clear()

    def close(down_to: int) -> None:
        nonlocal at_block
        gone = open_nodes[down_to:]
        if any(nodes[n].tag in BLOCKS for n in gone):
            end_block()
        del open_nodes[down_to:]
        at_block = open_nodes[-1]

    def add(piece: str) -> None:
        nonlocal at_block
        here = open_nodes[-1]
        if not piece or quiet[here]:
            return
        if not held:
            if piece.isspace():
                return
            at_block = here
        held.append(piece)

    last = 0
    for tag_match in _TAG.finditer(text):
        first, end = tag_match.span()
        if raw:
            closing = tag_match[1] or tag_match[4]
            if not closing or (tag_match[2] or tag_match[5]).lower() != raw:
                continue
            add(text[last:first])
            raw = ""
        else:
            add(text[last:first])
        last = end
        name = (tag_match[2] or tag_match[5] or "").lower()
        if not name:
            continue
        if tag_match[1] or tag_match[4]:
            for place in range(len(open_nodes) - 1, 0, -1):
                if nodes[open_nodes[place]].tag == name:
                    close(place)
                    break
                if nodes[open_nodes[place]].tag in _SCOPES and name not in BLOCKS:
                    break
            continue
        if name == "br":
            if held:
                held.append(" ")
            continue
        if name in _CLOSE_P or name in _CLOSES:
            wanted = _CLOSES.get(name, ()) + (("p",) if name in _CLOSE_P else ())
            for place in range(len(open_nodes) - 1, 0, -1):
                tag = nodes[open_nodes[place]].tag
                if tag in wanted:
                    close(place)
                elif tag in _SCOPES and tag not in wanted:
                    break
        attributes = tag_match[3] or tag_match[6] or ""
        label, noise, named, stated = _described(name, attributes)
        if name in BLOCKS or named:
            end_block()
        if name in VOID:
            continue
        quiet.append(quiet[open_nodes[-1]] or noise)
        nodes.append(Node(open_nodes[-1], name, label, noise, named, stated))
        open_nodes.append(len(nodes) - 1)
        at_block = open_nodes[-1] if not held else at_block
        if name in RAW:
            raw = name
    if not raw:
        add(text[last:])
    end_block()
    return Page(nodes, blocks)


def _noisy(page: Page) -> list[bool]:
    """Whether each element, or one around it, says that it is no main text.

    A name does not count on what holds the longest stated article, as a page's frame
    may be named after its sidebar; a header only counts outside of stated main text.
    """
    nodes = page.nodes
    size = [0] * len(nodes)
    for number, text in page.blocks:
        size[number] += len(text)
    for number in range(len(nodes) - 1, 0, -1):
        size[nodes[number].parent] += size[number]
    stated = [n for n, node in enumerate(nodes) if node.stated and not node.noise]
    articles = [n for n in stated if nodes[n].tag != "main"] or stated
    holds = [False] * len(nodes)
    if articles:
        at = max(articles, key=lambda n: size[n])
        while at > 0:
            holds[at] = True
            at = nodes[at].parent
    out, within = [False], [False]
    for number, node in enumerate(nodes[1:], 1):
        own = node.noise or (node.named and not holds[number] and node.tag not in ("html", "body"))
        own |= node.tag == "header" and not within[node.parent]
        out.append(out[node.parent] or own)
        within.append(within[node.parent] or node.stated)
    return out


def _paths(page: Page) -> list[int]:
    """A hash of the labels, and of what is stated, from the root to each element."""
    out = [0]
    for node in page.nodes[1:]:
        step = f"{out[node.parent]}>{node.label}{'!' * node.stated}"
        out.append(xxhash.xxh64_intdigest(step) - (1 << 63))
    return out


def _branches(page: Page) -> dict[tuple[int, bool, int], None]:
    """(path, is layout, value) of each branch: its children's labels, its texts."""
    paths = _paths(page)
    children: list[list[str]] = [[] for _ in page.nodes]
    for node in page.nodes[1:]:
        own = children[node.parent]
        if not own or own[-1] != node.label:
            own.append(node.label)
    out: dict[tuple[int, bool, int], None] = {}
    for number in range(1, len(page.nodes)):
        layout = xxhash.xxh64_intdigest(">".join(children[number])) - (1 << 63)
        out[paths[number], True, layout] = None
    for number, text in page.blocks:
        value = xxhash.xxh64_intdigest(text) - (1 << 63)
        while number > 0:
            out[paths[number], False, value] = None
            number = page.nodes[number].parent
    return out


class Evidence(NamedTuple):
    """Of each element: noise by what it says, within stated main text; of the page: states any."""

    noisy: list[bool]
    within: list[bool]
    states: bool


def _evidence(page: Page) -> Evidence:
    noisy, within = _noisy(page), [False]
    for node in page.nodes[1:]:
        within.append(within[node.parent] or node.stated)
    return Evidence(noisy, within, any(within[n] and not noisy[n] for n, _ in page.blocks))


def _holder(page: Page, number: int) -> int:
    """The element of a block, without the inline ones that it begins in."""
    while number > 0 and page.nodes[number].tag not in BLOCKS:
        number = page.nodes[number].parent
    return number


def _asks(page: Page) -> dict[tuple[int, float, bool], None]:
    """(path, bar, stays): a branch goes below the bar, or stays only from the bar on."""
    paths = _paths(page)
    noisy, within, states = _evidence(page)
    out: dict[tuple[int, float, bool], None] = {}
    for number, _ in page.blocks:
        if noisy[number]:
            continue
        if states and not within[number]:
            out[paths[_holder(page, number)], LEAST_IMPORTANCE + EVIDENCE, True] = None
        stated = within[number]
        while number > 0 and within[number] == stated:
            if page.nodes[number].tag not in ("html", "body"):
                out[paths[number], LEAST_IMPORTANCE - EVIDENCE * stated, False] = None
            number = page.nodes[number].parent
    return out


def _print() -> Column:
    return F.xxhash64(F.coalesce("html", F.lit(""))).alias("print")


def branches(pages: DataFrame) -> DataFrame:
    """host, print (of the html), and arrays of a page's branches and of what it asks of them."""
    kinds = {
        "path": pa.int64(), "is_layout": pa.bool_(), "value": pa.int64(),
        "asked": pa.int64(), "bar": pa.float64(), "stays": pa.bool_(),
    }

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, PAGES_AT_ONCE):
                part = batch.slice(first, PAGES_AT_ONCE)
                rows = []
                for text in part.column("html").to_pylist():
                    page = parse(text or "")
                    has, asks = _branches(page), _asks(page)
                    rows.append([*(list(zip(*has)) or [()] * 3), *(list(zip(*asks)) or [()] * 3)])
                columns = [pa.array(c, pa.list_(k)) for c, k in zip(zip(*rows), kinds.values())]
                yield pa.record_batch(
                    [part.column("host"), part.column("print"), *columns], ["host", "print", *kinds]
                )

    return pages.select("host", _print(), "html").mapInArrow(
        work,
        "host string, print long, path array<long>, is_layout array<boolean>, value array<long>, "
        "asked array<long>, bar array<double>, stays array<boolean>",
    )


def _distinct(read: DataFrame) -> DataFrame:
    """One row for each different page of a host."""
    return read.dropDuplicates(["host", "print"])


def _merged(read: DataFrame) -> DataFrame:
    each = read.select("host", F.explode(F.arrays_zip("path", "is_layout", "value")).alias("b"))
    return each.groupBy("host", "b.path", "b.is_layout", "b.value").agg(F.count("*").alias("n"))


def site_tree(pages: DataFrame) -> DataFrame:
    """host, path, is_layout, value, n: on how many pages of a host a path has a value.

    ``pages`` has host and html; pages of a host with equal html are one.
    """
    return _merged(_distinct(branches(pages)))


def importances(tree: DataFrame, pages: DataFrame) -> DataFrame:
    """host, path, n_pages, share and importance of each branch of a site's tree.

    With m pages on a branch, l layouts of frequency p, and texts that are on c pages:
    layouts count as -sum(p log_m p), contents as 1 - mean(log_m c), weighed by
    1 - decay ** l and decay ** l. A branch of one page has importance 1.
    """
    layouts = tree.where("is_layout").groupBy("host", "path").agg(
        F.sum("n").alias("m"), F.count("*").alias("l"), F.sum(F.col("n") * F.log("n")).alias("nlogn")
    )
    contents = tree.where("not is_layout").groupBy("host", "path").agg(
        F.avg(F.log("n")).alias("mean_log")
    )
    sizes = pages.groupBy("host").agg(F.count_distinct(_print()).alias("n_host"))
    both = layouts.join(contents, ["host", "path"], "left").join(sizes, "host")
    m, log_m = F.col("m"), F.log("m")
    layout = (log_m - F.col("nlogn") / m) / log_m
    content = 1 - F.coalesce(F.col("mean_log") / log_m, F.lit(1.0))
    weight = F.pow(F.lit(LAYOUT_DECAY), F.col("l"))
    importance = F.when(m <= 1, 1.0).otherwise((1 - weight) * layout + weight * content)
    return both.select(
        "host", "path", m.alias("n_pages"), (m / F.col("n_host")).alias("share"),
        importance.alias("importance"),
    )


def main_text(
    text: str | None, unimportant: Collection[int], important: Collection[int] = frozenset()
) -> str:
    """The blocks of a page that are left, joined by an empty line.

    Where main text is stated, only ``important`` branches stay beside it.
    """
    page = parse(text or "")
    noisy, within, states = _evidence(page)
    paths = _paths(page)
    low = [False]
    for number, node in enumerate(page.nodes[1:], 1):
        around = low[node.parent] and within[number] == within[node.parent]
        frame = node.tag in ("html", "body")
        low.append(around or (not frame and paths[number] in unimportant))
    return "\n\n".join(
        t for n, t in page.blocks
        if not noisy[n] and not low[n]
        and (within[n] or not states or paths[_holder(page, n)] in important)
    )


def _with_host(pages: DataFrame) -> DataFrame:
    return pages.select("page_id", "url", "html", host("url").alias("host"))


def judged(pages: DataFrame) -> DataFrame:
    """host, print, and the paths of a page that are unimportant and important.

    Only answers that change what a page would state by itself are listed.
    """
    # Written out, as it is read for the tree and for the questions, and parsing is dear.
    read = stored(_distinct(branches(pages)))
    known = importances(stored(_merged(read)), pages).where(F.col("n_pages") >= LEAST_PAGES)
    part = F.pmod("print", F.lit(PARTS)).cast("int").alias("part")
    asked = read.select("host", "print", part, F.explode(F.arrays_zip("asked", "bar", "stays")).alias("a"))
    answers = known.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))))
    met = asked.select("host", "print", "part", F.col("a.asked").alias("path"), "a.bar", "a.stays").join(
        answers, ["host", "path", "part"]
    )
    return met.where((F.col("importance") >= F.col("bar")) == F.col("stays")).groupBy("host", "print").agg(
        F.collect_set(F.when(~F.col("stays"), F.col("path"))).alias("unimportant"),
        F.collect_set(F.when(F.col("stays"), F.col("path"))).alias("important"),
    )


def extracted(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars for each row of ``pages``.

    A null or empty html, or one without main text, has an empty text. Pages without a
    host form one site. Repeated rows are pages of their own, extra columns are ignored,
    an empty table gives no rows.
    """
    sites = _with_host(pages)
    joined = sites.withColumn("print", _print()).join(stored(judged(sites)), ["host", "print"], "left")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [
                main_text(page, frozenset(low or ()), frozenset(high or ()))
                for page, low, high in zip(
                    *(batch.column(c).to_pylist() for c in ("html", "unimportant", "important"))
                )
            ]
            yield pa.record_batch(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
                 pa.array(np.fromiter(map(len, texts), np.int64, len(texts)))],
                ["page_id", "url", "text", "n_chars"],
            )

    return joined.select("page_id", "url", "html", "unimportant", "important").mapInArrow(
        work, "page_id long, url string, text string, n_chars long"
    )
