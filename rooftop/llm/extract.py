"""HTML extraction: pages score their containers, hosts vote on generalised tag-class paths, winners are re-extracted."""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rooftop.llm import common
from rooftop.llm.urls import host_and_path

# Element names of HTML by their role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe xmp noembed noframes".split())
DROPPED = frozenset(
    "head nav header footer aside form button select option dialog menu svg math canvas object audio video map label fieldset".split()
) | RAW
INLINE = frozenset(
        "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp small span strike strong sub "
        "sup time tt u var wbr".split()
)
CONTAINERS = frozenset("article main section div td body blockquote".split())
CLOSES_P = frozenset(
        "address article aside blockquote center details dialog dd dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 "
        "h6 header hgroup hr main menu nav ol p pre section summary table ul".split()
)
#: An element that opens ends an open element of these names, up to the nearest list or table.
SIBLINGS = {
    "li": {"li"},
    "dt": {"dt", "dd"},
    "dd": {"dt", "dd"},
    "tr": {"tr", "td", "th"},
    "td": {"td", "th"},
    "th": {"td", "th"},
    "option": {"option"},
}
BARRIERS = frozenset("ul ol dl table body article section main div".split())
#: Words of class and id, and roles, that mark what isn't the article.
NOISE = frozenset(
        "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner sidebar side nav navbar "
        "navigation menu breadcrumb breadcrumbs header masthead footer foot comment comments reply replies respond disqus notice "
        "notices alert cookie cookies consent gdpr popup modal overlay newsletter subscribe subscription signup login share sharing "
        "social related recommended widget pagination pager toolbar skip search tags".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog menu menubar".split())

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?/][^>]*(?:>|\Z)|[^<]+|<", re.S)
_ATTRIBUTE = re.compile(r"([^\s=/>\"']+)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_WORD = re.compile(r"[a-z]+|\d+")
#: Share of the best container's score that the host's container must reach on a page.
LEAST = 0.25


class _Node:
    __slots__ = ("dropped", "leaf", "links", "parent", "path", "score", "span", "tag", "text")

    def __init__(self, tag: str, path: str, parent, dropped: bool):
        self.tag, self.path, self.parent, self.dropped = tag, path, parent, dropped
        self.span, self.text, self.links, self.score, self.leaf = None, 0, 0, 0.0, False


def _label(tag: str, attributes: str, inside: bool) -> tuple[str, bool]:
    """Generalised name of an element, tag and classes without digits, and whether it isn't part of an article."""
    dropped = tag in DROPPED
    if not attributes.strip():
        return tag, dropped
    found = {m[1].lower(): entities.unescape(m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(attributes)}
    names = found.get("class", "").lower().split()
    words = {w for x in [*names, found.get("id", "").lower()] for w in _WORD.findall(x)}
    noisy = bool(words & NOISE) and tag not in ("html", "body", "article", "main")
    hidden = "hidden" in found or found.get("aria-hidden") == "true" or "display:none" in found.get("style", "").replace(" ", "").lower()
    dropped |= noisy or hidden or found.get("role", "").lower() in ROLES
    return ".".join([tag, *sorted({re.sub(r"\d+", "#", x) for x in names})]), dropped


def parse(page: str) -> tuple[list[str], list[_Node]]:
    """Text pieces in page order, and the containers with the range of pieces of each.

    Pieces are decoded texts outside dropped elements, and blanks where blocks begin and end. End tags that
    don't match and missing ones are mended the way browsers do for paragraphs, items and cells.
    """
    pieces: list[str] = []
    root = _Node("html", "", None, False)
    root.span = [0, 0]
    stack, nodes, at, low = [root], [root], 0, None
    link = 0

    def close(n: int) -> None:
        nonlocal link
        while len(stack) > n:
            node = stack.pop()
            if node.span is not None:
                node.span[1] = len(pieces)
            if node.tag == "a":
                link -= 1

    while m := _TOKEN.match(page, at):
        at = m.end()
        top = stack[-1]
        tag = m[2]
        if tag is None:
            piece = m[0]
            if (piece[0] != "<" or piece == "<") and not top.dropped:
                pieces.append(piece := entities.unescape(piece) if "&" in piece else piece)
                n = len(piece) - piece.count(" ")
                if n and not piece.isspace():
                    node, depth = top, 0
                    while node.tag in INLINE and node.parent is not None:
                        node = node.parent
                    while node is not None and depth < 2:
                        if node.span is not None or node is root:
                            node.text += n
                            node.links += n if link else 0
                            node.score += (0 if link else n) * (1.0, 0.5)[depth]
                            depth += 1
                        node = node.parent
            continue
        tag = tag.lower()
        if m[1]:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    if tag not in INLINE and not top.dropped:
                        pieces.append(" ")
                    close(i)
                    break
                if tag in INLINE and stack[i].tag in BARRIERS:
                    break
            continue
        if tag in CLOSES_P or tag in SIBLINGS:
            ends = SIBLINGS.get(tag, {"p"})
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag in ends:
                    close(i)
                    break
                if stack[i].tag in BARRIERS:
                    break
        top = stack[-1]
        name, dropped = _label(tag, m[3], False)
        if tag not in INLINE and not top.dropped:
            pieces.append(" ")
        if tag in VOID:
            continue
        if tag in RAW:
            low = page.lower() if low is None else low
            end = low.find(f"</{tag}", at)
            at = len(page) if end < 0 else end
        node = _Node(tag, f"{top.path}>{name}" if tag != "html" else "", top, dropped or top.dropped)
        if tag in CONTAINERS and not node.dropped:
            node.span = [len(pieces), len(pieces)]
            nodes.append(node)
        if tag == "a":
            link += 1
        stack.append(node)
    close(0)
    root.span[1] = len(pieces)
    return pieces, nodes


def _scored(nodes: list[_Node]) -> list[tuple[float, _Node]]:
    """Containers by score: letters outside links held directly or by children, less where links prevail."""
    out = [(x.score * (1 - x.links / x.text) * (1.25 if x.tag in ("article", "main") else 1), i, x) for i, x in enumerate(nodes) if x.text]
    return [(s, x) for s, _, x in sorted(out, key=lambda y: (-y[0], y[1]))]


def votes(page: str | None) -> list[tuple[str, int]]:
    """(path, millionths of the page's vote) of the containers with a score; paths of copies of a container are one."""
    best = [x for x in _scored(parse(page or "")[1]) if x[0] > 0]
    whole, out = sum(s for s, _ in best), {}
    for s, x in best:
        out[x.path] = out.get(x.path, 0) + round(1e6 * s / whole)
    return list(out.items())


def main_text(page: str | None, path: str | None) -> str:
    """The text of the containers at path; at the page's own best path where that one is missing or holds little."""
    pieces, nodes = parse(page or "")
    ranked = _scored(nodes)
    if not ranked:
        return ""
    best = ranked[0][0]
    at = [x for x in nodes if path is not None and x.path == path and x.text]
    if not at or sum(s for s, x in ranked if x.path == path) < LEAST * best:
        own: dict[str, float] = {}
        for s, x in ranked:
            own[x.path] = own.get(x.path, 0.0) + s
        best_path = max(own, key=own.__getitem__)
        at = [x for x in nodes if x.path == best_path and x.text]
    out, end = [], 0
    for a, b in sorted(x.span for x in at):
        out += [*pieces[max(a, end) : b], " "]
        end = max(end, b)
    return " ".join("".join(out).split())


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page.

    A null or empty page has an empty text; a null url belongs to the empty host. Repeated pages are extracted each;
    columns other than page_id, url and html are ignored. Texts are whole.
    """
    common.small_batches(pages.sparkSession)
    pages = pages.select("page_id", "url", "html", host_and_path(F.col("url"))[0].alias("host"))

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(h, *v) for h, page in zip(batch.column(0).to_pylist(), batch.column(1), strict=True) for v in votes(page.as_py())]
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[i] for x in found], t) for i, t in enumerate((pa.string(), pa.string(), pa.int64()))],
                ["host", "path", "vote"],
            )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page.as_py(), path) for page, path in zip(batch.column(2), batch.column(3).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    counted = pages.select("host", "html").mapInArrow(common.tidy(vote), "host string, path string, vote long").groupBy("host", "path").agg(
        F.sum("vote").alias("vote"),
        F.count(F.lit(1)).alias("pages"),
    )
    winners = counted.groupBy("host").agg(F.max(F.struct("vote", "path")).alias("best"), F.sum("pages").alias("pages"))
    winners = common.written(winners.select("host", F.col("best.path").alias("path"), "pages"), "winners")
    total = winners.agg(F.count(F.lit(1)).alias("hosts"), F.coalesce(F.sum("pages"), F.lit(0)).alias("pages")).first()
    if total.hosts <= common.BROADCAST_ROWS:
        joined = pages.join(F.broadcast(winners), "host", "left")
    else:
        joined = common.hot_left_join(pages, winners, ["host"], "pages", total.pages)
    return joined.select(F.col("page_id").cast("long"), "url", "html", "path").mapInArrow(
        common.tidy(read),
        "page_id long, url string, text string, n_chars long",
    )


def op7_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(common.table(spark, sf_dir, "pages"))
