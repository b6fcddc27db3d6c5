"""Main text of web pages by consensus paths of their hosts.

Every page's containers are scored by the plain text below them, and each page votes for
the smallest one that holds its whole article, under a path of generalised tag and class
names. Spark sums the votes per host; each page is then read again below the path of most
votes that holds the page's own article.
"""

from __future__ import annotations

import os
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from affinia.llm.tables import written
from affinia.operators.indexing import top_per_group
from affinia.operators.sizes import measured_bytes

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^>]*)>", re.S)
_NAMES = re.compile(r"""\b(class|id|role|hidden|style|aria-hidden)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)

#: Their content is no text.
RAW = {"script", "style", "noscript", "template", "svg", "iframe", "textarea", "title", "math", "object", "canvas"}
VOID = {"br", "hr", "img", "input", "meta", "link", "area", "base", "col", "embed", "source", "track", "wbr", "param"}
#: Elements that stand beside the article.
ASIDE = {"nav", "footer", "header", "aside", "form", "menu", "dialog", "button", "select", "fieldset", "label", "head"}
ASIDE_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert", "menu"}
#: Words of class names and ids of what stands beside the article.
ASIDE_WORDS = {
    "ad", "ads", "advert", "adverts", "advertisement", "advertising", "banner", "banners", "breadcrumb", "breadcrumbs",
    "comment", "comments", "cookie", "cookies", "consent", "disqus", "footer", "form", "gdpr", "header", "login", "masthead",
    "menu", "modal", "nav", "navbar", "navigation", "newsletter", "notice", "notices", "pagination", "pager", "popup",
    "promo", "promoted", "promotion", "recommended", "related", "replies", "reply", "respond", "responses", "search",
    "share", "sharing", "sidebar", "signup", "skip", "social", "sponsor", "sponsored", "subscribe", "subscription",
    "tagcloud", "toolbar", "topbar", "widget", "widgets"}
CONTAINERS = {"body", "div", "article", "section", "main", "table", "tbody", "tr", "td", "center", "ul", "ol", "dl", "figure",
              "details", "form", "nav", "aside", "footer", "header", "blockquote"}
#: Elements that mark the article.
ARTICLE = {"article", "main"}
BLOCKS = CONTAINERS | {
    "p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "pre", "dd", "dt", "figcaption", "address", "th", "thead", "tfoot",
    "caption", "summary", "hgroup", "fieldset", "legend", "option", "select", "button", "html", "head", "menu", "dialog"}
_CLOSES = {"li": {"li"}, "dd": {"dd", "dt"}, "dt": {"dd", "dt"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
           "option": {"option"}, "tbody": {"tr", "td", "th", "thead", "tbody"}}
_WITHIN = {"li": {"ul", "ol", "menu"}, "dd": {"dl"}, "dt": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"},
           "option": {"select"}, "tbody": {"table"}}


#: Of these words, those that name what readers, advertisers and the site add even inside an article.
ADDED_WORDS = {
    "ad", "ads", "advert", "adverts", "advertisement", "advertising", "comment", "comments", "cookie", "cookies", "consent",
    "disqus", "gdpr", "newsletter", "promo", "promoted", "promotion", "share", "sharing", "social", "sponsor", "sponsored",
    "subscribe", "subscription"}
#: Elements that words of a class or an id can mark; headings and paragraphs are not among them.
MARKED = CONTAINERS - {"body", "article", "main"} | {"span", "ins", "iframe", "menu", "dialog", "button", "address"}
#: Levels of containers that a path names; what lies deeper has the path of the last of them.
DEEPEST = 128


def _described(tag: str, attributes: str, within: bool) -> tuple[str, bool]:
    """The element's generalised name, and whether it stands beside the article.

    ``within`` an article a header is its heading, ids are anchors, and only classes that
    name additions mark a container; headings and paragraphs are marked nowhere.
    """
    aside = tag in ASIDE and not (within and tag in ("header", "label", "fieldset"))
    if not attributes or attributes.isspace():
        return tag, aside
    words = []
    for m in _NAMES.finditer(attributes):
        key, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        if key in ("class", "id"):
            tokens = re.findall(r"[a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", value))
            marks = (ADDED_WORDS if key == "class" else ()) if within else ASIDE_WORDS
            if tag in MARKED and any(t in marks for t in tokens):
                aside = True
            if key == "class" and value.split():
                words.append(re.sub(r"\d+", "#", value.split()[0]))
        elif key == "role":
            aside = aside or value in ASIDE_ROLES
        elif key == "hidden" or (key == "aria-hidden" and value == "true"):
            aside = True
        elif key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            aside = True
    return ".".join([tag, *words]), aside


class _Open:
    """The open elements of a page, with counts that spare looking through all of them."""

    def __init__(self) -> None:
        self.held: list[tuple[str, bool, bool, int]] = []  # tag, beside, block, length of the path before it
        self.path: list[str] = []
        self.tags: Counter[str] = Counter()
        self.beside = self.articles = 0

    def push(self, tag: str, name: str, aside: bool, block: bool) -> None:
        self.held.append((tag, aside, block, len(self.path)))
        if tag in CONTAINERS and len(self.path) < DEEPEST:
            self.path.append(name)
        self.tags[tag] += 1
        self.beside += aside
        self.articles += tag in ARTICLE

    def cut(self, depth: int) -> None:
        """Closes all elements from a depth on."""
        for tag, aside, _, before in reversed(self.held[depth:]):
            del self.path[before:]
            self.tags[tag] -= 1
            self.beside -= aside
            self.articles -= tag in ARTICLE
        del self.held[depth:]

    def last(self, tag: str) -> int | None:
        if not self.tags[tag]:
            return None
        return next(k for k in range(len(self.held) - 1, -1, -1) if self.held[k][0] == tag)

    def block_after(self, depth: int) -> bool:
        return any(block for _, _, block, _ in self.held[depth + 1:])

    def make_room(self, tag: str) -> None:
        """Closes what a new block ends by beginning."""
        depth = self.last("p")
        if depth is not None and (depth == len(self.held) - 1 or not self.block_after(depth)):
            self.cut(depth)
        ends = _CLOSES.get(tag, ())
        if not any(self.tags[t] for t in ends):
            return
        for k in range(len(self.held) - 1, -1, -1):
            if self.held[k][0] in _WITHIN[tag]:
                break
            if self.held[k][0] in ends:
                self.cut(k)
                if not any(self.tags[t] for t in ends):
                    break


def page_blocks(html: str) -> list[tuple[tuple[str, ...], str, int, bool]]:
    """(container path, text, linked characters, beside the article) of each block in page order."""
    out: list[tuple[tuple[str, ...], str, int, bool]] = []
    stack, parts = _Open(), []
    linked, in_link, at, end, last = 0, 0, 0, len(html), html.rfind(">")

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join(unescape("".join(parts)).split())
            if text:
                out.append((tuple(stack.path), text, linked, stack.beside > 0))
            parts.clear()
        linked = 0

    while at < end:
        # Behind the last ">" no tag ends; looking for one again and again would take the square of the length.
        m = _TAG.search(html, at) if at <= last or "<!--" in html[at:] else None
        if m is None:
            parts.append(html[at:])
            break
        if m.start() > at:
            parts.append(html[at:m.start()])
            if in_link:
                linked += m.start() - at
        at = m.end()
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            continue
        attributes = m[3] if m[2] else m[6]
        if m[1] or m[4]:
            if tag == "a":
                in_link = 0
            depth = stack.last(tag)
            if depth is None:
                if tag == "p":
                    flush()
                continue
            if stack.held[depth][2]:
                flush()
            elif stack.block_after(depth):
                continue  # an inline end inside a block that began later
            stack.cut(depth)
            continue
        if tag in VOID:
            if tag in ("br", "hr"):
                parts.append("\n")
            continue
        if tag in RAW and not attributes.endswith("/"):
            close = re.compile(rf"</{tag}\s*>", re.I).search(html, at)
            at = close.end() if close else end
            continue
        if tag == "a":
            in_link = 1
            continue
        if tag in BLOCKS:
            flush()
            stack.make_room(tag)
        name, aside = _described(tag, attributes, stack.articles > 0)
        if tag in BLOCKS or aside or attributes.strip():
            if not attributes.endswith("/") or tag in BLOCKS:
                if aside and tag not in BLOCKS:
                    flush()
                stack.push(tag, name, aside, tag in BLOCKS or aside)
    flush()
    return out


def best_path(blocks: list[tuple[tuple[str, ...], str, int, bool]], share: float = 0.8) -> str | None:
    """The path of the smallest container that holds all blocks of the article.

    If the deepest container of at least ``share`` of the plain text is an article or main
    element or lies in one, the article is what lies in such elements; else it is all
    plain text of the page. What stands beside the article never counts.
    """
    covered: dict[tuple[str, ...], float] = defaultdict(float)
    total = 0.0
    for path, text, linked, aside in blocks:
        if aside:
            continue
        weight = max(0, len(text) - 2 * linked)
        total += weight
        for depth in range(len(path) + 1):
            covered[path[:depth]] += weight
    if not total:
        return None
    good = [p for p, w in covered.items() if w >= share * total]
    marked = _in_article(max(good, key=lambda p: (len(p), covered[p], p)))
    held = [path for path, text, linked, aside in blocks
            if not aside and (_in_article(path) if marked else len(text) > 2 * linked)]
    return "/".join(os.path.commonprefix(held))


def _in_article(path: tuple[str, ...]) -> bool:
    return any(name.split(".")[0] in ARTICLE for name in path)


def read_below(blocks: list[tuple[tuple[str, ...], str, int, bool]], path: str) -> str:
    """The blocks of the article below a container path, in page order."""
    head = tuple(path.split("/")) if path else ()
    return " ".join(text for own, text, _, aside in blocks if not aside and own[:len(head)] == head)


def host_of(url: Column) -> Column:
    """The host of an address in lower case; empty where there is none."""
    return F.coalesce(F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)", 1), F.lit(""))


def _votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        hosts, paths = [], []
        for host, html in zip(batch.column(0).to_pylist(), batch.column(1)):
            path = best_path(page_blocks(html.as_py() or ""))
            if path is not None:
                hosts.append(host)
                paths.append(path)
        yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(paths, pa.string())], names=["host", "path"])


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = []
        for html, ranked in zip(batch.column(2), batch.column(3).to_pylist()):
            blocks = page_blocks(html.as_py() or "")
            path = best_path(blocks)
            if path is None:  # linked text only
                own = {"/".join(b[0][:d]) for b in blocks if not b[3] for d in range(len(b[0]) + 1)}
                path = next((p for p in ranked or () if p in own), None)
            else:
                path = next((p for p in ranked or () if not p or f"{path}/".startswith(f"{p}/")), path)
            texts.append("" if path is None else read_below(blocks, path))
        yield pa.RecordBatch.from_arrays([
            batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
            names=["page_id", "url", "text", "n_chars"])


def main_texts(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", paths: int = 16,
    broadcast_bytes: int = 8 << 20,
) -> DataFrame:
    """(page_id, url, text, n_chars) for every row of ``pages``.

    The text is that of the blocks below the consensus path of the page's host, in page
    order, without menus, headers, footers, sidebars, notices, adverts, forms, scripts,
    styles and comments; references are decoded, white space becomes one space. A host's
    ``paths`` best voted paths are kept; a page whose article lies whole below none of
    them uses its own best.

    Null and empty pages and pages without text give an empty text. Rows without url
    share the empty host; rows without an id and repeated rows are read one by one (a
    repeated page votes each time). Other columns are ignored; an empty table gives no
    rows. Host paths are broadcast if their counted bytes are few, else joined by
    shuffling, where a large host is split.
    """
    source = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    source = source.withColumn("host", host_of(F.col("url")))
    votes = source.select("host", "html").mapInArrow(_votes, "host string, path string").groupBy("host", "path").agg(
        F.count("*").alias("n"))
    # Per host at most as many rows as it has layouts.
    best = top_per_group(votes, ["host"], [F.desc("n"), F.asc("path")], paths)
    ranked = written(best.groupBy("host").agg(F.transform(
        F.array_sort(F.collect_list(F.struct("rank", "path"))), lambda s: s["path"]).alias("ranked")), "host-paths")
    size = measured_bytes(ranked.select("host", F.array_join("ranked", "/").alias("r")))
    ranked = F.broadcast(ranked) if size <= broadcast_bytes else ranked
    joined = source.join(ranked, "host", "left").select("page_id", "url", "html", "ranked")
    kind = source.schema["page_id"].dataType.simpleString()
    return joined.mapInArrow(_extract, f"page_id {kind}, url string, text string, n_chars bigint")
