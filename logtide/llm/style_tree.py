"""Main text of pages by a site style tree.

The pages of a host are merged into one tree: elements with the same path of names (tag,
classes, id) are one node. A node is presented in different ways (the sequence of its
children's names) and holds different content (the text below it). Each different page of the
host counts once, with all it has of a node. The entropy of either over two pages, relative to
the highest possible and averaged over all pairs of pages, is the node's importance, so the number
of pages does not move it. Branches that look and read the same on every page have an importance
near zero and are removed from each page; inside the article only those that bear a name, or are
no part of running text.

Sites with few pages, and chrome whose text is drawn anew for every page, give entropy nothing
to see. Elements whose tag, role or class says that they are a menu, a footer, an advert and so
on have importance zero from the start.

The tree is counted with distributed aggregations; a page meets only its host's low nodes.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from html import unescape
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from logtide.llm.common import ship, written

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "html body address article aside blockquote center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hgroup hr legend li main menu nav ol p pre search section summary table caption tbody "
    "td tfoot th thead tr ul".split()
)
HEAD_ONLY = frozenset("title meta link base script style noscript template".split())
# What a start tag of the first kind closes, if it is open in the same container.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
CLOSES |= {"thead": {"tr", "td", "th", "tbody", "thead", "tfoot"}, "tbody": {"tr", "td", "th", "tbody", "thead", "tfoot"}}
CONTAINERS = frozenset("ul ol menu dl table div section article body html main aside".split())
CHROME_TAGS = frozenset(
    "head nav footer aside form script style noscript template iframe object embed svg canvas audio video button select "
    "option textarea input dialog menu search map title".split()
)
CHROME_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form".split())
CHROME_NAMES = frozenset(
    "ad ads adbox adsense advert adverts advertisement advertising banner banners promo promos promotion sponsor sponsored "
    "sidebar sidebars side aside rail menu menus nav navbar navigation navi breadcrumb breadcrumbs footer foot masthead topbar header "
    "cookie cookies consent gdpr notice notices notification alert popup modal overlay newsletter subscribe subscription "
    "signup login search searchbox share sharing social comment comments commentlist reply replies respond discussion disqus "
    "related recommended recommendations widget widgets toolbar pagination pager skip".split()
)
# Names that say a page has such a part, not that this is one.
ABOUT_NAMES = frozenset("with without has no".split())
COMMENT_NAMES = frozenset("comment comments commentlist reply replies respond discussion disqus".split())
# Without a class or an id, entropy does not remove these from the article.
RUNNING = frozenset(
    "p h1 h2 h3 h4 h5 h6 hgroup ul ol li dl dt dd table caption thead tbody tfoot tr td th figure figcaption pre blockquote".split()
)
MAY_BE_CHROME = frozenset("div section ul ol dl table p span header aside li a figure center blockquote details".split())


@dataclass(frozen=True)
class Site:
    """Below ``lowest`` a branch is removed, on hosts with ``min_pages`` different pages or more."""

    lowest: float = 0.2
    content_weight: float = 0.7
    min_pages: int = 5


@lru_cache(maxsize=100_000)
def _tokens(value: str) -> frozenset[str]:
    return frozenset(re.sub(r"([a-z])([A-Z])", r"\1 \2", value).lower().replace("_", " ").replace("-", " ").split())


class Page(HTMLParser):
    """The elements of a page in document order: parent, tag, name, children (elements and text).

    Time grows with the length, also of broken pages: open elements are found by their name, an
    unclosed comment is sought once, and behind the last '>' no tag can end, so that is text.
    """

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.tags, self.names, self.parents, self.kids, self.chrome = ["#"], ["#"], [-1], [[]], [False]
        self.open = [0]
        # Per tag, and for all blocks, where in ``open`` they are.
        self.places: dict[str, list[int]] = {}
        self.open_blocks: list[int] = []
        self.comments_end = True
        last = html.rfind(">") + 1
        self.feed(html[:last])
        self.close()
        self.handle_data(unescape(html[last:]))

    def parse_comment(self, i, report=1):
        end = super().parse_comment(i, report) if self.comments_end else -1
        self.comments_end = end >= 0
        return end

    def _open(self, node):
        tag = self.tags[node]
        self.places.setdefault(tag, []).append(len(self.open))
        if tag in BLOCKS:
            self.open_blocks.append(len(self.open))
        self.open.append(node)

    def _close_from(self, at):
        while len(self.open) > at:
            tag = self.tags[self.open.pop()]
            self.places[tag].pop()
            if tag in BLOCKS:
                self.open_blocks.pop()

    def _last(self, tags):
        """Where the innermost open element of some tags is; 0 for none."""
        return max((self.places[tag][-1] for tag in tags if self.places.get(tag)), default=0)

    def parse_html_declaration(self, i):
        # The base class knows few marked sections and raises on others; in HTML all are comments up to '>'.
        return self.parse_bogus_comment(i) if self.rawdata.startswith("<![", i) else super().parse_html_declaration(i)

    def handle_starttag(self, tag, attrs):
        self._imply(tag)
        if tag in ("html", "body") and tag in self.tags:
            return
        get = dict(attrs).get
        label = f"{get('class') or ''} {get('id') or ''}".strip()
        node = len(self.tags)
        self.tags.append(tag)
        self.names.append(tag + re.sub(r"\d+", "9", label))
        self.parents.append(self.open[-1])
        self.kids.append([])
        self.chrome.append(self._is_chrome(tag, label, get("role"), attrs))
        self.kids[self.open[-1]].append(node)
        if tag not in VOID:
            self._open(node)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        places = self.places.get(tag)
        at = places[-1] if places else 0
        # An inline end tag does not close the block around it.
        if at and (tag in BLOCKS or not self.open_blocks or self.open_blocks[-1] < at):
            self._close_from(at)

    def handle_data(self, data):
        if data:
            if not data.isspace():
                self._leave_head()
            self.kids[self.open[-1]].append(data)

    def _leave_head(self):
        if self.tags[self.open[-1]] == "head":
            self._close_from(len(self.open) - 1)

    def _imply(self, tag):
        if tag not in HEAD_ONLY:
            self._leave_head()
        while True:
            if tag in BLOCKS and self.open_blocks and self.tags[self.open[self.open_blocks[-1]]] == "p":
                self._close_from(self.open_blocks[-1])
            at = self._last(CLOSES[tag]) if tag in CLOSES else 0
            if not at or at < self._last(CONTAINERS):
                return
            self._close_from(at)
            if tag not in ("tr", "tbody", "thead"):
                return

    def _in_main(self):
        return bool(self._last(("article", "main")))

    def _is_chrome(self, tag, label, role, attrs):
        if tag in CHROME_TAGS or (role or "").lower() in CHROME_ROLES:
            return True
        if tag == "header":
            return not self._in_main()
        if any(a == "hidden" or (a == "style" and v and re.search(r"display\s*:\s*none", v, re.I)) for a, v in attrs):
            return True
        if not label:
            return False
        names = _tokens(label)
        if names & COMMENT_NAMES and tag in MAY_BE_CHROME | {"article"}:
            return True
        found = names & CHROME_NAMES - ({"header"} if self._in_main() else set())
        return tag in MAY_BE_CHROME and bool(found) and not names & ABOUT_NAMES

    def keep_ancestors(self):
        """What holds the article or the main part is no chrome, whatever its name. On a page
        without either, nor is a branch with most of the text and another name besides."""
        seen = set()
        for node, tag in enumerate(self.tags):
            if tag in ("article", "main") and not self.chrome[node]:
                up = self.parents[node]
                while up > 0 and up not in seen:
                    seen.add(up)
                    if self.tags[up] in MAY_BE_CHROME and not _tokens(self.names[up][len(self.tags[up]) :]) & COMMENT_NAMES:
                        self.chrome[up] = False
                    up = self.parents[up]
        if "article" in self.tags or "main" in self.tags:
            return
        size = [0] * len(self.tags)
        for node in range(len(self.tags) - 1, -1, -1):
            if self.tags[node] not in CHROME_TAGS:
                size[node] += sum(len(kid) for kid in self.kids[node] if isinstance(kid, str))
                if node:
                    size[self.parents[node]] += size[node]
        for node, tag in enumerate(self.tags):
            if self.chrome[node] and tag in MAY_BE_CHROME and 10 * size[node] > 6 * size[0]:
                names = _tokens(self.names[node][len(tag) :])
                if names - CHROME_NAMES and not names & COMMENT_NAMES:
                    self.chrome[node] = False

    def keys(self) -> list[int]:
        """A number for each element: the hash of the names from the root to it."""
        out = [0]
        for node in range(1, len(self.tags)):
            out.append(xxh64_intdigest(f"{out[self.parents[node]]}/{self.names[node]}") >> 1)
        return out

    def looks(self) -> list[tuple[int, int]]:
        """Per element: hash of the sequence of its children's names, repeats merged, and of all text below it."""
        found = [(0, 0)] * len(self.tags)
        for node in range(len(self.tags) - 1, -1, -1):
            names, text = [], []
            for kid in self.kids[node]:
                if isinstance(kid, str):
                    words = kid.split()
                    if words:
                        text.append(" ".join(words))
                else:
                    if not names or names[-1] != self.names[kid]:
                        names.append(self.names[kid])
                    if found[kid][1]:
                        text.append(str(found[kid][1]))
            found[node] = (xxh64_intdigest(">".join(names)) >> 1, (xxh64_intdigest("\n".join(text)) >> 1) if text else 0)
        return found

    def text(self, low: frozenset[int] = frozenset()) -> str:
        """Blocks of the main part without chrome and low branches, joined by line ends."""
        self.keep_ancestors()
        if low:
            holds, inside = set(), [False] * len(self.tags)
            for node, tag in enumerate(self.tags):
                inside[node] = tag in ("article", "main") or (node > 0 and inside[self.parents[node]])
                if tag in ("article", "main", "body", "html"):
                    up = node
                    while up > 0 and up not in holds:
                        holds.add(up)
                        up = self.parents[up]
            for node, key in enumerate(self.keys()):
                running = inside[node] and self.tags[node] in RUNNING and self.names[node] == self.tags[node]
                if key in low and node not in holds and not running:
                    self.chrome[node] = True
        roots = [n for n in self._top("article") if self._has_text(n)] or [n for n in self._top("main") if self._has_text(n)] or [0]
        blocks: list[str] = []
        line: list[str] = []

        def end_block():
            words = " ".join("".join(line).split())
            if words:
                blocks.append(words)
            line.clear()

        for root in roots:
            todo: list = [root]
            while todo:
                item = todo.pop()
                if item is None:
                    end_block()
                elif isinstance(item, str):
                    line.append(item)
                elif self.tags[item] == "br":
                    line.append(" ")
                elif not self.chrome[item]:
                    block = self.tags[item] in BLOCKS
                    if block:
                        end_block()
                        todo.append(None)
                    todo.extend(reversed(self.kids[item]))
            end_block()
        return "\n".join(blocks)

    def _top(self, tag):
        """Outermost elements of a kind that are not inside chrome."""
        hidden, out = [False] * len(self.tags), []
        for node in range(1, len(self.tags)):
            up = self.parents[node]
            hidden[node] = hidden[up] or self.chrome[node] or self.tags[up] == tag
            if self.tags[node] == tag and not hidden[node]:
                out.append(node)
        return out

    def _has_text(self, node):
        todo = [node]
        while todo:
            item = todo.pop()
            if isinstance(item, str):
                if not item.isspace():
                    return True
            elif not self.chrome[item]:
                todo.extend(self.kids[item])
        return False


def host_of(column):
    """Host of a URL in lower case; empty for none."""
    return F.lower(F.coalesce(F.regexp_extract(column, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1), F.lit("")))


def low_branches(pages: DataFrame, site: Site = Site()) -> DataFrame:
    """(host, low): keys of the style-tree nodes of low importance of each host that has any."""
    ship(pages.sparkSession)

    def nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            host, copy, key, look, content = [], [], [], [], []
            for h, html in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                page, same = Page(html or ""), xxh64_intdigest((html or "").encode("utf-8", "replace")) >> 1
                met: dict[int, list[tuple[int, int]]] = {}
                for node, (k, seen) in enumerate(zip(page.keys(), page.looks(), strict=True)):
                    # The root (key 0) stands for the page; bare inline elements are part of their block.
                    if seen[1] and (not node or page.tags[node] in BLOCKS or page.tags[node] != page.names[node]):
                        met.setdefault(k, []).append(seen)
                for k, all_seen in met.items():
                    host.append(h)
                    copy.append(same)
                    key.append(k)
                    for out, parts in zip((look, content), zip(*all_seen), strict=True):
                        out.append(parts[0] if len(parts) == 1 else xxh64_intdigest(repr(parts)) >> 1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(host, pa.string()), *(pa.array(x, pa.int64()) for x in (copy, key, look, content))],
                ["host", "copy", "key", "look", "content"],
            )

    found = pages.select(host_of(F.col("url")).alias("host"), "html").where("html IS NOT NULL AND host <> ''")
    counted = (
        found.mapInArrow(nodes, "host string, copy long, key long, look long, content long")
        .distinct()  # copies of a page count once
        .groupBy("host", "key", "look", "content")
        .count()
    )
    counted = written(counted, "nodes")

    def entropy(feature: str) -> DataFrame:
        """Entropy of a feature over two of a node's pages, relative to the highest, averaged over
        all pairs: the share of pairs that differ."""
        each = counted.groupBy("host", "key", feature).agg(F.sum("count").alias("n"))
        sums = each.groupBy("host", "key").agg(
            F.sum("n").alias("m"), F.sum(F.col("n").cast("double") * F.col("n")).alias("s"), F.count("*").alias("kinds")
        )
        m = F.col("m").cast("double")
        h = F.when(m > 1, (m * m - F.col("s")) / (m * (m - 1))).otherwise(1.0)
        return sums.select("host", "key", "m", "kinds", h.alias("h"))

    content = entropy("content").withColumnRenamed("h", "content_h")
    look = entropy("look").select("host", "key", F.col("h").alias("look_h"))
    importance = F.col("content_h") * site.content_weight + F.col("look_h") * (1 - site.content_weight)
    scored = written(content.join(look, ["host", "key"]).withColumn("importance", importance), "importance")
    large = scored.where(f"key = 0 AND kinds >= {site.min_pages}").select("host")
    low = scored.where(f"key <> 0 AND m >= {site.min_pages} AND importance < {site.lowest}")
    return low.join(large, "host").groupBy("host").agg(F.collect_list("key").alias("low"))


def main_text(pages: DataFrame, site: Site = Site()) -> DataFrame:
    """Per row of ``pages`` (page_id, url, html): page_id, url, text of the article, n_chars.

    Null or empty html, and pages without main text, give the empty string. Pages without a
    readable host have no style tree and are judged by names alone. Null ids and repeated rows
    stay; other columns are not read; no rows give no rows.
    """
    ship(pages.sparkSession)
    low = written(low_branches(pages, site), "low")
    rows = pages.select("page_id", "url", host_of(F.col("url")).alias("host"), "html")
    # The list of a host is small; adaptive execution splits a hot host or copies the lists.
    met = rows.join(low, "host", "left").select("page_id", "url", "html", "low")

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [
                Page(html or "").text(frozenset(keys or ()))
                for html, keys in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    kinds = {f.name: f.dataType.simpleString() for f in pages.schema}
    return met.mapInArrow(extract, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")
