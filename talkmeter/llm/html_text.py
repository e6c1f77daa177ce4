"""Main text of web pages by minimum-cut labelling of their blocks.

A page is cut into blocks (text between the borders of block elements). Two things speak for or
against a block: a linear classifier over its text (length, links, punctuation, letters, kind of
element), and the markup around it (article, navigation, footer, class names ...). Together they
are the block's log-odds of being content; the two label costs that follow are the capacities of its
edges to source and sink. Neighbouring blocks, and neighbours under one parent, are joined by edges
whose capacity falls with their distance in the document tree. The minimum cut, found by maximum
flow, parts content from boilerplate.

The classifier is fitted on a bounded sample of pages: ``sample`` pages with the smallest hash of
their id; there, blocks inside <article> or <main> count as content, blocks under unmistakable
boilerplate markup as boilerplate, and others don't count. A page's graph has an edge or two per block
and stays inside one task, as the page does.

Defined results: a null page or one without content gives an empty text; broken markup (open tags,
stray ends, lone brackets, cut-off pages) is read as far as it goes; rows that repeat an id are pages
of their own; pages of any length take time in proportion to it; without both kinds of block in the sample, the text speaks neither for nor against;
an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from html import unescape

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talkmeter.llm.common import staged
from talkmeter.llm.optimize import minimise, sigmoid

# Elements and name parts of HTML pages.
BLOCK_TAGS = set(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre "
    "section summary table caption tbody td tfoot th thead tr ul".split()
)
VOID_TAGS = set("area base br col embed hr img input link meta param source track wbr".split())
SILENT_TAGS = set(
    "script style noscript template head title svg math canvas iframe object audio video select "
    "button textarea datalist".split()
)
RAW_TAGS = {"script", "style", "textarea", "title", "iframe"}
BOILERPLATE_TAGS = {"nav", "footer", "aside", "form", "menu", "dialog"}
BOILERPLATE_ROLES = set(
    "navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar "
    "toolbar".split()
)
BOILERPLATE_NAMES = set(
    "ad ads advert advertisement adverts advertising sponsor sponsored promo promotion banner nav "
    "navbar navigation menu breadcrumb breadcrumbs pagination pager sidebar aside footer header masthead "
    "topbar cookie cookies consent gdpr notice popup modal overlay newsletter subscribe subscription signup "
    "login share sharing social related recommended widget comment comments reply replies disqus "
    "respond toolbar search copyright disclaimer skip".split()
)
FOREIGN_NAMES = set("comment comments reply replies respond disqus related recommended".split())
CONTENT_NAMES = set("article articlebody content entry story post main".split())
PLACE_NAMES = set("nav navbar navigation menu sidebar aside footer header banner".split())
LAYOUT_NAMES = set("layout has with no page grid columns container wrapper".split())

START = re.compile(r"<(?:!--|(/?)([a-zA-Z][a-zA-Z0-9:-]*+)|[!?])")
MARK = re.compile(r"[>\"']")
NAMED = re.compile(
    r"(?:^|[\s\"'])(class|id|role|itemprop|hidden|style|aria-hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?",
    re.I,
)
PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
CLOSED_BY_BLOCK = {"p"}
ALIKE = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
         "td": {"td", "th"}, "th": {"td", "th"}}
SCOPES = {"ul", "ol", "table", "dl", "menu"}


@dataclass
class Element:
    tag: str
    state: int  # 1 content, 0 open, -1 boilerplate, -2 boilerplate that no article ends
    silent: bool
    link: bool
    depth: int
    number: int
    parent: "Element | None"
    block: "Element | None" = None  # the nearest block element, itself or above; the root where there is none

    def __post_init__(self) -> None:
        if self.block is None:
            own = self.parent is None or self.tag in BLOCK_TAGS
            self.block = self if own else self.parent.block


@dataclass
class Block:
    text: str
    linked: int
    holder: Element


def entered(parent: Element, tag: str, attributes: str, number: int) -> Element:
    state, silent = parent.state, parent.silent or tag in SILENT_TAGS
    named: dict[str, str] = {}
    if attributes:
        for m in NAMED.finditer(attributes):
            named.setdefault(m[1].lower(), m[2] or m[3] or m[4] or "")
    names: set[str] = set()
    if named:
        silent |= "hidden" in named or named.get("aria-hidden", "").lower() == "true"
        silent |= "display:none" in named.get("style", "").replace(" ", "").lower()
        for key in ("class", "id", "itemprop"):
            if key in named:
                names |= {part.lower() for part in PARTS.findall(named[key])}
                names |= set(named[key].lower().split())
    role = named.get("role", "").lower()
    if names & LAYOUT_NAMES:
        # A frame around the page's parts says which parts there are.
        names -= PLACE_NAMES
    if tag not in ("html", "body"):
        if tag == "main" or role == "main":
            state = 1
        elif tag == "article" or role == "article" or "articlebody" in names:
            if names & FOREIGN_NAMES:
                state = -2
            elif state > -2:
                state = 1
        elif tag in BOILERPLATE_TAGS or role in BOILERPLATE_ROLES or names & FOREIGN_NAMES:
            state = -2
        elif names & BOILERPLATE_NAMES or tag == "header" and state < 1:
            # The title of an article may stand in a header of its own.
            if not (state == 1 and (tag == "header" or tag[0] == "h" or names & CONTENT_NAMES)):
                state = min(state, -1) if state < 1 else -1
        elif state > -2 and names & CONTENT_NAMES and tag in BLOCK_TAGS:
            state = 1
    return Element(tag, state, silent, parent.link or tag == "a", parent.depth + 1, number, parent)


class Tags:
    """The tags, comments and declarations of a page, found in one pass: work is linear in its length."""

    def __init__(self, html: str):
        self.html = html
        self.last_end, self.last_start = html.rfind(">"), html.rfind("<")
        self.ends: dict[int, int] = {}

    def attributes_end(self, at: int) -> int:
        """Where a tag ends whose attributes begin at ``at``: after the first ">" outside quotes, or -1.

        What follows a closing quote doesn't depend on where the tag began, so it is looked up once.
        """
        trail, found = [], -1
        while at not in self.ends:
            trail.append(at)
            m = MARK.search(self.html, at)
            if not m:
                break
            if m[0] == ">":
                found = m.end()
                break
            closing = self.html.find(m[0], m.end())
            if closing < 0:
                break
            at = closing + 1
        else:
            found = self.ends[at]
        self.ends.update(dict.fromkeys(trail, found))
        return found

    def raw_end(self, tag: str, at: int) -> int:
        """The end of an element whose content isn't markup."""
        end = re.compile(rf"</{tag}\b[^>]*>", re.I).search(self.html, at, self.last_end + 1)
        return end.end() if end else len(self.html)

    def next(self, at: int) -> tuple[int, int, str, str, str] | None:
        """(start, end, "/" or "", name, attributes) of the next tag; comments have no name."""
        while m := START.search(self.html, at):
            start, inside = m.span()
            if m[0] == "<!--":
                end = self.html.find("-->", inside)
                return start, len(self.html) if end < 0 else end + 3, "", "", ""
            name = m[2] or ""
            end = self.attributes_end(inside) if name and inside <= self.last_end else -1
            if end < 0 and inside <= self.last_end:  # an open quote: the tag ends at the next ">"
                end = self.html.find(">", inside) + 1
            if end > 0:
                return start, end, m[1] or "", name, self.html[inside : end - 1]
            if start == self.last_start:  # the page is cut off inside a tag
                return start, len(self.html), "", "", ""
            at = inside
        return None


def blocks_of(html: str) -> list[Block]:
    """The page's visible blocks in page order, white space folded, references decoded."""
    here = root = Element("", 0, False, False, 0, 0, None)
    found: list[Block] = []
    pieces: list[str] = []
    linked = number = at = 0
    holder, tags, open_tags = root, Tags(html), Counter()

    def flush() -> None:
        nonlocal pieces, linked
        if pieces:
            text = " ".join(unescape("".join(pieces)).split())
            if text:
                found.append(Block(text, linked, holder))
            pieces = []
        linked = 0

    def say(raw: str) -> None:
        nonlocal linked, holder
        if raw and not here.silent:
            if not pieces:
                holder = here.block
            pieces.append(raw)
            if here.link:
                linked += len(raw)

    def leave(node: Element) -> None:
        """Close an element and all that is open inside it."""
        nonlocal here
        while here is not node.parent:
            open_tags[here.tag] -= 1
            here = here.parent

    while token := tags.next(at):
        start, end, closes, tag, attributes = token
        say(html[at:start])
        at = end
        if not tag:
            continue
        tag = tag.lower()
        if closes:
            if tag in BLOCK_TAGS:
                flush()
            if open_tags[tag]:
                node = here
                while node.tag != tag:
                    node = node.parent
                leave(node)
            continue
        if tag == "br":
            say(" ")
        if tag in BLOCK_TAGS:
            flush()
            node, alike = here.block, ALIKE.get(tag, ())
            while node.parent and node.tag not in SCOPES and (node.tag in CLOSED_BY_BLOCK or node.tag in alike):
                leave(node)
                if node.tag not in CLOSED_BY_BLOCK:
                    break
                node = node.parent.block
        if tag in VOID_TAGS:
            continue
        number += 1
        if attributes.endswith("/") and tag not in BLOCK_TAGS and tag not in SILENT_TAGS:
            continue
        if tag in RAW_TAGS:
            at = tags.raw_end(tag, at)
            continue
        here = entered(here, tag, attributes, number)
        open_tags[tag] += 1
    say(html[at:])
    flush()
    return found


FEATURES = 12
WORDS_END = re.compile(r"[.!?…][\"'”»)]*(?:\s|$)")


def described(blocks: Sequence[Block]) -> np.ndarray:
    rows = []
    for block in blocks:
        text, tag = block.text, block.holder.tag
        size = len(text)
        words = text.count(" ") + 1
        ends = len(WORDS_END.findall(text))
        rows.append((
            1.0, min(np.log1p(words), 6) / 5, min(block.linked / size, 1.0), min(ends / words, 1.0),
            ends > 0, text[-1] in ".!?…\"'”»)", min(size / words, 20) / 10,
            sum(map(str.isdigit, text)) / size, min(text.count(",") / words, 1.0),
            tag == "p", tag[0:1] == "h" and tag[1:].isdigit(), tag in ("li", "td", "th", "dt", "dd"),
        ))
    return np.array(rows, dtype=np.float64).reshape(-1, FEATURES)


def distance(a: Element, b: Element) -> int:
    """Steps between two elements in the document tree."""
    steps = 0
    while a is not b:
        if a.depth < b.depth:
            a, b = b, a
        a = a.parent
        steps += 1
    return steps


def joints(blocks: Sequence[Block], smooth: float) -> list[tuple[int, int, float]]:
    """Edges between neighbours on the page, and between neighbours under one parent."""
    found, latest = {}, {}
    for i, block in enumerate(blocks):
        near = [i - 1] if i else []
        key = (block.holder.parent or block.holder).number
        if key in latest:
            near.append(latest[key])
        latest[key] = i
        for j in near:
            apart = distance(block.holder, blocks[j].holder)
            found[j, i] = max(found.get((j, i), 0.0), smooth / (1 + apart))
    return [(j, i, w) for (j, i), w in found.items()]


def content_side(
    to_source: Sequence[float], to_sink: Sequence[float], edges: Sequence[tuple[int, int, float]]
) -> list[bool]:
    """Which nodes stay with the source in the minimum cut (maximum flow by level graphs).

    What a node can pass straight from source to sink is sent at once; then paths lead from nodes
    with capacity left from the source to nodes with capacity left to the sink. A round numbers the
    nodes by their distance from the first and sends all it can along shortest paths; an arc that leads
    nowhere is tried once a round. Rounds are as many as there are lengths of shortest paths.
    """
    n, tiny = len(to_source), 1e-9
    supply = [a - min(a, b) for a, b in zip(to_source, to_sink)]
    demand = [b - min(a, b) for a, b in zip(to_source, to_sink)]
    arcs: list[list[int]] = [[] for _ in range(n)]
    ends: list[int] = []
    left: list[float] = []  # an edge is two arcs, each other's reverse
    for i, j, w in edges:
        arcs[i].append(len(ends))
        arcs[j].append(len(ends) + 1)
        ends += [j, i]
        left += [w, w]
    while True:
        level = [0 if s > tiny else -1 for s in supply]
        line = [i for i in range(n) if level[i] == 0]
        reached = False
        for i in line:
            reached |= demand[i] > tiny
            for arc in arcs[i]:
                j = ends[arc]
                if level[j] < 0 and left[arc] > tiny:
                    level[j] = level[i] + 1
                    line.append(j)
        if not reached:
            return [distance >= 0 for distance in level]
        tried = [0] * n
        for first in range(n):
            path, i = [], first
            while supply[first] > tiny:
                if demand[i] > tiny:
                    flow = min([supply[first], demand[i], *[left[arc] for arc in path]])
                    supply[first] -= flow
                    demand[i] -= flow
                    for arc in path:
                        left[arc] -= flow
                        left[arc ^ 1] += flow
                    path, i = [], first
                    continue
                mine = arcs[i]
                while tried[i] < len(mine) and not (
                    left[mine[tried[i]]] > tiny and level[ends[mine[tried[i]]]] == level[i] + 1
                ):
                    tried[i] += 1
                if tried[i] < len(mine):
                    path.append(mine[tried[i]])
                    i = ends[path[-1]]
                elif path:
                    i = ends[path.pop() ^ 1]
                    tried[i] += 1
                else:
                    break


@dataclass
class Extractor:
    """Classifier weights, log-odds of the markup's states, and strength of the joints."""

    weights: np.ndarray
    certain: float = 9.0
    likely: float = 4.0
    smooth: float = 2.0

    def chosen(self, blocks: Sequence[Block]) -> list[bool]:
        if not blocks:
            return []
        odds = np.clip(described(blocks) @ self.weights, -3.0, 3.0)
        markup = {1: self.likely, 0: 0.0, -1: -self.certain, -2: -self.certain}
        odds += [markup[b.holder.state] for b in blocks]
        cost_if_left = np.logaddexp(0, odds)  # -log of the probability of boilerplate
        cost_if_kept = np.logaddexp(0, -odds)
        return content_side(cost_if_left.tolist(), cost_if_kept.tolist(), joints(blocks, self.smooth))

    def text(self, html: str | None) -> str:
        blocks = blocks_of(html or "")
        return "\n".join(b.text for b, keep in zip(blocks, self.chosen(blocks)) if keep)


def train(pages: DataFrame, sample: int = 600, penalty: float = 1.0) -> Extractor:
    marked = pages.filter("html is not null").select(
        F.xxhash64("page_id", "html").alias("mark"), "html"
    )
    # First the marks, then the pages of those, each once: no task sees more pages than its own.
    picked = marked.select("mark").distinct().orderBy("mark").limit(sample)
    some = staged(
        marked.join(F.broadcast(picked), "mark", "left_semi").dropDuplicates(["mark"]),
        "page-sample",
    )

    def featured(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for mark, html in zip(batch["mark"], batch["html"]):
                blocks = [b for b in blocks_of(html) if b.holder.state]
                if not blocks:
                    continue
                yield pd.DataFrame({
                    "mark": mark, "x": [row.tobytes() for row in described(blocks)],
                    "content": [int(b.holder.state > 0) for b in blocks],
                })

    # A block's features are a dozen numbers; pages of the sample are bounded, their blocks are folded
    # and all of them count.
    found = (
        some.mapInPandas(featured, "mark long, x binary, content int")
        .groupBy("x", "content").agg(F.count("*").alias("n"))
        .orderBy("content", "x").toPandas()
    )
    if found["content"].nunique() < 2:
        return Extractor(np.zeros(FEATURES))
    x = np.frombuffer(b"".join(found["x"]), dtype=np.float64).reshape(-1, FEATURES)
    y, n = found["content"].to_numpy(dtype=np.float64), found["n"].to_numpy(dtype=np.float64)
    # Both kinds of block weigh the same, whatever the sites' share of boilerplate.
    n *= np.where(y > 0, 0.5 / n[y > 0].sum(), 0.5 / n[y == 0].sum()) * n.sum()

    def cost(w: np.ndarray) -> tuple[float, np.ndarray]:
        score = x @ w
        loss = (n * np.logaddexp(0, score)).sum() - (n * y) @ score
        return loss + penalty / 2 * w @ w, x.T @ (n * (sigmoid(score) - y)) + penalty * w

    return Extractor(minimise(cost, np.zeros(FEATURES)))


def extracted(pages: DataFrame, **options) -> DataFrame:
    """(page_id, url, text, n_chars) for every row."""
    extractor = train(pages, **options)

    def visit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = batch[["page_id", "url"]].copy()
            out["page_id"] = out["page_id"].astype("Int64")
            out["text"] = [extractor.text(html) for html in batch["html"]]
            out["n_chars"] = out["text"].map(len).astype("int64")
            yield out

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    return rows.mapInPandas(visit, "page_id long, url string, text string, n_chars long")
