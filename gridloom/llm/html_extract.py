"""Main text of web pages by a tree-structured graphical model over the page's elements.

Each element that holds text, or holds such elements, is a node with two states: content or not. A node's potential comes
from its tag, the words of its class, id and role, its share of link text, its length and its place; a potential between
parent and child says how often content passes on, by the kind of parent. Messages go up from the leaves and down from the
root (sum-product), which gives each node's exact marginal; text of nodes with a content marginal over 1/2 is kept.

Potentials are counted on a bounded sample of pages that label themselves: those with an article or main element, whose
markup names the parts (menus, headers, footers, asides, forms, adverts, notices, comments).

Cases: null and empty pages give an empty text; pages without markup are one content block; unclosed, stray and wrongly
nested tags, unclosed comments, scripts and styles are read as browsers do, roughly; repeated rows each have their text;
with no page to learn from, fixed potentials stand in; other columns than id, url and html are not read.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import slices

#: Pages that the potentials are learned from, at most.
PAGES = 400
SKIPPED = frozenset(("script", "style", "noscript", "template", "iframe", "object", "svg", "select", "button", "textarea", "head", "title", "canvas", "audio", "video"))
RAW = frozenset(("script", "style", "textarea", "title", "noscript", "iframe", "template"))
VOID = frozenset(("br", "hr", "img", "input", "link", "meta", "area", "base", "col", "embed", "source", "track", "wbr", "param"))
INLINE = frozenset(("a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd", "label", "mark", "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr", "img"))
#: Elements that a start tag of one of these closes if they are open in the same container.
CLOSES = {t: frozenset(("p",)) for t in ("p", "div", "ul", "ol", "dl", "table", "h1", "h2", "h3", "h4", "h5", "h6", "article", "section", "aside", "nav", "header", "footer", "form", "blockquote", "pre", "figure", "address", "main", "hr", "fieldset", "details")} | {"li": frozenset(("li", "p")), "dt": frozenset(("dt", "dd", "p")), "dd": frozenset(("dt", "dd", "p")), "tr": frozenset(("tr", "td", "th", "p")), "td": frozenset(("td", "th", "p")), "th": frozenset(("td", "th", "p")), "option": frozenset(("option",))}
BOILER_TAGS = frozenset(("nav", "header", "footer", "aside", "form", "dialog", "menu"))
BOILER_WORDS = frozenset(("ad", "ads", "advert", "adverts", "advertisement", "sponsor", "sponsored", "promo", "banner", "sidebar", "menu", "nav", "navbar", "navigation", "breadcrumb", "breadcrumbs", "cookie", "cookies", "consent", "notice", "comment", "comments", "reply", "replies", "footer", "header", "masthead", "related", "share", "sharing", "social", "subscribe", "newsletter", "popup", "modal", "login", "search", "widget", "complementary", "contentinfo"))
CONTENT_TAGS = frozenset(("article", "main"))
TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)", re.S)
NAMED = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
WORDS = re.compile(r"[a-z]+")
#: White space between words of a block, no-break spaces included.
BLANKS = re.compile(r"\s+")


class Node:
    __slots__ = ("blocks", "depth", "inner", "kind", "link", "names", "parent", "tag", "text")

    def __init__(self, tag: str, names: frozenset, parent: int, depth: int):
        self.tag, self.names, self.parent, self.depth = tag, names, parent, depth
        self.text = self.link = 0  # characters below, and those in links
        self.inner: list[int] = []
        self.blocks: list[int] = []


def parse(page: str) -> tuple[list[Node], list[tuple[int, str]]]:
    """Nodes, parents first, and blocks of text in order, each with the node that holds it."""
    nodes, blocks = [Node("html", frozenset(), -1, 0)], []
    stack: list[tuple[str, int]] = [("html", 0)]  # inline elements have their container's node
    pieces: list[str] = []
    links = skipped = linked = 0

    def flush():
        nonlocal linked
        if pieces:
            text = BLANKS.sub(" ", html.unescape("".join(pieces))).strip()
            if text:
                node = nodes[stack[-1][1]]
                node.blocks.append(len(blocks))
                node.text += len(text)
                node.link += min(linked, len(text))
                blocks.append((stack[-1][1], text))
            pieces.clear()
        linked = 0

    at, raw = 0, None
    while at < len(page):
        if raw:
            end = re.compile(rf"</{raw}\b[^>]*>?", re.I).search(page, at)
            if raw not in SKIPPED:
                pieces.append(page[at : end.start() if end else len(page)])
            at, raw = (end.start() if end else len(page)), None
            continue
        token = TOKEN.search(page, at)
        stop = token.start() if token else len(page)
        if stop > at and not skipped:
            pieces.append(page[at:stop])
            if links:
                linked += stop - at
        if not token:
            break
        at = token.end()
        if not token[2]:
            continue
        tag = token[2].lower()
        if token[1]:
            places = [i for i, (t, _) in enumerate(stack) if t == tag and i]
            if not places:
                if tag in ("p", "br"):
                    flush()
                continue
            if tag not in INLINE:
                flush()
            elif any(t not in INLINE for t, _ in stack[places[-1] + 1 :]):
                continue  # a late end of an inline element does not close blocks
            for t, _ in stack[places[-1] :]:
                skipped -= t in SKIPPED
                links -= t == "a"
            del stack[places[-1] :]
            continue
        if tag in VOID:
            if tag in ("br", "hr"):
                pieces.append("\n") if tag == "br" else flush()
            continue
        if tag not in INLINE:
            flush()
            closes = CLOSES.get(tag, frozenset())
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] in closes:
                    for t, _ in stack[i:]:
                        links -= t == "a"
                        skipped -= t in SKIPPED
                    del stack[i:]
                elif stack[i][0] not in INLINE and stack[i][0] != "p":
                    break
        if token[3].rstrip().endswith("/") and tag in ("svg", "path"):
            continue
        names = frozenset(w for m in NAMED.finditer(token[3]) for w in WORDS.findall((m[1] or m[2] or m[3] or "").lower())) if "=" in token[3] else frozenset()
        place = stack[-1][1]
        if tag not in INLINE and tag not in SKIPPED:
            nodes.append(Node(tag, names, place, nodes[place].depth + 1))
            nodes[place].inner.append(len(nodes) - 1)
            place = len(nodes) - 1
        stack.append((tag, place))
        skipped += tag in SKIPPED
        links += tag == "a"
        if tag in RAW:
            raw = tag
    flush()
    for i in range(len(nodes) - 1, 0, -1):
        parent = nodes[nodes[i].parent]
        parent.text += nodes[i].text
        parent.link += nodes[i].link
    return nodes, blocks


def features(node: Node, place: float) -> list[str]:
    """Names of what a node shows of itself."""
    share = node.link / node.text if node.text else 0.0
    size = min(7, node.text.bit_length() // 2)
    out = [f"tag {node.tag}", f"size {size}", f"links {min(3, int(4 * share))}", f"place {int(3.999 * place)}"]
    return out + [f"name {w}" for w in node.names] + ["named like an extra"] * bool(node.names & BOILER_WORDS)


def kind(node: Node) -> str:
    """Of a parent, for the potential towards its children: as far as extras nest in it."""
    return "content" if node.tag in CONTENT_TAGS else "extra" if node.tag in BOILER_TAGS or node.names & BOILER_WORDS else "root" if node.tag in ("html", "body") else "other"


def own_labels(nodes: list[Node]) -> list[int | None] | None:
    """What a page's markup says of its nodes: 1 content, 0 extra, None above both; None for pages that say nothing."""
    if not any(n.tag in CONTENT_TAGS for n in nodes):
        return None
    out: list[int | None] = []
    above = {n.parent for n in nodes if n.tag in CONTENT_TAGS}
    for i in range(len(nodes) - 1, -1, -1):
        if i in above and nodes[i].parent >= 0:
            above.add(nodes[i].parent)
    for i, node in enumerate(nodes):
        inside = out[node.parent] if node.parent >= 0 else None
        extra = node.tag in BOILER_TAGS or bool(node.names & BOILER_WORDS)
        out.append(0 if extra or inside == 0 else 1 if node.tag in CONTENT_TAGS or inside == 1 else None if i in above else 0)
    return out


#: Potentials if there is nothing to learn from: log odds of content by feature; log of the chance to keep a parent's state.
FIXED = {"node": {"tag article": 3.0, "tag main": 3.0, "tag p": 1.0, "named like an extra": -4.0, "links 3": -2.0, **{f"tag {t}": -4.0 for t in BOILER_TAGS}}, "edge": {"content": (0.97, 0.5), "extra": (0.5, 0.99), "root": (0.6, 0.6), "other": (0.95, 0.95)}, "root": 0.0}


def fit(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> dict:
    """Log odds of features, and for each kind of parent how likely a child keeps the state 1 and the state 0."""
    n = pages.count()
    share = 1e6 * min(1.0, 0.9 * PAGES / max(n, 1))
    drawn = pages.filter(F.pmod(F.xxhash64(id_col), F.lit(1_000_000)) < share).select(F.coalesce(html_col, F.lit("")).alias("html"))
    kinds = pa.schema([("name", pa.string()), ("n", pa.int64())])

    def run(batches):
        seen: Counter = Counter()
        for batch in batches:
            for page in batch.column(0).to_pylist():
                nodes, _ = parse(page)
                if (labels := own_labels(nodes)) is None:
                    continue
                for i, (node, label) in enumerate(zip(nodes, labels, strict=True)):
                    if label is None or not node.text:
                        continue
                    seen.update(f"{label} {f}" for f in features(node, i / len(nodes)))
                    seen[f"{label}"] += 1
                    if node.parent >= 0 and (above := labels[node.parent]) is not None:
                        seen[f"{above}{label} edge {kind(nodes[node.parent])}"] += 1
        yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], schema=kinds)

    # Names of features on PAGES pages: bounded by the sample.
    seen = Counter(dict(map(tuple, drawn.mapInArrow(run, "name string, n bigint").groupBy("name").agg(F.sum("n")).collect())))
    if not seen["0"] or not seen["1"]:
        return FIXED
    names = {k[2:] for k in seen if k[:2] in ("0 ", "1 ")}
    odds = {f: float(np.clip(np.log((seen[f"1 {f}"] + 0.5) / (seen["1"] + 1)) - np.log((seen[f"0 {f}"] + 0.5) / (seen["0"] + 1)), -4, 4)) for f in names}
    # What the sample does not show keeps its fixed potential; what it shows in a way that contradicts markup is bounded.
    node = FIXED["node"] | odds | {k: min(v, odds.get(k, v)) for k, v in FIXED["node"].items() if v <= -4} | {k: max(v, odds.get(k, v)) for k, v in FIXED["node"].items() if v >= 3}
    edge = {}
    for k, (keep1, keep0) in FIXED["edge"].items():
        n11, n10, n01, n00 = (seen[f"{x} edge {k}"] for x in ("11", "10", "01", "00"))
        edge[k] = ((n11 + 20 * keep1) / (n11 + n10 + 20), (n00 + 20 * keep0) / (n00 + n01 + 20))
    return {"node": node, "edge": edge, "root": 0.0}


def marginals(nodes: list[Node], model: dict) -> list[float]:
    """Content marginals, by messages up and then down the tree. Of two states, each potential and message is its odds."""
    weigh, n = model["node"].get, len(nodes)
    up, message, keep = [math.exp(model["root"])], [1.0] * n, [model["edge"][kind(node)] for node in nodes]
    for i in range(1, n):
        # Named features decide; sizes, links and places count half.
        x = sum(weigh(f, 0.0) * (1.0 if f[0] in "tn" else 0.5) for f in features(nodes[i], i / n))
        up.append(math.exp(min(12.0, max(-12.0, x))))
    for i in range(n - 1, 0, -1):
        # Children without text tell nothing.
        if nodes[i].text:
            parent = nodes[i].parent
            keep1, keep0 = keep[parent]
            message[i] = (keep1 * up[i] + 1 - keep1) / ((1 - keep0) * up[i] + keep0)
            up[parent] = min(1e30, max(1e-30, up[parent] * message[i]))
    belief = up
    for i in range(1, n):
        keep1, keep0 = keep[nodes[i].parent]
        rest = belief[nodes[i].parent] / message[i]
        belief[i] = min(1e30, max(1e-30, up[i] * (rest * keep1 + 1 - keep0) / (rest * (1 - keep1) + keep0)))
    return [b / (1 + b) for b in belief]


def main_text(page: str, model: dict) -> str:
    nodes, blocks = parse(page)
    if not blocks:
        return ""
    if len(nodes) == 1:
        return "\n".join(text for _, text in blocks)
    content = marginals(nodes, model)
    return "\n".join(text for node, text in blocks if content[node] > 0.5)


def extract(pages: DataFrame, model: dict, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text, n_chars."""
    kinds = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])

    def run(batches):
        for batch in batches:
            for some in slices(batch, "html"):
                texts = [main_text(page, model) for page in some.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays([some.column(0), some.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], schema=kinds)

    rows = pages.select(F.col(id_col).cast("bigint").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.coalesce(F.col(html_col), F.lit("")).alias("html"))
    return rows.mapInArrow(run, "page_id bigint, url string, text string, n_chars bigint")
