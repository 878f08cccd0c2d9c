"""op8: main text of web pages by minimum-cut labelling.

A page becomes its text blocks in page order (runs of text between block-level tags). A
classifier turns each block into the cost of calling it boilerplate or content: a logistic
model of the text alone (length, links, punctuation, place), fitted on blocks whose page
marks them clearly, plus fixed evidence from the enclosing elements (landmark tags, roles,
class and id words; names of two meanings are none). The costs are the terminal capacities of a graph whose edges tie
neighbouring blocks and blocks of one container (weaker the farther apart they lie in the
tree). The minimum cut, found by maximum flow, is the cheapest labelling.

Text: character references decoded, white space inside a block made one space, blocks
joined by an empty line; nothing is dropped for its length.

Defined results for odd input: null or empty html gives empty text; unclosed or stray tags
close as a browser would for the common cases; a tag cut off by the end of the page is
dropped; without landmark pages to learn from, the classifier uses ``DEFAULT_WEIGHTS``.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter, deque

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarmac.llm.common import bounded_batches, table

# Element and attribute words with a known role.
BLOCK_TAGS = frozenset("""html body head address article aside blockquote button center dd details dialog
    dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr legend li
    main menu nav ol optgroup option p pre search section select summary table tbody td tfoot th thead tr ul
    caption iframe object video audio canvas""".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta source track wbr".split())
SKIPPED_TAGS = frozenset("script style template noscript textarea title svg math iframe object".split())
CONTENT_TAGS = frozenset(["article", "main"])
BOILERPLATE_TAGS = frozenset("nav footer aside form button select menu dialog search fieldset".split())
CONTENT_WORDS = frozenset("article content main post entry story body text prose".split())
BOILERPLATE_WORDS = frozenset("""ad ads advert adverts advertisement advertising adsense banner banners promo
    promotion sponsor sponsored sponsors cookie cookies consent gdpr notice notices alert alerts popup modal
    overlay newsletter subscribe subscription signup share sharing social related recommended recommendations
    sidebar aside widget widgets menu menus nav navbar navigation breadcrumb breadcrumbs pagination pager footer
    copyright legal disclaimer header masthead topbar toolbar comment comments commentlist reply replies respond
    disqus discussion login search rail skip""".split())
# A name that ends in one of these may be about what another of its words says ("rail-story"),
# unless that word is one of FIRM_WORDS: then neither is evidence.
STORY_WORDS = frozenset("article post entry story".split())
FIRM_WORDS = frozenset("""ad ads advert adverts advertisement advertising adsense promo promotion sponsor sponsored
    sponsors comment comments commentlist reply replies respond disqus related recommended recommendations share
    sharing cookie cookies consent gdpr""".split())
BOILERPLATE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert menu menubar".split())
HEADINGS = frozenset(["h1", "h2", "h3", "h4", "h5", "h6"])
# A start tag that closes an open paragraph, and elements that close their own kind.
CLOSES_P = BLOCK_TAGS - {"html", "body", "head", "option", "optgroup", "button"}
CLOSES_SAME = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"),
               "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
CLOSE_LIMITS = frozenset(["ul", "ol", "dl", "table", "article", "section", "div", "select", "nav", "body"])

TOKEN = re.compile(r"<!--(?:.*?-->|.*\Z)|<([/!?]?)([a-zA-Z\[][^\s/<>]*+)((?:[^<>\"']++|\"[^\"<]*+\"|'[^'<]*+'|[\"'])*+)>",
                   re.S)
ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|aria-hidden|style)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
CUT_TAG = re.compile(r"<[a-zA-Z/!][^<>]*\Z")

LANDMARK = 6.0       # log-odds of an enclosing element's evidence
TEXT_LIMIT = 2.5     # the text model's say is at most this
ADJACENT, SIBLING = 1.0, 0.5  # smoothness capacities
TRAIN_PAGES = 300    # the text model is fitted on so many marked pages (smallest hash of the id)
DEFAULT_WEIGHTS = np.array([-2.0, 1.0, -4.0, 1.0, 0.3, -0.5, 0.0])


class Block:
    __slots__ = ("text", "links", "heading", "item", "side", "parent", "depth")

    def __init__(self, text, links, heading, item, side, parent, depth):
        self.text, self.links, self.heading, self.item = text, links, heading, item
        self.side, self.parent, self.depth = side, parent, depth


def _evidence(tag: str, attrs: str, side: int) -> int:
    """Evidence inside an element: 1 content, -1 boilerplate, 0 none. Boilerplate stays
    boilerplate further inside; a header inside an article is left to its blocks."""
    if side < 0:
        return side
    if tag in BOILERPLATE_TAGS or (tag == "header" and side == 0):
        return -1
    words: set[str] = set()
    doubtful = False
    if attrs:
        for name, a, b, c in ATTRIBUTE.findall(attrs):
            name, value = name.lower(), (a or b or c).lower()
            if name in ("class", "id"):
                for whole in value.split():
                    parts = re.findall(r"[a-z0-9]+", whole)
                    if parts and parts[-1] in STORY_WORDS and BOILERPLATE_WORDS.intersection(
                            parts) and not FIRM_WORDS.intersection(parts):
                        doubtful = True
                    else:
                        words.update(parts)
            elif name == "role" and value in BOILERPLATE_ROLES or name == "hidden" or (
                    name == "aria-hidden" and value == "true") or (
                    name == "style" and re.search(r"display\s*:\s*none", value)):
                return -1
            elif name == "role" and value in ("main", "article"):
                side = 1
    if words & BOILERPLATE_WORDS and tag not in ("html", "body") and tag not in CONTENT_TAGS | HEADINGS:
        return -1
    if words & {"comment", "comments", "reply"} and tag == "article":
        return -1
    if doubtful and tag not in CONTENT_TAGS:
        return 0  # left to the text and the cut
    if tag in CONTENT_TAGS or (words & CONTENT_WORDS and tag in ("div", "section", "td")):
        return 1
    return side


def blocks(page: str) -> list[Block]:
    """Text blocks of a page in page order."""
    out: list[Block] = []
    parts: list[str] = []
    state = {"links": 0, "open_links": 0}
    # Open block-level elements: (tag, evidence, container number).
    stack: list[tuple[str, int, int]] = [("", 0, 0)]
    opened: Counter = Counter()
    numbered = 0

    def flush() -> None:
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                tag, side, me = stack[-1]
                parent = stack[-2][2] if len(stack) > 1 else 0
                out.append(Block(text, min(1.0, state["links"] / max(1, len(text))), tag in HEADINGS,
                                 opened["li"] > 0, side, parent if tag in HEADINGS or tag == "p" else me,
                                 len(stack)))
            parts.clear()
        state["links"] = 0

    def close(tag: str) -> None:
        while True:
            top = stack.pop()[0]
            opened[top] -= 1
            if top == tag:
                return

    def say(raw: str) -> None:
        if raw:
            text = entities.unescape(raw) if "&" in raw else raw
            parts.append(text)
            if state["open_links"]:
                state["links"] += len(text.strip())

    at, end = 0, len(page)
    # Looked for from the end of the last one: what a skipped element holds opens nothing.
    while m := TOKEN.search(page, at):
        say(page[at:m.start()])
        at = m.end()
        kind, tag = m.group(1), (m.group(2) or "").lower()
        if not tag or kind in ("!", "?") and kind:
            continue
        if tag in SKIPPED_TAGS:
            if not kind and not m.group(3).endswith("/"):
                ends = re.compile(f"</{tag}[\\s/>]", re.I).search(page, at)
                if tag in BLOCK_TAGS:
                    flush()
                if not ends:
                    at = end
                    break
                stop = page.find(">", ends.start())
                at = stop + 1 if stop >= 0 else end
            continue
        if tag not in BLOCK_TAGS:
            if tag == "br":
                parts.append(" ")
            elif tag == "a":
                state["open_links"] = 0 if kind else 1
            continue
        flush()
        if kind:
            state["open_links"] = 0
            if opened[tag] > 0:
                close(tag)
            continue
        if tag in VOID_TAGS:
            continue
        if tag in CLOSES_P and stack[-1][0] == "p":
            close("p")
        for other in CLOSES_SAME.get(tag, ()):
            if not opened[other]:
                continue
            for name, _, _ in reversed(stack):
                if name == other:
                    close(other)
                    break
                if name in CLOSE_LIMITS:
                    break
        numbered += 1
        stack.append((tag, _evidence(tag, m.group(3), stack[-1][1]), numbered))
        opened[tag] += 1
    if at < end:
        rest = page[at:]
        cut = CUT_TAG.search(rest)
        say(rest[:cut.start()] if cut else rest)
    flush()
    return out


def features(found: list[Block]) -> np.ndarray:
    """Of the text alone: constant, length, links, sentence end, heading, list item, place."""
    n = len(found)
    return np.array([[1.0, np.log1p(b.text.count(" ") + 1), b.links, b.text[-1] in ".!?:\"”»。",
                      b.heading, b.item, abs(k / max(1, n - 1) - 0.5)]
                     for k, b in enumerate(found)]).reshape(n, len(DEFAULT_WEIGHTS))


def fit(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights of a ridge-penalised logistic model, both classes weighing the same."""
    if not len(y) or y.min() == y.max():
        return DEFAULT_WEIGHTS
    weight = np.where(y > 0, 0.5 / y.mean(), 0.5 / (1 - y.mean()))
    w = np.zeros(x.shape[1])
    for _ in range(25):  # Newton steps
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (weight * p * (1 - p))[:, None]).T @ x + np.eye(len(w))
        w = w + np.linalg.solve(h, x.T @ (weight * (y - p)) - w)
    return w


def _dinic(n: int, head: list[int], cap: list[int], adj: list[list[int]], s: int, t: int) -> list[bool]:
    """Maximum flow from s to t; which nodes the source still reaches. Edge 2k and 2k+1
    are each other's reverse."""
    while True:
        level = [-1] * n
        level[s] = 0
        queue = deque([s])
        while queue:
            u = queue.popleft()
            for e in adj[u]:
                if cap[e] and level[head[e]] < 0:
                    level[head[e]] = level[u] + 1
                    queue.append(head[e])
        if level[t] < 0:
            return [x >= 0 for x in level]
        nxt = [0] * n
        path: list[int] = []
        u = s
        while True:
            if u == t:
                push = min(cap[e] for e in path)
                for e in path:
                    cap[e] -= push
                    cap[e ^ 1] += push
                k = next(i for i, e in enumerate(path) if not cap[e])
                u = head[path[k] ^ 1]
                del path[k:]
                continue
            edges = adj[u]
            while nxt[u] < len(edges):
                e = edges[nxt[u]]
                if cap[e] and level[head[e]] == level[u] + 1:
                    break
                nxt[u] += 1
            if nxt[u] < len(edges):
                path.append(edges[nxt[u]])
                u = head[path[-1]]
            elif path:
                e = path.pop()
                u = head[e ^ 1]
                nxt[u] += 1
            else:
                break


SCALE = 1 << 16  # capacities are whole numbers


def minimum_cut(score: list[float], ties: list[tuple[int, int, float]]) -> list[bool]:
    """Which nodes are on the source's (content) side of the minimum cut: terminal
    capacities are the positive and negative scores, ties the edges between nodes.

    A node whose terminal outweighs all its ties is on that side in every minimum cut; it
    is folded into the terminal first, and maximum flow decides the nodes that are left.
    """
    n = len(score)
    own = [round(x * SCALE) for x in score]
    near: list[list[tuple[int, int]]] = [[] for _ in range(n)]
    for a, b, w in ties:
        w = round(w * SCALE)
        near[a].append((b, w))
        near[b].append((a, w))
    load = [sum(w for _, w in ns) for ns in near]
    side: list[bool | None] = [None] * n
    queue = deque(i for i in range(n) if abs(own[i]) > load[i])
    while queue:
        i = queue.popleft()
        if side[i] is not None:
            continue
        side[i] = own[i] > 0
        for j, w in near[i]:
            if side[j] is None:
                own[j] += w if side[i] else -w
                load[j] -= w
                if abs(own[j]) > load[j]:
                    queue.append(j)
    left = [i for i in range(n) if side[i] is None]
    if left:
        place = {i: k for k, i in enumerate(left)}
        s, t = len(left), len(left) + 1
        head, cap, adj = [], [], [[] for _ in range(len(left) + 2)]

        def edge(a: int, b: int, there: int, back: int) -> None:
            adj[a].append(len(head))
            head.append(b)
            cap.append(there)
            adj[b].append(len(head))
            head.append(a)
            cap.append(back)

        for i in left:
            if own[i] > 0:
                edge(s, place[i], own[i], 0)
            elif own[i] < 0:
                edge(place[i], t, -own[i], 0)
            for j, w in near[i]:
                if j > i and side[j] is None:
                    edge(place[i], place[j], w, w)
        reach = _dinic(len(left) + 2, head, cap, adj, s, t)
        for i in left:
            side[i] = reach[place[i]]
    return side


def smoothness(found: list[Block]) -> list[tuple[int, int, float]]:
    """Edges between neighbours, and between a container's blocks in a row."""
    ties = [(k, k + 1, ADJACENT / (1 + abs(a.depth - b.depth) + (a.parent != b.parent)))
            for k, (a, b) in enumerate(zip(found, found[1:]))]
    last: dict[int, int] = {}
    for k, b in enumerate(found):
        if b.parent in last:
            ties.append((last[b.parent], k, SIBLING))
        last[b.parent] = k
    return ties


def main_text(page: str | None, weights: np.ndarray) -> str:
    found = blocks(page or "")
    if not found:
        return ""
    text = np.clip(features(found) @ weights, -TEXT_LIMIT, TEXT_LIMIT)
    score = [LANDMARK * b.side + float(x) for b, x in zip(found, text)]
    keep = minimum_cut(score, smoothness(found))
    return "\n\n".join(b.text for b, k in zip(found, keep) if k)


_ROWS = T.ArrayType(T.ArrayType(T.DoubleType()))


@F.arrow_udf(_ROWS)
def _labelled(page: pa.Array) -> pa.Array:
    """Per block with clear evidence: label, then features."""
    out = []
    for p in page.to_pylist():
        found = blocks(p or "")
        x = features(found)
        out.append([[float(b.side > 0), *x[k].tolist()] for k, b in enumerate(found) if b.side])
    return pa.array(out, pa.list_(pa.list_(pa.float64())))


def _marked(html: Column) -> Column:
    """Whether a page holds an element that may be evidence, as a built-in test."""
    tags = "|".join(sorted(CONTENT_TAGS | BOILERPLATE_TAGS | {"header"}))
    words = "|".join(sorted(CONTENT_WORDS | BOILERPLATE_WORDS | BOILERPLATE_ROLES))
    return F.regexp_like(html, F.lit(rf"(?i)<(?:{tags})[\s/>]")) | F.regexp_like(html, F.lit(
        rf"(?i)\s(?:class|id|role)\s*=[^<>]*?(?<![a-z0-9])(?:{words})(?![a-z0-9])|<[^<>]*\shidden\b"))


def train(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> np.ndarray:
    """The text model's weights from a bounded sample of the pages that hold evidence."""
    named = bounded_batches(pages).select(F.xxhash64(F.col(id_col).cast("string")).alias("h"),
                                          F.col(html_col).cast("string").alias("html")).filter(_marked(F.col("html")))
    # The hashes alone decide which of them are cut into blocks.
    last = named.select("h").orderBy("h").limit(TRAIN_PAGES).agg(F.max("h")).first()[0]
    sample = (named.filter(F.col("h") <= F.lit(last)).select("h", _labelled("html").alias("rows"))
              .orderBy("h", F.hash("rows")).limit(TRAIN_PAGES).collect())
    rows = np.array([r for s in sample for r in s.rows]).reshape(-1, 1 + len(DEFAULT_WEIGHTS))
    return fit(rows[:, 1:], rows[:, 0])


def with_main_text(pages: DataFrame, weights: np.ndarray, out: str, html_col: str = "html") -> DataFrame:
    """``pages`` plus the main text as a string column."""
    @F.arrow_udf("string")
    def extract(page: pa.Array) -> pa.Array:
        return pa.array([main_text(p.as_py(), weights) for p in page], pa.string())

    return bounded_batches(pages).withColumn(out, extract(F.col(html_col).cast("string")))


def extracted(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
              html_col: str = "html") -> DataFrame:
    """Per page row: (page_id, url, text, n_chars)."""
    narrow = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"),
                          F.col(html_col).alias("html"))
    text = with_main_text(narrow, train(narrow, "page_id", "html"), "text", "html")
    return text.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extracted(table(spark, sf_dir, "pages"))
