"""Main text of web pages by minimum-cut labelling.

A page is read into text blocks. A logistic classifier on a block's text (its
length, links, punctuation, kind) and the roles that its elements announce
(tag names, ``class``, ``id``, ``role``) give the cost of calling it content
and of calling it boilerplate; they are the capacities of its edges to the two
terminals. Neighbouring blocks, and consecutive blocks of one parent element,
are joined by smoothness edges whose capacity follows their proximity in the
element tree. A maximum flow finds the cheapest labelling: a short line inside
an article goes with its surroundings, a long advert between menus does not.

Words that also name the subjects of articles (``legal``, ``search``) say
little below a content element: there they weigh less than the classifier can,
and the ``id`` of a heading or paragraph, or of a section unless it names
comments or adverts, is an anchor and no role.

The classifier is fitted on blocks of at most ``TRAIN_PAGES`` different pages,
those of the smallest hashes, whose roles are plain; it starts from, and is
pulled towards, ``PRIOR``, which is used as it is where no such blocks exist.
Every page is labelled on its whole source, in time linear in it but for the
maximum flow.

Cases: null or empty html gives the empty text; broken markup (open elements,
cut-off tags, stray ends) is read as browsers do in outline; nothing is
dropped for its length; repeated rows are extracted each for itself; other
columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from html import unescape

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ingot.llm.common import distinct_sample

TRAIN_PAGES = 400
ADJACENT, SIBLING = 0.9, 0.7          # smoothness of neighbours and of consecutive blocks of one parent
ROLE_COST, ARTICLE_COST = 9.0, 5.0    # what a plain boilerplate or content role weighs
DOUBT_COST = 3.0                      # what a doubtful word weighs below a content element

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"'=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+|[\"'])*+)(?:>|\Z)", re.S)
_ATTR = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""")
_RAW = frozenset("script style textarea title iframe xmp noembed noframes".split())
_RAW_END = {t: re.compile(rf"</{t}\b[^>]*>?", re.I) for t in _RAW}
_DROPPED = _RAW | frozenset("head noscript template svg annotation annotation-xml object canvas select button audio video map datalist "
                            "dialog".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q ruby rb rt "
                    "s samp small span strike strong sub sup time tt u var wbr img "
                    "math semantics mrow mi mn mo mtext mspace ms mfrac msqrt mroot mstyle mpadded mphantom msub msup "
                    "msubsup munder mover munderover mmultiscripts".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# an element that a following start tag closes
_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
           "th": {"td", "th"}, "option": {"option"}, "body": {"head"}}
_SCOPE = frozenset("ul ol dl table tr article section main div body".split())

# ---- roles that elements announce -------------------------------------------

_NEGATIVE_TAGS = frozenset("nav aside footer menu".split())
_POSITIVE_TAGS = frozenset("article main".split())
_NEGATIVE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu "
                            "menubar toolbar".split())
_NEGATIVE_WORDS = frozenset("ad ads adv dfp outbrain taboola menu nav topnav topbar masthead header head footer foot "
                            "colophon sidebar rail disqus reply replies respond discussion consent gdpr notice alert "
                            "popup modal overlay signup login share sharing social related popular trending widget "
                            "toolbar pager pagination copyright legal search searchbox form skip tags byline toc "
                            "imprint".split())
_NEGATIVE_STARTS = ("advert", "sponsor", "promo", "banner", "sidebar", "navig", "navbar", "breadcrumb", "footer",
                    "comment", "cookie", "newsletter", "subscri", "recommend", "masthead")
# of these, the ones that articles also write about
_DOUBTFUL = frozenset("menu head rail reply replies respond discussion consent notice alert widget share sharing social "
                      "popular related trending copyright legal search form skip tags imprint signup login".split())
# what an anchor of a section of an article must begin with to be a role
_ANCHOR_STARTS = ("advert", "sponsor", "comment", "cookie", "newsletter", "subscri", "disqus", "outbrain", "taboola")
_ANCHORED = _HEADINGS | {"p", "section"}
_POSITIVE_WORDS = frozenset("article content main post entry story".split())
_ABOUT_LAYOUT = frozenset("has with no without".split())      # has-sidebar speaks of the page, not of the element
_NAME = re.compile(r"[a-z]+")

BAD, GOOD, FORM, HEADER, DOUBT = 1, 2, 4, 8, 16


def _role(tag: str, attrs: str, in_content: bool) -> tuple[int, bool]:
    """Role flags of an element, and whether it is hidden."""
    role, hidden = 0, False
    if tag in _NEGATIVE_TAGS:
        role |= BAD
    elif tag in _POSITIVE_TAGS:
        role |= GOOD
    elif tag == "form":
        role |= FORM
    elif tag == "header":
        role |= HEADER
    if not attrs or "=" not in attrs and "hidden" not in attrs:
        return role, False
    for name, value in _ATTR.findall(attrs):
        name = name.lower()
        value = value.strip("\"'")
        if name == "hidden" or name == "aria-hidden" and value.lower() == "true":
            hidden = True
        elif name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            hidden = True
        elif name == "role":
            role |= BAD if value.lower() in _NEGATIVE_ROLES else GOOD if value.lower() in ("main", "article") else 0
        elif name in ("class", "id") and tag not in ("body", "html"):
            for word in re.sub(r"([a-z])([A-Z])", r"\1-\2", value).lower().split():
                parts = _NAME.findall(word)
                if not parts or parts[0] in _ABOUT_LAYOUT:
                    continue
                if name == "id" and tag in _ANCHORED and (tag in _HEADINGS or in_content) \
                        and not (tag == "section" and parts[0].startswith(_ANCHOR_STARTS)):
                    continue
                listed = [p for p in parts if p in _NEGATIVE_WORDS or p.startswith(_NEGATIVE_STARTS)]
                if listed:
                    role |= HEADER if set(parts) <= {"header", "head", "entry", "post", "article"} \
                        else DOUBT if _DOUBTFUL.issuperset(listed) else BAD
                elif any(p in _POSITIVE_WORDS for p in parts):
                    role |= GOOD
    return role, hidden


class Block:
    """A run of text between block-level tags: the parent
    of its innermost block-level element by number, how deep it lies, and how many of
    the elements around it also hold the block before."""

    __slots__ = ("text", "links", "parent", "depth", "shared", "tag", "role")

    def __init__(self, text: str, links: int, parent: int, depth: int, shared: int, tag: str, role: int):
        self.text, self.links, self.parent, self.depth, self.shared = text, links, parent, depth, shared
        self.tag, self.role = tag, role


def _role_below(role: int, good: bool, flags: int) -> tuple[int, bool]:
    """The role inside an element, from the one around it. A header inside an
    article and a form around one do not speak against it; a doubtful word
    speaks as plainly as any outside of content."""
    if flags < 0:                        # dropped: holds no text
        return role, good
    if flags & BAD or flags & (HEADER | DOUBT) and not good:
        return BAD, good
    if flags & FORM:
        return BAD if role == BAD else FORM, good
    if flags & DOUBT and role != BAD:
        return DOUBT, good
    if flags & GOOD and role != BAD:
        return GOOD, True
    return role, good


class _Open:
    """An open element: what lies around its text is known when it begins."""

    __slots__ = ("tag", "flags", "inline", "role", "good")

    def __init__(self, tag: str, flags: int, inline: bool, role: int, good: bool):
        self.tag, self.flags, self.inline = tag, flags, inline
        self.role, self.good = _role_below(role, good, flags)


def blocks_of(html: str) -> list[Block]:
    """Text blocks of a page in page order; character references decoded,
    white space inside a block made one space."""
    out: list[Block] = []
    stack: list[_Open] = []
    places: dict[str, list[int]] = {}    # where the open elements of each tag are in the stack
    holders: list[tuple[int, int]] = []  # the block-level ones: place in the stack, element number
    parts: list[str] = []
    links = in_link = dropped = count = 0
    shared = 0                           # holders left from the block before

    def flush():
        nonlocal links, shared
        if parts:
            text = " ".join(unescape("".join(parts)).split())
            if text:
                role = stack[-1].role if stack else 0
                out.append(Block(text, min(links, len(text)), holders[-2][1] if len(holders) > 1 else 0, len(holders),
                                 min(shared, len(holders)), stack[holders[-1][0]].tag if holders else "",
                                 BAD if role == FORM else role))
                shared = len(holders)
            parts.clear()
        links = 0

    def close(k: int):
        """End the elements from the k-th of the stack on."""
        nonlocal in_link, dropped, shared
        if holders and holders[-1][0] >= k:
            flush()
        for s in stack[k:]:
            in_link -= s.tag == "a"
            dropped -= s.flags < 0
            places[s.tag].pop()
        del stack[k:]
        while holders and holders[-1][0] >= k:
            holders.pop()
        shared = min(shared, len(holders))

    def place(tag: str) -> int:
        at = places.get(tag)
        return at[-1] if at else -1

    at, n = 0, len(html)
    while at < n:
        lt = html.find("<", at)
        if lt < 0:
            lt = n
        if lt > at and not dropped:
            parts.append(html[at:lt])
            if in_link:
                links += lt - at
        if lt == n:
            break
        m = _TAG.match(html, lt)
        if m is None:                    # a lone "<" is text
            if not dropped:
                parts.append("<")
            at = lt + 1
            continue
        at = m.end()
        tag = m[2]
        if tag is None:
            continue
        tag = tag.lower()
        if m[1]:
            k = place(tag)
            # an inline end tag does not end blocks
            if k >= 0 and not (tag in _INLINE and holders and holders[-1][0] > k):
                close(k)
            if tag in ("p", "br"):
                flush()
            continue
        if tag in _VOID:
            if tag in ("br", "hr") and not dropped:
                if tag == "hr":
                    flush()
                else:
                    parts.append("\n")
            continue
        inline = tag in _INLINE
        if not inline:
            flush()
            k = max(map(place, ("p", *_CLOSES.get(tag, ()))))
            if k >= 0 and k >= max(map(place, _SCOPE)):
                close(k)
        if m[3].rstrip().endswith("/") and tag in _DROPPED:
            continue                     # <svg/> has no end tag
        if tag in _RAW:
            end = _RAW_END[tag].search(html, at)
            at = end.end() if end else n
            continue
        role, good = (stack[-1].role, stack[-1].good) if stack else (0, False)
        flags, hidden = _role(tag, m[3], good)
        if hidden or tag in _DROPPED:
            flags = -1
            dropped += 1
        in_link += tag == "a"
        count += 1
        places.setdefault(tag, []).append(len(stack))
        if not inline:
            holders.append((len(stack), count))
        stack.append(_Open(tag, flags, inline, role, good))
    flush()
    return out


# ---- costs --------------------------------------------------------------------

FEATURES = ("bias", "log length", "link share", "punctuation", "heading", "list item", "paragraph", "short", "marks")
#: Content grows with length, punctuation and paragraphs; links, lists, short lines and bylines of sites speak against it.
PRIOR = np.array([-1.0, 2.0, -3.5, 1.0, 0.3, -0.8, 0.8, -0.8, -2.0])
_MARKS = re.compile(r"[©®|·•»›]|all rights reserved|click here|sign up|log in", re.I)


def features_of(b: Block) -> list[float]:
    n = len(b.text)
    punct = sum(map(b.text.count, ".,;:!?"))
    return [1.0, min(1.5, np.log1p(n) / 5), b.links / n, min(1.0, 20 * punct / n), float(b.tag in _HEADINGS),
            float(b.tag in ("li", "dt", "dd", "td", "th")), float(b.tag in ("p", "blockquote", "pre")),
            float(n < 25), float(_MARKS.search(b.text) is not None)]


def fit(pages: list[str]) -> np.ndarray:
    """Logistic weights from blocks of plain role, pulled towards PRIOR."""
    rows = [(features_of(b), b.role) for html in pages for b in blocks_of(html) if b.role in (BAD, GOOD)]
    x = np.array([f for f, _ in rows]).reshape(len(rows), len(PRIOR))
    y = np.array([r == GOOD for _, r in rows], float)
    w = PRIOR.copy()
    if not len(rows) or y.min() == y.max():
        return w
    balance = np.where(y > 0, 0.5 / y.mean(), 0.5 / (1 - y.mean())) / len(y)
    pull = 0.02
    for _ in range(60):                  # Newton steps on a convex problem
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (balance * (y - p)) - pull * (w - PRIOR)
        hess = (x * (balance * p * (1 - p))[:, None]).T @ x + pull * np.eye(len(w))
        step = np.linalg.solve(hess, grad)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w


# ---- minimum cut ---------------------------------------------------------------

def min_cut(net: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Which nodes stay with the source. ``net`` is a node's capacity from the
    source (positive) or to the sink (negative); edges count both ways.

    Shortest augmenting paths (Dinic): levels by breadth-first search, then
    blocking flows along them."""
    n = len(net)
    adj: list[list[int]] = [[] for _ in range(n)]
    to: list[int] = []
    cap: list[float] = []
    for a, b, c in edges:
        adj[a].append(len(to))
        to.append(b)
        cap.append(c)
        adj[b].append(len(to))
        to.append(a)
        cap.append(c)
    source = [max(0.0, x) for x in net]
    sink = [max(0.0, -x) for x in net]
    eps = 1e-9
    while True:
        level = [-1] * n
        queue = [i for i in range(n) if source[i] > eps]
        for i in queue:
            level[i] = 0
        found = False
        for u in queue:
            if sink[u] > eps:
                found = True
            for e in adj[u]:
                v = to[e]
                if cap[e] > eps and level[v] < 0:
                    level[v] = level[u] + 1
                    queue.append(v)
        if not found:
            return [x >= 0 for x in level]
        nxt = [0] * n
        for start in range(n):
            while source[start] > eps:
                path: list[int] = []
                u = start
                while True:
                    if sink[u] > eps:
                        flow = min([source[start], sink[u], *(cap[e] for e in path)])
                        source[start] -= flow
                        sink[u] -= flow
                        for e in path:
                            cap[e] -= flow
                            cap[e ^ 1] += flow
                        break
                    while nxt[u] < len(adj[u]):
                        e = adj[u][nxt[u]]
                        if cap[e] > eps and level[to[e]] == level[u] + 1:
                            break
                        nxt[u] += 1
                    if nxt[u] < len(adj[u]):
                        path.append(adj[u][nxt[u]])
                        u = to[path[-1]]
                    elif path:
                        u = to[path.pop() ^ 1]
                        nxt[u] += 1
                    else:
                        break
                if not path and sink[start] <= eps and nxt[start] >= len(adj[start]):
                    break


def label(blocks: list[Block], weights: np.ndarray) -> list[bool]:
    """Content or not, for each block of a page."""
    x = np.array([features_of(b) for b in blocks])
    net = (x @ weights).clip(-6, 6).tolist()      # cost of boilerplate less cost of content
    for i, b in enumerate(blocks):
        if b.role == BAD:
            net[i] -= ROLE_COST
        elif b.role == DOUBT:
            net[i] -= DOUBT_COST
        elif b.role == GOOD:
            net[i] += ARTICLE_COST
    edges = []
    last: dict[int, int] = {}
    for i, b in enumerate(blocks):
        if i:
            edges.append((i - 1, i, ADJACENT * (b.shared + 1) / (max(blocks[i - 1].depth, b.depth) + 1)))
        if b.parent in last and last[b.parent] < i:
            edges.append((last[b.parent], i, SIBLING))
        last[b.parent] = i
    return min_cut(net, edges)


def main_text(html: str | None, weights: np.ndarray) -> str:
    blocks = blocks_of(html or "")
    if not blocks:
        return ""
    return " ".join(b.text for b, keep in zip(blocks, label(blocks, weights), strict=True) if keep)


# ---- Spark jobs ------------------------------------------------------------------

def train(pages: DataFrame, n: int = TRAIN_PAGES) -> np.ndarray:
    """Weights from at most n different pages."""
    return fit(distinct_sample(pages, "html", n))


def extract(pages: DataFrame, weights: np.ndarray) -> DataFrame:
    """Per page: page_id, url, text, n_chars."""
    w = np.asarray(weights)

    @F.pandas_udf("string")
    def run(html: pd.Series) -> pd.Series:
        return pd.Series([main_text(x, w) for x in html], dtype=object)

    return pages.select("page_id", "url", run("html").alias("text")) \
        .withColumn("n_chars", F.length("text").cast("long"))
