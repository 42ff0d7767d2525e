"""Main text of web pages by minimum cut (operator 9).

A page becomes blocks of text with their place in the element tree. A logistic
classifier on how a block reads (words, links, marks, place on the page) gives
the costs of calling it content or boilerplate; what its elements say by name
(article, nav, footer, classes such as "sidebar") adds to them, no more than
the classifier and the ties can outweigh; only what is hidden is out for good.
Both are the capacities of edges to the two terminals. Neighbouring blocks, and
blocks of one parent, are tied by edges that weigh more the more of the tree
they share, and less where their elements say different things. A name counts
as a whole ("sidebar", "site-footer", not "with-sidebar"); an article or main
element inside another that says "boilerplate" leaves the matter open.
The maximum flow cuts the cheapest set of edges; blocks on the content side
are the text.

The classifier is fitted on the blocks of a bounded sample of pages, by hash
of the html (`SAMPLE_PAGES`), whose elements say clearly what they are; if
they hold one sort alone, the given weights stay. Every page is extracted
whole.

Null or empty html: empty text. Markup without blocks of text: empty text.
Broken markup is read as far as it goes: open elements are closed where a new
one forces it, at the latest at the end. The head ends at the first element or
text that may not stand in it. A button, select, drawing and the like without
an end tag of its own hides nothing from the first block in it on. Null and repeated ids and urls stay
as they are, each row gets a row. Extra columns are left. An empty table gives
no rows.
"""

from __future__ import annotations

import re
from collections import deque
from functools import lru_cache
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from tracelake.llm.shared import slices

SAMPLE_PAGES = 2000
#: Weight of what elements say (twice that against), of ties between blocks, the share of it where elements say different things, of what is hidden.
NAMED, TIED, UNLIKE, HIDDEN = 2.0, 4.5, 0.25, 100.0
SCALE = 1000
UNSEEN = {"script", "style", "noscript", "template", "svg", "math", "iframe", "object", "select", "button", "textarea", "head", "title", "canvas", "audio", "video"}
#: Of these, those that hide their blocks only if an end tag of their own closes them; and what may stand in the head.
IF_CLOSED = {"noscript", "svg", "math", "object", "select", "button", "canvas", "audio", "video", "head"}
IN_HEAD = {"html", "head", "base", "basefont", "bgsound", "link", "meta", "title", "noscript", "noframes", "style", "script", "template"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "br", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins", "kbd", "label", "mark",
          "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr"}
#: An open element of the first sort ends when one of the second begins.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "option": {"option"}}
PLAIN = {"nav", "footer", "aside", "form", "header", "menu", "dialog", "fieldset"}
BODY = {"article", "main"}
PLAIN_NAMES = re.compile(r"ads?|advert\w*|banner|sponsor\w*|promo\w*|sidebar|side|menu|nav\w*|breadcrumbs?|footer|foot|header|masthead|cookies?|consent|notice|popup|modal|"
                         r"overlay|newsletter|subscribe|signup|login|share|sharing|social|related|recommend\w*|comments?|commentlist|disqus|replies|reply|respond|widget|toolbar|pagination|pager|"
                         r"copyright|legal|search|form")
BODY_NAMES = re.compile(r"article|content|entry|post|story|main|body|text")
#: Parts of a name after the one that counts; and first parts that make it the state of a page, not what the element holds.
CARRIERS = re.compile(r"wrap\w*|inner|outer|container|box|list|area|section|block|bar|links?|items?|slot|units?|buttons?|posts?|panel|group|row|col|top|bottom|left|right|\d+|")
STATES = {"with", "without", "no", "not", "has", "is", "hide", "show", "toggle", "layout"}
#: Words, share of words in links, marks, length of a word, place on the page, a constant: weights before fitting.
WEIGHTS = np.array([1.2, -4.0, 0.8, 0.0, 0.0, -1.5])


@lru_cache(4096)
def named(names: str) -> int:
    """-1 if one of the names is that of boilerplate, else 1 if one is that of the main text, else 0. The last part of a name counts."""
    said = 0
    for name in names.lower().split():
        parts = re.split("[_-]+", name)
        if parts[0] in STATES:
            continue
        while len(parts) > 1 and CARRIERS.fullmatch(parts[-1]):
            parts.pop()
        own = len(parts)
        while own > 1 and BODY_NAMES.fullmatch(parts[own - 1]):  # the text of a comment
            own -= 1
            while own > 1 and CARRIERS.fullmatch(parts[own - 1]):
                own -= 1
        if PLAIN_NAMES.fullmatch(parts[own - 1]):
            return -1
        said = said or int(bool(BODY_NAMES.fullmatch(parts[-1])))
    return said


class Blocks(HTMLParser):
    """Text blocks of a page: [path of (tag, number), words, words in links, text]; what is said about a path is kept beside."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.stack: list[tuple[str, int, int]] = []
        self.count = self.unseen = self.links = 0
        self.parts: list[str] = []
        self.linked = 0
        self.blocks: list[tuple[tuple[int, ...], int, str, int]] = []
        self.inside: list[list[int]] = []  # by block, the elements that hide it if they are closed
        self.closed: set[int] = set()

    def _cut(self) -> None:
        words = "".join(self.parts).split()
        if words:
            said = 0
            for tag, _, own in self.stack:
                said = min(said, own) if -2 in (said, own) or said == -1 and own < 1 else 0 if said == -1 and tag in BODY else said if said == -1 else own or said
            self.blocks.append((tuple(n for _, n, _ in self.stack), self.linked, " ".join(words), said))
            self.inside.append([n for t, n, _ in self.stack if t in IF_CLOSED])
        self.parts, self.linked = [], 0

    def _said(self, tag: str, attrs) -> int:
        """1 if the element says it holds the main text, -1 if something else, -2 if it is hidden, 0 if it says nothing."""
        names = " ".join(v or "" for k, v in attrs if k in ("class", "id", "role", "aria-label"))
        hidden = any(k == "hidden" or (k == "aria-hidden" and v == "true") or (k == "style" and re.search(r"display\s*:\s*none", v or "")) for k, v in attrs)
        if hidden:
            return -2
        if tag in PLAIN and not (tag == "header" and any(t in BODY for t, _, _ in self.stack)):
            return -1
        if tag in BODY:
            return 1 if named(names) >= 0 else -1
        return named(names) if tag not in ("html", "body") else 0

    def _heard(self) -> bool:
        """Whether text here may count: nothing hides it, or only elements that may prove unclosed, and a block has begun in the innermost."""
        if not self.unseen:
            return True
        inner = next(t for t, _, _ in reversed(self.stack) if t not in INLINE)
        return inner not in UNSEEN and all(t in IF_CLOSED for t, _, _ in self.stack if t in UNSEEN)

    def _leave_head(self) -> None:
        while any(t == "head" for t, _, _ in self.stack):
            self._close()

    def handle_starttag(self, tag, attrs):
        if self.stack and self.stack[-1][0] == "head" and tag not in IN_HEAD or tag == "body":
            self._leave_head()
        if tag == "head" and any(t in ("head", "body") for t, _, _ in self.stack):
            return
        if tag in ("button", "select") and any(t == tag for t, _, _ in self.stack):  # neither holds another
            if self._heard():
                self._cut()
            while self._close() != tag:
                pass
        if tag in UNSEEN:
            self._open(tag, 0)
            self.unseen += 1
            return
        if tag in VOID:
            if tag in ("br", "hr", "img", "wbr"):
                self.parts.append("" if tag == "wbr" else " ")
            if tag == "hr":
                self._cut()
            return
        if tag in INLINE:
            if tag == "a":
                self.links += 1
            self._open(tag, self._said(tag, attrs))
            return
        self._cut()
        while self.stack and (self.stack[-1][0] == "p" or self.stack[-1][0] in INLINE and any(t == "p" for t, _, _ in self.stack)):
            self._close()
        for i in range(len(self.stack) - 1, -1, -1):
            if tag in ENDS.get(self.stack[i][0], ()):
                while len(self.stack) > i:
                    self._close()
                break
            if self.stack[i][0] in ("ul", "ol", "dl", "table", "div", "article", "section"):
                break
        self._open(tag, self._said(tag, attrs))

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def _open(self, tag: str, said: int) -> None:
        self.count += 1
        self.stack.append((tag, self.count, said))

    def _close(self) -> str:
        tag = self.stack.pop()[0]
        self.unseen -= tag in UNSEEN
        self.links -= tag == "a"
        return tag

    def handle_endtag(self, tag):
        if not any(t == tag for t, _, _ in self.stack):
            return
        last = max(i for i, (t, _, _) in enumerate(self.stack) if t == tag)
        if tag not in INLINE and tag not in UNSEEN or self._heard() and any(t in UNSEEN for t, _, _ in self.stack[last:]):
            self._cut()
        if tag in UNSEEN:
            self.closed.add(self.stack[last][1])
        while self.stack[-1][0] != tag:
            self._close()
        self._close()

    def handle_data(self, data):
        if self.unseen and self.stack[-1][0] == "head" and data.strip():
            self._leave_head()
        if self._heard():
            self.parts.append(data)
            if self.links:
                self.linked += len(data.split())


def blocks_of(html: str) -> list[tuple[tuple[int, ...], int, str, int]]:
    parser = Blocks()
    parser.feed(html)
    parser.close()
    parser._cut()
    return [b for b, inside in zip(parser.blocks, parser.inside) if parser.closed.isdisjoint(inside)]


def features(blocks: list) -> np.ndarray:
    rows = []
    for i, (_, linked, text, _) in enumerate(blocks):
        words = text.count(" ") + 1
        marks = sum(text.count(m) for m in ".,;:!?")
        rows.append((np.log(words), linked / words, min(marks, 10) / 3, min(len(text) / words, 12) / 6, i / len(blocks), 1.0))
    return np.array(rows).reshape(-1, len(WEIGHTS))


def fit(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Logistic regression by Newton steps with a little shrinkage towards the given weights; both sorts weigh the same."""
    weight = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean()))
    pull = 0.02 * len(y)
    w = WEIGHTS.copy()
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (weight * (p - y)) + pull * (w - WEIGHTS)
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + pull * np.eye(len(w)), slope)
        w = w - step / max(1.0, np.abs(step).max())
    return w


def minimum_cut(source: list[int], sink: list[int], ties: list[tuple[int, int, int]]) -> list[bool]:
    """Which nodes stay with the source. Shortest augmenting paths in levels; capacities are integers."""
    n = len(source)
    s, t = n, n + 1
    heads: list[list[int]] = [[] for _ in range(n + 2)]
    to: list[int] = []
    room: list[int] = []

    def edge(a: int, b: int, there: int, back: int) -> None:
        heads[a].append(len(to))
        to.append(b)
        room.append(there)
        heads[b].append(len(to))
        to.append(a)
        room.append(back)

    for i in range(n):
        both = min(source[i], sink[i])  # what would flow straight through
        edge(s, i, source[i] - both, 0)
        edge(i, t, sink[i] - both, 0)
    for a, b, c in ties:
        edge(a, b, c, c)
    while True:
        level = [-1] * (n + 2)
        level[s] = 0
        queue = deque([s])
        while queue:
            a = queue.popleft()
            for e in heads[a]:
                if room[e] and level[to[e]] < 0:
                    level[to[e]] = level[a] + 1
                    queue.append(to[e])
        if level[t] < 0:
            return [level[i] >= 0 for i in range(n)]
        at = [0] * (n + 2)
        path: list[int] = []
        a = s
        while True:
            if a == t:
                flow = min(room[e] for e in path)
                for e in path:
                    room[e] -= flow
                    room[e ^ 1] += flow
                cut = next(i for i, e in enumerate(path) if not room[e])
                a = to[path[cut] ^ 1]
                del path[cut:]
                continue
            while at[a] < len(heads[a]):
                e = heads[a][at[a]]
                if room[e] and level[to[e]] == level[a] + 1:
                    break
                at[a] += 1
            if at[a] < len(heads[a]):
                path.append(heads[a][at[a]])
                a = to[path[-1]]
            elif a == s:
                break
            else:
                level[a] = -1
                a = to[path.pop() ^ 1]


def nearness(a: tuple[int, ...], b: tuple[int, ...]) -> float:
    """Share of two blocks' ancestors that they have in common."""
    same = 0
    for x, y in zip(a, b):
        if x != y:
            break
        same += 1
    return (same + 1) / (max(len(a), len(b)) + 1)


def content(blocks: list, weights: np.ndarray) -> str:
    """The text of the blocks on the content side, one line each."""
    if not blocks:
        return ""
    scores = np.clip(features(blocks) @ weights, -6, 6)
    said = np.array([b[3] for b in blocks])
    keep = np.maximum(scores, 0) + NAMED * (said > 0)
    leave = np.maximum(-scores, 0) + 2 * NAMED * (said < 0) + HIDDEN * (said < -1)
    ties, last_of = [], {}
    for i, (path, _, _, own) in enumerate(blocks):
        parent = path[:-1]
        for j in {i - 1, last_of.get(parent, i - 1)}:
            if j >= 0:
                ties.append((j, i, int(SCALE * TIED * nearness(path, blocks[j][0]) * (1 if own == blocks[j][3] else UNLIKE))))
        last_of[parent] = i
    inside = minimum_cut([int(SCALE * c) for c in keep], [int(SCALE * c) for c in leave], ties)
    return "\n".join(b[2] for b, k in zip(blocks, inside) if k)


def weights_from(pages: DataFrame) -> np.ndarray:
    """Fit on the clear blocks of the sample."""
    html = F.col("html")
    sample = pages.where(html.isNotNull()).select("html").orderBy(F.xxhash64(html), html).limit(SAMPLE_PAGES)
    examples = F.arrow_udf(_examples, "array<array<double>>")
    rows = [r for part in sample.select(examples(html).alias("e")).toLocalIterator() for r in part.e]
    data = np.array(rows).reshape(-1, len(WEIGHTS) + 1)
    x, y = data[:, :-1], data[:, -1]
    return fit(x, y) if 0 < y.sum() < len(y) else WEIGHTS


def _examples(htmls: pa.Array) -> pa.Array:
    out = []
    for html in htmls.to_pylist():
        blocks = blocks_of(html or "")
        clear = [[*map(float, f), float(b[3] > 0)] for f, b in zip(features(blocks), blocks) if b[3]]
        out.append(clear)
    return pa.array(out, pa.list_(pa.list_(pa.float64())))


def _extractor(weights: np.ndarray):
    @F.arrow_udf("string")
    def extracted(htmls: pa.Array) -> pa.Array:
        out = []
        for part in slices(pa.RecordBatch.from_arrays([htmls], names=["html"]), "html"):
            out += [content(blocks_of(h or ""), weights) for h in part.column(0).to_pylist()]
        return pa.array(out, pa.string())

    return extracted


def main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars for every page. One pass after the fit, no shuffle of pages."""
    text = _extractor(weights_from(pages))(F.col("html"))
    return pages.select("page_id", "url", text.alias("text")).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op9_main_text(spark: SparkSession, sf: str) -> DataFrame:
    return main_text(spark.read.parquet(f"{sf}/pages.parquet"))
