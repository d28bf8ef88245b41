"""Main text of HTML pages by a tree-structured graphical model (operator 3).

The block elements of a page are the nodes of a tree, each main text or not. What a node looks like (its tag, names in class
and id, text length, share of links) gives it a potential of its own, and each parent-child edge one for the two labels. Sum-product messages
passed up and then down the tree give every node's marginal exactly; the text of nodes that are more likely main text than not is kept. All
potentials are frequencies counted on the labelled pages of ``labelled_pages``, smoothed.

Inline elements belong to their block, so a link or an emphasis within a sentence is never dropped. What is no text on a page (scripts,
styles, comments, titles, form controls) is left out by its kind. Formulas, drawings and what stands in for media, frames or scripts are text like any other.

Each page is extracted by itself in its task: no shuffle, bounded memory, and the parser and the messages are loops, so no depth is too
deep. Defined results: a null or empty page, or one without main text, gives an empty text. Broken markup is read as far as it goes, an unfinished tag at
the end is dropped, and an unfinished character reference stays as it is. Text without any tag is main text. Repeated rows are extracted row by row; other
columns pass through unless they have the name of an added one.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections import Counter
from functools import lru_cache

from pyspark.sql import DataFrame

from acctmart.llm.common import add_columns
from acctmart.llm.labelled_pages import labelled_pages

#: Elements that make up a node. Others are inline.
BLOCKS = set(
    "html body div section article main header footer nav aside p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot "
    "caption tr td th blockquote pre figure figcaption form fieldset details summary address center dialog menu hgroup".split()
)
#: Of these, those that divide a page; the others mostly are what their parent is.
SECTIONS = set("div section article main header footer nav aside form fieldset details dialog menu address".split())
#: How far a node's looks are trusted: its features aren't independent, as their product supposes.
TRUST = 0.6
#: Elements whose content is no text of the page.
SILENT = set("head title script style template textarea select option button label legend datalist".split())
#: Of these, those whose content isn't markup.
RAW = set("script style title textarea".split())
EMPTY = set("area base br col embed hr img input link meta param source track wbr".split())
#: An open element of the first kind ends where one of the second begins.
ENDED_BY = {
    "p": BLOCKS - {"html", "body", "td", "th", "caption"},
    "li": {"li"},
    "dt": {"dt", "dd"},
    "dd": {"dt", "dd"},
    "td": {"td", "th", "tr", "tbody", "tfoot"},
    "th": {"td", "th", "tr", "tbody", "tfoot"},
    "tr": {"tr", "tbody", "tfoot"},
    "option": {"option"},
}
_ENDING = set().union(*ENDED_BY.values())
#: No element outside of these is ended by a new one within.
FENCES = set("table ul ol dl body html article section main div td th blockquote".split())
#: Names in class, id and role, by what they speak of.
FAMILIES = {
    "text": "article content post entry story main body text prose",
    "menu": "nav navbar navigation menu menubar breadcrumb breadcrumbs pagination pager toc tabs",
    "head": "header masthead topbar logo head",
    "foot": "footer foot copyright legal imprint bottom",
    "side": "sidebar aside side widget related recommended trending popular more",
    "advert": "ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promoted promotion",
    "notice": "notice cookie cookies consent gdpr popup modal overlay alert warning paywall",
    "social": "share sharing social follow tweet",
    "reader": "comment comments commentlist reply replies respond disqus discussion reviews",
    "form": "form search login signup subscribe newsletter register",
}
_FAMILY = {name: family for family, names in FAMILIES.items() for name in names.split()}
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']+|\"[^\"]*\"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|<[!?/][^>]*>|<[a-zA-Z/!?][^>]*\Z|([^<]+|<)",
    re.S,
)
_ATTRIBUTE = re.compile(r"(?i)\b(class|id|role|data-main)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)")
_NAME = re.compile(r"[a-z]+")


class Page:
    """The nodes of a page in order, and its texts with the node they belong to; None as text is a border of blocks."""

    def __init__(self, source: str):
        self.parent, self.tag, self.names, self.marks = [-1], ["page"], [frozenset()], [None]
        self.texts: list[tuple[int, str | None]] = []
        self.words, self.linked = Counter(), Counter()
        self._read(source)

    def _open(self, parent: int, tag: str, attributes: str) -> int:
        names, mark = set(), None
        for key, value in _ATTRIBUTE.findall(attributes) if attributes else ():
            value = value.strip("\"'")
            if key.lower() == "data-main":
                mark = value == "1"
            else:
                names.update(_FAMILY[n] for n in _NAME.findall(value.lower()) if n in _FAMILY)
        self.parent.append(parent)
        self.tag.append(tag)
        self.names.append(frozenset(names))
        self.marks.append(mark)
        return len(self.tag) - 1

    def _read(self, source: str) -> None:
        stack: list[tuple[str, int]] = []  # open elements and the node that each belongs to
        bounds: list[int] = []  # depths of those that a new element may end, or that fence off what is outside
        opened = Counter()
        silent = links = 0
        node, at, end = 0, 0, len(source)

        def close(depth: int) -> None:
            nonlocal node, silent, links
            while len(stack) > depth:
                tag, _ = stack.pop()
                opened[tag] -= 1
                silent -= tag in SILENT
                links -= tag == "a"
                if tag in BLOCKS:
                    self.texts.append((0, None))
            while bounds and bounds[-1] >= depth:
                bounds.pop()
            node = stack[-1][1] if stack else 0

        while at < end:
            token = _TOKEN.match(source, at)
            at = token.end()
            text = token[7]
            if text is not None:
                if not silent:
                    text = entities.unescape(text)
                    self.texts.append((node, text))
                    n = len(text.split())
                    self.words[node] += n
                    self.linked[node] += n if links else 0
                continue
            closing, tag, attributes = (token[1], token[2], token[3]) if token[2] else (token[4], token[5], token[6])
            if not tag:
                continue
            tag = tag.lower()
            if closing:
                if opened[tag]:
                    depth = len(stack) - 1
                    while stack[depth][0] != tag:
                        depth -= 1
                    close(depth)
                continue
            if tag in EMPTY:
                if tag in ("br", "hr"):
                    self.texts.append((0, None))
                continue
            if attributes.endswith("/") and tag not in BLOCKS and tag not in RAW:
                continue
            if tag in RAW:
                stop = re.compile(rf"</{tag}", re.I).search(source, at)
                at = stop.start() if stop else end
            for depth in reversed(bounds) if tag in _ENDING else ():
                if tag in ENDED_BY.get(stack[depth][0], ()):
                    close(depth)
                    break
                if stack[depth][0] in FENCES:
                    break
            if tag in BLOCKS:
                self.texts.append((0, None))
                node = self._open(node, tag, attributes)
            if tag in ENDED_BY or tag in FENCES:
                bounds.append(len(stack))
            stack.append((tag, node))
            opened[tag] += 1
            silent += tag in SILENT
            links += tag == "a"

    def labels(self) -> list[bool]:
        """Whether each node is main text, by the nearest mark above it."""
        out: list[bool] = []
        for parent, mark in zip(self.parent, self.marks):
            out.append(bool(mark) if mark is not None else parent >= 0 and out[parent])
        return out

    def features(self) -> list[tuple[str, ...]]:
        """What each node looks like."""
        n = len(self.tag)
        words, linked = [self.words[k] for k in range(n)], [self.linked[k] for k in range(n)]
        for k in range(n - 1, 0, -1):
            words[self.parent[k]] += words[k]
            linked[self.parent[k]] += linked[k]
        out = []
        for k in range(n):
            size = "none" if not words[k] else "few" if words[k] < 8 else "some" if words[k] < 40 else "many"
            share = "no links" if not linked[k] else "links" if linked[k] < 0.6 * words[k] else "all links"
            names = [f"name {f}" if f in self.names[k] else f"not {f}" for f in FAMILIES]
            out.append((f"tag {self.tag[k]}", f"size {size}", share, *names))
        return out


class Model:
    """Log potentials of nodes and edges, counted on labelled pages."""

    def __init__(self, pages: list[str], smooth: float = 0.5):
        seen, edges = (Counter(), Counter()), Counter()
        totals = [0, 0]
        for source in pages:
            page = Page(source)
            labels = page.labels()
            for k, features in enumerate(page.features()):
                y = int(labels[k])
                totals[y] += 1
                seen[y].update(features)
                if k:
                    edges[page.tag[k] in SECTIONS, int(labels[page.parent[k]]), y] += 1
        self.nodes: dict[str, tuple[float, float]] = {}
        for feature in {*seen[0], *seen[1]}:
            self.nodes[feature] = tuple(math.log((seen[y][feature] + smooth) / (totals[y] + 2 * smooth)) for y in (0, 1))
        # how often a label stands below another one, for elements that divide a page and for others
        self.edges = {
            kind: [
                [(edges[kind, x, y] + smooth) / (edges[kind, x, 0] + edges[kind, x, 1] + 2 * smooth) for y in (0, 1)]
                for x in (0, 1)
            ]
            for kind in (True, False)
        }

    def marginals(self, page: Page) -> list[float]:
        """Each node's probability to be main text, by sum-product up and down the tree."""
        parent, n = page.parent, len(page.parent)
        own = []
        for features in page.features():
            low = high = 0.0
            for feature in features:
                a, b = self.nodes.get(feature, (0.0, 0.0))
                low, high = low + a, high + b
            top = max(low, high)
            own.append(tuple(math.exp(max(TRUST * (v - top), -60.0)) for v in (low, high)))
        edges = [self.edges[tag in SECTIONS] for tag in page.tag]
        up: list[tuple[float, float]] = [(1.0, 1.0)] * n  # the product of what the children say
        said: list[tuple[float, float]] = [(1.0, 1.0)] * n  # what each node says to its parent
        for k in range(n - 1, 0, -1):
            x, y = own[k][0] * up[k][0], own[k][1] * up[k][1]
            (a, b), (c, d) = edges[k]
            m0, m1 = a * x + b * y, c * x + d * y
            total = m0 + m1
            said[k] = (m0 / total, m1 / total)
            p = parent[k]
            x, y = up[p][0] * said[k][0], up[p][1] * said[k][1]
            up[p] = (x / (x + y), y / (x + y))
        down: list[tuple[float, float]] = [(1.0, 0.02)] * n  # the page as a whole is hardly ever main text
        out = [0.0] * n
        for k in range(n):
            if k:
                p = parent[k]
                # the parent's belief without what this node said
                x = own[p][0] * up[p][0] * down[p][0] / said[k][0]
                y = own[p][1] * up[p][1] * down[p][1] / said[k][1]
                (a, b), (c, d) = edges[k]
                m0, m1 = a * x + c * y, b * x + d * y
                total = m0 + m1
                down[k] = (m0 / total, m1 / total)
            x, y = own[k][0] * up[k][0] * down[k][0], own[k][1] * up[k][1] * down[k][1]
            out[k] = y / (x + y)
        return out

    def main_text(self, source: str | None) -> str:
        if not source:
            return ""
        page = Page(source)
        if len(page.tag) == 1:
            return " ".join("".join(" " if t is None else t for _, t in page.texts).split())
        kept = [p > 0.5 for p in self.marginals(page)]
        parts = [" " if text is None else text for node, text in page.texts if text is None or kept[node]]
        return " ".join("".join(parts).split())


@lru_cache(maxsize=1)
def trained() -> Model:
    """The model of the labelled pages."""
    return Model(labelled_pages())


def main_text(pages: DataFrame, html: str = "html", keep: list[str] | None = None) -> DataFrame:
    """``pages`` with ``text``, the main text, and ``n_chars``, its code points."""

    def make():
        model = trained()

        def run(sources):
            texts = [model.main_text(s) for s in sources]
            return texts, [len(t) for t in texts]

        return run

    return add_columns(pages, [html], "text string, n_chars long", make, keep)
