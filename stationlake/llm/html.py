"""Main text of web pages from a graphical model on the page's tree.

Every element and every run of text is a node that is main text or not. A node's own features
(its tag, the words of its class, id and role, how much text and how many links it has) give it
log-odds; potentials on the edges, by the kind of the child, say how parents and children agree.
Sum-product messages go from the leaves to the root and back, which gives each node's exact
marginal, and runs of text with a marginal of one half or more are the main text. The weights are
those that make the marks of labelled pages most likely; the same messages give the gradient.
"""

from __future__ import annotations

import functools
import html
import math
import re
from collections import Counter
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stationlake.llm.common import ship
from stationlake.llm.labelled_pages import pages as labelled_pages

# Kinds of elements in HTML.
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark nobr q"
    " s samp small span strike strong sub sup time tt u var wbr".split()
)
DROPPED = frozenset(
    "button canvas datalist embed iframe input math noscript object option script select style"
    " svg template textarea title".split()
)
RAW = frozenset("iframe noembed noframes script style textarea title xmp".split())
CLOSES_P = frozenset(
    "address article aside blockquote center details dir div dl dd dt fieldset figcaption figure"
    " footer form h1 h2 h3 h4 h5 h6 header hgroup hr li main menu nav ol p pre section summary"
    " table ul".split()
)
#: Elements that end an open one of the first set, as far as one of the second.
ENDS = {
    "li": (frozenset(["li"]), frozenset(["ul", "ol", "menu"])),
    "dt": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "dd": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "td": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "th": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "tr": (frozenset(["tr"]), frozenset(["table"])),
    "tbody": (frozenset(["thead", "tbody", "tfoot"]), frozenset(["table"])),
    "tfoot": (frozenset(["thead", "tbody", "tfoot"]), frozenset(["table"])),
}
P_SCOPE = frozenset(["table", "td", "th", "button", "caption"])

TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+>|<(/?)([a-zA-Z][^\s/>]*+)"
    r"((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>|[^>]*+(?:>|\Z))",
    re.DOTALL,
)
ATTRIBUTE = re.compile(
    r"([a-zA-Z][\w:-]*+)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s\"'>]++)))?+"
)
NAME = re.compile(r"[a-z]+")
REGIONS = frozenset("article aside footer form header main nav".split())
TEXT, INNER, OUTER = 0, 1, 2


@dataclass
class Tree:
    """A page's nodes in page order, so parents come before their children."""

    parent: list[int] = field(default_factory=list)
    tag: list[str] = field(default_factory=list)
    names: list[str] = field(default_factory=list)
    text: list[str] = field(default_factory=list)
    kind: list[int] = field(default_factory=list)
    breaks: list[int] = field(default_factory=list)  # numbers of the block that each text is in
    mark: list[str] = field(default_factory=list)


def parse(page: str) -> Tree:
    """The tree of a page; errors in its markup are mended much as browsers do."""
    tree = Tree()
    add_parent, add_tag, add_names = tree.parent.append, tree.tag.append, tree.names.append
    add_text, add_kind, add_break = tree.text.append, tree.kind.append, tree.breaks.append

    def add(parent: int, tag: str, names: str, text: str, kind: int) -> int:
        add_parent(parent)
        add_tag(tag)
        add_names(names)
        add_text(text)
        add_kind(kind)
        add_break(block)
        return len(tree.parent) - 1

    block, at, hidden = 0, 0, 0
    root = add(-1, "#page", "", "", OUTER)
    open_nodes, open_tags = [root], ["#page"]
    opened: Counter[str] = Counter()
    tree.mark.append("")

    def close(n: int) -> None:
        """Close all but the first n open elements."""
        nonlocal block, hidden
        for tag in open_tags[n:]:
            block += tag not in INLINE
            hidden -= tag in DROPPED
            opened[tag] -= 1
        del open_nodes[n:], open_tags[n:]

    def close_within(tags: frozenset, scope: frozenset) -> None:
        if not any(opened[tag] for tag in tags):
            return None  # most often so: no walk through deep pages
        for n in range(len(open_tags) - 1, 0, -1):
            if open_tags[n] in tags:
                return close(n)
            if open_tags[n] in scope:
                return None
        return None

    end = len(page)
    while at < end:
        found = TAG.search(page, at)
        upto = found.start() if found else end
        if upto > at and not hidden:
            text = page[at:upto]
            add(open_nodes[-1], "#text", "", html.unescape(text) if "&" in text else text, TEXT)
            tree.mark.append("")
        if not found:
            break
        at = found.end()
        if not found[2]:
            continue  # a comment or a declaration
        tag = found[2].lower()
        if found[1]:
            for n in range(len(open_tags) - 1, 0, -1):
                if open_tags[n] == tag:
                    close(n)
                    break
                if tag in INLINE and open_tags[n] not in INLINE:
                    break
            continue
        if tag in CLOSES_P:
            close_within(frozenset(["p"]), P_SCOPE)
        if tag in ENDS:
            close_within(*ENDS[tag])
        block += tag not in INLINE
        if tag in VOID:
            continue
        names = mark = ""
        if len(found[3]) > 1:
            for a in ATTRIBUTE.finditer(found[3]):
                key = a[1].lower()
                if key in ("class", "id", "role", "itemprop"):
                    names += " " + (a[2] or a[3] or a[4] or "").lower()
                elif key in ("m", "x"):
                    mark = key
                elif key == "hidden":
                    names += " hidden"
        node = add(open_nodes[-1], tag, names, "", INNER if tag in INLINE else OUTER)
        tree.mark.append(mark)
        if found[3].endswith("/>") and tag not in INLINE and tag not in CLOSES_P:
            continue
        open_nodes.append(node)
        open_tags.append(tag)
        opened[tag] += 1
        hidden += tag in DROPPED
        if tag in RAW:
            over = re.compile(f"</{tag}", re.IGNORECASE).search(page, at)
            at = over.start() if over else end
    return tree


def _size(n: int) -> int:
    """A step for an amount of text."""
    return 0 if n == 0 else 1 if n < 15 else 2 if n < 40 else 3 if n < 120 else 4 if n < 500 else 5


def signatures(tree: Tree) -> list[tuple]:
    """What decides each node's features."""
    n = len(tree.parent)
    length, linked, ends = [0] * n, [0] * n, [0] * n
    parent, tag = tree.parent, tree.tag
    for i in range(n - 1, -1, -1):
        if tree.kind[i] == TEXT:
            text = tree.text[i].strip()
            length[i] = len(text)
            ends[i] = text.count(". ") + text.endswith((".", "!", "?", "…", "。"))
        elif tag[i] == "a":
            linked[i] = length[i]
        p = parent[i]
        if p >= 0:
            length[p] += length[i]
            linked[p] += linked[i]
            ends[p] += ends[i]
    inside = [""] * n
    for i in range(n):
        inside[i] = tag[i] if tag[i] in REGIONS else inside[parent[i]] if i else ""
    return [
        (
            tag[i],
            inside[i],
            tree.names[i],
            _size(length[i]),
            linked[i] * 4 // max(length[i], 1),
            min(ends[i], 2),
        )
        for i in range(n)
    ]


def _features(signature: tuple) -> list[str]:
    tag, inside, names, size, links, ends = signature
    found = [f"tag {tag}", f"in {inside}", f"size {tag == '#text'} {size}", f"ends {tag == '#text'} {ends}"]
    if tag != "#text":
        found.append(f"links {links}")
    return found + [f"name {w}" for w in dict.fromkeys(NAME.findall(names))]


@dataclass(frozen=True)
class Model:
    """Log-odds of features, and edge potentials by kind of child, parent and child state."""

    weights: dict[str, float]
    edges: tuple[tuple[float, float, float, float], ...]


def marginals(tree: Tree, odds: list[float], edges: tuple) -> tuple[list[float], list[float]]:
    """Exact log-odds of each node by sum-product, and the messages that went up.

    A message is the log-odds that it adds. Edges hold, for a child's kind, potentials of
    (parent, child) states 00, 01, 10 and 11.
    """
    n = len(odds)
    log, exp = math.log, math.exp
    belief, up = list(odds), [0.0] * n
    tables = [tuple(exp(v) for v in e) for e in edges]
    parent, kind = tree.parent, tree.kind
    for i in range(n - 1, 0, -1):
        e = tables[kind[i]]
        x = exp(min(max(belief[i], -40.0), 40.0))
        up[i] = log((e[2] + e[3] * x) / (e[0] + e[1] * x))
        belief[parent[i]] += up[i]
    for i in range(1, n):
        e = tables[kind[i]]
        x = exp(min(max(belief[parent[i]] - up[i], -40.0), 40.0))
        belief[i] += log((e[1] + e[3] * x) / (e[0] + e[2] * x))
    return belief, up


def fit(pages: list[str], rounds: int = 25, rate: float = 0.3, ridge: float = 0.002) -> Model:
    """The most likely weights for pages with marks, by gradient steps after each page."""
    known = []
    for page in pages:
        tree = parse(page)
        state: list[int] = []
        for p, mark in zip(tree.parent, tree.mark):
            state.append(int(mark == "m") if mark else state[p] if p >= 0 else 0)
        known.append((tree, state, [_features(s) for s in signatures(tree)]))
    weights = {f: 0.0 for _, _, rows in known for row in rows for f in row}
    weights |= {(kind, s): 0.0 for kind in (TEXT, INNER, OUTER) for s in range(4)}
    squares = dict.fromkeys(weights, 1.0)
    for _ in range(rounds):
        for tree, state, rows in known:
            for f, g in _gradient(tree, state, rows, weights).items():
                g -= ridge * weights[f]
                squares[f] += g * g
                weights[f] += rate * g / math.sqrt(squares[f])
    return Model({f: w for f, w in weights.items() if isinstance(f, str)}, _edges(weights))


def _edges(weights: dict) -> tuple:
    return tuple(tuple(weights[kind, s] for s in range(4)) for kind in (TEXT, INNER, OUTER))


def _gradient(tree: Tree, state: list[int], rows: list[list[str]], weights: dict) -> dict:
    """How the log-likelihood of the marks of a page grows with each weight."""
    slope: dict = {}
    edges = _edges(weights)
    belief, up = marginals(tree, [sum(weights[f] for f in row) for row in rows], edges)
    tables = [[math.exp(v) for v in e] for e in edges]
    for i, row in enumerate(rows):
        miss = state[i] - 1 / (1 + math.exp(-min(max(belief[i], -40.0), 40.0)))
        for f in row:
            slope[f] = slope.get(f, 0.0) + miss
        if i == 0:
            continue
        p, kind = tree.parent[i], tree.kind[i]
        t = tables[kind]
        # joint chances of both: the parent without this child, the child without its parent
        x = math.exp(min(max(belief[p] - up[i], -40.0), 40.0))
        below = belief[i] - math.log((t[1] + t[3] * x) / (t[0] + t[2] * x))
        y = math.exp(min(max(below, -40.0), 40.0))
        joint = [t[0], t[1] * y, t[2] * x, t[3] * x * y]
        total = sum(joint)
        for s in range(4):
            g = (s == 2 * state[p] + state[i]) - joint[s] / total
            slope[kind, s] = slope.get((kind, s), 0.0) + g
    return slope


@functools.cache
def default_model() -> Model:
    """The model of the labelled pages in this package."""
    return fit(labelled_pages())


class Extractor:
    """A model with the log-odds of the signatures it has met."""

    def __init__(self, model: Model):
        self.model = model
        self.odds: dict[tuple, float] = {}

    def _odds(self, signature: tuple) -> float:
        if signature not in self.odds:
            if len(self.odds) >= 100_000:
                self.odds.clear()
            weights = self.model.weights
            self.odds[signature] = sum(weights.get(f, 0.0) for f in _features(signature))
        return self.odds[signature]

    def text(self, page: str | None) -> str:
        """The main text of a page, its blocks joined by one space."""
        if not page:
            return ""
        tree = parse(page)
        belief, _ = marginals(tree, [self._odds(s) for s in signatures(tree)], self.model.edges)
        out, last = [], -1
        for i, kind in enumerate(tree.kind):
            if kind == TEXT and belief[i] >= 0:
                if tree.breaks[i] != last:
                    out.append(" ")
                    last = tree.breaks[i]
                out.append(tree.text[i])
        return " ".join("".join(out).split())


_extractors: dict[int, Extractor] = {}


def _extractor(model: Model) -> Extractor:
    key = hash((model.edges, tuple(sorted(model.weights.items()))))
    return _extractors.setdefault(key, Extractor(model))


def main_text(page: Column, model: Model | None = None) -> Column:
    """The main text of a whole page; empty for null and empty pages and those without any."""
    ship()
    model = model or default_model()

    @F.arrow_udf("string")
    def extract(pages: pa.Array) -> pa.Array:
        own = _extractor(model)
        texts = [own.text(p.as_py()) for p in pages]
        return pa.array([t.encode("utf-8", "replace").decode() for t in texts], pa.string())

    return extract(page)


def extract(
    pages: DataFrame, model: Model | None = None, page: str = "html", text: str = "text"
) -> DataFrame:
    """``pages`` with the main text of each row; a column called ``text`` is replaced.

    White space inside a block becomes one space, blocks are joined by one in page order, and
    nothing is cut. Rows are read one by one: repeats get equal texts, other columns stay, and
    an empty table stays empty.
    """
    return pages.withColumn(text, main_text(F.col(page).cast("string"), model))
