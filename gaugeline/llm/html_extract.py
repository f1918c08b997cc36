"""Main text of web pages: boosted trees over DOM nodes, decoded along the tree.

A node's features are the size, density and links of its subtree, words of its class, id
and role, its tag and those above it, its depth and its place among siblings. Gradient
boosted trees give the probability that a subtree holds main text. Decoding then chooses
the labels of all nodes together: a node may hold main text only if its parent does, and
among those choices the most likely one is taken, so no node contradicts those above or
below it.

Pages carry no labels, so the trees are trained on pages laid out by rule, whose every
block is known: ``layouts`` pages (a documented bound) with menus, headers, adverts,
side columns, notices, forms, comments and articles in varying mark-up. Their words do not
matter, since no feature looks at words of the text.

Edge cases: a null, empty or unparsable page gives an empty text; unclosed elements end
with their parent or the page; repeated rows are extracted each; other columns, whatever
their names, are carried along; no rows give no rows.
"""

from __future__ import annotations

import pickle
import random
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .dom import Node, blocks, parsed

LAYOUTS, TREES, DEPTH, RATE, BINS = 400, 60, 4, 0.2, 32

# Words that tell what an element holds, by kind.
KINDS = {
    "nav": "nav navbar navigation menu menubar breadcrumb breadcrumbs toc pagination pager tabs skip links",
    "head": "header masthead banner topbar logo brand top",
    "foot": "footer foot copyright legal bottom colophon",
    "side": "sidebar side aside widget widgets rail column related recommended popular trending more teaser",
    "ad": "ad ads advert adverts advertisement sponsor sponsored promo promotion promoted banner dfp",
    "notice": "cookie cookies consent gdpr notice notification alert popup modal overlay dialog paywall subscribe "
              "newsletter signup",
    "form": "form search login contact input field",
    "talk": "comment comments reply replies discussion disqus respond thread reviews",
    "share": "share sharing social follow tools toolbar tags meta byline author",
    "main": "article content main post entry story text body prose page",
}
_KIND_WORDS = {kind: frozenset(words.split()) for kind, words in KINDS.items()}
TAGS = ["article", "main", "section", "div", "nav", "aside", "header", "footer", "form", "ul", "ol", "li", "p",
        "h1", "h2", "h3", "table", "td", "blockquote", "pre", "figure", "body", "html"]
_TAG = {tag: k for k, tag in enumerate(TAGS)}
_HEADINGS = frozenset(f"h{k}" for k in range(1, 7))


def node_features(root: Node) -> tuple[list[Node], np.ndarray]:
    """The nodes, parents first, and a row of features for each."""
    nodes, stack = [], [root]
    while stack:
        node = stack.pop()
        node.index = len(nodes)
        nodes.append(node)
        stack.extend(reversed(node.children))
    n = len(nodes)
    totals = np.zeros((n, 6))  # characters, linked characters, links, marks, nodes, paragraphs
    for node in nodes:
        totals[node.index] = (node.chars, node.link_chars, node.links, node.marks, 1, node.tag == "p")
    own = totals.copy()
    for node in reversed(nodes):
        if node.parent is not None:
            totals[node.parent.index] += totals[node.index]
    kinds = np.array([[not words.isdisjoint(node.tokens) for words in _KIND_WORDS.values()] for node in nodes], float)
    above = np.zeros_like(kinds)
    tags = np.full((n, 3), len(TAGS), float)
    within = np.zeros((n, 5))
    shape = np.zeros((n, 6))
    alike = [Counter(child.tag for child in node.children) for node in nodes]
    for node in nodes:
        k, parent = node.index, node.parent
        tags[k, 0] = _TAG.get(node.tag, len(TAGS))
        if parent is not None:
            p = parent.index
            above[k] = np.maximum(above[p], kinds[p])
            within[k] = within[p]
            tags[k, 1] = tags[p, 0]
            if node.place + 1 < len(parent.children):
                tags[k, 2] = _TAG.get(parent.children[node.place + 1].tag, len(TAGS))
            siblings = len(parent.children)
            shape[k] = (node.depth, node.place / siblings, siblings, alike[p][node.tag] / siblings,
                        totals[k, 0] / max(1.0, totals[p, 0]), node.tag in _HEADINGS)
        for j, tag in enumerate(("article", "main", "nav", "aside", "footer")):
            if node.tag == tag:
                within[k, j] = 1
    size = np.maximum(totals[:, 0], 1)
    share = totals[:, 0] / max(1.0, totals[0, 0])
    density = np.stack([np.log1p(totals[:, 0]), totals[:, 1] / size, np.log1p(totals[:, 2]),
                        totals[:, 3] / size, totals[:, 0] / totals[:, 4], np.log1p(totals[:, 5]), share,
                        np.log1p(own[:, 0]), own[:, 1] / np.maximum(own[:, 0], 1),
                        np.array([node.hidden for node in nodes], float)], axis=1)
    return nodes, np.concatenate([density, shape, tags, kinds, above, within], axis=1)


# --- gradient boosted trees -------------------------------------------------

class Boosted:
    """Binary classification by regression trees over binned features."""

    def __init__(self, x: np.ndarray, y: np.ndarray):
        self.edges = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1], method="lower")) for c in x.T]
        bins = self._binned(x)
        self.start = float(np.log(y.mean() / (1 - y.mean())))
        self.trees: list[tuple] = []
        total = np.full(len(y), self.start)
        for _ in range(TREES):
            p = 1 / (1 + np.exp(-total))
            tree = self._tree(bins, y - p, p * (1 - p))
            self.trees.append(tree)
            total += self._value(tree, bins)

    def _binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, c, "right") for e, c in zip(self.edges, x.T)], axis=1)

    def _tree(self, bins, g, h):
        """All nodes of a level split at once; inner nodes as (feature, bin), leaves as values."""
        size = 2 ** DEPTH
        feature, cut = np.zeros(size, np.int64), np.full(size, BINS, np.int64)
        at = np.ones(len(g), np.int64)
        for level in range(DEPTH):
            low = 2 ** level
            best = np.full(low, 1e-6)
            node = at - low
            for j in range(bins.shape[1]):
                cell = node * BINS + bins[:, j]
                gs = np.bincount(cell, g, low * BINS).reshape(low, BINS).cumsum(1)
                hs = np.bincount(cell, h, low * BINS).reshape(low, BINS).cumsum(1)
                ga, ha = gs[:, -1:], hs[:, -1:]
                gain = gs ** 2 / (hs + 1) + (ga - gs) ** 2 / (ha - hs + 1) - ga ** 2 / (ha + 1)
                gain = np.where((hs > 0.5) & (ha - hs > 0.5), gain, 0)
                k = gain.argmax(1)
                top = gain[np.arange(low), k]
                better = top > best
                best[better] = top[better]
                feature[low:2 * low][better] = j
                cut[low:2 * low][better] = k[better]
            at = 2 * at + (bins[np.arange(len(at)), feature[at]] > cut[at])
        leaf = at - size
        values = RATE * np.bincount(leaf, g, size) / (np.bincount(leaf, h, size) + 1)
        return feature, cut, values

    def _value(self, tree, bins) -> np.ndarray:
        feature, cut, values = tree
        at, rows = np.ones(len(bins), np.int64), np.arange(len(bins))
        for _ in range(DEPTH):
            at = 2 * at + (bins[rows, feature[at]] > cut[at])
        return values[at - 2 ** DEPTH]

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        bins = self._binned(x)
        return self.start + sum((self._value(tree, bins) for tree in self.trees), np.zeros(len(x)))


# --- training pages ----------------------------------------------------------

def _layout(rng: random.Random) -> tuple[str, list[bool]]:
    """A page, and for each of its block elements in order whether it holds main text."""
    out, labels = [], []

    def words(low, high):
        return " ".join("".join(rng.choice("abcdefghilmnoprstu") for _ in range(rng.randint(2, 9)))
                        for _ in range(rng.randint(low, high)))

    def prose(low, high):
        return ". ".join(words(5, 18) for _ in range(rng.randint(low, high))) + "."

    def link(low=1, high=4):
        return f'<a href="/{rng.randint(1, 99)}">{words(low, high)}</a>'

    def element(tag, main, content, name=""):
        attributes = f' {rng.choice(("class", "id"))}="{name}"' if name else ""
        labels.append(main)
        out.append(f"<{tag}{attributes}>")
        content()
        out.append("" if tag in ("p", "li") and rng.random() < 0.3 else f"</{tag}>")

    say = lambda text: lambda: out.append(text)
    named = lambda kind, chance=0.8: rng.choice(KINDS[kind].split()) if rng.random() < chance else ""

    def menu():
        for _ in range(rng.randint(3, 9)):
            element("li", False, say(link()))

    def junk(kind):
        if kind == "nav":
            tag = rng.choice(["nav", "nav", "div"])
            element(tag, False, lambda: element("ul", False, menu), named("nav", 0.3 if tag == "nav" else 1))
        elif kind == "head":
            element(rng.choice(["header", "div"]), False, lambda: (
                element(rng.choice(["p", "h1", "div"]), False, say(words(1, 6))),
                junk("nav") if rng.random() < 0.5 else None), named("head", 0.9))
        elif kind == "foot":
            tag = rng.choice(["footer", "footer", "div"])
            element(tag, False, lambda: (
                out.append("&copy; " + prose(1, 3)) if rng.random() < 0.5 else element("p", False, say(prose(1, 3))),
                junk("nav") if rng.random() < 0.3 else None), named("foot", 0.3 if tag == "footer" else 1))
        elif kind == "side":
            element(rng.choice(["aside", "div", "section"]), False, lambda: (
                element(rng.choice(["h2", "h3", "p"]), False, say(words(1, 4))),
                element("ul", False, menu) if rng.random() < 0.6 else element("p", False, say(prose(1, 3)))),
                rng.choice(KINDS["side"].split()))
        elif kind == "form":
            element("form", False, lambda: (
                element("p", False, say(words(2, 8))), out.append('<label>Name</label><input name="q"><button>Go</button>')),
                named("form", 0.5))
        elif kind == "talk":
            def one():
                element(rng.choice(["p", "div"]), False, say(words(1, 3)))
                for _ in range(rng.randint(1, 2)):
                    element("p", False, say(prose(1, 5)))
            element(rng.choice(["section", "div", "ul"]), False, lambda: [
                element(rng.choice(["div", "article", "li"]), False, one, named("talk", 0.8))
                for _ in range(rng.randint(1, 6))], rng.choice("comments comment-list discussion replies reader-comments".split()))
        else:
            element(rng.choice(["div", "section", "aside"] if kind == "ad" else ["div", "section"]), False, lambda: (
                out.append(prose(1, 2)) if rng.random() < 0.6 else element("p", False, say(prose(1, 3)))),
                rng.choice(KINDS[kind].split()))

    def article():
        if rng.random() < 0.8:
            element(rng.choice(["h1", "h1", "h2"]), True, say(words(3, 12)))
        for k in range(rng.choice([1, 1, 2, 3, 4, 5, 6, 8, 10])):
            draw = rng.random()
            if draw < 0.78:
                element("p", True, say((f"<b>{words(1, 3)}</b> " if rng.random() < 0.2 else "") + prose(1, 9)
                                       + (" " + link() if rng.random() < 0.2 else "")))
            elif draw < 0.84:
                element(rng.choice(["h2", "h3"]), True, say(words(2, 7)))
            elif draw < 0.89:
                element(rng.choice(["ul", "ol"]), True, lambda: [
                    element("li", True, say(words(3, 15))) for _ in range(rng.randint(2, 6))])
            elif draw < 0.92:
                element("blockquote", True, lambda: element("p", True, say(prose(1, 3))))
            elif draw < 0.94:
                element("table", True, lambda: [element("tr", True, lambda: [
                    element("td", True, say(words(1, 4))) for _ in range(3)]) for _ in range(rng.randint(2, 4))])
            elif k:
                junk(rng.choice(["ad", "share", "side", "notice"]))

    def body():
        for kind in ("head", "nav", "notice", "ad"):
            if rng.random() < 0.55:
                junk(kind)
        tag = rng.choice(["article", "article", "main", "div", "section"])
        name = named("main", 0.3 if tag in ("article", "main") else 0.9)
        holder = lambda: element(tag, True, article, name)
        if rng.random() < 0.3:
            element(rng.choice(["main", "div"]), True, lambda: (
                junk("ad") if rng.random() < 0.3 else None, holder(),
                junk("side") if rng.random() < 0.4 else None, junk("talk") if rng.random() < 0.3 else None),
                named("main", 0.5))
        else:
            holder()
        for kind in ("share", "side", "form", "talk", "ad", "foot"):
            if rng.random() < 0.5:
                junk(kind)
    out.append("<html><head><title>" + words(2, 6) + "</title></head><body>")
    body()
    out.append("</body></html>")
    return "".join(out), labels


def trained(layouts: int = LAYOUTS, seed: int = 7) -> Boosted:
    rng = random.Random(seed)
    xs, ys = [], []
    while len(xs) < layouts:
        page, labels = _layout(rng)
        nodes, x = node_features(parsed(page))
        if len(nodes) != len(labels) + 1:
            raise AssertionError("a training page was not read as it was laid out")
        xs.append(x)
        ys.append(np.array([any(labels), *labels], float))
    return Boosted(np.concatenate(xs), np.concatenate(ys))


# --- decoding ------------------------------------------------------------------

def decoded(nodes: list[Node], log_odds: np.ndarray) -> np.ndarray:
    """The most likely labels in which no node holds main text below one that doesn't."""
    yes, no = -np.logaddexp(0, -log_odds), -np.logaddexp(0, log_odds)
    none, some = no.copy(), yes.copy()  # best of the subtree if the node is off, or on
    for node in reversed(nodes):
        if node.parent is not None:
            p, k = node.parent.index, node.index
            none[p] += none[k]
            some[p] += max(none[k], some[k])
    on = np.zeros(len(nodes), bool)
    for node in nodes:
        k = node.index
        on[k] = some[k] > none[k] and (node.parent is None or on[node.parent.index])
    return on


def main_texts(model: Boosted, pages: list[str | None]) -> list[str]:
    roots = [parsed(p) for p in pages]
    found = [node_features(root) for root in roots]
    odds = model.log_odds(np.concatenate([x for _, x in found])) if found else np.zeros(0)
    out, at = [], 0
    for root, (nodes, x) in zip(roots, found):
        on = decoded(nodes, odds[at:at + len(nodes)])
        at += len(nodes)
        out.append("\n\n".join(blocks(root, lambda node: node.tag != "hr" and on[node.index])))
    return out


def extracted(pages: DataFrame, html_col: str = "html", layouts: int = LAYOUTS,
              carried: list[str] | None = None) -> DataFrame:
    """``row`` (the input row, or its ``carried`` columns), ``text`` and ``n_chars``."""
    shared = pages.sparkSession.sparkContext.broadcast(pickle.dumps(trained(layouts)))
    rows = pages.select(F.struct(*[pages[f"`{c}`"] for c in carried or pages.columns]).alias("row"),
                        F.col(f"`{html_col}`").alias("html"))

    def run(batches):
        model = pickle.loads(shared.value)
        for batch in batches:
            texts, group, size = [], [], 0
            for page in batch.column("html"):
                group.append(page.as_py())
                size += len(group[-1] or "")
                if size >= 1_000_000:
                    texts += main_texts(model, group)
                    group, size = [], 0
            texts += main_texts(model, group)
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(texts, pa.string()),
                                              pa.array(map(len, texts), pa.int64())], names=["row", "text", "n_chars"])
    return rows.mapInArrow(run, f"row {rows.schema['row'].dataType.simpleString()}, text string, n_chars bigint")
