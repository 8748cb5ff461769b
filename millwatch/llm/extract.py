"""Main text of pages by a tree-structured graphical model.

Every node of a page's tree, element or text, is content or not. A node's own potential is a linear score of its tag,
its names, and the length and the share of links of the text below it; parent and child are tied by a potential for
each kind of parent. On a tree, sum-product messages upward and then downward give exact marginals, here for the nodes
of many pages at once, one depth after another. Text nodes whose marginal for content is at least one half are kept.

The potentials start from documented prior weights and are fitted to labelled pages: pages that mark their main text
(article, main) and so label all of their nodes. SAMPLE of them, chosen by hash, are enough for some sixty weights.
"""

from __future__ import annotations

import html
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millwatch.llm.html_tree import TEXT, Tree
from millwatch.llm.store import map_arrow, octets_of

#: Labelled pages that the weights are fitted on, about, and the bytes of a page to be one of them.
SAMPLE = 1500
SAMPLE_BYTES = 1 << 18

#: Prior weights, for content when positive. Words stand for class, id and role names.
TAGS = {
    "article": 4.0, "main": 4.0, "nav": -5.0, "header": -3.0, "footer": -5.0, "aside": -5.0, "form": -5.0, "button": -5.0, "label": -3.0, "menu": -4.0,
    "dialog": -4.0, "fieldset": -4.0, "legend": -3.0, "head": -5.0, "p": 0.8, "h1": 2.0, "h2": 1.5, "h3": 1.2, "blockquote": 0.4, "pre": 0.4,
    "ul": -0.2, "ol": 0.0, "li": 0.0, "a": -0.4, "div": 0.0, "section": 0.2, "table": 0.0, "figure": 0.2, "figcaption": 0.2, "body": 0.0, "html": 0.0, "#root": 0.0, TEXT: 0.0, "#other": 0.0,
}
NAMES = {
    "boilerplate": (-5.0, "nav navbar navigation menu header masthead topbar footer sidebar side widget widgets ad ads advert adverts advertisement adsense sponsor sponsored promo promotion banner cookie cookies consent gdpr notice alert popup modal overlay comment comments disqus reply replies respond discussion reaction reactions social share sharing related recommended recommendations trending popular more newsletter subscribe subscription signup login search breadcrumb breadcrumbs pagination pager toc tags copyright legal disclaimer contentinfo complementary"),
    "content": (2.0, "article articlebody content maincontent main post entry story text body prose page"),
}
MEASURES = {"long text": 0.5, "links": -3.0, "sentence": 0.6, "short": -0.3}
BIAS = -0.3
_TAG = {t: i for i, t in enumerate(TAGS)}
_WORDS = {w: k for k, (_, words) in enumerate(NAMES.values()) for w in words.split()}
_SPLIT = re.compile(r"[^a-z]+")
N_WEIGHTS = len(TAGS) + len(NAMES) + len(MEASURES) + 1
PRIOR = np.array([*TAGS.values(), *(w for w, _ in NAMES.values()), *MEASURES.values(), BIAS])
#: Kinds of parent: page-wide wrappers, which hold both, and others. Prior counts of (parent, child) labels.
WRAPPERS = frozenset(("#root", "html", "body"))
PRIOR_TIES = np.array([[[60.0, 40.0], [40.0, 60.0]], [[95.0, 5.0], [8.0, 92.0]]])
#: Labelled nodes that count for a row of the ties, at most.
TIE_ROWS = 200


class Forest:
    """The nodes of several pages as arrays, parents before children, and their depths."""

    def __init__(self, trees: list[Tree]) -> None:
        sizes = [len(t.tag) for t in trees]
        self.first = np.cumsum([0, *sizes])
        shift = np.repeat(self.first[:-1], sizes)
        cat = lambda name, kind: np.array([x for t in trees for x in getattr(t, name)], kind)
        self.parent = cat("parent", np.int64)
        self.parent = np.where(self.parent >= 0, self.parent + shift, -1)
        self.depth = cat("depth", np.int64)
        tags = [x for t in trees for x in t.tag]
        names = [x for t in trees for x in t.names]
        texts = [x for t in trees for x in t.text]
        link = cat("link", bool)
        n = len(tags)
        other = _TAG["#other"]
        tag = np.array([_TAG.get(t, other) for t in tags], np.int64)
        self.is_text = tag == _TAG[TEXT]
        self.wrapper = np.array([t in WRAPPERS for t in tags], bool)
        size = np.array([len(x.strip()) for x in texts], float)
        stops = np.array([x.count(". ") + x.count(", ") + x.rstrip().endswith((".", "!", "?", ":")) for x in texts], float)
        linked = np.where(link, size, 0.0)
        order = np.argsort(self.depth, kind="stable")
        cuts = np.searchsorted(self.depth[order], np.arange(self.depth.max(initial=0) + 2))
        self.levels = [order[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        for level in reversed(self.levels[1:]):
            for sums in (size, stops, linked):
                np.add.at(sums, self.parent[level], sums[level])
        self.size = size
        x = np.zeros((n, N_WEIGHTS))
        x[np.arange(n), tag] = 1
        for i, text in enumerate(names):
            if text:
                for w in _SPLIT.split(text):
                    if w in _WORDS:
                        x[i, len(TAGS) + _WORDS[w]] = 1
        at = len(TAGS) + len(NAMES)
        x[:, at] = np.clip(np.log1p(size) - 4, -4, 4) / 2
        x[:, at + 1] = linked / np.maximum(size, 1)
        x[:, at + 2] = np.minimum(1, stops / np.maximum(1, size / 80))
        x[:, at + 3] = size < 25
        x[:, -1] = 1
        self.x = x


class Model:
    def __init__(self, weights: np.ndarray = PRIOR, ties: np.ndarray = PRIOR_TIES) -> None:
        self.weights = weights
        self.log_ties = np.log(ties / ties.sum(axis=2, keepdims=True))  # [kind of parent, parent, child]

    def marginals(self, f: Forest) -> np.ndarray:
        """Chance of content of every node, by messages up to the roots and down again."""
        n = len(f.parent)
        own = np.zeros((n, 2))
        own[:, 1] = f.x @ self.weights
        up = np.zeros((n, 2))  # what a node tells its parent
        below = own.copy()
        for level in reversed(f.levels[1:]):
            tie = self.log_ties[np.where(f.wrapper[f.parent[level]], 0, 1)]
            up[level] = np.logaddexp(tie[:, :, 0] + below[level, None, 0], tie[:, :, 1] + below[level, None, 1])
            np.add.at(below, f.parent[level], up[level])
        down = np.zeros((n, 2))
        for level in f.levels[1:]:
            parent = f.parent[level]
            tie = self.log_ties[np.where(f.wrapper[parent], 0, 1)]
            rest = below[parent] - up[level] + down[parent]
            down[level] = np.logaddexp(tie[:, 0, :] + rest[:, None, 0], tie[:, 1, :] + rest[:, None, 1])
        belief = below + down
        return 1 / (1 + np.exp(np.clip(belief[:, 0] - belief[:, 1], -500, 500)))


def labels(tree: Tree) -> np.ndarray | None:
    """1 for content, 0 for other nodes, -1 for wrappers of both, of a page that marks its main text; else None."""
    tags = tree.tag
    if sum(t in ("article", "main") for t in tags) != 1:
        return None
    out = np.zeros(len(tags), np.int64)
    inside = np.zeros(len(tags), bool)
    for i, tag in enumerate(tags):
        p = tree.parent[i]
        if p >= 0:
            inside[i] = inside[p] or tag in ("article", "main")
            off = TAGS.get(tag, 0) <= -3 or any(_WORDS.get(w) == 0 for w in _SPLIT.split(tree.names[i]) if w)
            out[i] = int(inside[i] and not off and (out[p] == 1 or tag in ("article", "main")))
    for i in range(len(tags) - 1, 0, -1):
        if inside[i] and tags[i] in ("article", "main"):
            at = tree.parent[i]
            while at >= 0:
                out[at] = -1
                at = tree.parent[at]
    return out


def fit(pages: list[str], rounds: int = 60, hold: float = 20.0) -> Model:
    """Weights nearest to the prior (as by `hold` nodes) that explain the nodes of labelled pages, and counted ties."""
    trees = [Tree(p) for p in pages]
    known = [(t, y) for t in trees if (y := labels(t)) is not None]
    if not known:
        return Model()
    f, y = Forest([t for t, _ in known]), np.concatenate([y for _, y in known])
    ties = PRIOR_TIES.copy()
    child = np.flatnonzero((f.parent >= 0) & (y >= 0))
    parent = f.parent[child]
    sure = y[parent] >= 0
    seen = np.zeros_like(ties)
    np.add.at(seen, (np.where(f.wrapper[parent[sure]], 0, 1), y[parent[sure]], y[child[sure]]), 1.0)
    # however many nodes agree, a node's own potential must be able to stand against its parent's
    ties += seen * np.minimum(1, TIE_ROWS / np.maximum(1, seen.sum(axis=2, keepdims=True)))
    some = np.flatnonzero(y >= 0)
    x, want = f.x[some], y[some]
    share = np.where(want == 1, 0.5 / max(1, (want == 1).sum()), 0.5 / max(1, (want == 0).sum())) * len(want)
    w = PRIOR.copy()
    for _ in range(rounds):  # Newton steps of a logistic fit with a normal prior
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (share * (want - p)) - hold * (w - PRIOR)
        curve = (x * (share * p * (1 - p) + 1e-9)[:, None]).T @ x + hold * np.eye(len(w))
        step = np.linalg.solve(curve, slope)
        w = w + step
        if np.abs(step).max() < 1e-6:
            break
    return Model(w, ties)


def _join(tree: Tree, keep: np.ndarray) -> str:
    """Kept texts: raw within a block, white space as one space, blocks joined by one space."""
    blocks: list[list[str]] = []
    last = None
    for i in np.flatnonzero(keep):
        if tree.tag[i] != TEXT:
            continue
        if tree.block[i] != last:
            blocks.append([])
            last = tree.block[i]
        blocks[-1].append(tree.text[i])
    return " ".join(t for b in blocks if (t := " ".join(html.unescape("".join(b)).split())))


def extract(pages: list[str], model: Model) -> list[str]:
    trees = [Tree(p) for p in pages]
    f = Forest(trees)
    chance = model.marginals(f)
    return [_join(t, chance[a:b] >= 0.5) for t, a, b in zip(trees, f.first[:-1], f.first[1:], strict=True)]


def _extract(batch: pa.RecordBatch, shared) -> dict:
    pages = [p.decode("utf-8", "replace") for p in octets_of(batch, "html")]
    texts: list[str] = []
    start = size = 0
    for i, p in enumerate(pages):
        size += len(p)
        if size > 1 << 20 or i + 1 == len(pages):
            texts += extract(pages[start : i + 1], shared.value)
            start, size = i + 1, 0
    return {"row": batch.column("row"), "text": texts}


def train(pages: DataFrame, sample: int = SAMPLE) -> Model:
    """The model of about `sample` pages of at most SAMPLE_BYTES, chosen by hash; the prior if none is labelled."""
    n = pages.count()
    part = min(1 << 20, -(-sample * (1 << 20) // max(1, n)))
    some = pages.where(F.pmod(F.xxhash64("page_id", "url"), F.lit(1 << 20)) < part).where(F.octet_length("html") <= SAMPLE_BYTES)
    return fit([r["html"] for r in some.select(F.col("html").cast("string").alias("html")).collect()])


def extract_pages(pages: DataFrame, model: Model | None = None) -> DataFrame:
    """page_id, url, text and n_chars of each row of `pages` (page_id, url, html).

    Null or empty html gives an empty text, as does a page without content. No rows move. Without a `model`, one is
    trained on the pages themselves.
    """
    shared = pages.sparkSession.sparkContext.broadcast(model or train(pages))
    rows = pages.select(F.struct("page_id", "url").alias("row"), F.col("html").cast("binary").alias("html"))
    out = map_arrow(rows, _extract, f"row {rows.schema['row'].dataType.simpleString()}, text string", shared, rows=512)
    return out.select("row.page_id", "row.url", "text", F.char_length("text").cast("long").alias("n_chars"))
