"""Main text of web pages: boosted trees over DOM nodes, decoded down the tree.

Every element gets features of its subtree (text and link density, size), its tag and
attribute words, its depth and its siblings.  Gradient-boosted trees give the probability
that it belongs to the main text.  Decoding maximises the product of the nodes' chosen
probabilities under the rule that nothing below a dropped element is kept.

Pages carry no labels, so the trees learn from the pages that mark their main text
themselves (``article``, ``main``): nodes on the way to and inside it are kept, named
furniture is dropped.  Each training page is also taken with its tags and attribute
words renamed and with further furniture put in, so that no single sign decides.
"""

from __future__ import annotations

import html as references
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratingloom.llm.common import first_by_hash

# Training takes at most so many pages, of at most so many code points.
SAMPLE_PAGES, SAMPLE_CHARS = 400, 40_000

# HTML's elements by what they mean for text.
_VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
_RAW = frozenset("script style textarea title noscript template iframe svg".split())
_BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav "
    "ol optgroup option p pre section summary table tbody td tfoot th thead tr ul".split()
)
_ENDS_P = _BLOCK - {"html", "head", "body", "option", "optgroup", "summary", "legend", "caption"}
# Elements that an open element of these kinds ends when no other of the stops lies between.
_CLOSES = {
    "li": (("li",), ("ul", "ol", "menu", "dir")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr",), ("table",)),
    "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")),
    "option": (("option",), ("select",)),
}
_FURNITURE_TAGS = frozenset(
    "nav header footer aside form script style noscript template head button select dialog menu "
    "iframe svg textarea title input label".split()
)
_MAIN_TAGS = frozenset("article main".split())
_FURNITURE_WORDS = frozenset(
    "ad ads advert advertisement adsense banner sponsor sponsored promo promotion nav navbar "
    "navigation menu menubar breadcrumb breadcrumbs header masthead footer foot sidebar side aside "
    "rail widget related recommended popular trending share sharing social cookie cookies consent "
    "gdpr notice notification alert popup modal overlay newsletter subscribe subscription signup "
    "login register search form comment comments reply replies discussion disqus respond feedback "
    "toolbar tags pagination pager copyright legal disclaimer skip".split()
)
_MAIN_WORDS = frozenset(
    "article content main body post entry story text page prose hentry articlebody".split()
)

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(
    r"(?:class|id|role|itemprop|aria-label)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))", re.I
)
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_BLANKS = re.compile(r"[\s]+")


@dataclass
class Tree:
    """Elements in page order, root first, and the texts between tags with their owner."""

    tag: list[str]
    parent: list[int]
    words: list[tuple[str, ...]]
    text: list[tuple[int, str]]


def parse(page: str) -> Tree:
    """Read markup as a browser would, roughly: optional end tags, raw text, broken nesting."""
    tree = Tree(["#root"], [-1], [()], [])
    stack, at = [0], 0
    places: dict[str, list[int]] = {}  # where in the stack elements of a name are open

    def innermost(names: tuple[str, ...]) -> int:
        return max((places[n][-1] for n in names if places.get(n)), default=0)

    def close(names: tuple[str, ...], stops: tuple[str, ...]) -> None:
        depth = innermost(names)
        if depth > innermost(stops):
            for node in stack[depth:]:
                places[tree.tag[node]].pop()
            del stack[depth:]

    while True:
        found = _TOKEN.search(page, at)
        if found is None:
            break
        if found.start() > at:
            tree.text.append((stack[-1], page[at : found.start()]))
        at = found.end()
        if found[2] is None:
            continue
        name = found[2].lower()
        if found[1]:
            stops = () if name in _BLOCK else ("td", "th", "table", "body", "article", "div")
            close((name,), stops)
            continue
        if name in _ENDS_P:
            close(("p",), ("table", "button", "td", "th", "div", "article", "section", "li"))
        if name in _CLOSES:
            close(*_CLOSES[name])
        if name == "br":
            tree.text.append((stack[-1], " "))  # white space where it stands
        names: list[str] = []
        if found[3] and "=" in found[3]:
            for a in _ATTRIBUTE.findall(found[3]):
                names += [w.lower() for w in _NAME.findall(a[0] or a[1] or a[2])]
        tree.tag.append(name)
        tree.parent.append(stack[-1])
        tree.words.append(tuple(names))
        node = len(tree.tag) - 1
        if name in _RAW and not found[3].endswith("/"):
            end = re.compile(rf"</{re.escape(name)}(?=[\s/>]|\Z)[^>]*>?", re.I).search(page, at)
            tree.text.append((node, page[at : end.start() if end else len(page)]))
            at = end.end() if end else len(page)
        elif name not in _VOID and not found[3].endswith("/"):
            places.setdefault(name, []).append(len(stack))
            stack.append(node)
    if at < len(page):
        tree.text.append((stack[-1], page[at:]))
    return tree


def node_features(tree: Tree) -> np.ndarray:
    """One row per element; subtree sums are taken from the last element to the first."""
    n = len(tree.tag)
    parent = np.array(tree.parent)
    tag = tree.tag
    own = np.zeros((n, 4))  # letters and blanks, of them in links, elements, block elements
    for node, text in tree.text:
        own[node, 0] += len(text)
    link = [t == "a" for t in tag]
    good, bad = np.zeros(n), np.zeros(n)
    depth, in_link = np.zeros(n), np.zeros(n, bool)
    for i in range(n):
        p = tree.parent[i]
        depth[i] = depth[p] + 1 if p >= 0 else 0
        in_link[i] = link[i] or (p >= 0 and in_link[p])
        good[i] = sum(w in _MAIN_WORDS for w in tree.words[i])
        bad[i] = sum(w in _FURNITURE_WORDS for w in tree.words[i])
    own[:, 1] = own[:, 0] * in_link
    own[:, 2] = 1
    own[:, 3] = [t in _BLOCK for t in tag]
    total = own.copy()
    for i in range(n - 1, 0, -1):
        total[parent[i]] += total[i]
    children = np.bincount(parent[1:], minlength=n)
    order = np.zeros(n)
    seen = np.zeros(n)
    for i in range(1, n):
        order[i] = seen[parent[i]]
        seen[parent[i]] += 1
    up = np.maximum(parent, 0)
    siblings = np.maximum(children[up], 1)
    letters = total[:, 0]
    columns = [
        np.log1p(letters), total[:, 1] / (letters + 1), letters / total[:, 2],
        letters / (letters[up] + 1), letters / (letters[0] + 1), np.log1p(own[:, 0]),
        own[:, 0] / (letters + 1), np.log1p(total[:, 3]), np.log1p(children), depth,
        order / siblings, np.log1p(siblings), good > 0, bad > 0, good[up] > 0, bad[up] > 0,
        [t in _FURNITURE_TAGS for t in tag], [t in _MAIN_TAGS for t in tag],
        [tag[p] in _FURNITURE_TAGS for p in up], [tag[p] in _MAIN_TAGS for p in up],
        [t in ("p", "h1", "h2", "h3", "h4", "blockquote", "pre") for t in tag],
        [t in ("li", "ul", "ol", "a") for t in tag], [t in _BLOCK for t in tag],
        [t in ("html", "body", "#root") for t in tag],
    ]
    return np.stack([np.asarray(c, np.float32) for c in columns], axis=1)


class BoostedTrees:
    """Complete regression trees of one depth, boosted on the logistic loss over binned features."""

    def __init__(self, rounds: int = 40, depth: int = 3, rate: float = 0.3, bins: int = 32):
        self.rounds, self.depth, self.rate, self.bins = rounds, depth, rate, bins
        self.cuts: list[np.ndarray] = []
        self.trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.base = 0.0

    def _binned(self, x: np.ndarray) -> np.ndarray:
        columns = [np.searchsorted(c, x[:, j], side="right") for j, c in enumerate(self.cuts)]
        return np.stack(columns, axis=1)

    def fit(self, x: np.ndarray, y: np.ndarray) -> BoostedTrees:
        share = min(max(float(y.mean()), 1e-3), 1 - 1e-3)
        self.base = float(np.log(share / (1 - share)))
        steps = np.linspace(0, 1, self.bins + 1)[1:-1]
        self.cuts = [np.unique(np.quantile(x[:, j], steps)) for j in range(x.shape[1])]
        b, width, nodes = self._binned(x), x.shape[1], 1 << self.depth
        score = np.full(len(x), self.base)
        for _ in range(self.rounds):
            p = 1 / (1 + np.exp(-score))
            slope, curve = y - p, p * (1 - p)
            at = np.zeros(len(x), int)
            feature, cut = np.zeros(nodes, int), np.full(nodes, self.bins)
            for level in range(self.depth):
                here, first = 1 << level, (1 << level) - 1
                best = np.full(here, -np.inf)
                for j in range(width):
                    key = at * (self.bins + 1) + b[:, j]
                    size = here * (self.bins + 1)
                    g = np.bincount(key, slope, size).reshape(here, -1).cumsum(1)
                    h = np.bincount(key, curve, size).reshape(here, -1).cumsum(1)
                    rest_g, rest_h = g[:, -1:] - g, h[:, -1:] - h
                    gain = g**2 / (h + 1) + rest_g**2 / (rest_h + 1)
                    top = gain.argmax(1)
                    for k in np.flatnonzero(gain[np.arange(here), top] > best):
                        best[k] = gain[k, top[k]]
                        feature[first + k], cut[first + k] = j, top[k]
                node = first + at
                at = 2 * at + (b[np.arange(len(b)), feature[node]] > cut[node])
            g = np.bincount(at, slope, nodes)
            leaf = self.rate * g / (np.bincount(at, curve, nodes) + 1)
            self.trees.append((feature, cut, leaf))
            score += leaf[at]
        return self

    def logit(self, x: np.ndarray) -> np.ndarray:
        b, rows = self._binned(x), np.arange(len(x))
        score = np.full(len(x), self.base)
        for feature, cut, leaf in self.trees:
            at = np.zeros(len(x), int)
            for level in range(self.depth):
                node = (1 << level) - 1 + at
                at = 2 * at + (b[rows, feature[node]] > cut[node])
            score += leaf[at]
        return score


def decode(tree: Tree, logit: np.ndarray) -> np.ndarray:
    """Which elements to keep: the likeliest choice in which no dropped element has a kept one below.

    Dropping is the base; ``gain`` is what keeping an element, with the best choice below
    it, adds to the log-probability.
    """
    gain = np.clip(logit, -20, 20).astype(float)
    for i in range(len(gain) - 1, 0, -1):
        gain[tree.parent[i]] += max(gain[i], 0.0)
    keep = gain > 0
    for i in range(1, len(keep)):
        keep[i] = keep[i] and keep[tree.parent[i]]
    return keep


def kept_text(tree: Tree, keep: np.ndarray) -> str:
    """Kept texts with references decoded, white space as one space; blocks are parted by two
    line feeds."""
    blocks: list[str] = []
    held: list[str] = []
    owner: dict[int, int] = {}

    def block_of(node: int) -> int:
        path = []
        while node > 0 and node not in owner and tree.tag[node] not in _BLOCK:
            path.append(node)
            node = tree.parent[node]
        found = owner.get(node, node)
        owner.update((p, found) for p in path)
        return found

    def finish() -> None:
        line = _BLANKS.sub(" ", references.unescape("".join(held))).strip()
        if line:
            blocks.append(line)
        held.clear()

    now = -1
    for node, text in tree.text:
        if not keep[node] or tree.tag[node] in _RAW:
            continue
        block = block_of(node)
        if block != now:
            finish()
            now = block
        held.append(text)
    finish()
    return "\n\n".join(blocks)


def teacher_labels(tree: Tree) -> np.ndarray | None:
    """1 for elements to keep where a page marks its main text, else no labels at all."""
    n = len(tree.tag)
    inside, furniture = np.zeros(n, bool), np.zeros(n, bool)
    for i in range(1, n):
        p = tree.parent[i]
        named = any(w in _FURNITURE_WORDS for w in tree.words[i])
        furniture[i] = furniture[p] or named or tree.tag[i] in _FURNITURE_TAGS
        inside[i] = inside[p] or tree.tag[i] in _MAIN_TAGS
    keep = inside & ~furniture
    if not keep.any():
        return None
    for i in range(n - 1, 0, -1):
        keep[tree.parent[i]] |= keep[i]
    return keep.astype(float)


# Furniture to put into training pages, and other names for main elements.
_PUT_IN = (
    '<aside class="sidebar"><h3>{0}</h3><ul><li><a href="/">{1}</a></li></ul></aside>',
    '<header class="masthead"><h1><a href="/">{0}</a></h1><p>{1}</p></header>',
    '<div class="cookie-notice"><p>{0}</p><button>{1}</button></div>',
    '<section id="comments"><h2>{0}</h2><div class="comment"><p>{1}</p><p>{0}</p></div></section>',
    '<form class="newsletter"><label>{0}</label><input name="q"><button>{1}</button></form>',
    '<div class="ad-slot sponsored"><p>{0}</p><a href="/">{1}</a></div>',
    '<div class="related"><h4>{0}</h4><p><a href="/">{1}</a></p></div>',
    '<ol class="comments"><li class="reply"><p>{1}</p></li><li><p>{0} {1}</p></li></ol>',
)
_MAIN_AS = ("<main>", '<div class="post-content">', '<div id="content">', "<div>", '<div class="c1">')


def variants(page: str, number: int) -> list[tuple[str, str]]:
    """A training page as it is and changed: (page to read features of, page to take labels of)."""
    r = np.random.default_rng(number)
    text = [t.strip() for _, t in parse(page).text if len(t.strip()) > 20] or ["text"]

    def furniture() -> str:
        a, b = (text[int(r.integers(len(text)))][: int(r.integers(10, 160))] for _ in range(2))
        return _PUT_IN[int(r.integers(len(_PUT_IN)))].format(a.replace("<", ""), b.replace("<", ""))

    inner = page.replace("</article>", furniture() + "</article>", 1)
    changed = inner.replace("<article", furniture() + "<article", 1)
    changed = changed.replace("</article>", "</article>" + furniture() + furniture(), 1)
    new = _MAIN_AS[int(r.integers(len(_MAIN_AS)))]
    end = "</main>" if new == "<main>" else "</div>"
    renamed = changed.replace("<article>", new).replace("</article>", end)
    return [(page, page), (changed, changed), (renamed, changed)]


def _examples(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        x, y = [], []
        for number, page in zip(batch["page_id"], batch["html"], strict=True):
            for seen, named in variants(page, 0 if pd.isna(number) else int(number) & 0xFFFFFFFF):
                tree, teacher = parse(seen), parse(named)
                labels = teacher_labels(teacher)
                if labels is not None and len(labels) == len(tree.tag):
                    x.append(node_features(tree).tobytes())
                    y.append(labels.astype(np.float32).tobytes())
        yield pd.DataFrame({"x": x, "y": y})


def fit_extractor(pages: DataFrame, most: int = SAMPLE_PAGES) -> BoostedTrees:
    """Train on a bounded sample of pages, first by hash of their id.

    Without a page that marks its main text, furniture is told by its names alone.
    """
    some = pages.filter(F.length("html") <= SAMPLE_CHARS).select("page_id", "html")
    some = first_by_hash(some, "page_id", most)
    rows = some.mapInPandas(_examples, "x binary, y binary").orderBy("x").toPandas()
    if rows.empty:
        page = "<html><body><nav>a</nav><article><p>{}</p></article></body></html>".format("text " * 40)
        parts = [(node_features(parse(s)), teacher_labels(parse(t))) for i in range(40) for s, t in variants(page, i)]
        parts = [(x, y) for x, y in parts if y is not None and len(x) == len(y)]
        return BoostedTrees().fit(np.vstack([x for x, _ in parts]), np.concatenate([y for _, y in parts]))
    width = node_features(parse("")).shape[1]
    x = np.vstack([np.frombuffer(b, np.float32).reshape(-1, width) for b in rows["x"]])
    y = np.concatenate([np.frombuffer(b, np.float32) for b in rows["y"]])
    return BoostedTrees().fit(x, y.astype(float))


def main_text(pages: list[str], model: BoostedTrees) -> list[str]:
    """Main text of each page; the trees see all nodes of the pages at once."""
    trees = [parse(p) for p in pages]
    sizes = [len(t.tag) for t in trees]
    if not trees:
        return []
    logit = model.logit(np.vstack([node_features(t) for t in trees]))
    ends = np.cumsum(sizes)
    return [
        kept_text(t, decode(t, logit[e - s : e])) for t, s, e in zip(trees, sizes, ends, strict=True)
    ]


def extract_text(pages: DataFrame, model: BoostedTrees, batch_pages: int = 200) -> DataFrame:
    """page_id, url, text and n_chars of every page, in one narrow pass.

    A null or empty page, and one without main text, give an empty text.  Whole pages are
    read; repeated rows give equal results, an empty table none, and other columns are
    not looked at.
    """
    kind = pages.select("page_id").schema["page_id"].dataType.simpleString()

    def extracted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), batch_pages):
                part = batch.iloc[at : at + batch_pages]
                texts = main_text(list(part["html"]), model)
                yield pd.DataFrame(
                    {"page_id": part["page_id"].to_numpy(), "url": part["url"].to_numpy(), "text": texts}
                )

    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    out = rows.mapInPandas(extracted, f"page_id {kind}, url string, text string")
    return out.withColumn("n_chars", F.length("text").cast("bigint"))
