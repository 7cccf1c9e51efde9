"""Main text of web pages: boosted trees over DOM nodes and a consistent choice over the tree.

Each element gets features: its tag, the words of its class, id and role (weighed by how
often they mark content in training), text and link density of its subtree, depth,
place among its siblings, and the same of its parent. Gradient-boosted trees give the
probability that its text is main text. The choice over the page is made as a whole:
an element inside a dropped one is dropped, and under that rule the choice of highest
total log-likelihood is found in one pass up and one down the tree.

Pages carry no labels. Training uses a bounded, hashed sample of pages that mark their
article themselves, as they are and rebuilt into layouts whose parts are known.
"""

import html
import random
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import string_texts

SAMPLE = 400
SAMPLE_CHARS = 60_000
TREES = 40
DEPTH = 4
RATE = 0.3
BINS = 32
BATCH = 256

# Kinds of HTML elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
UNSEEN = frozenset("script style noscript template svg iframe object canvas title".split())
# What may stand in a head; anything else ends it, as its closing tag may be left out.
IN_HEAD = frozenset("base basefont bgsound link meta script style noscript template title".split())
INLINE = frozenset(
    "math mfrac mi mn mo mover mrow ms msqrt mstyle msub msubsup msup mtext munder semantics "
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q ruby rt s samp "
    "small span strike strong sub sup time tt u var wbr".split()
)
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 "
    "h5 h6 header hgroup hr main menu nav ol p pre search section summary table ul".split()
)
# An opening tag ends these open elements, up to the nearest of the elements that scope it.
IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}), "tbody": ({"tr", "td", "th", "thead", "tbody"}, {"table"}),
}
TAGS = (
    "html body div section article main aside nav header footer form ul ol li p h1 h2 h3 h4 blockquote pre table tr td "
    "a span b em figure figcaption details button label input select textarea dl dd dt img"
).split()
# Names of page parts that rebuilt layouts use.
CONTENT_NAMES = (
    "content article post entry story main body text post-content entry-content article-body story-body page-content "
    "main-content blog-post articleBody richtext prose markdown single"
).split()
OTHER_NAMES = (
    "nav menu navbar breadcrumb breadcrumbs topbar site-header masthead banner logo toolbar pagination footer site-footer "
    "copyright legal colophon sidebar aside widget related recommended trending more-stories popular also-like rail notice "
    "cookie cookie-banner consent gdpr alert popup modal overlay newsletter subscribe signup paywall ad ads advert "
    "advertisement sponsor sponsored promo promoted adsbygoogle search login form contact share social tags author-box "
    "comments comment comment-list reply discussion disqus reviews respond skip-link"
).split()

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style|(?:noscript|template|svg|iframe|title|textarea)(?![^>]*/>))\b[^>]*>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?/][^>]*>",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_LABEL = re.compile(r"data-y=(\d)")
_NAME = re.compile(r"[a-z]+")


class Page:
    """Elements of a page in document order, and its pieces of text."""

    def __init__(self, source: str) -> None:
        self.tags, self.parent, self.attributes = ["html"], [-1], [""]
        # pieces: (element, block number, text as written)
        self.pieces: list[tuple[int, int, str]] = []
        self._read(source)

    def _read(self, source: str) -> None:
        open_, block, at = [0], 0, 0
        tags, parent, attributes, pieces = self.tags, self.parent, self.attributes, self.pieces
        unseen, in_head = 0, False
        for match in _TAG.finditer(source):
            if match.start() > at and not unseen:
                # a head also ends at text
                in_head = in_head and source[at : match.start()].isspace()
                if not in_head:
                    pieces.append((open_[-1], block, source[at : match.start()]))
            at = match.end()
            closing, name, rest = match.group(2, 3, 4)
            if name is None:
                continue
            name = name.lower()
            if name not in INLINE:
                block += 1
            elif name == "br" and not unseen:
                pieces.append((open_[-1], block, " "))
            if name == "head":
                in_head = not closing
                continue
            if not closing and name not in IN_HEAD:
                in_head = False
            if name in UNSEEN:
                # one that is closed within its tag holds nothing
                if closing or not rest.endswith("/"):
                    unseen = 0 if closing else unseen + 1
                continue
            if closing:
                for k in range(len(open_) - 1, 0, -1):
                    if tags[open_[k]] == name:
                        del open_[k:]
                        break
                continue
            if name == "html":
                continue
            if name == "body":
                unseen = 0
            self._close_implied(open_, name)
            tags.append(name)
            parent.append(open_[-1])
            attributes.append(rest or "")
            if name not in VOID and not (rest or "").endswith("/"):
                open_.append(len(tags) - 1)
        if at < len(source) and not unseen:
            pieces.append((open_[-1], block, source[at:]))

    def _close_implied(self, open_: list[int], name: str) -> None:
        tags = self.tags
        ends, scope = IMPLIED.get(name, (None, None))
        if ends is None and name in CLOSES_P:
            ends, scope = {"p"}, {"div", "article", "section", "body", "td", "li", "main", "aside", "form", "blockquote"}
        if ends is None:
            return
        for k in range(len(open_) - 1, 0, -1):
            if tags[open_[k]] in scope:
                return
            if tags[open_[k]] in ends:
                del open_[k:]
                if name not in ("tr", "tbody"):
                    return

    def names(self, node: int) -> list[str]:
        """Words of an element's class, id and role."""
        if "=" not in self.attributes[node]:
            return []
        values = (v for m in _ATTRIBUTE.findall(self.attributes[node]) for v in m[1:] if v)
        found = []
        for value in values:
            for part in value.split():
                words = _NAME.findall(re.sub(r"([a-z])([A-Z])", r"\1 \2", part).lower())
                found += words
                if len(words) > 1:
                    found.append("-".join(words))
        return found

    def plain_inline(self) -> np.ndarray:
        """Elements within a line and without a name: they go with their parent."""
        return np.array([t in INLINE and not self.names(k) for k, t in enumerate(self.tags)])

    def labels(self) -> np.ndarray:
        """Training labels that rebuilt pages carry; -1 without one."""
        found = [_LABEL.search(a) for a in self.attributes]
        return np.array([int(m.group(1)) if m else -1 for m in found])


N_NUMERIC = 21


def features(page: Page, weights: dict[str, float]) -> np.ndarray:
    """One row of features per element."""
    n = len(page.tags)
    own = np.zeros(n)
    marks = np.zeros(n)
    first = np.full(n, np.inf)
    offset = 0
    for node, _, text in page.pieces:
        size = len(text.strip())
        own[node] += size
        marks[node] += text.count(".") + text.count(",")
        first[node] = min(first[node], offset)
        offset += size
    parent = page.parent
    text, stops, tags, links, paragraphs, items = own.copy(), marks.copy(), np.ones(n), np.zeros(n), np.zeros(n), np.zeros(n)
    depth, place, siblings = np.zeros(n), np.zeros(n), np.zeros(n)
    highest, lowest = np.zeros(n), np.zeros(n)
    for node in range(n):
        up = parent[node]
        if up >= 0:
            depth[node] = depth[up] + 1
            place[node] = siblings[up]
            siblings[up] += 1
        known = [weights[w] for w in page.names(node) if w in weights]
        if known:
            highest[node], lowest[node] = max(known), min(known)
    above = np.zeros(n)
    for node in range(1, n):
        above[node] = min(above[parent[node]], lowest[parent[node]])
    for node in range(n - 1, 0, -1):
        up, tag = parent[node], page.tags[node]
        text[up] += text[node]
        stops[up] += stops[node]
        tags[up] += tags[node]
        links[up] += text[node] if tag == "a" else links[node]
        paragraphs[up] += paragraphs[node] + (tag == "p")
        items[up] += items[node] + (tag == "li")
        first[up] = min(first[up], first[node])
    up = np.maximum(np.array(parent), 0)
    total = max(1.0, text[0])
    size, link = np.log1p(text), links / np.maximum(text, 1)
    numeric = np.stack(
        [
            size, np.log1p(own), text / total, text / tags, link, stops / np.maximum(text, 1), np.log1p(paragraphs),
            np.log1p(items), np.log1p(tags), depth, place, siblings[up], place / np.maximum(siblings[up], 1),
            np.where(np.isfinite(first), first, 0) / total, highest, lowest, above, size[up], link[up], text[up] / total,
            text / np.maximum(text[up], 1),
        ],
        axis=1,
    )
    tag_no = {t: k for k, t in enumerate(TAGS)}
    kinds = np.zeros((n, 2 * len(TAGS)))
    own_kind = np.array([tag_no.get(t, -1) for t in page.tags])
    at = np.flatnonzero(own_kind >= 0)
    kinds[at, own_kind[at]] = 1
    parent_kind = own_kind[up]
    at = np.flatnonzero(parent_kind >= 0)
    kinds[at, len(TAGS) + parent_kind[at]] = 1
    return np.concatenate([numeric, kinds], axis=1)


class Boosted:
    """Gradient-boosted trees of fixed depth for a yes-or-no label, over binned features."""

    def __init__(self) -> None:
        self.base = 0.0
        self.trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def fit(self, x: np.ndarray, y: np.ndarray) -> "Boosted":
        edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS)[1:-1])) for f in range(x.shape[1])]
        binned = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)], axis=1)
        share = np.clip(y.mean(), 0.01, 0.99)
        self.base = float(np.log(share / (1 - share)))
        margin = np.full(len(y), self.base)
        for _ in range(TREES):
            p = 1 / (1 + np.exp(-margin))
            feature, cut, leaf, where = self._grow(binned, edges, y - p, p * (1 - p))
            self.trees.append((feature, cut, leaf))
            margin += leaf[where]
        return self

    def _grow(self, binned, edges, gradient, curvature):
        inner = 2**DEPTH - 1
        feature, cut = np.zeros(inner, np.int64), np.full(inner, np.inf)
        node = np.zeros(len(gradient), np.int64)
        for level in range(DEPTH):
            base, width = 2**level - 1, 2**level
            local = node - base
            best = np.full(width, 1e-6)
            chosen = np.full((width, 2), -1)
            g_all = np.bincount(local, gradient, width)
            h_all = np.bincount(local, curvature, width)
            for f, e in enumerate(edges):
                if not len(e):
                    continue
                cells = len(e) + 1
                key = local * cells + binned[:, f]
                g = np.bincount(key, gradient, width * cells).reshape(width, cells).cumsum(1)[:, :-1]
                h = np.bincount(key, curvature, width * cells).reshape(width, cells).cumsum(1)[:, :-1]
                rest_g, rest_h = g_all[:, None] - g, h_all[:, None] - h
                gain = g**2 / (h + 1) + rest_g**2 / (rest_h + 1) - (g_all**2 / (h_all + 1))[:, None]
                top = gain.argmax(1)
                value = gain[np.arange(width), top]
                better = value > best
                best[better] = value[better]
                chosen[better, 0], chosen[better, 1] = f, top[better]
            for k in range(width):
                if chosen[k, 0] >= 0:
                    feature[base + k], cut[base + k] = chosen[k, 0], edges[chosen[k, 0]][chosen[k, 1]]
            picked = np.maximum(chosen[local, 0], 0)
            right = (chosen[local, 0] >= 0) & (binned[np.arange(len(node)), picked] > chosen[local, 1])
            node = 2 * node + 1 + right
        where = node - inner
        g, h = np.bincount(where, gradient, 2**DEPTH), np.bincount(where, curvature, 2**DEPTH)
        return feature, cut, RATE * g / (h + 1), where

    def margin(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for feature, cut, leaf in self.trees:
            node = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                node = 2 * node + 1 + (x[rows, feature[node]] > cut[node])
            total += leaf[node - (2**DEPTH - 1)]
        return total


def decode(parent: list[int], margin: np.ndarray) -> np.ndarray:
    """Which elements are kept: nothing below a dropped element, highest total log-likelihood; ties are kept."""
    keep = (-np.logaddexp(0, -margin)).tolist()
    drop = (-np.logaddexp(0, margin)).tolist()
    choice = [False] * len(parent)
    for node in range(len(parent) - 1, 0, -1):
        up = parent[node]
        choice[node] = keep[node] >= drop[node]
        keep[up] += max(keep[node], drop[node])
        drop[up] += drop[node]
    kept = np.zeros(len(parent), bool)
    kept[0] = True
    for node in range(1, len(parent)):
        kept[node] = kept[parent[node]] and choice[node]
    return kept


def blocks(page: Page, kept: np.ndarray) -> str:
    """Text of the kept elements: white space joined within a block, blocks by line feeds."""
    lines: list[str] = []
    last = None
    for node, block, text in page.pieces:
        if not kept[node]:
            continue
        if block != last:
            lines.append(text)
            last = block
        else:
            lines[-1] += text
    plain = (" ".join(html.unescape(line).split()) for line in lines)
    return "\n".join(line for line in plain if line)


class Extractor:
    def __init__(self, weights: dict[str, float], trees: Boosted) -> None:
        self.weights, self.trees = weights, trees

    def extract(self, sources: list[str]) -> list[str]:
        pages = [Page(s) for s in sources]
        rows = [features(p, self.weights) for p in pages]
        margins = self.trees.margin(np.concatenate(rows)) if rows else np.zeros(0)
        found, at = [], 0
        for page in pages:
            size = len(page.tags)
            margin = np.where(page.plain_inline(), 0.0, margins[at : at + size])
            found.append(blocks(page, decode(page.parent, margin)))
            at += size
        return found


def _own_article(page: Page) -> int | None:
    """The element that a page itself marks as its article, if there is just one."""
    marked = [k for k, t in enumerate(page.tags) if t == "article"] or [k for k, t in enumerate(page.tags) if t == "main"]
    return marked[0] if len(marked) == 1 else None


def _inside(page: Page, root: int) -> np.ndarray:
    inside = np.zeros(len(page.tags), bool)
    for node in range(len(page.tags)):
        inside[node] = node == root or (page.parent[node] >= 0 and inside[page.parent[node]])
    return inside


def rebuilt(paragraphs: list[str], others: list[str], rng: random.Random) -> str:
    """A page of known parts: paragraphs of an article, and texts of other pages around and inside it."""
    escape = lambda t: html.escape(t, quote=False)
    some = lambda: escape(rng.choice(others))

    def part() -> str:
        name, tag = rng.choice(OTHER_NAMES), rng.choice(["div", "div", "section", "aside", "ul", "nav", "form", "header", "footer"])
        mark = rng.choice([f'class="{name}"', f'id="{name}"', f'class="{name} {rng.choice(["box", "inner", "x1", "wrap"])}"', ""])
        if not mark and tag in ("div", "section", "ul"):
            tag = rng.choice(["aside", "nav", "form", "footer"])
        style = rng.random()
        if tag in ("ul", "nav") or style < 0.25:
            item = lambda: f'<li data-y=0><a href="/x" data-y=0>{" ".join(some().split()[:3])}</a></li>'
            inner = "<ul data-y=0>" + "".join(item() for _ in range(rng.randint(2, 9))) + "</ul>"
        elif tag == "form":
            inner = f"<label data-y=0>{some()[:30]}</label><input data-y=0><button data-y=0>{some()[:12]}</button>"
        elif "comment" in name or style < 0.5:
            say = lambda: f'<div class="{rng.choice(["comment", "item", "entry-item", "reply"])}" data-y=0><p data-y=0>{some()}</p></div>'
            inner = "".join(say() for _ in range(rng.randint(1, 5)))
        else:
            inner = rng.choice([some(), f"<p data-y=0>{some()}</p>", f"<h3 data-y=0>{some()[:40]}</h3><p data-y=0>{some()}</p>"])
        return f"<{tag} {mark} data-y=0>{inner}</{tag}>"

    body = [f"<h1 data-y=1>{escape(paragraphs[0])[:80]}</h1>"] if rng.random() < 0.8 else []
    for text in paragraphs:
        shape = rng.random()
        if shape < 0.85:
            body.append(f"<p data-y=1>{escape(text)}</p>")
        elif shape < 0.92:
            body.append(f"<ul data-y=1><li data-y=1>{escape(text)}</li><li data-y=1>{escape(text[::-1])}</li></ul>")
        else:
            body.append(f"<blockquote data-y=1><p data-y=1>{escape(text)}</p></blockquote>")
        if rng.random() < 0.08:
            body.append(part())
    if rng.random() < 0.3:
        body.append(part())
    tag = rng.choice(["article", "article", "main", "div", "section"])
    mark = "" if tag == "article" and rng.random() < 0.6 else f'class="{rng.choice(CONTENT_NAMES)}"'
    main = f"<{tag} {mark} data-y=1>{''.join(body)}</{tag}>"
    parts = [part() for _ in range(rng.randint(0, 3))] + [main] + [part() for _ in range(rng.randint(0, 4))]
    if rng.random() < 0.4:
        parts = [f'<div class="{rng.choice(["container", "wrapper", "page", "site", "row"])}">', *parts, "</div>"]
    return f"<html><body>{''.join(parts)}</body></html>"


def train(sources: list[str]) -> Extractor:
    """Fit on pages that mark their article, and on layouts rebuilt from their texts."""
    rng = random.Random(11)
    pages = [(p, root) for p in map(Page, sources) if (root := _own_article(p)) is not None]
    labelled: list[tuple[Page, np.ndarray]] = []
    articles, others = [], []
    for page, root in pages:
        inside = _inside(page, root)
        labelled.append((page, inside.astype(int)))
        articles.append([t for t in blocks(page, inside).split("\n") if t][1:] or [blocks(page, inside)])
        others += [t for t in blocks(page, ~inside).split("\n") if t]
    articles = [a for a in articles if a and a[0]] or [["Text of an article, with a second clause.", "Another line of it."]]
    pool = others[:500] + [t for a in articles for t in a][:500] + ["Home", "About us"]
    for article in articles * max(1, SAMPLE // len(articles)):
        page = Page(rebuilt(article, pool, rng))
        labelled.append((page, page.labels()))
    counts: dict[str, list[int]] = {}
    for page, labels in labelled:
        for node, label in enumerate(labels):
            if label >= 0:
                for word in set(page.names(node)):
                    counts.setdefault(word, [0, 0])[label] += 1
    weights = {w: float(np.log((c[1] + 0.5) / (c[0] + 0.5))) for w, c in counts.items() if sum(c) >= 3}
    x = np.concatenate([features(p, weights)[labels >= 0] for p, labels in labelled])
    y = np.concatenate([labels[labels >= 0] for _, labels in labelled]).astype(float)
    return Extractor(weights, Boosted().fit(x, y))


def sample(pages: DataFrame, source: str) -> list[str]:
    """The hashed sample of distinct pages that training reads, at most SAMPLE of at most SAMPLE_CHARS."""
    keyed = pages.select(F.col(source).alias("html"), F.xxhash64(source).alias("order")).where(
        F.length("html").between(1, SAMPLE_CHARS)
    )
    # keys alone are ranked, so that no task gathers the pages of all others
    first = keyed.select("order").distinct().orderBy("order").limit(SAMPLE)
    chosen = keyed.join(F.broadcast(first), "order").dropDuplicates(["order"]).orderBy("order")
    return [r.html for r in chosen.collect()]


def main_texts(pages: DataFrame, page_id: str = "page_id", url: str = "url", source: str = "html") -> DataFrame:
    """Per page: page_id, url, text and n_chars. NULL or empty html gives an empty text; every row gives a row."""
    shared = pages.sparkSession.sparkContext.broadcast(train(sample(pages, source)))
    chosen = pages.select(
        F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.col(source).cast("string").alias("html")
    )
    kinds = [f"{f.name} {f.dataType.simpleString()}" for f in chosen.schema.fields[:2]]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        extractor = shared.value
        for batch in batches:
            column = string_texts(batch, 2)
            for at in range(0, batch.num_rows, BATCH):
                found = extractor.extract(column.slice(at, BATCH).to_pylist())
                rows = batch.slice(at, BATCH)
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), rows.column(1), pa.array(found, pa.string()), pa.array(map(len, found), pa.int64())],
                    ["page_id", "url", "text", "n_chars"],
                )

    return chosen.mapInArrow(work, f"{kinds[0]}, {kinds[1]}, text string, n_chars long")
