"""Main text of web pages by a tree-structured graphical model.

The DOM's elements are nodes with two states, content or not. Unary potentials come from the element itself (tag, words of
class and id, text length, links, place in the page); parent-child potentials say how far a child takes after its
parent. Sum-product messages up and down the tree give every element's exact marginal; the text of blocks whose marginal is
one half or more is the main text. Training maximises the likelihood of labelled pages with the same messages. The pages
for it are composed by ``labelled_pages``: articles with the usual surroundings in many layouts, every element labelled.
"""

from __future__ import annotations

import html as html_entities
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PAGES_AT_ONCE = 256

_START = re.compile(r"<(?:!--|[!?]|(/?)([a-zA-Z][^\s/>]*))")
_MARKS = re.compile(r"""["'>]""")
_ATTRIBUTE = re.compile(r"""(?<![^\s=/"'>])([^\s=/"'>]++)\s*+=\s*+("[^"]*"|'[^']*'|[^\s"'>]+)""")
#: Browsers, too, hang elements that are nested deeper than this beside each other.
DEEPEST = 512
_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
_INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split())
_SILENT = frozenset("script style template noscript title textarea select option iframe svg object canvas head".split())
_RAW = frozenset("script style title textarea iframe noscript".split())
#: An opening tag of the second kind ends an open element of the first.
_ENDED_BY = {"p": frozenset("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul li dt dd td th tr".split()), "li": frozenset(["li"]), "dt": frozenset("dt dd".split()), "dd": frozenset("dt dd".split()), "tr": frozenset(["tr"]), "td": frozenset("td th tr".split()), "th": frozenset("td th tr".split()), "head": frozenset(["body"])}

_TAGS = "html body div section article main nav header footer aside form p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table tbody thead tr td th blockquote pre figure figcaption button fieldset details summary address dialog menu hr".split()
#: Words of class and id by what they tell.
_WORDS = {
    "content": "article post entry story content body text main page prose blog copy single news",
    "navigation": "nav navbar navigation menu breadcrumb breadcrumbs crumbs pagination pager toc tabs skip sitemap topbar submenu",
    "header": "header masthead banner logo brand branding top hero",
    "footer": "footer copyright legal colophon bottom imprint credits foot",
    "side": "sidebar aside side rail widget widgets secondary complementary tags meta byline author bio",
    "advert": "ad ads advert adverts advertisement sponsor sponsored promo promotion adsense banner adbox commercial affiliate outbrain taboola",
    "notice": "cookie cookies consent gdpr notice alert popup modal overlay privacy warning announcement toast dialog paywall",
    "form": "form search login signup subscribe newsletter subscription register contact input",
    "comment": "comment comments reply replies respond discussion disqus responses commentlist reader readers feedback reviews thread",
    "share": "share sharing social follow like tweet facebook twitter buttons toolbar print",
    "related": "related recommended recommendations more popular trending similar latest recent also next prev",
}
_WORD_GROUP = {w: g for g, words in _WORDS.items() for w in words.split()}
_GROUPS = list(_WORDS)
_TAG_AT = {t: i for i, t in enumerate(_TAGS)}
_BASE_WORDS = len(_TAGS) + 1
_BASE_BINS = _BASE_WORDS + len(_GROUPS)
_N_FEATURES = _BASE_BINS + 4 * 5 + 1
_SUSPECT_TAGS = frozenset("nav header footer aside form button fieldset dialog menu address".split())
_KINDS = 4


@dataclass
class Page:
    """A page's elements in document order, and its text runs as (element, text)."""

    parent: list[int] = field(default_factory=list)
    depth: list[int] = field(default_factory=list)
    tag: list[str] = field(default_factory=list)
    groups: list[frozenset[str]] = field(default_factory=list)
    label: list[int] = field(default_factory=list)
    runs: list[tuple[int, str]] = field(default_factory=list)
    linked: list[int] = field(default_factory=list)


class _TagEnds:
    """Where tags end: at the first ">" outside quotes or, if quotes never close, at the first one at all.

    Each end is looked up in a table of all quotes and ">" of the page, made once from its end to its start when a tag with a quote
    comes up, so no part of a page is read again for each tag.
    """

    def __init__(self, source: str):
        self.source, self.places, self.ends, self.last = source, None, [], 0

    def after(self, at: int) -> int:
        """The place of the ">" that ends a tag whose name ends at ``at``, or -1."""
        plain = self.source.find(">", at)
        if plain < 0 or not _quoted(self.source, at, plain):
            return plain
        if self.places is None:
            self._tabulate()
        while self.last < len(self.places) and self.places[self.last] < at:
            self.last += 1
        end = self.ends[self.last] if self.last < len(self.places) else -1
        return plain if end < 0 else end

    def _tabulate(self) -> None:
        found = [(m.start(), m[0]) for m in _MARKS.finditer(self.source)]
        self.places = [place for place, _ in found]
        self.ends = [-1] * (len(found) + 1)
        following = {'"': -1, "'": -1}
        for k in range(len(found) - 1, -1, -1):
            place, mark = found[k]
            if mark == ">":
                self.ends[k] = place
            else:
                close, following[mark] = following[mark], k
                self.ends[k] = self.ends[close + 1] if close >= 0 else -1


def _quoted(source: str, start: int, end: int) -> bool:
    return source.find('"', start, end) >= 0 or source.find("'", start, end) >= 0


def parse(source: str | None) -> Page:
    """Read a page as browsers do, as far as text is concerned: missing end tags, raw elements, character references.

    Inline elements are not nodes: their text joins the block around them. Any other tag, and a line break, ends a run.
    A ``data-y`` of 0 or 1 is a label, for training only; pages at large put other values there, which say nothing.
    Time grows with the length of the page, whatever is left open in it.
    """
    source = source or ""
    page = Page([-1], [0], ["html"], [frozenset()], [0], [], [])
    stack: list[tuple[str, int]] = [("html", 0)]
    blocks: list[int] = []  # places in the stack of elements that are not inline
    opened: dict[str, int] = {}
    ends = _TagEnds(source)
    text: list[str] = []
    silent = links = linked = 0
    at = 0

    def flush() -> None:
        nonlocal linked
        run = " ".join("".join(text).split())
        if run:
            page.runs.append((stack[-1][1], run))
            page.linked.append(linked)
        text.clear()
        linked = 0

    def say(piece: str) -> None:
        nonlocal linked
        if silent or not piece:
            return
        piece = html_entities.unescape(piece) if "&" in piece else piece
        text.append(piece)
        if links:
            linked += len(piece)

    def pop() -> None:
        nonlocal silent, links
        name, _ = stack.pop()
        opened[name] -= 1
        if blocks and blocks[-1] == len(stack):
            blocks.pop()
        silent -= name in _SILENT
        links -= name == "a"

    while True:
        found = _START.search(source, at)
        if found and not found[2]:
            say(source[at : found.start()])
            if found[0] == "<!--":
                end = source.find("-->", found.end())
                at = len(source) if end < 0 else end + 3
            else:
                end = source.find(">", found.end())
                at = len(source) if end < 0 else end + 1
                if end < 0:
                    say(source[found.start() :])
            continue
        end = ends.after(found.end()) if found else -1
        if end < 0:  # no tag ends any more: what is left is text up to a comment
            comment = source.find("<!--", at)
            say(source[at : comment if comment >= 0 else len(source)])
            break
        say(source[at : found.start()])
        at, name, attributes = end + 1, found[2].lower(), source[found.end() : end]
        inline = name in _INLINE
        if not inline:
            flush()
        if found[1]:
            if opened.get(name):
                while stack[-1][0] != name:
                    pop()
                pop()
            continue
        if not inline:
            # an open paragraph, item or cell ends here, with the inline elements in it
            while blocks and name in _ENDED_BY.get(stack[blocks[-1]][0], ()):
                down = blocks[-1]
                while len(stack) > down:
                    pop()
        if name in _VOID or attributes.endswith("/") and inline:
            continue
        node = stack[-1][1]
        if name == "html":
            continue
        if not inline and name not in _SILENT:
            given = {k.lower(): v.strip("\"'").lower() for k, v in _ATTRIBUTE.findall(attributes)} if "=" in attributes else {}
            words = re.split(r"[^a-z]+", f"{given.get('class', '')} {given.get('id', '')} {given.get('role', '')}")
            above = node if page.depth[node] < DEEPEST else page.parent[node]
            page.parent.append(above)
            page.depth.append(page.depth[above] + 1)
            page.tag.append(name)
            page.groups.append(frozenset(_WORD_GROUP[w] for w in words if w in _WORD_GROUP))
            page.label.append(int(given["data-y"]) if given.get("data-y") in ("0", "1") else page.label[node])
            node = len(page.parent) - 1
        if not inline:
            blocks.append(len(stack))
        stack.append((name, node))
        opened[name] = opened.get(name, 0) + 1
        silent += name in _SILENT
        links += name == "a"
        if name in _RAW:
            end = re.compile(rf"</{re.escape(name)}\b", re.I).search(source, at)
            at = end.start() if end else len(source)
    flush()
    return page


@dataclass
class Forest:
    """The pages of a batch as one set of arrays; features are rows of indices."""

    parent: np.ndarray
    depth: np.ndarray
    kind: np.ndarray
    features: np.ndarray
    label: np.ndarray
    starts: np.ndarray

    @staticmethod
    def of(pages: list[Page]) -> Forest:
        sizes = np.array([len(p.parent) for p in pages])
        starts = np.concatenate([[0], np.cumsum(sizes)])
        parent = np.concatenate([np.where(np.array(p.parent) >= 0, np.array(p.parent) + s, -1) for p, s in zip(pages, starts, strict=False)])
        depth = np.concatenate([p.depth for p in pages])
        total = len(parent)
        own, linked = np.zeros(total), np.zeros(total)
        for p, s in zip(pages, starts, strict=False):
            for (node, run), of_links in zip(p.runs, p.linked, strict=True):
                own[s + node] += len(run)
                linked[s + node] += of_links
        below, links_below = own.copy(), linked.copy()
        for at in reversed(_levels(depth)[1:]):
            np.add.at(below, parent[at], below[at])
            np.add.at(links_below, parent[at], links_below[at])
        page_of = np.repeat(np.arange(len(pages)), sizes)
        share = below / np.maximum(1, below[starts[:-1]])[page_of]
        place = (np.arange(total) - starts[page_of]) / np.maximum(1, sizes[page_of])
        density = links_below / np.maximum(1, below)
        bins = [np.digitize(own, [1, 40, 120, 400]), np.digitize(density, [0.05, 0.3, 0.6, 0.9]), np.digitize(share, [0.02, 0.1, 0.4, 0.8]), np.digitize(place, [0.1, 0.35, 0.65, 0.9])]
        tags = [t for p in pages for t in p.tag]
        groups = [g for p in pages for g in p.groups]
        width = 1 + 4 + len(_GROUPS)
        features = np.full((total, width), _N_FEATURES - 1, np.int64)  # the last weight stays zero
        features[:, 0] = [_TAG_AT.get(t, len(_TAGS)) for t in tags]
        for k, b in enumerate(bins):
            features[:, 1 + k] = _BASE_BINS + 5 * k + b
        for i, g in enumerate(groups):
            for k, name in enumerate(sorted(g)):
                features[i, 5 + k] = _BASE_WORDS + _GROUPS.index(name)
        suspect = np.array([t in _SUSPECT_TAGS or bool(g - {"content"}) for t, g in zip(tags, groups, strict=True)])
        central = np.array([t in ("article", "main") or g == {"content"} for t, g in zip(tags, groups, strict=True)])
        leaf = np.array([t not in ("div", "section", "body", "html") for t in tags])
        kind = np.where(suspect, 1, np.where(central, 2, np.where(leaf, 3, 0)))
        return Forest(parent, depth, kind, features, np.array([y for p in pages for y in p.label]), starts)


def _levels(depth: np.ndarray) -> list[np.ndarray]:
    """The nodes of each depth, in order."""
    order = np.argsort(depth, kind="stable")
    return np.split(order, np.cumsum(np.bincount(depth))[:-1])


@dataclass
class TreeModel:
    """Unary weights for the state "content" and log potentials [kind of child, parent's state, child's state]."""

    weights: np.ndarray
    pairs: np.ndarray

    def marginals(self, forest: Forest) -> tuple[np.ndarray, np.ndarray]:
        """P(content) of every node, and the joint P(parent's state, node's state) [node, 2, 2]; a root's has only its own."""
        n = len(forest.parent)
        unary = np.zeros((n, 2))
        unary[:, 1] = self.weights[forest.features].sum(axis=1)
        pair = self.pairs[forest.kind]
        levels = _levels(forest.depth)
        up = unary.copy()  # own potential and all messages from below
        message = np.zeros((n, 2))  # to the parent
        for at in reversed(levels[1:]):
            joint = pair[at] + up[at][:, None, :]
            message[at] = np.logaddexp(joint[:, :, 0], joint[:, :, 1])
            np.add.at(up, forest.parent[at], message[at])
        belief = up.copy()
        both = np.zeros((n, 2, 2))
        both[levels[0], 0] = _normal(up[levels[0]])
        for at in levels[1:]:
            mother = forest.parent[at]
            joint = (belief[mother] - message[at])[:, :, None] + pair[at] + up[at][:, None, :]
            flat = _normal(joint.reshape(len(at), 4)).reshape(len(at), 2, 2)
            both[at] = flat
            down = np.logaddexp((joint - up[at][:, None, :])[:, 0], (joint - up[at][:, None, :])[:, 1])
            belief[at] = up[at] + down - down.max(axis=1, keepdims=True)
        return both.sum(axis=1)[:, 1], both


def _normal(logs: np.ndarray) -> np.ndarray:
    e = np.exp(logs - logs.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def train(sources: list[str], *, epochs: int = 200, rate: float = 0.08, decay: float = 1e-3) -> TreeModel:
    """Fit on pages whose elements carry labels in ``data-y``: gradient ascent, observed less expected counts."""
    forest = Forest.of([parse(s) for s in sources])
    n, y = len(forest.parent), forest.label
    inner = np.flatnonzero(forest.parent >= 0)
    seen = np.zeros((_KINDS, 2, 2))
    np.add.at(seen, (forest.kind[inner], y[forest.parent[inner]], y[inner]), 1)
    flat = np.concatenate([np.zeros(_N_FEATURES), np.zeros(_KINDS * 4)])
    moment, second = np.zeros_like(flat), np.zeros_like(flat)
    for t in range(1, epochs + 1):
        model = TreeModel(flat[:_N_FEATURES], flat[_N_FEATURES:].reshape(_KINDS, 2, 2))
        p, both = model.marginals(forest)
        unary = np.bincount(forest.features.ravel(), np.repeat(y - p, forest.features.shape[1]), _N_FEATURES)
        expected = np.zeros((_KINDS, 2, 2))
        np.add.at(expected, forest.kind[inner], both[inner])
        grad = np.concatenate([unary, (seen - expected).ravel()]) / n - decay * flat
        grad[_N_FEATURES - 1] = 0
        moment, second = 0.9 * moment + 0.1 * grad, 0.99 * second + 0.01 * grad**2
        flat = flat + rate * (moment / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.99**t)) + 1e-8)
    return TreeModel(flat[:_N_FEATURES], flat[_N_FEATURES:].reshape(_KINDS, 2, 2))


def labelled_pages(n: int, seed: int = 3) -> list[str]:
    """Articles with surroundings in many layouts; ``data-y`` labels an element and all that it holds until it is said anew."""
    rng = np.random.default_rng(seed)
    pick = lambda *options: options[rng.integers(len(options))]

    def words(low: int, high: int) -> str:
        return " ".join("".join(chr(97 + c) for c in rng.integers(0, 26, rng.integers(2, 9))) for _ in range(rng.integers(low, high))).capitalize() + "."

    def links(k: int) -> str:
        return "".join(f'<li><a href="/x">{words(1, 4)}</a></li>' for _ in range(k))

    def noise() -> str:
        some = words(3, pick(12, 40))
        return pick(
            lambda: f"<nav{pick('', ' class=main-menu', ' id=navigation')}><ul>{links(rng.integers(3, 9))}</ul></nav>",
            lambda: f'<div class="{pick("menu", "breadcrumbs", "navbar", "pagination")}"><ul>{links(rng.integers(2, 7))}</ul></div>',
            lambda: f"<header{pick('', ' class=masthead', ' id=site-header')}>{pick('<h1>', '<p>', '<div>')}{some}</header>",
            lambda: f"<footer{pick('', ' class=site-footer')}>{pick('', '<p>')}&copy; {some}{pick('', f'<ul>{links(3)}</ul>')}</footer>",
            lambda: f'<div class="{pick("footer", "copyright", "legal")}"><p>{some}</p></div>',
            lambda: f"<aside{pick('', ' class=sidebar', ' id=side')}><h3>{words(1, 4)}</h3><p>{some}</p>{pick('', f'<ul>{links(4)}</ul>')}</aside>",
            lambda: f'<div class="{pick("sidebar", "widget", "side-rail")}"><h3>{words(1, 4)}</h3><p>{some}</p></div>',
            lambda: f'<div class="{pick("ad", "ads", "advert", "sponsored", "promo-box", "ad-banner", "advertisement")}">{pick("", "<p>")}{words(3, pick(20, 60))}</div>',
            lambda: f'<div {pick("class", "id")}="{pick("cookie-notice", "consent", "gdpr", "notice", "popup", "alert", "cookies")}"><p>{some}</p><button>{words(1, 3)}</button></div>',
            lambda: f"<form{pick('', ' class=search', ' class=newsletter', ' id=login')}><p>{some}</p><label>{words(1, 3)}</label><input><button>{words(1, 2)}</button></form>",
            lambda: f'<div class="{pick("search", "newsletter", "subscribe", "signup")}"><p>{some}</p></div>',
            lambda: f'<{(t := pick("div", "section"))} {pick("class", "id")}="{pick("comments", "comment-list", "replies", "disqus", "discussion", "reader-comments")}"><h3>{words(1, 3)}</h3>' + "".join(f'<div class="{pick("comment", "reply", "comment-body")}"><p>{words(5, 60)}</p></div>' for _ in range(rng.integers(1, 6))) + f"</{t}>",
            lambda: f'<ol class="{pick("comments", "commentlist")}">' + "".join(f"<li>{words(4, 50)}</li>" for _ in range(rng.integers(1, 5))) + "</ol>",
            lambda: f'<div class="{pick("share", "social", "share-buttons")}"><a href="/s">{words(1, 3)}</a></div>',
            lambda: f'<div class="{pick("related", "popular", "recommended")}"><h3>{words(1, 4)}</h3><ul>{links(rng.integers(2, 6))}</ul></div>',
        )().replace(">", " data-y=0>", 1)

    def content() -> str:
        return pick(
            lambda: f"<p>{words(1, 120)}</p>",
            lambda: f"<p>{words(20, 200)}</p>",
            lambda: f"<p>{words(5, 60)} <a href=/y>{words(1, 3)}</a> {words(3, 40)}</p>",
            lambda: f"<p><b>{words(5, 60)}<br><p>{words(5, 60)}</p>",
            lambda: f"<{(t := pick('h1', 'h2', 'h3'))}>{words(1, 8)}</{t}>",
            lambda: "<ul>" + "".join(f"<li>{words(3, 25)}</li>" for _ in range(rng.integers(1, 6))) + "</ul>",
            lambda: f"<blockquote>{pick('', '<p>')}{words(5, 40)}</blockquote>",
            lambda: f"<div>{pick('', '<p>')}{words(5, 80)}</div>",
            lambda: f"<pre>{words(5, 30)}</pre>",
            lambda: "<table>" + "".join(f"<tr><td>{words(1, 4)}</td><td>{words(1, 6)}</td></tr>" for _ in range(rng.integers(1, 5))) + "</table>",
            lambda: f"<figure><figcaption>{words(3, 15)}</figcaption></figure>",
        )()

    pages = []
    for _ in range(n):
        inside = [pick("", f"<h1>{words(2, 12)}</h1>", f"<header><h1>{words(2, 12)}</h1></header>")] + [content() for _ in range(pick(rng.integers(1, 16), rng.integers(1, 16), rng.integers(1, 16), 60))]
        if rng.random() < 0.08:
            inside += [f"<p>{words(1, 5)}" for _ in range(300)]
        for _ in range(pick(0, 0, 1, 2)):
            inside.insert(rng.integers(1, len(inside) + 1), noise())
        tag = pick("article", "article", "article", "main", 'div class="content"', 'div id="post"', 'section class="entry-content"', 'div class="article-body"', 'div class="story"')
        body = f"<{tag} data-y=1>{''.join(inside)}</{tag.split()[0]}>"
        if rng.random() < 0.3:
            body = f"<{pick('main', 'div', 'div class=page', 'div id=wrapper')} data-y=0>{pick('', noise())}{body}{pick('', noise())}</div></main>"
        before, after = ("".join(noise() for _ in range(rng.integers(0, 4))) for _ in range(2))
        pages.append(f"<!DOCTYPE html><html><head><title>{words(2, 6)}</title></head><body>{before}{body}{after}{pick('', '</body></html>')}")
    return pages


@lru_cache(maxsize=1)
def default_model() -> TreeModel:
    return train(labelled_pages(400))


def main_texts(sources: list[str | None], model: TreeModel) -> list[str]:
    """The main text of each page."""
    pages = [parse(s) for s in sources]
    if not pages:
        return []
    forest = Forest.of(pages)
    content, _ = model.marginals(forest)
    return [" ".join(run for node, run in p.runs if content[s + node] >= 0.5) for p, s in zip(pages, forest.starts, strict=False)]


def extract(df: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", *, model: TreeModel | None = None) -> DataFrame:
    """``page_id, url, text, n_chars`` of every page; null or empty html has an empty text.

    Repeated rows give repeated rows; null ids and urls stay null; other columns are not carried. The model is a few
    hundred numbers and goes with the tasks.
    """
    fitted = model or default_model()
    rows = df.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))

    def extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, PAGES_AT_ONCE):
                batch = whole.slice(at, PAGES_AT_ONCE)
                texts = main_texts(batch["html"].to_pylist(), fitted)
                yield pa.RecordBatch.from_arrays([batch["page_id"], batch["url"], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    return rows.mapInArrow(extracted, f"page_id {dict(rows.dtypes)['page_id']}, url string, text string, n_chars long")
