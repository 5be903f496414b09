"""Main-text extraction by a tree-structured graphical model over the DOM.

Every element and every text is a node that is content or not. Unary potentials read the node (tag,
words of class and id, share of link text, length), a 2 x 2 potential on each edge ties a child to its
parent, by kind of child. As a page is a tree, one pass of sum-product messages up and one down give
exact marginals. Texts with a content marginal above one half are kept.

The potentials are the maximum of the regularized conditional likelihood of labelled pages, found by
gradient ascent: observed minus expected features, the latter from the same messages. Labelled are at
most `sample` pages of the table, by the elements that say what they are (`article`, `main` against
`nav`, `footer` and the like), and pages built from labelled layouts that write the same parts with
plain `div` elements and class names, and place adverts and comments inside articles.

Scripts, styles and other raw elements hold no text. A block is what block-level tags enclose; `br` is
white space. Character references are decoded, white space in a block (as `str.split` knows it) becomes
one space, empty blocks vanish, blocks are joined in page order by one line break. A null or empty page
has the empty text; malformed markup is read leniently, nothing is cut off. Rows stay as they are.
"""

from __future__ import annotations

import html
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardlens.llm.staging import ship_package

SAMPLE_PAGES = 200
LAYOUT_PAGES = 160
_BATCH_PAGES = 256

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+>"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>",
    re.S,
)
_ATTRIBUTE = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_LABEL = re.compile(r"data-y=\"([01])\"")
_WORD = re.compile(r"[a-z]+")

_RAW = {"script", "style", "noscript", "template", "iframe", "textarea", "title", "svg", "select", "object"}
_RAW_END = {tag: re.compile(f"</{tag}", re.IGNORECASE | re.ASCII) for tag in _RAW}
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search "
    "section summary table tbody td tfoot th thead tr ul".split()
)
# What a start tag closes: an open element of the first set, looked for up to one of the second.
_CLOSES = {
    **dict.fromkeys(_BLOCK - {"html", "head", "body", "td", "th", "tr", "tbody", "thead", "tfoot", "caption"}, ({"p"}, {"table", "button"})),
    "li": ({"li", "p"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd", "p"}, {"dl"}),
    "dd": ({"dt", "dd", "p"}, {"dl"}),
    "tr": ({"tr"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "body": ({"head"}, set()),
}

# Kinds of tags that the model tells apart.
_KINDS = [
    "article main", "nav menu", "header", "footer", "aside", "form fieldset label input button legend", "section", "div center",
    "p", "h1", "h2 h3 h4 h5 h6", "ul ol dl", "li dt dd", "a", "table thead tbody tfoot tr", "td th", "blockquote pre code",
    "figure figcaption caption", "html", "head", "body", "span b i em strong u small mark sub sup font",
]
_KIND_OF = {tag: k for k, tags in enumerate(_KINDS) for tag in tags.split()}
_OTHER, _TEXT = len(_KINDS), len(_KINDS) + 1
_GOOD = set("article articles articlebody content contents main post entry story text body hentry prose page wiki".split())
_BAD = set(
    "ad ads advert adverts advertisement advertising banner promo sponsor sponsored nav navbar navigation menu menus header "
    "masthead footer foot sidebar side aside widget comment comments reply replies disqus cookie cookies consent notice alert gdpr "
    "popup modal share sharing social related recommended subscribe newsletter signup login search form breadcrumb breadcrumbs "
    "pagination pager tags toolbar skip copyright legal".split()
)
_N_KINDS = len(_KINDS) + 2
N_FEATURES = _N_KINDS + 2 + 4 + 4
EDGE_KINDS = 3  # child is a block, an inline element, a text


@dataclass
class Page:
    parent: list[int]
    depth: list[int]
    kind: list[int]
    good: list[bool]
    bad: list[bool]
    chars: list[int]  # visible characters at or below
    linked: list[int]  # of these, inside links
    label: list[int]
    events: list[tuple[int, str]]  # (text node, its characters); node -1: a block ends or begins


def parse(source: str) -> Page:
    page = Page([-1], [0], [_OTHER], [False], [False], [0], [0], [0], [])
    open_tags, open_nodes = ["#root"], [0]

    def add(parent: int, kind: int, attributes: str) -> int:
        page.parent.append(parent)
        page.depth.append(page.depth[parent] + 1)
        page.kind.append(kind)
        good = bad = False
        label = page.label[parent]
        if attributes:
            names = set()
            for m in _ATTRIBUTE.finditer(attributes):
                names.update(_WORD.findall((m[1] or m[2] or m[3] or "").lower()))
            good, bad = not names.isdisjoint(_GOOD), not names.isdisjoint(_BAD)
            if told := _LABEL.search(attributes):
                label = int(told[1])
        page.good.append(good)
        page.bad.append(bad)
        page.chars.append(0)
        page.linked.append(0)
        page.label.append(label)
        return len(page.parent) - 1

    def text(raw: str) -> None:
        if raw.isspace():
            page.events.append((-2, " "))
        elif raw:
            node = add(open_nodes[-1], _TEXT, "")
            page.chars[node] = len(raw)
            page.events.append((node, raw))

    def close_to(depth: int) -> None:
        del open_tags[depth:], open_nodes[depth:]

    at = 0
    while found := _TOKEN.search(source, at):
        if found.start() > at:
            text(source[at : found.start()])
        at = found.end()
        closing, tag, attributes = (found[1], found[2], found[3]) if found[2] else (found[4], found[5], found[6])
        if not tag:
            continue
        tag = tag.lower()
        if tag in _BLOCK:
            page.events.append((-1, ""))
        elif tag == "br":
            page.events.append((-2, " "))
        if closing:
            if tag in open_tags:
                close_to(len(open_tags) - 1 - open_tags[::-1].index(tag))
            continue
        if tag in _RAW:
            page.events.append((-1, "")) if tag == "title" else None
            # Not in a lower-cased copy: lower() can change the length, and with it all later positions.
            last = _RAW_END[tag].search(source, at)
            end = last.start() if last else len(source)
            at = source.find(">", end) + 1 or len(source)
            continue
        if tag in _CLOSES:
            closes, until = _CLOSES[tag]
            for d in range(len(open_tags) - 1, 0, -1):
                if open_tags[d] in closes:
                    close_to(d)
                    break
                if open_tags[d] in until:
                    break
        node = add(open_nodes[-1], _KIND_OF.get(tag, _OTHER), attributes)
        if tag not in _VOID:
            open_tags.append(tag)
            open_nodes.append(node)
    if at < len(source):
        text(source[at:])
    parent, kind, chars, linked, link = page.parent, page.kind, page.chars, page.linked, _KIND_OF["a"]
    for node in range(len(parent) - 1, 0, -1):
        if kind[node] == link:
            linked[node] = chars[node]
        chars[parent[node]] += chars[node]
        linked[parent[node]] += linked[node]
    return page


class Forest:
    """Pages side by side, by depth, as the messages need them."""

    def __init__(self, pages: list[Page]):
        sizes = np.array([len(p.parent) for p in pages])
        self.first = np.cumsum(sizes) - sizes
        shift = np.repeat(self.first, sizes)

        def all_of(name: str, dtype=np.int64) -> np.ndarray:
            return np.concatenate([np.array(getattr(p, name), dtype) for p in pages])

        self.parent = all_of("parent")
        self.root = self.parent < 0
        self.parent = self.parent + np.where(self.root, 0, shift)
        self.kind, self.label, depth = all_of("kind"), all_of("label"), all_of("depth")
        self.levels = [np.flatnonzero(depth == d) for d in range(1, int(depth.max()) + 1)]
        chars, linked = all_of("chars"), all_of("linked")
        length = np.digitize(chars, [1, 25, 120])
        share = np.digitize(linked / np.maximum(chars, 1), [0.01, 0.35, 0.75])
        n = len(self.kind)
        none = np.full(n, N_FEATURES)
        self.features = np.stack(
            [
                self.kind,
                np.where(all_of("good", bool), _N_KINDS, none),
                np.where(all_of("bad", bool), _N_KINDS + 1, none),
                _N_KINDS + 2 + length,
                _N_KINDS + 6 + share,
            ],
            axis=1,
        )
        inline = np.isin(self.kind, [_KIND_OF["a"], _KIND_OF["span"], _OTHER])
        self.edge = np.where(self.kind == _TEXT, 2, np.where(inline, 1, 0))


@dataclass
class Potentials:
    unary: np.ndarray  # log-odds of content, by feature
    edge: np.ndarray  # log potential, by kind of edge, parent's and child's state

    def messages(self, forest: Forest, edges: bool = True) -> tuple[np.ndarray, np.ndarray]:
        """Content marginal of each node; joint marginal of each edge (by its child: parent, child)."""
        n = len(forest.kind)
        belief = np.zeros((n, 2))
        belief[:, 1] = np.append(self.unary, 0.0)[forest.features].sum(axis=1)
        up = np.zeros((n, 2))
        for level in reversed(forest.levels):
            joint = self.edge[forest.edge[level]] + belief[level][:, None, :]
            up[level] = sent = np.logaddexp(joint[:, :, 0], joint[:, :, 1])
            parents, at = np.unique(forest.parent[level], return_inverse=True)
            for state in (0, 1):
                belief[parents, state] += np.bincount(at, weights=sent[:, state])
        pair = np.zeros((n, 2, 2))
        total = belief.copy()
        for level in forest.levels:
            above = total[forest.parent[level]] - up[level]
            joint = self.edge[forest.edge[level]] + above[:, :, None] + belief[level][:, None, :]
            total[level] = np.logaddexp(joint[:, 0, :], joint[:, 1, :])
            if not edges:
                continue
            joint -= np.logaddexp.reduce(joint.reshape(len(level), 4), axis=1)[:, None, None]
            pair[level] = np.exp(joint)
        return 1 / (1 + np.exp(np.clip(total[:, 0] - total[:, 1], -500, 500))), pair


def train(pages: list[Page], steps: int = 300, rate: float = 0.5, penalty: float = 0.1) -> Potentials:
    """Gradient ascent with per-weight step sizes (Adam) on the conditional likelihood."""
    forest = Forest(pages)
    model = Potentials(np.zeros(N_FEATURES), np.zeros((EDGE_KINDS, 2, 2)))
    child = ~forest.root
    above = forest.label[forest.parent]
    seen_pairs = np.zeros_like(model.edge)
    np.add.at(seen_pairs, (forest.edge[child], above[child], forest.label[child]), 1)
    of_edge = [child & (forest.edge == k) for k in range(EDGE_KINDS)]
    mean = [np.zeros(N_FEATURES), np.zeros_like(model.edge)]
    square = [np.zeros(N_FEATURES), np.zeros_like(model.edge)]
    for step in range(1, steps + 1):
        marginal, pair = model.messages(forest)
        expected = np.stack([pair[rows].sum(axis=0) for rows in of_edge])
        error = np.repeat(forest.label - marginal, forest.features.shape[1])
        slopes = [
            np.bincount(forest.features.ravel(), weights=error, minlength=N_FEATURES + 1)[:-1] - penalty * model.unary,
            seen_pairs - expected - penalty * model.edge,
        ]
        for i, weights in enumerate((model.unary, model.edge)):
            slope = slopes[i] / len(forest.label)
            mean[i] = 0.9 * mean[i] + 0.1 * slope
            square[i] = 0.99 * square[i] + 0.01 * slope**2
            weights += rate * (mean[i] / (1 - 0.9**step)) / (np.sqrt(square[i] / (1 - 0.99**step)) + 1e-6) / step**0.25
    return model


def labelled_by_elements(source: str) -> Page | None:
    """A page whose main element says so; None if it has none."""
    page = parse(source)
    main = _KIND_OF["article"]
    if main not in page.kind:
        return None
    out = {_KIND_OF[t] for t in ("nav", "footer", "aside", "form", "header")}
    for node in range(1, len(page.parent)):
        inside = page.label[page.parent[node]]
        page.label[node] = int((page.kind[node] == main or inside) and page.kind[node] not in out and not page.bad[node])
    return page


def layouts(n: int, seed: int = 7) -> list[Page]:
    """Pages put together from labelled parts, written in varying ways."""
    rng = random.Random(seed)

    def words(a: int, b: int) -> str:
        return " ".join("x" * rng.randint(2, 9) for _ in range(rng.randint(a, b)))

    def links(k: int) -> str:
        items = "".join(f'<li><a href="#">{words(1, 3)}</a></li>' for _ in range(k))
        return f"<ul>{items}</ul>" if rng.random() < 0.7 else re.sub(r"</?li>", " ", items)

    def named(tag: str, names: list[str], inner: str, y: int) -> str:
        if tag and rng.random() < 0.6:
            return f'<{tag} data-y="{y}">{inner}</{tag}>'
        how = rng.choice(["class", "id"])
        return f'<{rng.choice(["div", "section"])} {how}="{rng.choice(names)}" data-y="{y}">{inner}</div>'

    def advert() -> str:
        return named("", ["ad", "advert box", "banner", "promo", "sponsored"], words(3, 20), 0)

    def body() -> str:
        parts = [f"<h1>{words(2, 9)}</h1>"] if rng.random() < 0.8 else []
        longest = rng.choice([6, 20, 60])
        for _ in range(rng.randint(1, rng.choice([3, 9]))):
            r = rng.random()
            if r < 0.68:
                inner = words(1, longest)
                if rng.random() < 0.3:
                    inner += f' <a href="#">{words(1, 4)}</a> <b>{words(1, 5)}</b>'
                parts.append(f"<p>{inner}</p>" if rng.random() < 0.85 else f"<p><b>{words(2, 8)}<br><p>{inner}")
            elif r < 0.78:
                parts.append(f"<h2>{words(1, 6)}</h2>")
            elif r < 0.84:
                parts.append("<ul>" + "".join(f"<li>{words(2, 14)}</li>" for _ in range(rng.randint(2, 5))) + "</ul>")
            elif r < 0.89:
                parts.append(f"<blockquote><p>{words(4, 30)}</p></blockquote>")
            elif r < 0.92:
                parts.append(f"<table><tr><td>{words(1, 5)}</td><td>{words(1, 5)}</td></tr></table>")
            elif r < 0.95:
                parts.append(f"<div>{words(8, 40)}</div>")
            else:
                parts.append(advert())
        if rng.random() < 0.2:
            parts.append(named("", ["share", "social links", "related", "newsletter signup"], links(3), 0))
        return "".join(parts)

    def comments() -> str:
        posts = "".join(f'<div class="{rng.choice(["comment", "reply", "x"])}"><p>{words(3, 40)}</p></div>' for _ in range(3))
        return named("", ["comments", "comment-list", "disqus_thread comments"], f"<h3>{words(1, 2)}</h3>{posts}", 0)

    pages = []
    for _ in range(n):
        parts = []
        if rng.random() < 0.7:
            inner = (f"<h1>{words(1, 3)}</h1>" if rng.random() < 0.3 else "") + links(4)
            parts.append(named("header", ["header", "site-header", "masthead"], inner, 0))
        parts.append(named("nav", ["nav", "menu", "main-menu", "navbar", "breadcrumbs"], links(rng.randint(3, 8)), 0))
        if rng.random() < 0.4:
            inner = f"<p>{words(6, 30)} <a href='#'>{words(1, 2)}</a></p><button>{words(1, 1)}</button>"
            parts.append(named("", ["cookie-notice", "notice", "alert", "gdpr consent"], inner, 0))
        if rng.random() < 0.5:
            parts.append(advert())
        inner = body() + (comments() if rng.random() < 0.25 else "")
        main = named(rng.choice(["article", "main"]), ["content", "article-body", "post", "entry-content", "story"], inner, 1)
        parts.append(f'<div class="{rng.choice(["wrapper", "row", "container"])}" data-y="0">{main}</div>' if rng.random() < 0.4 else main)
        if rng.random() < 0.5:
            inner = f"<h3>{words(1, 3)}</h3>{links(4)}<p>{words(4, 25)}</p>"
            parts.append(named("aside", ["sidebar", "widget", "side", "related"], inner, 0))
        if rng.random() < 0.3:
            parts.append(f'<form data-y="0"><label>{words(1, 4)}</label><input><button>{words(1, 2)}</button></form>')
        if rng.random() < 0.4:
            parts.append(comments())
        parts.append(named("footer", ["footer", "site-footer", "legal copyright"], f"{words(4, 20)} {links(3)}", 0))
        head = f"<head><title>{words(2, 6)}</title></head>" if rng.random() < 0.8 else ""
        pages.append(parse(f"<html>{head}<body>{''.join(parts)}</body></html>"))
    return pages


def _text(page: Page, content: np.ndarray) -> str:
    blocks: list[str] = []
    pieces: list[str] = []
    for node, raw in page.events:
        if node == -1:
            if pieces:
                blocks.append("".join(pieces))
                pieces = []
        elif node == -2 or content[node]:
            pieces.append(raw)
    blocks.append("".join(pieces))
    lines = (" ".join((html.unescape(b) if "&" in b else b).split()) for b in blocks)
    return "\n".join(line for line in lines if line)


def extract(sources: list[str | None], model: Potentials) -> list[str]:
    pages = [parse(s or "") for s in sources]
    if not pages:
        return []
    forest = Forest(pages)
    content = model.messages(forest, edges=False)[0] > 0.5
    return [_text(p, content[a : a + len(p.parent)]) for p, a in zip(pages, forest.first)]


def sample_pages(pages: DataFrame, html_col: str, sample: int) -> DataFrame:
    """hash and html of at most `sample` different pages that name their main element, those with the
    least hashes. Hashes are picked first; only the picked pages, one for each hash, are moved.
    """
    marked = pages.filter(F.col(html_col).rlike("(?i)<(article|main)[\\s>]"))
    marked = marked.select(F.xxhash64(html_col).alias("hash"), F.col(html_col).alias("html"))
    least = marked.select("hash").distinct().orderBy("hash").limit(sample)
    return marked.join(F.broadcast(least), "hash").groupBy("hash").agg(F.min("html").alias("html"))


def fit(pages: DataFrame, html_col: str = "html", sample: int = SAMPLE_PAGES, layout_pages: int = LAYOUT_PAGES) -> Potentials:
    """Train on layouts and at most `sample` pages of the table."""
    few = sample_pages(pages, html_col, sample).orderBy("hash").collect()
    own = [p for p in (labelled_by_elements(r.html) for r in few) if p]
    return train(own + layouts(layout_pages))


def extract_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", model: Potentials | None = None) -> DataFrame:
    """page_id, url and text of every page."""
    ship_package(pages.sparkSession)
    potentials = model or fit(pages, html_col)

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for i in range(0, len(batch), _BATCH_PAGES):
                part = batch.slice(i, _BATCH_PAGES)
                texts = extract(part.column(2).to_pylist(), potentials)
                yield pa.record_batch([part.column(0), part.column(1), pa.array(texts, pa.string())], names=["page_id", "url", "text"])

    picked = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    return picked.mapInArrow(batches, "page_id long, url string, text string")
