"""Main text of web pages: gradient-boosted trees over DOM nodes, decoded along the tree.

1. A page is parsed into elements and texts (tolerant of missing and crossed end tags; the
   contents of scripts, styles and the like are skipped).
2. Every element gets features: its kind, hints in its class and id tokens and in those of
   its ancestors, depth, size and link share of its subtree, text per tag, sentence marks,
   place in the page, and statistics of its siblings.
3. Boosted regression trees (logistic loss, histogram splits) give the probability that all
   text under the element is main text.
4. Decoding: an element is kept whole, dropped whole, or split among its children; the best
   combination over the tree is found bottom-up, so a kept element never lies in a dropped
   one and nothing is dropped inside an element kept whole.

The trees are fitted on ``TRAINING_PAGES`` pages that a seeded rule renders from layouts
with menus, headers, notices, adverts, sidebars, forms, comments and footers in many
spellings (no page of the input has labels). Fitting is bounded and done once on the
driver; extraction covers every page and whole texts, one page at a time.

Text: character references decoded, white space inside a block (every character that Unicode
counts as such, no-break spaces included) turned into one space, blocks in page order joined by
two line feeds. A block is the text between the start or end
tags of block elements.

Defined results: a null or empty html and a page without main text give the empty text.
Null ids and urls stay null; repeated rows are extracted like any others. Markup that ends
early is closed at the end of the page. An empty table gives an empty result. ``extract`` keeps
all other columns; where one has the name of the result, the result's gets underscores.
"""

from __future__ import annotations

import html as html_entities
import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from cohortex.llm.common import fresh, table

TRAINING_PAGES = 500
TREES, DEPTH, RATE, BINS = 60, 4, 0.2, 32
CHUNK_PAGES = 64

# Element kinds of HTML
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
SKIPPED = set("script style noscript template iframe object svg math head title select textarea button canvas audio video".split())
RAW = set("script style noscript template iframe textarea title svg math".split())
BLOCKS = set(
    "address article aside blockquote body center dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul caption".split()
)
KINDS = {
    "p": "p", "heading": "h1 h2 h3 h4 h5 h6", "item": "li dd dt", "list": "ul ol dl menu", "box": "div section center td", "main": "article main",
    "nav": "nav", "header": "header", "footer": "footer", "aside": "aside", "form": "form fieldset input label legend", "link": "a", "quote": "blockquote pre figure figcaption",
    "table": "table tbody tr th thead tfoot caption", "inline": "b i em strong span u s small sub sup code mark q cite time font abbr br",
}
KIND_OF = {tag: k for k, (_, tags) in enumerate(KINDS.items()) for tag in tags.split()}
# Tokens of class and id attributes that hint at main text or at something else
GOOD_HINTS = set("article content post entry main body text story copy prose page blog single".split())
BAD_HINTS = {
    "menu": "nav navbar navigation menu breadcrumb breadcrumbs pagination pager toc tabs links sitemap",
    "frame": "header masthead footer bottom top copyright legal colophon logo branding toolbar",
    "side": "sidebar aside widget related recommended trending popular more teaser rail also",
    "advert": "ad ads advert advertisement adslot sponsor sponsored promo promotion banner dfp commercial",
    "notice": "cookie cookies consent gdpr notice alert popup modal overlay warning message subscribe newsletter paywall",
    "talk": "comment comments commentlist disqus discussion reply replies respond responses reader feedback",
    "form": "form login signup search register contact share social rating vote",
}
BAD_OF = {token: k for k, (_, tokens) in enumerate(BAD_HINTS.items()) for token in tokens.split()}

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:\"[^\"]*+\"|'[^']*+'|[^>\"'])*+|[^>]*+)(?:>|\Z)", re.S
)
_ATTRIBUTE = re.compile(r"(?:class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.I)
_SELF_CLOSED = re.compile(r"(?:^|[\s\"'])/\Z")  # a slash at the end of an unquoted value belongs to it
_TOKEN = re.compile(r"[a-z]+")
_MARK = re.compile(r"[.!?,;:]")


class Page:
    """Elements (tag, attributes, parent) in page order and texts (element, text, block number)."""

    def __init__(self, source: str):
        self.tags, self.attributes, self.parents = ["#root"], [""], [-1]
        self.texts: list[tuple[int, str, int]] = []
        self.block = 0
        self._parse(source)

    def _text(self, at: int, text: str) -> None:
        if text and not text.isspace():
            self.texts.append((at, html_entities.unescape(text) if "&" in text else text, self.block))
        elif text:
            self.texts.append((at, " ", self.block))

    def _parse(self, source: str) -> None:
        stack, pos = [0], 0
        tags = self.tags
        opened: Counter[str] = Counter()  # of the stack, so that a tag without a partner is settled at once

        def close(k: int) -> None:
            opened.subtract(tags[i] for i in stack[k:])
            del stack[k:]

        while True:
            m = _TAG.search(source, pos)
            if m is None:
                self._text(stack[-1], source[pos:])
                return
            if m.start() > pos:
                self._text(stack[-1], source[pos : m.start()])
            pos = m.end()
            if m[2] is None:
                continue
            tag = m[2].lower()
            if tag in BLOCKS:
                self.block += 1
            if m[1]:
                for k in range(len(stack) - 1, 0, -1) if opened[tag] else ():
                    if tags[stack[k]] == tag:
                        close(k)
                        break
                    if tags[stack[k]] in ("td", "th", "table") and tag in ("p", "div", "li", "span", "a", "b", "i"):
                        break
                continue
            self._imply_ends(stack, opened, close, tag)
            at = len(tags)
            tags.append(tag)
            self.attributes.append(m[3])
            self.parents.append(stack[-1])
            if tag == "br":
                self.texts.append((stack[-1], " ", self.block))
            if tag in VOID or tag not in BLOCKS and _SELF_CLOSED.search(m[3]):
                continue
            if tag in RAW:
                end = re.compile(rf"</{tag}\s*>", re.I).search(source, pos)
                pos = end.end() if end else len(source)
                continue
            stack.append(at)
            opened[tag] += 1

    def _imply_ends(self, stack: list[int], opened: Counter[str], close: Callable[[int], None], tag: str) -> None:
        """Close the paragraph, item or cell that the new element ends."""
        ends = {"li": ("li",), "dd": ("dd", "dt"), "dt": ("dd", "dt"), "td": ("td", "th"), "th": ("td", "th"), "tr": ("tr",), "option": ("option",)}.get(tag, ())
        walls = {"li": ("ul", "ol"), "dd": ("dl",), "dt": ("dl",), "td": ("table",), "th": ("table",), "tr": ("table",)}.get(tag, ())
        if not any(opened[name] for name in ends) and not (tag in BLOCKS and opened["p"]):
            return
        for k in range(len(stack) - 1, 0, -1):
            name = self.tags[stack[k]]
            if name in ends or (name == "p" and tag in BLOCKS):
                close(k)
                return
            if name in walls or name in ("table", "td", "th", "body") and tag not in ("td", "th", "tr"):
                return


WIDTH_OF_FEATURES = len(KINDS) + 8 + 2 * len(BAD_HINTS) + 16


def page_features(page: Page) -> np.ndarray:
    """One row of features per element."""
    n = len(page.tags)
    parent = page.parents
    size, own, link, marks, below = [0] * n, [0] * n, [0] * n, [0] * n, [1] * n
    first = [0] * n
    total = 0
    for at, text, _ in page.texts:
        length = len(text) if text != " " else 0
        own[at] += length
        marks[at] += len(_MARK.findall(text))
        if not first[at]:
            first[at] = total
        total += length
    kind = [KIND_OF.get(t, -1) for t in page.tags]
    for i in range(n):
        size[i], link[i] = own[i], own[i] if kind[i] == KIND_OF["a"] else 0
    paragraphs, long_text = [0] * n, [0] * n
    children, child_size = [0] * n, [0] * n
    for i in range(n - 1, 0, -1):
        p = parent[i]
        if kind[i] == KIND_OF["a"]:
            link[i] = size[i]
        size[p] += size[i]
        link[p] += link[i]
        marks[p] += marks[i]
        below[p] += below[i]
        is_p = page.tags[i] == "p"
        paragraphs[p] += paragraphs[i] + is_p
        long_text[p] += long_text[i] + (size[i] if is_p and size[i] > 80 else 0)
        children[p] += 1
        child_size[p] += size[i]
        first[p] = first[i] or first[p]
    x = np.zeros((n, WIDTH_OF_FEATURES), dtype=np.float32)
    good, depth, index = [0] * n, [0] * n, [0] * n
    inside_bad = [[0] * len(BAD_HINTS) for _ in range(n)]
    inside = [[0] * 5 for _ in range(n)]  # main, nav, frame, aside, form
    seen = [0] * n
    k0, k1 = len(KINDS), len(KINDS) + 8
    for i in range(n):
        p = parent[i]
        bad = [0] * len(BAD_HINTS)
        hints = 0
        if page.attributes[i]:
            for value in _ATTRIBUTE.findall(page.attributes[i]):
                for token in _TOKEN.findall(value.lower()):
                    if token in BAD_OF:
                        bad[BAD_OF[token]] += 1
                    elif token in GOOD_HINTS:
                        hints += 1
        k = kind[i]
        if k >= 0:
            x[i, k] = 1
        if p >= 0:
            depth[i] = depth[p] + 1
            index[i] = seen[p]
            seen[p] += 1
            inside_bad[i] = [a + b for a, b in zip(inside_bad[p], bad, strict=True)]
            good[i] = good[p] + hints
            inside[i] = list(inside[p])
        tag = page.tags[i]
        for j, names in enumerate((("article", "main"), ("nav",), ("header", "footer"), ("aside",), ("form",))):
            inside[i][j] += tag in names
        s = size[i]
        siblings = children[p] if p >= 0 else 1
        row = x[i]
        row[k0 : k0 + 5] = inside[i]
        row[k0 + 5], row[k0 + 6], row[k0 + 7] = hints, good[i], sum(inside_bad[i])
        row[k1 : k1 + len(bad)] = bad
        row[k1 + len(bad) : k1 + 2 * len(bad)] = inside_bad[i]
        row[-16:] = (
            depth[i], np.log1p(s), np.log1p(own[i]), link[i] / (s + 1), s / below[i], marks[i] / (s + 1) * 100, marks[i], paragraphs[i],
            long_text[i] / (s + 1), first[i] / (total + 1), s / (total + 1), siblings, index[i] / siblings,
            np.log1p(child_size[p] / siblings if p >= 0 else 0), link[p] / (size[p] + 1) if p >= 0 else 0, np.log1p(below[i]),
        )
    return x


@dataclass
class Trees:
    """Boosted trees of one depth: per tree split features and thresholds by heap position, and leaf values."""

    features: np.ndarray
    thresholds: np.ndarray
    leaves: np.ndarray
    bias: float

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.bias)
        rows = np.arange(len(x))
        for f, t, v in zip(self.features, self.thresholds, self.leaves, strict=True):
            at = np.zeros(len(x), dtype=np.int64)
            for _ in range(DEPTH):
                at = 2 * at + 1 + (x[rows, f[at]] > t[at])
            out += v[at - (2**DEPTH - 1)]
        return out


def fit_trees(x: np.ndarray, y: np.ndarray, weight: np.ndarray, trees: int = TREES) -> Trees:
    """Newton boosting on the logistic loss with histogram splits."""
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x.T]
    binned = np.stack([np.searchsorted(e, c, side="left") for e, c in zip(edges, x.T, strict=True)], axis=1)
    rate = (weight * y).sum() / weight.sum()
    bias = float(np.log(rate / (1 - rate)))
    score = np.full(len(x), bias)
    inner = 2**DEPTH - 1
    all_f, all_t, all_v = [], [], []
    offsets = np.arange(x.shape[1]) * BINS
    for _ in range(trees):
        p = 1 / (1 + np.exp(-score))
        g, h = weight * (p - y), weight * np.maximum(p * (1 - p), 1e-6)
        f, t = np.zeros(inner, np.int64), np.full(inner, np.inf, np.float32)
        at = np.zeros(len(x), np.int64)
        for node in range(inner):
            rows = np.flatnonzero(at == node)
            if len(rows) > 20:
                flat = (binned[rows] + offsets).ravel()
                sums = [np.bincount(flat, np.repeat(v[rows], x.shape[1]), BINS * x.shape[1]).reshape(-1, BINS).cumsum(axis=1) for v in (g, h)]
                gl, hl = sums
                gt, ht = gl[:, -1:], hl[:, -1:]
                gain = gl**2 / (hl + 1) + (gt - gl) ** 2 / (ht - hl + 1) - gt**2 / (ht + 1)
                gain[(hl < 1) | (ht - hl < 1)] = 0
                best = int(gain.argmax())
                if gain.flat[best] > 1e-6 and best % BINS < len(edges[best // BINS]):
                    f[node], t[node] = best // BINS, edges[best // BINS][best % BINS]
            at[rows] = 2 * node + 1 + (x[rows, f[node]] > t[node])
        leaf = at - inner
        v = -np.bincount(leaf, g, inner + 1) / (np.bincount(leaf, h, inner + 1) + 1) * RATE
        score += v[leaf]
        all_f.append(f)
        all_t.append(t)
        all_v.append(v)
    return Trees(np.stack(all_f), np.stack(all_t), np.stack(all_v), bias)


def decode(page: Page, log_odds: np.ndarray) -> np.ndarray:
    """Which elements' own texts are kept: keep whole, drop whole or split, best over the tree."""
    n = len(page.tags)
    keep = -np.logaddexp(0, -log_odds)
    drop = -np.logaddexp(0, log_odds)
    for i, tag in enumerate(page.tags):
        if tag in SKIPPED:
            keep[i] = -1e9
    own = np.zeros(n, dtype=bool)
    for at, text, _ in page.texts:
        own[at] |= text != " "
    split_sum, best, choice = np.zeros(n), np.zeros(n), np.zeros(n, np.int8)
    single_keep, single_drop = keep.copy(), drop.copy()
    for i in range(n - 1, -1, -1):
        # a split element's own text goes the likelier way
        split = split_sum[i] + (max(single_keep[i], single_drop[i]) if own[i] else 0.0) - 0.2
        options = (keep[i], drop[i], split)
        choice[i] = int(np.argmax(options))
        best[i] = options[choice[i]]
        p = page.parents[i]
        if p >= 0:
            keep[p] += keep[i]
            drop[p] += drop[i]
            split_sum[p] += best[i]
    kept = np.zeros(n, dtype=bool)
    decided = np.zeros(n, np.int8)
    for i in range(n):
        above = decided[page.parents[i]] if i else 2
        decided[i] = choice[i] if above == 2 else above
        kept[i] = decided[i] == 0 or (decided[i] == 2 and single_keep[i] > single_drop[i])
    return kept


def blocks(page: Page, kept: np.ndarray) -> str:
    out, held, number = [], [], -1
    for at, text, block in page.texts:
        if block != number:
            out.append("".join(held))
            held, number = [], block
        if kept[at]:
            held.append(text)
    out.append("".join(held))
    return "\n\n".join(t for t in (" ".join(b.split()) for b in out) if t)


def extract_texts(sources: list[str | None], trees: Trees) -> list[str]:
    pages = [Page(s or "") for s in sources]
    x = [page_features(p) for p in pages]
    odds = trees.log_odds(np.concatenate(x)) if x else np.zeros(0)
    ends = np.cumsum([len(r) for r in x])
    return [blocks(p, decode(p, odds[e - len(r) : e])) for p, r, e in zip(pages, x, ends, strict=True)]


MARKER = ""


def render_page(r: np.random.Generator) -> str:
    """A page of a random layout; every run of main text begins with MARKER."""
    syllables = "the an re ti on er and st en at ion le de la es que ung ein sch ver ber au ge do ra os".split()

    def words(low: int, high: int) -> str:
        n = int(r.integers(low, high + 1))
        out = ["".join(r.choice(syllables, int(r.integers(1, 4)))) for _ in range(n)]
        return " ".join(w + ("." if r.random() < 0.1 else "," if r.random() < 0.06 else "") for w in out).capitalize() + "."

    def one(*options: str) -> str:
        return str(r.choice(options))

    def maybe(p: float, text) -> str:
        return text() if r.random() < p else ""

    plain = r.random() < 0.15  # class names without a meaning

    def box(hints: str, inner: str, tags: str = "div") -> str:
        tag, hint = one(*tags.split()), one(*hints.split())
        if plain and tag == "div":
            hint = "c" + "".join(r.choice(list("xyzqw"), 5))
        attribute = "" if tag not in ("div", "ul", "section", "ol", "table") and r.random() < 0.6 else f' {one("class", "id")}="{hint}"'
        return f"<{tag}{attribute}>{inner}</{tag}>"

    def links(low: int, high: int) -> str:
        items = [f'<a href="/{i}">{words(1, 3)}</a>' for i in range(int(r.integers(low, high + 1)))]
        return "<ul>" + "".join(f"<li>{a}</li>" for a in items) + "</ul>" if r.random() < 0.7 else one(" | ", " ", "<br>").join(items)

    def advert() -> str:
        return box("ad ads advert sponsored promo ad-slot banner-ad adslot", one(words(2, 12), f"<p>{words(3, 20)}</p>", f'<a href="/x">{words(2, 8)}</a>'), "div div div aside section")

    def notice() -> str:
        return box("cookie-notice notice alert consent gdpr popup newsletter-box", one(words(4, 30), f"<p>{words(5, 30)}</p>") + maybe(0.5, lambda: f"<button>{words(1, 2)}</button>"), "div div section")

    def form() -> str:
        return f'<form action="/f">{maybe(0.6, lambda: f"<label>{words(1, 4)}</label>")}<input type="text">{maybe(0.4, lambda: f"<p>{words(3, 12)}</p>")}<button>{words(1, 2)}</button></form>'

    def comments() -> str:
        one_comment = lambda: box("comment reply response comment-body", maybe(0.6, lambda: f"<b>{words(1, 2)}</b>") + f"<p>{words(3, 60)}</p>", "div div li article")
        return box("comments commentlist discussion responses reader-comments", maybe(0.6, lambda: f"<h3>{words(1, 3)}</h3>") + "".join(one_comment() for _ in range(int(r.integers(1, 8)))), "section div ol div")

    def sidebar() -> str:
        return box("sidebar widget related trending right-rail", maybe(0.7, lambda: f"<h3>{words(1, 4)}</h3>") + one(links(3, 9), f"<p>{words(5, 30)}</p>", links(2, 5) + f"<p>{words(4, 20)}</p>"), "aside div div section")

    def marked(text: str) -> str:
        return MARKER + text

    def paragraph() -> str:
        text = words(1, 6) if r.random() < 0.12 else words(6, 160)
        if r.random() < 0.25:
            cut = len(text) // 3
            tag = one("b", "i", "em", "a href='/y'", "span", "strong")
            text = marked(text[:cut]) + f"<{tag}>" + marked(text[cut : 2 * cut]) + f"</{tag.split()[0]}>" + marked(text[2 * cut :])
        else:
            text = marked(text)
        style = r.random()
        if style < 0.12:
            return f"<p><b>{text}<br>"
        return f"<p>{text}" if style < 0.2 else f"<p>{text}</p>"

    def piece() -> str:
        kind = r.random()
        if kind < 0.78:
            return paragraph()
        if kind < 0.84:
            return f"<h2>{marked(words(1, 8))}</h2>"
        if kind < 0.9:
            return "<ul>" + "".join(f"<li>{marked(words(2, 25))}</li>" for _ in range(int(r.integers(2, 6)))) + "</ul>"
        if kind < 0.93:
            return f"<blockquote>{paragraph()}</blockquote>"
        return one(advert(), form(), box("share social", links(2, 4)), box("related more", links(2, 4)), notice())

    body = maybe(0.85, lambda: f"<h1>{marked(words(2, 12))}</h1>") + "".join(piece() for _ in range(int(r.choice([1, 2, 3, 5, 8, 14, 25]))))
    main = box("content post article-body entry-content story main text page", body, "article article article main div div section td")
    for _ in range(int(r.integers(0, 3))):
        main = box("wrapper container main-content page layout row", main, "div div section main")
    main += maybe(0.35, comments)
    top = maybe(0.5, lambda: box("header masthead site-header top logo", f"<h2>{words(1, 4)}</h2>" + maybe(0.4, lambda: f"<p>{words(2, 10)}</p>") + maybe(0.5, lambda: links(2, 6)), "header div div"))
    top += maybe(0.85, lambda: box("nav menu navbar navigation breadcrumb", links(3, 9), "nav nav div ul"))
    top += maybe(0.3, notice) + maybe(0.5, lambda: "<!-- ad -->" + advert())
    around = [main] + [f() for f, p in ((sidebar, 0.4), (advert, 0.3), (form, 0.25), (notice, 0.15)) if r.random() < p]
    if r.random() < 0.5:
        around = around[::-1]
    foot = maybe(0.85, lambda: box("footer bottom copyright site-footer legal", "&copy; " + words(2, 30) + maybe(0.4, lambda: links(2, 6)) + maybe(0.2, lambda: f"<p>{words(4, 20)}</p>"), "footer footer div"))
    page = f"<!DOCTYPE html><html><head><title>{words(2, 8)}</title><style>p{{margin:0}}</style><script>var a='<p>';</script></head><body>{top}{''.join(around)}{foot}</body></html>"
    return page[: int(len(page) * r.uniform(0.4, 0.95))] if r.random() < 0.1 else page


def train(pages: int = TRAINING_PAGES, seed: int = 7) -> Trees:
    """Fit the trees on rendered pages; elements with both kinds of text under them teach nothing."""
    r = np.random.default_rng(seed)
    xs, ys = [], []
    for _ in range(pages):
        page = Page(render_page(r))
        n = len(page.tags)
        main, other = np.zeros(n, np.int64), np.zeros(n, np.int64)
        for at, text, _ in page.texts:
            if text != " ":
                (main if MARKER in text else other)[at] += 1
        for i in range(n - 1, 0, -1):
            main[page.parents[i]] += main[i]
            other[page.parents[i]] += other[i]
        page.texts = [(at, text.replace(MARKER, ""), b) for at, text, b in page.texts]
        pure = np.flatnonzero((main > 0) != (other > 0))
        xs.append(page_features(page)[pure])
        ys.append(main[pure] > 0)
    x, y = np.concatenate(xs), np.concatenate(ys).astype(float)
    return fit_trees(x, y, np.ones(len(y)))


_trained: dict[int, Trees] = {}


def default_trees() -> Trees:
    """The trees of the default training set, fitted once per process."""
    if 0 not in _trained:
        _trained[0] = train()
    return _trained[0]


def extract(df: DataFrame, trees: Trees | None = None, html_col: str = "html", out_col: str = "_main_text") -> DataFrame:
    """``df`` without its html, with the main text of each page."""
    model = trees or default_trees()
    others = [c for c in df.columns if c != html_col]
    rows, out_col = df.select(*others, F.col(html_col).cast("string").alias(fresh(df, "source"))), fresh(df.drop(html_col), out_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, CHUNK_PAGES):
                part = batch.slice(at, CHUNK_PAGES)
                texts = extract_texts(part.column(len(others)).to_pylist(), model)
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(texts, pa.string())], names=[*others, out_col])

    return rows.mapInArrow(run, StructType([*rows.schema.fields[:-1], StructField(out_col, StringType())]))


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    text = F.col("_main_text")
    return extract(pages).select("page_id", "url", text.alias("text"), F.char_length(text).cast(LongType()).alias("n_chars"))
