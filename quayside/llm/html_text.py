"""Main text of web pages by a recurrent block labeller.

A page becomes its sequence of leaf blocks: text between block-level tags, with the path of tags,
classes and ids above it. Every block is a vector: a slot for each known tag and telling name of its path,
hashed slots of their own for all other names (an open set, which so never looks like a telling one), hashed
words, length, link share, place. A bidirectional LSTM (numpy) reads the whole sequence, so each block is
labelled main or not in the context of the document. Very long pages are read in stretches that hand on the
states, so memory is bounded by the states alone.

There are no labels, so the labeller learns from ``SAMPLE`` pages (bounded, repeatable) whose
blocks a rule labels: inside an article or main element (on a page with neither, one whose class or id
names content) and inside no element whose tag, class or id names a menu, header, footer, sidebar, notice, advert, form or comment. Every page also
comes in ``VARIANTS`` with other containers, names that occur nowhere else on any element, and inserted
boilerplate around or inside the article, filled with text of other pages, so that neither the words of a block
nor chance names give it away; some variants are hundreds of blocks long.

A block's text: tags dropped, character references decoded, white space runs one blank, trimmed.
Scripts, styles and comments are no text. Null or empty html has the empty text. Equal
html gives equal text. Without any usable page for training the rule itself labels.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from quayside.llm.common import IS_MARK, byte_rows, sampled, span_hashes, word_spans

SAMPLE = 300
VARIANTS = 5
EPOCHS = 6
#: A variant in so many has its article repeated to a length of up to ``LONG`` blocks.
LONG_EVERY = 12
LONG = 600
HIDDEN = 16
NAME_SLOTS = 48
WORD_SLOTS = 64
PAGES_AT_ONCE = 256
#: A page of more blocks is read in stretches of so many.
STRETCH = 16_384

_INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = ("script", "style", "template", "noscript", "textarea", "iframe", "svg", "select")
#: Of these, a missing end tag makes the rest of the page no text; of the others it hides nothing.
_RAW_TO_END = ("script", "style", "textarea", "iframe")
_RAW_END = {t: re.compile(rf"</{t}(?=[\s/>])[^>]*(?:>|\Z)", re.I | re.A) for t in _RAW}
_ENDS_SAME = {"li": ("li",), "p": ("p",), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "option": ("option",)}
_TAG = re.compile(r"<(?:!--(?:.*?)(?:-->|\Z)|[!?][^>]*>|(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|(/?)([a-zA-Z][^\s/>]*)([^>]*)>)", re.S)
_ATTR = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_BLANKS = re.compile(r"[\x20\x09-\x0D]+")
_SPLIT = re.compile(r"[^a-z0-9]+")

# What names main text and what names the rest, in tags, classes and ids.
MAIN_TAGS = ("article", "main")
MAIN_NAMES = ("content", "article", "post", "entry", "story", "body", "main", "text")
REST_TAGS = ("nav", "header", "footer", "aside", "form", "menu", "head", "button", "dialog", "fieldset")
REST_NAMES = ("nav", "menu", "navbar", "breadcrumb", "breadcrumbs", "navigation", "complementary", "contentinfo", "header", "masthead", "footer", "sidebar", "aside", "widget", "ad", "ads", "advert", "advertisement", "banner", "sponsor", "sponsored", "promo", "cookie", "cookies", "consent", "notice", "alert", "popup", "modal", "newsletter", "subscribe", "signup", "login", "form", "search", "share", "social", "related", "recommended", "comment", "comments", "reply", "replies", "disqus", "pagination", "pager", "toolbar", "legal", "copyright")

_TAGS = ("html", "body", "div", "p", "section", "h1", "h2", "h3", "h4", "h5", "h6", "ul", "ol", "li", "dl", "dt", "dd", "table", "thead", "tbody", "tfoot", "tr", "td", "th", "caption", "blockquote", "pre", "figure", "figcaption", "details", "summary", "address", "center")
_KNOWN = {t: k for k, t in enumerate((*_TAGS, *MAIN_TAGS, *REST_TAGS, *("." + n for n in (*MAIN_NAMES, *REST_NAMES))))}
PATH_SLOTS = len(_KNOWN) + NAME_SLOTS
#: Beside path and words: whether the path has a main tag, a main name, a tag or name of the rest; length, words, links, place, one.
_MORE = 8
_WIDTH = PATH_SLOTS + WORD_SLOTS + _MORE


@dataclass
class Block:
    path: tuple[str, ...]  # tags, ".name" of classes and ids, outermost first
    text: str
    linked: int = 0  # characters inside links


@dataclass
class _Reader:
    stack: list[tuple[str, tuple[str, ...]]] = field(default_factory=list)
    parts: list[str] = field(default_factory=list)
    blocks: list[Block] = field(default_factory=list)
    linked: int = 0
    in_link: bool = False

    def text(self, raw: str) -> None:
        if raw:
            self.parts.append(raw)
            if self.in_link:
                self.linked += len(raw)

    def cut(self) -> None:
        if self.parts:
            text = _BLANKS.sub(" ", html.unescape("".join(self.parts))).strip(" ")
            if text:
                self.blocks.append(Block(tuple(t for _, names in self.stack for t in names), text, self.linked))
            self.parts, self.linked = [], 0

    def open(self, tag: str, attrs: str) -> None:
        if tag in _INLINE:
            if tag == "a":
                self.in_link = True
            elif tag == "br":
                self.parts.append(" ")
            return
        self.cut()
        if self.stack and self.stack[-1][0] == "p":  # a paragraph ends where a block begins
            self.stack.pop()
        while self.stack and self.stack[-1][0] in _ENDS_SAME.get(tag, ()):
            self.stack.pop()
        if tag not in _VOID:
            names = {w for m in _ATTR.finditer(attrs) for w in _SPLIT.split((m[2] or m[3] or m[4] or "").lower()) if w} if attrs else ()
            self.stack.append((tag, (tag, *(f".{w}" for w in sorted(names)))))

    def close(self, tag: str) -> None:
        if tag in _INLINE:
            if tag == "a":
                self.in_link = False
            return
        self.cut()
        for k in range(len(self.stack) - 1, -1, -1):
            if self.stack[k][0] == tag:
                del self.stack[k:]
                return


def read_blocks(page: str) -> list[Block]:
    """The leaf blocks of a page, in page order."""
    r, at, n = _Reader(), 0, len(page)
    unclosed: set[str] = set()
    while at < n:
        m = _TAG.search(page, at)
        r.text(page[at : m.start()] if m else page[at:])
        if not m:
            break
        at = m.end()
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            continue
        if m[1] or m[4]:
            r.close(tag)
            continue
        attrs = m[3] if m[2] else m[6]
        if tag in _RAW:
            r.cut() if tag not in ("script", "style") else None
            if tag == "svg" and attrs and attrs.endswith("/"):
                continue
            end = _RAW_END[tag].search(page, at) if tag not in unclosed else None
            if end:
                at = end.end()
            elif tag in _RAW_TO_END:
                at = n
            else:
                unclosed.add(tag)
            continue
        r.open(tag, attrs or "")
        if attrs and attrs.endswith("/") and tag not in _VOID and tag not in _INLINE:
            r.close(tag)
    r.cut()
    return r.blocks


def _named(path: tuple[str, ...]) -> bool:
    """Whether a class or id below the body names main text."""
    tag = ""
    for t in path:
        if t[0] != ".":
            tag = t
        elif tag not in ("html", "body") and t[1:] in MAIN_NAMES:
            return True
    return False


def _rest(path: tuple[str, ...]) -> bool:
    return any(t in REST_TAGS or t[0] == "." and t[1:] in REST_NAMES for t in path)


def rule(path: tuple[str, ...], named: bool = False) -> bool:
    """Whether the path says main text; ``named``: by content names too."""
    inside = any(t in MAIN_TAGS for t in path) or named and _named(path)
    return inside and not _rest(path)


def rule_labels(blocks: list[Block]) -> np.ndarray:
    """The rule's label of every block; on a page without article or main, content names count."""
    named = not any(t in MAIN_TAGS for b in blocks for t in b.path)
    return np.array([rule(b.path, named) for b in blocks], bool)


# ---------------------------------------------------------------- block vectors


def _slot(token: str) -> int:
    h = 2166136261
    for c in token.encode():
        h = (h ^ c) * 16777619 & 0xFFFFFFFF
    return len(_KNOWN) + (h ^ h >> 15) % NAME_SLOTS


_SLOTS: dict[str, int] = {}


def vectors(blocks: list[Block], place: np.ndarray) -> np.ndarray:
    """One row per block; ``place`` is its relative place in the page."""
    out = np.zeros((len(blocks), _WIDTH), np.float32)
    for k, b in enumerate(blocks):
        for t in b.path:
            if t not in _SLOTS:
                if len(_SLOTS) > 100_000:
                    _SLOTS.clear()
                _SLOTS[t] = _KNOWN[t] if t in _KNOWN else _slot(t)
            out[k, _SLOTS[t]] = 1
        out[k, -8:-5] = any(t in MAIN_TAGS for t in b.path), _named(b.path), _rest(b.path)
    data, off = byte_rows(pa.array([b.text for b in blocks], pa.string()), lower=True)
    starts, ends, n = word_spans(data, off, IS_MARK)
    slot = (span_hashes(data, starts, ends) % np.uint64(WORD_SLOTS)).astype(np.int64)
    words = np.bincount(np.repeat(np.arange(len(blocks)), n) * WORD_SLOTS + slot, minlength=len(blocks) * WORD_SLOTS).reshape(-1, WORD_SLOTS)
    out[:, PATH_SLOTS : PATH_SLOTS + WORD_SLOTS] = words / np.maximum(n, 1)[:, None]
    size = np.diff(off)
    out[:, -5], out[:, -4] = np.log1p(size) / 8, np.log1p(n) / 6
    out[:, -3] = np.minimum(1, np.array([b.linked for b in blocks]) / np.maximum(size, 1))
    out[:, -2], out[:, -1] = place, 1
    return out


def page_vectors(pages: list[list[Block]]) -> np.ndarray:
    """The vectors of all blocks of the pages, one page after the other."""
    return vectors([b for p in pages for b in p], np.concatenate([np.arange(len(p)) / len(p) for p in pages]))


def _padded(sizes: list[int], rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(pages, longest, width) vectors and the mask of real blocks."""
    mask = np.arange(max(sizes))[None] < np.array(sizes)[:, None]
    x = np.zeros((*mask.shape, _WIDTH), np.float32)
    x[mask] = rows
    return x, mask


# ---------------------------------------------------------------- bidirectional LSTM


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _lstm(x: np.ndarray, mask: np.ndarray, w: np.ndarray, u: np.ndarray, keep: bool = False, state=None):
    """Hidden states of one direction, from ``state`` on; padded steps carry the state on."""
    n, t, _ = x.shape
    zx = x @ w
    h, c = state or (np.zeros((n, HIDDEN), np.float32), np.zeros((n, HIDDEN), np.float32))
    states, trace = np.zeros((n, t, HIDDEN), np.float32), []
    for k in range(t):
        z = zx[:, k] + h @ u
        i, f, o = (_sigmoid(z[:, j * HIDDEN : (j + 1) * HIDDEN] + (j == 1)) for j in range(3))
        g = np.tanh(z[:, 3 * HIDDEN :])
        new = f * c + i * g
        tc = np.tanh(new)
        m = mask[:, k, None]
        if keep:
            trace.append((h, c, i, f, o, g, tc, m))
        h, c = np.where(m, o * tc, h), np.where(m, new, c)
        states[:, k] = h
    return states, trace, (h, c)


def _lstm_grad(x, trace, u, dstates):
    n, t, _ = x.shape
    dz_all = np.zeros((n, t, 4 * HIDDEN), np.float32)
    du = np.zeros_like(u)
    dh, dc = np.zeros((n, HIDDEN), np.float32), np.zeros((n, HIDDEN), np.float32)
    for k in range(t - 1, -1, -1):
        h, c, i, f, o, g, tc, m = trace[k]
        dh = dh + dstates[:, k]
        d, dcm = np.where(m, dh, 0), np.where(m, dc, 0)
        dnew = dcm + d * o * (1 - tc * tc)
        dz = np.concatenate([dnew * g * i * (1 - i), dnew * c * f * (1 - f), d * tc * o * (1 - o), dnew * i * (1 - g * g)], 1)
        dz_all[:, k] = dz
        du += h.T @ dz
        dh, dc = np.where(m, 0, dh) + dz @ u.T, np.where(m, dnew * f, dc)
    return x.reshape(-1, x.shape[2]).T @ dz_all.reshape(-1, 4 * HIDDEN), du


@dataclass
class Labeller:
    """Weights of the two directions and of the output; None: no model, the rule decides."""
    params: list[np.ndarray] | None

    def main(self, pages: list[list[Block]]) -> list[np.ndarray]:
        """Of every page, which blocks are main text."""
        out: list[np.ndarray] = [np.zeros(0, bool)] * len(pages)
        if self.params is None:
            return [rule_labels(p) for p in pages]
        order = sorted((k for k, p in enumerate(pages) if p), key=lambda k: len(pages[k]))
        at = 0
        while at < len(order):  # as many pages at once as keep blocks times longest bounded
            if len(pages[order[at]]) > STRETCH:
                out[order[at]] = self._long(pages[order[at]])
                at += 1
                continue
            end = at + 1
            while end < len(order) and end - at < PAGES_AT_ONCE and (end - at + 1) * len(pages[order[end]]) <= 16_384:
                end += 1
            own = order[at:end]
            x, mask = _padded([len(pages[k]) for k in own], page_vectors([pages[k] for k in own]))
            p = self._forward(x, mask)[0]
            for k, row, m in zip(own, p, mask, strict=True):
                out[k] = row[m] > 0.5
            at = end
        return out

    def _long(self, page: list[Block]) -> np.ndarray:
        """The labels of one page, a stretch at a time: once forwards, once backwards."""
        wf, uf, wb, ub, v = self.params
        total, state = np.zeros(len(page), np.float32), None
        for a in range(0, len(page), STRETCH):
            x = self._stretch(page, a)
            states, _, state = _lstm(x, np.ones(x.shape[:2], bool), wf, uf, state=state)
            total[a : a + x.shape[1]] += states[0] @ v[:HIDDEN] + v[-1]
        state = None
        for a in range((len(page) - 1) // STRETCH * STRETCH, -1, -STRETCH):
            x = self._stretch(page, a)[:, ::-1]
            states, _, state = _lstm(x, np.ones(x.shape[:2], bool), wb, ub, state=state)
            total[a : a + x.shape[1]] += states[0, ::-1] @ v[HIDDEN:-1]
        return _sigmoid(total) > 0.5

    @staticmethod
    def _stretch(page: list[Block], a: int) -> np.ndarray:
        own = page[a : a + STRETCH]
        return vectors(own, np.arange(a, a + len(own)) / len(page))[None]

    def _forward(self, x, mask, keep: bool = False):
        wf, uf, wb, ub, v = self.params
        a, ta, _ = _lstm(x, mask, wf, uf, keep)
        b, tb, _ = _lstm(x[:, ::-1], mask[:, ::-1], wb, ub, keep)
        both = np.concatenate([a, b[:, ::-1], np.ones((*a.shape[:2], 1), np.float32)], 2)
        return _sigmoid(both @ v), both, ta, tb


def train(pages: list[list[Block]], labels: list[np.ndarray], epochs: int = EPOCHS, seed: int = 13) -> Labeller:
    rng = np.random.default_rng(seed)
    params = [rng.normal(0, s, shape).astype(np.float32) for s, shape in ((0.08, (_WIDTH, 4 * HIDDEN)), (0.15, (HIDDEN, 4 * HIDDEN))) * 2] + [rng.normal(0, 0.15, 2 * HIDDEN + 1).astype(np.float32)]
    model, m1, m2, step = Labeller(params), [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    rows = [page_vectors([p]) for p in pages]
    for _ in range(epochs):
        # pages of like lengths together, so that little is padded
        order = np.argsort([len(p) * rng.uniform(0.8, 1.25) for p in pages], kind="stable")
        for a in rng.permutation(range(0, len(order), 32)):
            own = order[a : a + 32]
            x, mask = _padded([len(rows[k]) for k in own], np.concatenate([rows[k] for k in own]))
            y = np.zeros(mask.shape, np.float32)
            y[mask] = np.concatenate([labels[k] for k in own])
            p, both, ta, tb = model._forward(x, mask, keep=True)
            d = np.where(mask, p - y, 0).astype(np.float32) / mask.sum()
            dboth = d[..., None] * params[4]
            dwf, duf = _lstm_grad(x, ta, params[1], dboth[..., :HIDDEN])
            dwb, dub = _lstm_grad(x[:, ::-1], tb, params[3], dboth[:, ::-1, HIDDEN:-1])
            step += 1
            for k, g in enumerate((dwf, duf, dwb, dub, np.einsum("nt,nth->h", d, both))):
                g = np.clip(g, -1, 1)
                m1[k] = 0.9 * m1[k] + 0.1 * g
                m2[k] = 0.99 * m2[k] + 0.01 * g * g
                params[k] -= (0.02 * (m1[k] / (1 - 0.9**step)) / (np.sqrt(m2[k] / (1 - 0.99**step)) + 1e-7)).astype(np.float32)
    return model


def variant(blocks: list[Block], others: list[str], rng: np.random.Generator, repeat: int = 1) -> tuple[list[Block], np.ndarray]:
    """The page with other containers, other kinds of blocks, chance names and inserted boilerplate, and
    its labels. A container may be a mere division with a telling class, then often on a page without article;
    the main blocks come ``repeat`` times."""
    pick = lambda xs: xs[rng.integers(len(xs))]
    odd = lambda share=0.3: tuple(f".{pick('xyzqk')}{rng.integers(1 << 20)}" for _ in range(1 + rng.integers(3))) if rng.random() < share else ()
    roots = [("article",), ("article",), ("main",), ("main", "article"), ("main", "div", "." + pick(MAIN_NAMES)), ("div", "." + pick(MAIN_NAMES), "article"), ("article", "section"), ("article", "div", "." + pick(MAIN_NAMES)), *[("div", "." + pick(MAIN_NAMES))] * 3, ("section", "." + pick(MAIN_NAMES))]
    often = rng.random()  # how often this page's elements have chance names
    root = pick(roots) + odd(often)
    kinds = [("p",)] * 5 + [("h2",), ("h3",), ("ul", "li"), ("ol", "li"), ("blockquote", "p"), ("pre",), ("table", "tr", "td"), ("figure", "figcaption"), ("div",), ("div",), ("section", "p"), ("dl", "dd"), ("div", "p"), ("div", "div", "p"), ("div", "div")]
    named = lambda kind: tuple(x for t in kind for x in (t, *odd(often)))
    leads, out, good = ("html", "body"), [], []
    for b, main in zip(blocks, rule_labels(blocks), strict=True):
        for _ in range(repeat if main else 1):
            if main:
                own = b.path[-1] if rng.random() < 0.4 else None
                kind = (own,) if own and own[0] != "." and own not in MAIN_TAGS else pick(kinds)
                out.append(Block(leads + root + named(kind), b.text if rng.random() < 0.7 else pick(others), 0))
            else:
                path = b.path if any(t in MAIN_TAGS for t in root) else tuple(t for t in b.path if t not in MAIN_TAGS) or ("div",)
                out.append(Block(path[:-1] + odd(often / 2) + path[-1:], b.text, b.linked))
            good.append(bool(main))
    for _ in range(rng.integers(2, 8)):
        names = (pick(("div", "section", "ul", "p")), "." + pick(REST_NAMES)) if rng.random() < 0.6 else (pick(REST_TAGS),)
        inner = pick([("p",), ("ul", "li"), ("div",), (), ("h3",), ("div", "p")])
        first, last = good.index(True), len(good) - good[::-1].index(True)
        at = int(pick([0, first, last, len(out), rng.integers(first, last + 1)]))
        within = first < at < last or rng.random() < 0.2
        for _ in range(rng.integers(1, 4)):
            text = pick(others)
            text = text if rng.random() < 0.5 else " ".join(text.split(" ")[: rng.integers(1, 8)])
            good.insert(at, False)
            out.insert(at, Block(leads + (root if within else ()) + names + odd(often) + named(inner), text, len(text) if rng.random() < 0.3 else 0))
    # blocks outside every container are no main text either, whatever their chance names
    for _ in range(rng.integers(0, 3)):
        at = int(pick([0, len(out)]))
        good.insert(at, False)
        out.insert(at, Block(leads + named(pick(kinds)), pick(others), 0))
    return out, np.array(good)


def fit(pages: DataFrame, sample: int = SAMPLE) -> Labeller:
    """Learn from about ``sample`` pages, chosen by a hash of their id."""
    got = sorted(sampled(pages.filter("html IS NOT NULL"), "page_id", "html", sample, 21).collect())
    plain = [b for b in (read_blocks(r["html"]) for r in got) if rule_labels(b).any()]
    if not plain:
        return Labeller(None)
    rng = np.random.default_rng(29)
    texts = [b.text for p in plain for b in p]
    repeat = lambda k, p: 1 + (int(rng.integers(LONG)) // len(p) if k % LONG_EVERY == 0 else 0)
    every = [(p, rule_labels(p)) for p in plain] + [variant(p, texts, rng, repeat(k * VARIANTS + j, p)) for k, p in enumerate(plain) for j in range(VARIANTS)]
    return train([p for p, _ in every], [y for _, y in every])


def main_text(pages: DataFrame, model: Labeller | None = None) -> DataFrame:
    """``page_id, url, text, n_chars`` for every row."""
    model = model or fit(pages.select("page_id", "html"))
    schema = pages.select("page_id", "url").schema.add("text", "string").add("n_chars", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 2 * PAGES_AT_ONCE):
                b = batch.slice(a, 2 * PAGES_AT_ONCE)
                pages = [read_blocks(h or "") for h in b.column(2).to_pylist()]
                texts = ["\n\n".join(x.text for x, y in zip(p, m, strict=True) if y) for p, m in zip(pages, model.main(pages), strict=True)]
                yield pa.record_batch([b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], schema.names)

    return pages.select("page_id", "url", "html").mapInArrow(run, schema)
