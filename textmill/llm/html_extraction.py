"""Main text of web pages by a recurrent block labeller.

A page is cut at block-level tags into leaf blocks. Each block is a vector: its
tag path and class names (hashed), its words (hashed) and a few measures. A
bidirectional LSTM in numpy reads all blocks of a page, so that every block is
judged by what stands before and behind it, and labels it text or not.

There are no labelled pages, so the model is trained on about TRAIN_PAGES pages
(a hash sample) labelled by their semantic tags. Each is shown in variants: the
container of the article renamed, boilerplate of other kinds put in, part of the
path hidden, so that the labeller has to use words, shape and neighbours too.

Defined results
    null or empty html, or nothing but boilerplate: the empty text.
    Unclosed, nested or cut-off tags are read as far as they go.
    Repeated pages are each extracted. No pages at all: no rows.
    Pages are read whole, however long.
    Other columns stay; one named like the output (text) is replaced.
"""

from __future__ import annotations

import html as entities
import re
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from textmill.llm.rows import whole_text
from textmill.llm.text_arrays import buffers, slices, word_hashes, words

TRAIN_PAGES = 400
PATH, WORDS, SHAPE, HIDDEN = 64, 32, 8, 24
WIDTH = PATH + WORDS + SHAPE
EPOCHS = 16
BLOCKS_AT_ONCE = 16_384
SEED = 17

# Values are quoted only behind an equals sign, so other quotes never hide a tag's end. A tag that the
# page does not end is read to the page's end, so no part of a page is read again and again.
_ATTRIBUTES = r"(?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')|=)*+"
_TOKEN = re.compile(
    r"<!--.*?(?:-->|$)"
    rf"|<(?P<raw>script|style|iframe)(?![a-z0-9:-]){_ATTRIBUTES}>.*?(?:</(?P=raw)\s*>|$)"
    rf"|<(?P<unseen>noscript|template|svg)(?![a-z0-9:-]){_ATTRIBUTES}(?:(?<=/)>|>.*?(?:</(?P=unseen)\s*>|$))"
    rf"|<(?P<end>/?)(?P<name>[a-z][a-z0-9:-]*)(?P<attributes>{_ATTRIBUTES})(?:>|$)"
    r"|<[!?][^>]*>",
    re.S | re.I,
)
_NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_NAME_PART = re.compile(r"[a-z]+|\d+", re.I)
BLOCK_TAGS = frozenset(
    "address article aside blockquote body button caption center dd details dialog div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hr html label legend li main menu nav ol optgroup option p pre section "
    "select summary table tbody td textarea tfoot th thead title tr ul".split()
)
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Opening one of these ends an open paragraph.
ENDS_PARAGRAPH = BLOCK_TAGS - {"label", "button", "option", "optgroup", "legend", "caption", "summary"}
SAME_LEVEL = {"li": "li", "dt": "dt dd", "dd": "dt dd", "td": "td th", "th": "td th", "tr": "tr", "option": "option"}

BOILERPLATE_TAGS = frozenset("nav header footer aside form title button select option label menu dialog".split())
BOILERPLATE_NAMES = frozenset(
    "ad ads advert advertisement banner menu nav navbar navigation sidebar cookie cookies notice consent comment comments "
    "promo related share social footer header breadcrumb subscribe newsletter sponsor login search popup widget "
    "reply replies response responses discussion thread".split()
)
CONTAINERS = ["main", "div.content", "div.post", "div.article.body", "section.story", "div.entry", "td", "div", "article.post", "div/div", "section", "div.c1/div.x"]
# What text consists of besides paragraphs: path, blocks in a row at most, words of each at most.
CONTENT = [
    ("ul/li", 6, 25), ("ol/li", 6, 25), ("table/tr/td", 8, 6), ("table/tbody/tr/td", 8, 6), ("table/tr/th", 4, 3), ("h2", 1, 9), ("h3", 1, 9), ("h4", 1, 8),
    ("h5", 1, 8), ("h6", 1, 8), ("blockquote/p", 2, 40), ("blockquote", 1, 40), ("figure/figcaption", 1, 20), ("pre", 1, 60), ("dl/dt", 1, 4),
    ("dl/dd", 2, 25), ("section/p", 3, 60), ("div", 3, 60), ("section/h2", 1, 9), ("header/h1", 1, 12), ("header/p", 1, 25), ("h1", 1, 12), ("div/p", 3, 60),
    ("ul/li/p", 4, 25), ("table/caption", 1, 8), ("details/summary", 1, 6), ("address", 1, 12),
]
EXTRAS = [
    "aside.sidebar/p", "aside/ul/li", "div.sidebar/p", "div.comments/p", "section.comments/div.comment", "ul.comment.list/li/p",
    "div.comment/p", "div.cookie.notice/p", "div.notice/p", "div.banner/p", "form/label", "form/p", "form/button", "div.advert/p",
    "div.ad", "div.ads/p", "header/h1", "header/p", "header.site/div", "div.related/ul/li", "div.newsletter/p", "nav/a", "div.menu/li",
    "footer/p", "div.footer/p", "div.promo/p", "aside.ad/p", "section.related/h2", "div.share",
    "section.responses/div.reply/p", "div.thread/div/p", "ol.replies/li/p", "section.discussion/div.reply", "aside/h2", "footer/ul/li", "nav/ul/li", "div.widget/ul/li",
]


# Tokens that labels come from keep their names; the others are known by their slot of the vector.
# So the open elements of a page, however deep, have no more different tokens than these and PATH.
NAMED = {"article", "main"} | BOILERPLATE_TAGS | {"." + name for name in BOILERPLATE_NAMES}


def placed(token: str) -> str:
    return token if token in NAMED else f"#{zlib.crc32(token.encode()) % PATH}"


class Block(NamedTuple):
    path: tuple[str, ...]
    text: str
    linked: int


def blocks(page: str) -> list[Block]:
    """The leaf blocks of a page in order, with non-empty text."""
    out: list[Block] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    opened: dict[str, int] = {}  # how often each token of all open elements occurs
    parts: list[str] = []
    links = [0, 0]  # open links, characters inside links

    def flush() -> None:
        raw = "".join(parts)
        parts.clear()
        linked, links[1] = links[1], 0
        text = " ".join(entities.unescape(raw).split())
        if text:
            out.append(Block(tuple(opened), text, linked))

    def close(name: str, until: frozenset[str] = frozenset()) -> None:
        for i in range(len(stack) - 1, -1, -1):
            if stack[i][0] == name:
                for tag, tokens in stack[i:]:
                    links[0] -= tag == "a"
                    for token in tokens:
                        opened[token] -= 1
                        if not opened[token]:
                            del opened[token]
                del stack[i:]
                return
            if stack[i][0] in until:
                return

    at = 0
    for m in _TOKEN.finditer(page):
        if m.start() > at:
            parts.append(page[at : m.start()])
            links[1] += (m.start() - at) if links[0] > 0 else 0
        at = m.end()
        name = (m["name"] or "").lower()
        if not name:
            continue
        if name in BLOCK_TAGS:
            flush()
        elif name == "br":
            parts.append(" ")
        if m["end"]:
            close(name)
            continue
        if name in VOID_TAGS:
            continue
        if name in ENDS_PARAGRAPH:
            close("p", BLOCK_TAGS - {"p"})
        for same in SAME_LEVEL.get(name, "").split():
            close(same, frozenset({"ul", "ol", "dl", "table", "select"}))
        tokens = [name]
        for found in _NAMES.finditer(m["attributes"]) if "=" in m["attributes"] else ():
            value = found[1] or found[2] or found[3] or ""
            tokens += ["." + part.lower() for part in _NAME_PART.findall(value)]
        links[0] += name == "a"
        tokens = [placed(token) for token in tokens]
        for token in tokens:
            opened[token] = opened.get(token, 0) + 1
        stack.append((name, tuple(tokens)))
    if at < len(page):
        parts.append(page[at:])
        links[1] += (len(page) - at) if links[0] > 0 else 0
    flush()
    return out


def vectors(listed: list[Block], page_of: np.ndarray) -> np.ndarray:
    """One row per block; ``page_of`` numbers the page of each."""
    n = len(listed)
    x = np.zeros((n, WIDTH), np.float32)
    known: dict[str, int] = {}
    for i, block in enumerate(listed):
        for token in block.path:
            slot = known.get(token)
            if slot is None:
                slot = int(token[1:]) if token[0] == "#" else zlib.crc32(token.encode()) % PATH
                known[token] = slot
            x[i, slot] = 1.0
    texts = pa.array([b.text for b in listed], pa.string())
    for a, b in slices(texts):
        data, offsets = buffers(texts.slice(a, b - a))
        start, end, owner = words(data, offsets)
        slot = (word_hashes(data, start, end) % np.uint64(WORDS)).astype(np.int64)
        count = np.bincount(owner * WORDS + slot, minlength=(b - a) * WORDS).reshape(b - a, WORDS)
        x[a:b, PATH : PATH + WORDS] = 0.3 * np.log1p(count)
    size = np.array([len(b.text) for b in listed], np.float32)
    gaps = np.array([b.text.count(" ") + 1 for b in listed], np.float32)
    stops = np.array([sum(map(b.text.count, ".!?")) for b in listed], np.float32)
    commas = np.array([b.text.count(",") for b in listed], np.float32)
    linked = np.array([b.linked for b in listed], np.float32)
    first = np.searchsorted(page_of, page_of)
    total = np.searchsorted(page_of, page_of, "right") - first
    at = PATH + WORDS
    x[:, at] = np.log1p(size) / 6
    x[:, at + 1] = np.log1p(gaps) / 5
    x[:, at + 2] = np.minimum(1, linked / np.maximum(size, 1))
    x[:, at + 3] = np.minimum(1, 10 * stops / gaps)
    x[:, at + 4] = np.minimum(1, 5 * commas / gaps)
    x[:, at + 5] = (np.arange(n) - first) / total
    x[:, at + 6] = np.minimum(1, total / 50)
    x[:, at + 7] = 1.0
    return x


# The network -----------------------------------------------------------------


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 0.5 * (np.tanh(0.5 * z) + 1)


def _run(x: np.ndarray, mask: np.ndarray, w: np.ndarray, keep: bool = False):
    """One direction of the LSTM over x (steps, pages, WIDTH); masked steps hold the state."""
    steps, pages, _ = x.shape
    h = np.zeros((pages, HIDDEN), np.float32)
    c = np.zeros((pages, HIDDEN), np.float32)
    hs, trace = np.zeros((steps, pages, HIDDEN), np.float32), []
    from_input = x @ w[:WIDTH]
    for t in range(steps):
        z = from_input[t] + h @ w[WIDTH:]
        gates = _sigmoid(z[:, : 3 * HIDDEN])
        i, f, o = gates[:, :HIDDEN], gates[:, HIDDEN : 2 * HIDDEN], gates[:, 2 * HIDDEN :]
        g = np.tanh(z[:, 3 * HIDDEN :])
        c_new = f * c + i * g
        squashed = np.tanh(c_new)
        m = mask[t][:, None]
        if keep:
            trace.append((h, c, i, f, o, g, squashed))
        c = np.where(m, c_new, c)
        h = np.where(m, o * squashed, h)
        hs[t] = h
    return hs, trace


def _back(x: np.ndarray, mask: np.ndarray, w: np.ndarray, trace, d_hs: np.ndarray) -> np.ndarray:
    """Gradient of w, given that of every step's output."""
    grad = np.zeros_like(w)
    dh = np.zeros_like(d_hs[0])
    dc = np.zeros_like(d_hs[0])
    dz_all = np.zeros((*x.shape[:2], 4 * HIDDEN), np.float32)
    for t in range(len(trace) - 1, -1, -1):
        h, c, i, f, o, g, squashed = trace[t]
        m = mask[t][:, None]
        dh = dh + d_hs[t]
        held_h, held_c = np.where(m, 0, dh), np.where(m, 0, dc)
        dh_in = np.where(m, dh, 0)
        dc_in = np.where(m, dc, 0) + dh_in * o * (1 - squashed**2)
        dz = np.concatenate(
            [dc_in * g * i * (1 - i), dc_in * c * f * (1 - f), dh_in * squashed * o * (1 - o), dc_in * i * (1 - g**2)], axis=1
        )
        dz_all[t] = dz
        grad[WIDTH:] += h.T @ dz
        dh = dz @ w[WIDTH:].T + held_h
        dc = dc_in * f + held_c
    grad[:WIDTH] = np.tensordot(x, dz_all, ([0, 1], [0, 1]))
    return grad


class Labeller(NamedTuple):
    forward: np.ndarray
    backward: np.ndarray
    out: np.ndarray

    def scores(self, x: np.ndarray, mask: np.ndarray, keep: bool = False):
        ahead, trace_a = _run(x, mask, self.forward, keep)
        behind, trace_b = _run(x[::-1], mask[::-1], self.backward, keep)
        joined = np.concatenate([ahead, behind[::-1], np.ones((*x.shape[:2], 1), np.float32)], axis=2)
        return joined @ self.out, (joined, trace_a, trace_b)


def new_labeller(rng: np.random.Generator) -> Labeller:
    scale = 1 / np.sqrt(WIDTH + HIDDEN)
    one, two = (rng.normal(0, scale, (WIDTH + HIDDEN, 4 * HIDDEN)).astype(np.float32) for _ in range(2))
    return Labeller(one, two, rng.normal(0, 0.2, 2 * HIDDEN + 1).astype(np.float32))


def _stacked(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Pages of unequal length as one (steps, pages, WIDTH) array and its mask."""
    steps = max(map(len, rows))
    x = np.zeros((steps, len(rows), WIDTH), np.float32)
    mask = np.zeros((steps, len(rows)), bool)
    for k, r in enumerate(rows):
        x[: len(r), k], mask[: len(r), k] = r, True
    return x, mask


def label(model: Labeller, pages: list[list[Block]]) -> list[list[bool]]:
    """Which blocks of each page are text. Pages of like length are read together."""
    sizes = np.array([len(p) for p in pages])
    out: list[list[bool]] = [[] for _ in pages]
    order = [int(k) for k in np.argsort(sizes, kind="stable") if sizes[k]]
    at = 0
    while at < len(order):
        last = at + 1
        while last < len(order) and sizes[order[last]] * (last + 1 - at) <= BLOCKS_AT_ONCE:
            last += 1
        group = order[at:last]
        at = last
        flat = [b for k in group for b in pages[k]]
        x = vectors(flat, np.repeat(np.arange(len(group)), sizes[group]))
        rows = np.split(x, np.cumsum(sizes[group])[:-1])
        score, _ = model.scores(*_stacked(rows))
        for k, page in enumerate(group):
            out[page] = (score[: sizes[page], k] > 0).tolist()
    return out


def main_text(model: Labeller, pages: list[str]) -> list[str]:
    cut = [blocks(p) for p in pages]
    return ["\n\n".join(b.text for b, yes in zip(p, kept) if yes) for p, kept in zip(cut, label(model, cut))]


# Training --------------------------------------------------------------------


def taught(page: list[Block]) -> list[bool] | None:
    """Labels by semantic tags; None for pages without an article."""
    inside = [("article" in b.path or "main" in b.path) for b in page]
    if not any(inside):
        return None
    names = {"." + n for n in BOILERPLATE_NAMES}
    # A header inside the article is the article's own.
    return [yes and not (names & set(b.path) or (BOILERPLATE_TAGS - {"header"}) & set(b.path)) for b, yes in zip(page, inside)]


def tokens_of(path: str) -> list[str]:
    return [t if k == 0 else "." + t for step in path.split("/") for k, t in enumerate(step.split("."))]


def varied(page: list[Block], labels: list[bool], spare: list[str], rng: np.random.Generator) -> tuple[list[Block], list[bool]]:
    """A variant of a page: another container, other kinds of text in it, further boilerplate, names hidden."""
    container = tokens_of(CONTAINERS[rng.integers(len(CONTAINERS))]) if rng.random() < 0.6 else ["article"]
    # In some pages nothing is named: place, links, shape and words must do.
    unnamed = rng.random() < 0.25
    rich = rng.random() < 0.6
    out, kept = [], []

    def put(path: list[str], text: str, linked: int, yes: bool) -> None:
        if unnamed:
            path = ["div" if t in NAMED or t in ("section", "main") else t for t in path if t[0] != "."]
        out.append(Block(tuple(dict.fromkeys(path)), text, linked))
        kept.append(yes)

    def some(words: int) -> str:
        picked = spare[rng.integers(len(spare))].split()
        first = int(rng.integers(max(1, len(picked) - words)))
        return " ".join(picked[first : first + int(rng.integers(1, words + 1))])

    def extra() -> None:
        kind = EXTRAS[rng.integers(len(EXTRAS))]
        # Headers are the page's own only outside the text.
        inside = rng.random() < 0.5 and not kind.startswith("header") and not unnamed
        path = ["html", "body", *(container if inside else []), *tokens_of(kind)]
        links = rng.random() < (0.9 if "li" in path or "a" in path else 0.15) or unnamed
        for _ in range(rng.integers(1, 7)):
            text = some(8 if links or "li" in path else 60)
            put(path, text, len(text) if links else 0, False)

    def content() -> None:
        kind, most, words = CONTENT[rng.integers(len(CONTENT))]
        for _ in range(rng.integers(1, most + 1)):
            text = some(words)
            put(["html", "body", *container, *tokens_of(kind)], text, int(len(text) * (rng.random() < 0.15) * rng.random()), True)

    begun = ended = False
    for block, yes in zip(page, labels):
        if rng.random() < 0.12 and not (unnamed and begun and not ended):
            extra()
        if yes and not begun and rich and rng.random() < 0.5:
            put(["html", "body", *container, *tokens_of(("header/h1", "h1", "header/p", "div/h1")[rng.integers(4)])], some(12), 0, True)
        begun, ended = begun or yes, begun and not yes
        path = [t for p in block.path for t in (container if p in ("article", "main") else [p])]
        if rng.random() < 0.1:
            path = [t for t in path if rng.random() < 0.5]
        put(path, block.text, block.linked, yes)
        if yes and rich and rng.random() < 0.35:
            content()
    if rng.random() < 0.5:
        extra()
    return out, kept


def train(pages: list[str], epochs: int = EPOCHS, seed: int = SEED) -> Labeller:
    """Fit the labeller to pages labelled by their tags."""
    rng = np.random.default_rng(seed)
    model = new_labeller(rng)
    known = [(b, y) for b in map(blocks, pages) if b and (y := taught(b)) is not None]
    if not known:
        # Nothing to learn from: one page with the tags the labels come from.
        page = "<body><nav><a>Menu one</a></nav><article><h1>Title</h1><p>First words of a text, a sentence.</p></article><footer>End</footer></body>"
        known = [(b := blocks(page), taught(b))] * 32
    spare = [b.text for p, _ in known for b in p]
    parameters = list(model)
    first = [np.zeros_like(p) for p in parameters]
    second = [np.zeros_like(p) for p in parameters]
    step = 0
    for _ in range(epochs):
        shown = [varied(p, y, spare, rng) if rng.random() < 0.7 else (p, y) for p, y in known]
        for a in range(0, len(shown), 32):
            part = shown[a : a + 32]
            sizes = np.array([len(p) for p, _ in part])
            x = vectors([b for p, _ in part for b in p], np.repeat(np.arange(len(part)), sizes))
            x, mask = _stacked(np.split(x, np.cumsum(sizes)[:-1]))
            target = np.zeros(mask.shape, np.float32)
            for k, (_, y) in enumerate(part):
                target[: len(y), k] = y
            score, (joined, trace_a, trace_b) = model.scores(x, mask, keep=True)
            d = (_sigmoid(score) - target) * mask / mask.sum()
            d_joined = d[:, :, None] * model.out
            grads = [
                _back(x, mask, model.forward, trace_a, d_joined[:, :, :HIDDEN]),
                _back(x[::-1], mask[::-1], model.backward, trace_b, d_joined[::-1, :, HIDDEN : 2 * HIDDEN]),
                np.tensordot(d, joined, ([0, 1], [0, 1])),
            ]
            step += 1
            for k, g in enumerate(grads):
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                rate = 0.01 * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
                parameters[k] -= (rate * first[k] / (np.sqrt(second[k]) + 1e-8)).astype(np.float32)
    return model


def fit_labeller(pages: DataFrame, html: str = "html", rows: int = TRAIN_PAGES) -> Labeller:
    """Train on about ``rows`` pages drawn by a hash of the page."""
    share = min(1.0, rows / max(1, pages.count()))
    drawn = pages.where(F.col(html).isNotNull()).where(F.pmod(F.xxhash64(html), F.lit(1 << 30)) < int(share * (1 << 30)))
    # The order makes the training repeatable; the sample is bounded by ``rows``.
    return train(sorted(r[0] for r in drawn.select(html).collect()))


def extract_text(pages: DataFrame, model: Labeller, html: str = "html", out: str = "text") -> DataFrame:
    """Add the main text of every page; no row moves."""

    @F.arrow_udf("string")
    def extracted(column: pa.Array) -> pa.Array:
        parts: Iterator[list[str]] = (
            main_text(model, column.slice(a, b - a).to_pylist()) for a, b in slices(column)
        )
        return pa.array([t for part in parts for t in part], pa.string())

    return pages.withColumn(out, extracted(whole_text(html)))
