"""Main text of web pages by a recurrent labeller of leaf blocks.

A page becomes the sequence of its leaf blocks (runs of text between block-level
tags).  A bidirectional LSTM in numpy reads, for every block, hashed vectors of
its tag path and its words, and labels each block with the whole page in view.
"""

from __future__ import annotations

import html
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gramlark.llm.common import bounded_sample, column_map, sigmoid

# How HTML nests.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe svg math select object canvas".split())
BLOCK = frozenset(
    "address article aside blockquote body button caption center dd details dialog div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre search section summary "
    "table tbody td tfoot th thead tr ul".split()
)
CLOSES = {  # an opening tag ends these when they are open and nothing in STOPS lies between
    "li": {"li"},
    "dt": {"dt", "dd"},
    "dd": {"dt", "dd"},
    "tr": {"tr", "td", "th"},
    "td": {"td", "th"},
    "th": {"td", "th"},
    "option": {"option"},
}
STOPS = frozenset("ul ol dl table article section div body html td th".split())

# Words of class and id attributes, and tags, that tell parts of a page.
MAIN_WORDS = "article body content entry main page post story text".split()
NOISE_WORDS = (
    "ad ads advert advertisement alert author banner breadcrumb byline comment comments consent cookie disclaimer "
    "discussion feedback footer form header masthead menu meta nav navbar navigation newsletter notice pager "
    "pagination popup privacy promo related reply respond search share sharing sidebar signup social sponsor "
    "sponsored subscribe tags toc toolbar top widget"
).split()
NOISE_TAGS = frozenset("nav footer aside form button dialog menu search label".split())

TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)"
    r"|<(/?)([A-Za-z][A-Za-z0-9:-]*+)((?:[^>\"']++|\"[^\"]*+(?:\"|\Z)|'[^']*+(?:'|\Z))*+)(?:>|\Z)",
    re.S,
)
NAMED = re.compile(r"(?:^|\s)(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
PART = re.compile(r"[a-z]+")
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")

PATH, WORDS, EXTRA, HIDDEN = 64, 32, 8, 20
WIDTH = PATH + WORDS + EXTRA


def _token(name: str, attributes: str) -> tuple[str, ...]:
    """The tag, then the words of its class, id and role."""
    words = []
    if "=" in attributes:
        for m in NAMED.finditer(attributes):
            words += PART.findall(CAMEL.sub(" ", m[1] or m[2] or m[3] or "").lower())
    return (name, *words)


def blocks(page: str | None) -> list[tuple[tuple[tuple[str, ...], ...], str, float]]:
    """(path, text, share of it in links) of every leaf block with text, in page order.

    Comments, scripts, styles, titles and the like hold no text.  References are
    decoded and white space becomes one space.  Unclosed and cut tags are
    tolerated; the whole page is read.
    """
    page = page or ""
    out, stack, parts, linked, links, at = [], [], [], 0, 0, 0

    def flush():
        nonlocal linked
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                size = sum(map(len, parts)) or 1
                out.append((tuple(t for t in stack if t[0] in BLOCK), text, linked / size))
            parts.clear()
            linked = 0

    end = len(page)
    while at < end:
        m = TAG.search(page, at)
        stop = m.start() if m else end
        if stop > at:
            parts.append(page[at:stop])
            if links:
                linked += stop - at
        if not m:
            break
        at = m.end()
        if m[2] is None:
            continue
        name = m[2].lower()
        if m[1]:  # a closing tag
            if name in BLOCK:
                flush()
            if name == "a":
                links = max(0, links - 1)
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == name:
                    del stack[k:]
                    break
            if name == "br":
                parts.append(" ")
            continue
        if name in RAW:
            close = _closing(name).search(page, at)
            at = close.end() if close else end
            parts.append(" ")
            continue
        if name in BLOCK:
            flush()
            if any(t[0] == "p" for t in stack[-3:]) and name not in ("button", "option"):
                for k in range(len(stack) - 1, -1, -1):  # a paragraph ends where a block begins
                    if stack[k][0] == "p":
                        del stack[k:]
                        break
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] in CLOSES.get(name, ()):
                    del stack[k:]
                    if name not in ("tr",):
                        break
                elif stack[k][0] in STOPS:
                    break
        elif name == "br":
            parts.append(" ")
        if name == "a":
            links += 1
        if name not in VOID and not m[3].endswith("/"):
            stack.append(_token(name, m[3]))
    flush()
    return out


@lru_cache(maxsize=64)
def _closing(name: str) -> re.Pattern:
    return re.compile(rf"</{name}(?:[^>]*+>|\Z)", re.I)


@lru_cache(maxsize=50_000)
def _path_vector(path: tuple[tuple[str, ...], ...]) -> np.ndarray:
    v = np.zeros(PATH, "float32")
    for depth, token in enumerate(reversed(path)):
        for k, w in enumerate(token):
            h = zlib.crc32(("." * (k > 0) + w).encode())
            v[h % PATH] += 1.0 if (h >> 16) & 1 else -1.0
            if k:
                g = zlib.crc32(b"~" + w[:4].encode())
                v[g % PATH] += 0.5 if (g >> 16) & 1 else -0.5
            elif depth == 0:
                g = zlib.crc32(b"!" + w.encode())
                v[g % PATH] += 1.0 if (g >> 16) & 1 else -1.0
    return v


def features(page: list[tuple]) -> np.ndarray:
    """One row of inputs per block."""
    out = np.zeros((len(page), WIDTH), "float32")
    for k, (path, text, linked) in enumerate(page):
        words = text.split()
        h = np.fromiter((zlib.crc32(w.encode("utf-8", "surrogatepass")) for w in words), "i8", len(words))
        sign = ((h >> 16) & 1) * 2.0 - 1
        out[k, :PATH] = _path_vector(path)
        bag = np.bincount(h % WORDS, sign, WORDS)
        out[k, PATH : PATH + WORDS] = bag / max(1.0, np.linalg.norm(bag))
        out[k, PATH + WORDS :] = (
            np.log1p(len(text)) / 5,
            np.log1p(len(words)) / 3,
            linked,
            sum(w[-1] in ".,;:!?" for w in words) / len(words),
            text[-1] in ".!?",
            len(path) / 6,
            k / len(page),
            1.0 / len(page),
        )
    return out


@dataclass
class Labeller:
    """Two LSTM directions (input, recurrent weights, bias) and the output layer."""

    forward: list[np.ndarray]
    backward: list[np.ndarray]
    out: list[np.ndarray]

    def scores(self, x: np.ndarray, mask: np.ndarray) -> np.ndarray:
        """Probability of main text: x is (time, page, input), mask (time, page)."""
        a, _ = _run(self.forward, x, mask)
        b, _ = _run(self.backward, x[::-1], mask[::-1])
        return sigmoid(np.concatenate([a, b[::-1]], 2) @ self.out[0] + self.out[1])[..., 0]

    def label(self, pages: list[np.ndarray], cells: int = 40_000) -> list[np.ndarray]:
        """Scores of the blocks of every page; pages of like length run together."""
        found: list[np.ndarray] = [np.zeros(0)] * len(pages)
        order = sorted((i for i, p in enumerate(pages) if len(p)), key=lambda i: len(pages[i]))
        at = 0
        while at < len(order):
            group = [order[at]]
            while at + len(group) < len(order) and (len(group) + 1) * len(pages[order[at + len(group)]]) <= cells:
                group.append(order[at + len(group)])
            x, mask = pad([pages[i] for i in group])
            s = self.scores(x, mask)
            for k, i in enumerate(group):
                found[i] = s[: len(pages[i]), k]
            at += len(group)
        return found


def pad(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    x = np.zeros((max(map(len, pages)), len(pages), WIDTH), "float32")
    mask = np.zeros(x.shape[:2], "float32")
    for k, p in enumerate(pages):
        x[: len(p), k], mask[: len(p), k] = p, 1
    return x, mask


def _run(w: list[np.ndarray], x: np.ndarray, mask: np.ndarray, keep: bool = False):
    """Hidden states over time; where the mask is 0 the state stays zero."""
    steps, pages, _ = x.shape
    n = w[1].shape[0]
    z = x @ w[0] + w[2]
    h, c = np.zeros((pages, n), "float32"), np.zeros((pages, n), "float32")
    hs, kept = np.empty((steps, pages, n), "float32"), []
    for t in range(steps):
        g = z[t] + h @ w[1]
        s = 1 / (1 + np.exp(-np.clip(g[:, : 3 * n], -30, 30)))
        u = np.tanh(g[:, 3 * n :])
        before = (h, c)
        m = mask[t][:, None]
        c = (s[:, n : 2 * n] * c + s[:, :n] * u) * m
        tc = np.tanh(c)
        h = s[:, 2 * n :] * tc * m
        hs[t] = h
        if keep:
            kept.append((s, u, tc, *before))
    return hs, kept


def _back(w: list[np.ndarray], x: np.ndarray, mask: np.ndarray, kept: list, dh_out: np.ndarray) -> list[np.ndarray]:
    """Gradients of the three weight arrays by back-propagation through time."""
    steps, pages, _ = x.shape
    n = w[1].shape[0]
    dz, dw = np.empty((steps, pages, 4 * n), "float32"), np.zeros_like(w[1])
    dh, dc = np.zeros((pages, n), "float32"), np.zeros((pages, n), "float32")
    for t in range(steps - 1, -1, -1):
        s, u, tc, h0, c0 = kept[t]
        m = mask[t][:, None]
        dh = (dh + dh_out[t]) * m
        dc = dc * m + dh * s[:, 2 * n :] * (1 - tc**2)
        d = np.concatenate([dc * u, dc * c0, dh * tc, dc * s[:, :n]], 1)
        d[:, : 3 * n] *= s * (1 - s)
        d[:, 3 * n :] *= 1 - u**2
        dz[t] = d
        dw += h0.T @ d
        dh, dc = d @ w[1].T, dc * s[:, n : 2 * n]
    return [np.tensordot(x, dz, ((0, 1), (0, 1))), dw, dz.sum((0, 1))]


def fit(pages: list[np.ndarray], marks: list[np.ndarray], steps: int = 320, batch: int = 32, seed: int = 3) -> Labeller:
    """Train by Adam on pages of block features; a mark is 1, 0, or -1 for unknown."""
    rng = np.random.default_rng(seed)
    part = lambda: [
        rng.normal(0, WIDTH**-0.5, (WIDTH, 4 * HIDDEN)).astype("float32"),
        rng.normal(0, HIDDEN**-0.5, (HIDDEN, 4 * HIDDEN)).astype("float32"),
        np.r_[np.zeros(HIDDEN), np.ones(HIDDEN), np.zeros(2 * HIDDEN)].astype("float32"),
    ]
    model = Labeller(part(), part(), [rng.normal(0, 0.1, (2 * HIDDEN, 1)).astype("float32"), np.zeros(1, "float32")])
    slow: dict[int, list[np.ndarray]] = {}
    for step in range(steps if pages else 0):
        rows = rng.choice(len(pages), min(batch, len(pages)), replace=False)
        x, mask = pad([pages[i] for i in rows])
        y = np.full(mask.shape, -1.0, "float32")
        for k, i in enumerate(rows):
            y[: len(marks[i]), k] = marks[i]
        a, keep_a = _run(model.forward, x, mask, True)
        b, keep_b = _run(model.backward, x[::-1], mask[::-1], True)
        both = np.concatenate([a, b[::-1]], 2)
        p = sigmoid(both @ model.out[0] + model.out[1])[..., 0]
        known = (y >= 0) & (mask > 0)
        d = (np.where(known, p - y, 0) / max(1, known.sum())).astype("float32")[..., None]
        dboth = d * model.out[0][:, 0]
        grads = {
            0: _back(model.forward, x, mask, keep_a, dboth[..., :HIDDEN]),
            1: _back(model.backward, x[::-1], mask[::-1], keep_b, dboth[::-1, :, HIDDEN:]),
            2: [np.tensordot(both, d, ((0, 1), (0, 1))), d.sum((0, 1))],
        }
        rate = 0.02 * min(1.0, 2 * (1 - step / steps))
        for k, weights in enumerate((model.forward, model.backward, model.out)):
            state = slow.setdefault(k, [np.zeros((2, *w.shape), "float32") for w in weights])
            for w, g, s in zip(weights, grads[k], state):
                s[0] = 0.9 * s[0] + 0.1 * g
                s[1] = 0.99 * s[1] + 0.01 * g * g
                w -= rate * s[0] / (1 - 0.9 ** (step + 1)) / (np.sqrt(s[1] / (1 - 0.99 ** (step + 1))) + 1e-7)
    return model


def weak_marks(page: list[tuple]) -> np.ndarray:
    """1 for blocks in a part that names itself main, 0 for parts that name themselves anything else.

    The innermost telling token decides; a header in an article is part of it.
    """
    out = []
    for path, _, _ in page:
        mark = -1
        inside = False
        for tag, *words in path:
            if tag in NOISE_TAGS or any(w in NOISE_WORDS for w in words) or (tag == "header" and not inside):
                mark = 0
            elif mark and (tag in ("article", "main") or any(w in MAIN_WORDS for w in words) and tag != "body"):
                mark, inside = 1, True
        out.append(mark)
    return np.array(out, "float32")


def composed_page(texts: list[str], rng: np.random.Generator) -> tuple[list[tuple], np.ndarray]:
    """A training page of random layout: known roles, texts taken from real pages.

    Every noise role holds any text at all, so that words alone don't decide.
    """
    pick = lambda xs: xs[int(rng.integers(len(xs)))]
    page: list[tuple] = []
    marks: list[int] = []

    def text(short: bool) -> str:
        words = pick(texts).split()
        n = int(rng.integers(1, 6)) if short else int(rng.integers(1, max(2, min(len(words), 200))))
        at = int(rng.integers(max(1, len(words) - n + 1)))
        if rng.random() < 0.1:
            return " ".join([words[at]] * int(rng.integers(2, 200)))
        return " ".join(words[at : at + n]) or "text"

    def add(path: list[tuple], mark: int, short: bool, linked: float):
        page.append((tuple(path), text(short), linked))
        marks.append(mark)

    html_, body = ("html",), ("body",) if rng.random() < 0.7 else ("body", pick(["page", "home", "single", "post"]))
    root = [html_, body] + [("div", pick(["wrapper", "container", "page", "site", "layout"]))] * int(rng.random() < 0.5)
    main = pick(
        [[("article",)], [("article",)], [("main",)], [("main",), ("article",)], [("div", "content")], [("div", "post", "content")]]
        + [[("div", w)] for w in MAIN_WORDS]
        + [[("section", "story")], [("div", "entry", "content")], [("article", "post"), ("div", "body")], [("td", "content")]]
    )
    noise = [
        ([("nav",), ("ul",), ("li",)], True, 1.0),
        ([("nav",)], True, 1.0),
        ([("div", pick(["menu", "nav", "navbar", "navigation", "breadcrumb"])), ("ul",), ("li",)], True, 1.0),
        ([("ul", "menu"), ("li",)], True, 1.0),
        ([("header",)], rng.random() < 0.7, 0.0),
        ([("header",), (pick(["h1", "h2", "p", "div"]),)], rng.random() < 0.7, 0.0),
        ([("footer",)], False, 0.2),
        ([("footer",), ("p",)], False, 0.2),
        ([("aside",), (pick(["p", "div", "h3"]),)], False, 0.3),
        ([("aside",), ("ul",), ("li",)], True, 1.0),
        ([("form",), (pick(["p", "div", "label", "button", "fieldset"]),)], True, 0.0),
        ([("form",)], True, 0.0),
        ([("div", pick(["comments", "comment", "discussion", "respond"])), (pick(["p", "div"]),)], False, 0.0),
        ([("section", "comments"), ("ol",), ("li", "comment"), ("p",)], False, 0.0),
        ([("section", "comments"), ("article", "comment"), ("p",)], False, 0.0),
        *[([(pick(["div", "div", "section", "p", "ul"]), w)], rng.random() < 0.4, float(rng.random() < 0.3)) for w in rng.choice(NOISE_WORDS, 5)],
        *[([("div", w), (pick(["p", "h3", "div", "li"]),)], rng.random() < 0.3, 0.0) for w in rng.choice(NOISE_WORDS, 5)],
    ]

    def some(base: list[tuple], most: int):
        for _ in range(int(rng.integers(0, most + 1))):
            path, short, linked = pick(noise)
            for _ in range(int(rng.integers(1, 7)) if path[-1][0] in ("li", "p", "div") else 1):
                add(base + path, 0, short, linked)

    some(root, 4)
    if rng.random() < 0.95:
        if rng.random() < 0.8:
            add(root + main + [("header",)] * int(rng.random() < 0.15) + [(pick(["h1", "h1", "h2"]),)], 1, rng.random() < 0.5, 0.0)
        for _ in range(int(rng.integers(0, 14))):
            tail = pick([[("p",)]] * 9 + [[("h2",)], [("h3",)], [("blockquote",), ("p",)], [("ul",), ("li",)], [("pre",)], [("table",), ("tr",), ("td",)], [("div",)], [("figure",), ("figcaption",)], [("section",), ("p",)], []])
            add(root + main + tail, 1, rng.random() < 0.15, float(rng.random() < 0.1) * 0.5)
            if rng.random() < 0.12:
                some(root + main, 1)
    some(root, 4)
    return page, np.array(marks, "float32")


def train(pages: DataFrame, max_pages: int = 400, composed: int = 900, key: str = "page_id") -> Labeller:
    """Labeller trained on at most ``max_pages`` pages, chosen by hash of ``key``.

    Their blocks are marked where the markup names the part; their texts also
    fill ``composed`` pages of random layouts.
    """
    got = bounded_sample(pages.select(key, "html").where("html IS NOT NULL"), max_pages, F.col(key))
    real = [b for h in got.html if (b := blocks(h))]
    texts = [t for p in real for _, t, _ in p] or ["some words of text, in a row."]
    rng = np.random.default_rng(17)
    data = [(p[:120], weak_marks(p)[:120]) for p in real] + [composed_page(texts, rng) for _ in range(composed)]
    data = [(p, m) for p, m in data if p]
    return fit([features(p) for p, _ in data], [m for _, m in data])


def main_text(pages: DataFrame, labeller: Labeller, column: str = "html"):
    """Struct column ``text``, ``n_chars`` and ``n_blocks`` (kept blocks) of every whole page."""
    model = pages.sparkSession.sparkContext.broadcast(labeller)  # some ten thousand numbers

    def make():
        fitted = model.value

        def each(values: pd.Series) -> pd.DataFrame:
            rows = []
            for part in _runs(values.tolist()):
                split = [blocks(v) for v in part]
                for page, s in zip(split, fitted.label([features(p) for p in split])):
                    kept = [t for (_, t, _), v in zip(page, s) if v >= 0.5]
                    text = " ".join(kept)
                    rows.append((text, len(text), len(kept)))
            return pd.DataFrame(rows, columns=["text", "n_chars", "n_blocks"])

        return each

    return column_map(pages, column, "text string, n_chars long, n_blocks int", make)


def _runs(values: list[str | None], chars: int = 4_000_000) -> Iterator[list[str | None]]:
    part, size = [], 0
    for v in values:
        part.append(v)
        size += len(v or "")
        if size >= chars:
            yield part
            part, size = [], 0
    if part:
        yield part
