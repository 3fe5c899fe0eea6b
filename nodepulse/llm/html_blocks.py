"""Main text of web pages by a recurrent block labeller.

A page is cut into its leaf blocks: runs of text that no block-level tag
interrupts.  A block is described by the tags, classes and ids on its path, by
all its words, hashed, its length, the share of it inside links, its place, and
the part of the page's text that has the same path.  A
bidirectional LSTM reads the page's blocks in order and gives each the
probability of being main text, so that a block is judged with the whole page.

There are no labels.  Pages on which names speak for themselves have them by a
rule: blocks below an article, less those below menus, headers, footers, sidebars,
notices, adverts, forms and comments.  From the texts of such blocks other pages
are built for training: the article below a name that was never seen, below one
of the usual names or none, with headings, lists, tables and quotations; around
and inside it menus, link lists, notices, comments and so on, most of them without their names
too.  So length, links, words, neighbours and a block's part of the whole page have to carry the decision
where names do not.  Training takes at most ``sample`` pages of any length, drawn
by a hash of their id and url.  A page is cut into at most ``WINDOWS`` stretches,
and of each a run of at most ``BLOCKS`` blocks at a hashed place teaches, as it is
and as ``BUILT`` pages.  Extraction reads all pages, whole.  Where no drawn page
has a text there is nothing to learn, and blocks are judged by the names on their
paths alone.

Cases: a null or empty page, and one without text, has an empty text; unclosed
and misplaced tags are read as browsers do in the common cases (a paragraph ends
the one before it, a stray end tag is ignored, an open script ends with the
page); repeated rows stay; an empty table gives no rows; other columns pass
through.
"""

from __future__ import annotations

import html
import pickle
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nodepulse.llm.common import share_of, with_text_columns

#: Training sequences of a page, blocks of one, pages built from one, hashed path and word inputs, numbers, cells of
#: each direction.
WINDOWS, BLOCKS, BUILT, PATH, WORDS, NUMBERS, CELLS = 4, 64, 4, 160, 40, 17, 16

# Tags that end a block, that hold no text, and that have no end.
BLOCK_TAGS = frozenset(
    """address article aside blockquote body caption dd details dialog div dl dt fieldset figcaption figure footer form
    h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol optgroup option p pre section select summary table
    tbody td tfoot th thead title tr ul""".split()
)
SILENT_TAGS = ("script", "style", "noscript", "template", "textarea", "svg", "iframe", "object")
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Beginnings of names of parts that are not main text, such names as a whole, and names that may belong to
# parts of an article too.
SIDE_STARTS = (
    "advert", "breadcrumb", "comment", "consent", "cookie", "disqus", "footer", "gdpr", "masthead", "modal", "navbar", "navigation",
    "newsletter", "pagination", "popup", "promo", "recommend", "related", "replies", "sidebar", "social", "sponsor", "subscribe",
)
SIDE_NAMES = frozenset("ad ads alert aside banner button complementary contentinfo dialog footer form menu nav notice option respond select toolbar widget".split())
EITHER_NAMES = frozenset("bottom head header label share tags title top".split())
MAIN_NAMES = ("article", "main")
#: A tag by which an open one of the same kind ends.
_ENDS = {"p": ("p",), "li": ("li",), "td": ("td", "th"), "th": ("td", "th"), "tr": ("tr", "td", "th"), "option": ("option",), "dt": ("dt", "dd"), "dd": ("dt", "dd")}

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)>""", re.S)
_NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_PART = re.compile(r"[a-z]+")


@dataclass
class Block:
    path: tuple[str, ...]
    text: str
    linked: int


def blocks_of(page: str) -> list[Block]:
    """Leaf blocks of a page, in order."""
    stack: list[tuple[str, tuple[str, ...]]] = []
    out: list[Block] = []
    parts: list[str] = []
    linked = at = 0

    def names() -> tuple[str, ...]:
        return tuple(n for tag, own in stack for n in (tag, *own))

    def flush() -> None:
        nonlocal linked
        text = " ".join("".join(parts).split())
        if text:
            out.append(Block(names(), text, min(linked, len(text))))
        parts.clear()
        linked = 0

    def say(raw: str) -> None:
        nonlocal linked
        if raw:
            text = html.unescape(raw) if "&" in raw else raw
            parts.append(text)
            if any(tag == "a" for tag, _ in stack):
                linked += len(text.strip())

    end = len(page)
    while at < end:
        m = _TOKEN.search(page, at)
        if not m:
            say(page[at:])
            break
        say(page[at : m.start()])
        at = m.end()
        if not m[2]:
            continue
        tag = m[2].lower()
        if tag in SILENT_TAGS and not m[1]:
            close = re.compile(rf"</{re.escape(tag)}[\s>]", re.I).search(page, at)
            at = end if not close else max(close.end(), page.find(">", close.start()) + 1)
            continue
        if tag == "br":
            parts.append(" ")
            continue
        if tag in BLOCK_TAGS:
            flush()
        if m[1]:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == tag:
                    del stack[k:]
                    break
            continue
        if tag in VOID_TAGS:
            continue
        if tag in _ENDS and stack:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] in _ENDS[tag]:
                    del stack[k:]
                    break
                if stack[k][0] in BLOCK_TAGS and stack[k][0] != "p":
                    break
        own = tuple(p for g in _NAMES.findall(m[3]) for p in _PART.findall(" ".join(g).lower())) if m[3] else ()
        if not m[3].rstrip().endswith("/") or tag in BLOCK_TAGS:
            stack.append((tag, own))
    flush()
    return out


def told(path: tuple[str, ...]) -> tuple[bool, bool, bool]:
    """Whether a path has a name of articles, one of other parts, and one that may be either."""
    return (
        any(n in MAIN_NAMES for n in path),
        any(n in SIDE_NAMES or n.startswith(SIDE_STARTS) for n in path),
        any(n in EITHER_NAMES for n in path),
    )


def taught(blocks: list[Block]) -> np.ndarray:
    """Which blocks are main text, by the names on their paths."""
    says = [told(b.path) for b in blocks]
    spoken = any(inside for inside, _, _ in says)
    # A heading or a list of an article may have a name of either kind; outside, or where it is all links, it is none.
    return np.array(
        [
            (inside or not spoken) and not side and not (either and (not inside or 2 * b.linked > len(b.text)))
            for b, (inside, side, either) in zip(blocks, says, strict=True)
        ],
        bool,
    )


def _hash(name: str) -> int:
    return zlib.crc32(name.encode("utf-8", "replace"))


def _path_inputs(path: tuple[str, ...]) -> np.ndarray:
    """Hashed names of a path, their beginnings, its neighbouring pairs and its last name."""
    row = np.zeros(PATH, np.float32)
    marks = {*path, *[f"^{n[:5]}" for n in path if len(n) > 5], *[f"{a}>{b}" for a, b in zip(path, path[1:], strict=False)], f"${path[-1] if path else ''}"}
    for mark in marks:
        h = _hash(mark)
        row[h % PATH] += 1 if h >> 16 & 1 else -1
        row[(h >> 8) % PATH] += 1 if h >> 17 & 1 else -1
    return row


def inputs(blocks: list[Block]) -> np.ndarray:
    """Input vectors of a page's blocks."""
    total = len(blocks)
    x = np.zeros((total, PATH + WORDS + NUMBERS), np.float32)
    paths: dict[tuple[str, ...], np.ndarray] = {}
    said, around, count = {}, {}, {}
    for b in blocks:
        plain = len(b.text) - b.linked
        said[b.path] = said.get(b.path, 0) + plain
        around[b.path[:-1]] = around.get(b.path[:-1], 0) + plain
        count[b.path] = count.get(b.path, 0) + 1
    whole = 1 + sum(said.values())
    says = {path: told(path) for path in said}
    for k, b in enumerate(blocks):
        if b.path not in paths:
            paths[b.path] = _path_inputs(b.path)
        x[k, :PATH] = paths[b.path]
        words = b.text.lower().split()
        h = np.fromiter(map(_hash, words), np.int64, len(words))
        x[k, PATH : PATH + WORDS] = np.bincount(h % WORDS, np.where(h >> 16 & 1, 1.0, -1.0), WORDS) / len(words)
        stops = sum(w[-1] in ".!?" for w in words)
        x[k, PATH + WORDS :] = (
            *says[b.path],
            np.log1p(len(b.text)) / 6,
            b.linked / len(b.text),
            k / total,
            k == 0,
            b.text[-1] in ".!?",
            min(stops, 8) / 4,
            len(b.path) / 10,
            k > 0 and blocks[k - 1].path == b.path,
            k + 1 < total and blocks[k + 1].path == b.path,
            said[b.path] / whole,
            around[b.path[:-1]] / whole,
            np.log1p(said[b.path] / count[b.path]) / 6,
            sum(c.isdigit() for c in b.text) / len(b.text),
            bool(b.path) and b.path[-1] in ("h1", "h2", "h3", "h4", "h5", "h6"),
        )
    return x


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class BlockLabeller:
    """A bidirectional LSTM over blocks; both directions have weights of their own."""

    def __init__(self, seed: int = 7):
        rng, n, h = np.random.default_rng(seed), PATH + WORDS + NUMBERS, CELLS
        self.w = {}
        for way in ("f", "b"):
            self.w[f"x{way}"] = rng.normal(0, 0.15, (n, 4 * h))
            self.w[f"h{way}"] = rng.normal(0, 0.15, (h, 4 * h))
            self.w[f"c{way}"] = np.r_[np.zeros(h), np.ones(h), np.zeros(2 * h)]
        self.w["o"] = rng.normal(0, 0.15, 2 * h)
        self.w["s"] = rng.normal(0, 0.05, n)
        self.w["k"] = np.zeros(1)

    def _run(self, way: str, x: np.ndarray, mask: np.ndarray, trace: list | None = None) -> np.ndarray:
        """Hidden states (time, page, cell) in one direction; x is (time, page, input)."""
        steps, n, h = len(x), x.shape[1], CELLS
        out = np.zeros((steps, n, h))
        state, cell = np.zeros((n, h)), np.zeros((n, h))
        drive = x @ self.w[f"x{way}"] + self.w[f"c{way}"]
        for t in range(steps) if way == "f" else range(steps - 1, -1, -1):
            z = drive[t] + state @ self.w[f"h{way}"]
            gates = _sigmoid(z[:, : 3 * h])
            i, f, o, g = gates[:, :h], gates[:, h : 2 * h], gates[:, 2 * h :], np.tanh(z[:, 3 * h :])
            on = mask[t][:, None]
            new = f * cell + i * g
            if trace is not None:
                trace.append((t, i, f, o, g, cell, new, state))
            cell = np.where(on, new, cell)
            state = np.where(on, o * np.tanh(new), state)
            out[t] = state
        return out

    def _back(self, way: str, x: np.ndarray, mask: np.ndarray, trace: list, slope: np.ndarray, grad: dict) -> None:
        """Add the gradients of one direction; ``slope`` is that of its hidden states."""
        h = CELLS
        ds, dc = np.zeros(slope.shape[1:]), np.zeros(slope.shape[1:])
        for t, i, f, o, g, cell, new, state in reversed(trace):
            on = mask[t][:, None]
            ds = ds + slope[t]
            top = np.tanh(new)
            dnew = np.where(on, dc + ds * o * (1 - top * top), 0)
            dz = np.concatenate(
                [dnew * g * i * (1 - i), dnew * cell * f * (1 - f), np.where(on, ds * top, 0) * o * (1 - o), dnew * i * (1 - g * g)], 1
            )
            grad[f"x{way}"] += x[t].T @ dz
            grad[f"h{way}"] += state.T @ dz
            grad[f"c{way}"] += dz.sum(0)
            dc = np.where(on, dnew * f, dc)
            ds = np.where(on, dz @ self.w[f"h{way}"].T, ds)

    def probabilities(self, x: np.ndarray, mask: np.ndarray) -> np.ndarray:
        both = np.concatenate([self._run("f", x, mask), self._run("b", x, mask)], 2)
        return _sigmoid(both @ self.w["o"] + x @ self.w["s"] + self.w["k"])

    def fit(self, pages: list[tuple[np.ndarray, np.ndarray]], steps: int = 900, batch: int = 32) -> None:
        """Learn from (inputs, labels) of pages, by about ``steps`` steps of Adam on the log-loss."""
        rounds = -(-steps // max(1, len(pages) // batch))
        last = rounds * max(1, len(pages) // batch)
        mean, square, step = {k: 0 * v for k, v in self.w.items()}, {k: 0 * v for k, v in self.w.items()}, 0
        order = np.random.default_rng(3)
        for _ in range(rounds):
            for part in np.array_split(order.permutation(len(pages)), max(1, len(pages) // batch)):
                if not len(part):
                    continue
                x, mask, y = _padded([pages[k][0] for k in part], [pages[k][1] for k in part])
                traces: dict[str, list] = {"f": [], "b": []}
                both = np.concatenate([self._run(w, x, mask, traces[w]) for w in "fb"], 2)
                p = _sigmoid(both @ self.w["o"] + x @ self.w["s"] + self.w["k"])
                d = np.where(mask, p - y, 0) / mask.sum()
                grad = {k: 0 * v for k, v in self.w.items()}
                grad["o"], grad["s"], grad["k"] = np.einsum("tn,tnh->h", d, both), np.einsum("tn,tnh->h", d, x), np.array([d.sum()])
                for n, way in enumerate("fb"):
                    self._back(way, x, mask, traces[way], d[:, :, None] * self.w["o"][n * CELLS : (n + 1) * CELLS], grad)
                step += 1
                rate = 0.02 * (1 - 0.95 * step / last)
                for k, g in grad.items():
                    g = g + 1e-5 * self.w[k]
                    mean[k] = 0.9 * mean[k] + 0.1 * g
                    square[k] = 0.99 * square[k] + 0.01 * g * g
                    self.w[k] -= rate * (mean[k] / (1 - 0.9**step)) / (np.sqrt(square[k] / (1 - 0.99**step)) + 1e-8)

    def extract(self, pages: list[str | None]) -> tuple[list[str], list[int]]:
        """Main text and its length for each page."""
        blocks = [blocks_of(p) if p else [] for p in pages]
        texts = [""] * len(pages)
        if not self.w:
            texts = ["\n".join(x.text for x, y in zip(b, taught(b), strict=True) if y) if b else "" for b in blocks]
            return texts, [len(t) for t in texts]
        some = sorted((k for k, b in enumerate(blocks) if b), key=lambda k: len(blocks[k]))
        at = 0
        while at < len(some):
            part = some[at : at + max(1, min(128, 20_000 // len(blocks[some[min(at + 127, len(some) - 1)]])))]
            at += len(part)
            x, mask, _ = _padded([inputs(blocks[k]) for k in part], None)
            p = self.probabilities(x, mask)
            for n, k in enumerate(part):
                texts[k] = "\n".join(b.text for b, q in zip(blocks[k], p[:, n], strict=False) if q >= 0.5)
        return texts, [len(t) for t in texts]


def _padded(xs: list[np.ndarray], ys: list[np.ndarray] | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sequences side by side, (time, page, ...), with a mask of what is there."""
    steps = max(map(len, xs))
    x, y = np.zeros((steps, len(xs), xs[0].shape[1]), np.float32), np.zeros((steps, len(xs)))
    mask = np.zeros((steps, len(xs)), bool)
    for k, v in enumerate(xs):
        x[: len(v), k], mask[: len(v), k] = v, True
        if ys is not None:
            y[: len(v), k] = ys[k]
    return x, mask, y


# Parts of a page that are not main text, with the tags and the names that they go by.
SIDE_PARTS = {
    "links": (("nav", "menu"), "nav navbar navigation menu breadcrumb breadcrumbs pagination toolbar mainmenu".split()),
    "top": (("header",), "header masthead banner topbar brand".split()),
    "bottom": (("footer",), "footer bottom copyright colophon contentinfo".split()),
    "rail": (("aside",), "sidebar aside widget rail complementary".split()),
    "notice": (("dialog",), "notice cookie cookies consent gdpr popup modal alert cookiebar".split()),
    "advert": ((), "ad ads advert adverts advertisement sponsor sponsored promo adbox".split()),
    "form": (("form",), "subscribe newsletter search login signup".split()),
    "comments": ((), "comment comments commentlist replies respond discussion disqus".split()),
    "more": ((), "related recommended share social morelinks".split()),
}
#: Parts that are known without their name, by what is in them.
PLAIN_PARTS = ("links", "top", "bottom", "form", "more", "rail")
MAIN_BOXES = "content post entry story text body page maincontent articlebody".split()
INNER_NAMES = "title entry head tags label lead intro header share section first note summary box".split()


class _Builder:
    """Pages with articles of given texts."""

    def __init__(self, texts: list[str], rng: np.random.Generator):
        self.texts, self.rng = texts, rng
        self.words = " ".join(texts).split() or ["x"]
        self.blocks: list[Block] = []
        self.labels: list[bool] = []

    def one(self, of):
        return of[int(self.rng.integers(len(of)))]

    def coin(self, chance: float) -> bool:
        return bool(self.rng.random() < chance)

    def strange(self) -> str:
        """A name that was never seen."""
        return "".join(self.one("abcdefghijklmnopqrstuvwxyz") for _ in range(int(self.rng.integers(3, 10))))

    def phrase(self, low: int, high: int, stop: bool = False) -> str:
        size = int(self.rng.integers(low, high + 1))
        at = int(self.rng.integers(max(1, len(self.words) - size)))
        text = " ".join(self.words[at : at + size])
        return text.rstrip(".,!?;:") + "." if stop else text.rstrip(".,!?;:") or "x"

    def put(self, main: bool, path: tuple[str, ...], text: str, linked: bool = False) -> None:
        self.blocks.append(Block(path, text, len(text) if linked else 0))
        self.labels.append(main)

    def side(self, kind: str, top: tuple[str, ...], named: bool) -> None:
        """One part that is not main text, below ``top``."""
        tags, names = SIDE_PARTS[kind]
        named = named or kind not in PLAIN_PARTS
        if told(top)[0]:  # inside an article that is named so, other parts have names that tell
            names = [n for n in names if told((n,))[1]]
        if named and tags and self.coin(0.5):
            box = (self.one(tags),)
        elif named:
            box = (self.one(("div", "div", "section", "ul", "ol") if kind == "comments" else ("div", "div", "section")), self.one(names))
        elif self.coin(0.25):
            box = ()
        else:
            box = (self.one(("div", "div", "section", "ul", "td", "p")), *([self.strange()] if self.coin(0.5) else []))
        if named and self.coin(0.3):
            box += (self.strange(),)
        path = top + box
        items = ("li",) if box[:1] in (("ul",), ("ol",)) else self.one((("ul", "li"), ("ul", "li"), (), ("span",), ("div",), ("p",)))
        if kind in ("links", "more", "rail"):
            if kind != "links" and self.coin(0.6):
                self.put(False, path + (self.one(("h2", "h3", "h4", "p", "div")),), self.phrase(1, 4))
            for _ in range(int(self.rng.integers(2, 9))):
                self.put(False, path + items, self.phrase(1, 2 if kind == "links" else 8), True)
            if kind == "rail" and named and self.coin(0.5):
                self.put(False, path + ("p",), self.phrase(5, 30, True))
        elif kind == "top":
            self.put(False, path + self.one(((), ("h1",), ("div",), ("p",), ("span",))), self.phrase(1, 4), self.coin(0.5))
            if self.coin(0.5):
                self.put(False, path + self.one((("p",), ("div",), ("span",))), self.phrase(2, 7))
        elif kind == "bottom":
            for _ in range(int(self.rng.integers(1, 4))):
                year = self.one(("\xa9 2020 ", "\xa9 ", "Copyright 2021 ", "Copyright ", "(c) 2019 ", *([""] if box else [])))
                self.put(False, path + self.one(((), ("p",), ("div",))), year + self.phrase(2, 12, self.coin(0.4)), self.coin(0.3))
        elif kind == "notice":
            self.put(False, path + self.one(((), ("p",), ("div",))), self.phrase(5, 30, True))
            if self.coin(0.6):
                self.put(False, path + ("button",), self.phrase(1, 2))
        elif kind == "advert":
            self.put(False, path + self.one(((), (), ("p",), ("div",))), self.phrase(2, 25, self.coin(0.7)), self.coin(0.3))
        elif kind == "form":
            path = path if "form" in path else path + ("form",)
            for tag in ("p", "label", "label", "button")[int(self.rng.integers(0, 3)) :]:
                self.put(False, path + (tag,), self.phrase(1, 8 if tag == "p" else 3))
        else:
            if self.coin(0.6):
                self.put(False, path + (self.one(("h2", "h3", "h4")),), self.phrase(1, 3))
            each = self.one((("li",), ("div", "comment"), ("article",), ("li", "article"), ()))
            for _ in range(int(self.rng.integers(1, 6))):
                if self.coin(0.5):
                    self.put(False, path + each + (self.one(("div", "p", "b", "cite")),), self.phrase(1, 4))
                self.put(False, path + each + self.one((("p",), ("p",), ())), self.phrase(3, 50, True))

    def article(self, top: tuple[str, ...]) -> None:
        """The texts as an article below ``top``."""
        name = lambda: (self.one((self.strange(), self.one(INNER_NAMES))),) if self.coin(0.25) else ()
        if self.coin(0.8):
            head = ("header",) if self.coin(0.2) and ("article" in top or "main" in top) else ()
            self.put(True, top + head + (self.one(("h1", "h1", "h2")), *name()), self.phrase(2, 10))
        for text in self.texts:
            kind = self.rng.random()
            if kind < 0.1:
                self.put(True, top + (self.one(("h2", "h3", "h4")), *name()), self.phrase(1, 8))
            if kind > 0.9:
                own = (self.one(("ul", "ol")), *[self.one((self.strange(), self.one(INNER_NAMES))) for _ in range(int(self.rng.integers(0, 3)))], "li")
                for _ in range(int(self.rng.integers(2, 5))):
                    self.put(True, top + own, self.phrase(2, 20, self.coin(0.5)))
            elif kind > 0.86:
                for _ in range(int(self.rng.integers(2, 7))):
                    self.put(True, top + ("table", "tr", self.one(("td", "td", "th"))), self.phrase(1, 8))
            elif kind > 0.82:
                self.put(True, top + self.one((("blockquote", "p"), ("blockquote",), ("pre",), ("figure", "figcaption"), ("dl", "dd"))), self.phrase(3, 30, True))
            elif kind > 0.76:
                again = self.phrase(1, 4, True)
                for _ in range(int(self.rng.integers(2, 9))):
                    self.put(True, top + ("p",), again if self.coin(0.6) else self.phrase(1, 5, self.coin(0.7)))
            if self.coin(0.12):
                self.side(self.one(("advert", "advert", "more", "notice", "form")), top, True)
            self.put(True, top + (self.one(("p",) * 8 + ("div",)), *name()), text if self.coin(0.6) else self.phrase(1, 40, self.coin(0.6)))

    def page(self) -> tuple[list[Block], np.ndarray]:
        mode = self.one(("tags", "names", "strange", "strange", "none"))
        named = mode in ("tags", "names") or self.coin(0.3)
        top: tuple[str, ...] = ("html", "body")
        self.put(False, ("html", "head", "title"), self.phrase(2, 10))
        for _ in range(int(self.rng.integers(0, 3))):
            top += ("div", *([self.one((self.strange(), "wrapper", "container", "page"))] if mode != "none" else []))
        if self.coin(0.12):
            top += ("table", "tr", "td")
        box = {
            "tags": self.one((("article",), ("main",), ("main", "article"), ("article", self.strange()))),
            "names": (self.one(("div", "div", "section", "td")), self.one(MAIN_BOXES)),
            "strange": (self.one(("div", "div", "section", "td")), self.strange()),
            "none": self.one(((), ("div",), ("td",), ("div", "div"))),
        }[mode]
        before = [k for k in ("top", "links", "notice", "advert", "rail", "form") if self.coin(0.4 if k != "links" else 0.8)]
        after = [k for k in ("more", "comments", "advert", "rail", "form", "notice", "links", "bottom") if self.coin(0.35 if k != "bottom" else 0.8)]
        if self.coin(0.4):
            self.rng.shuffle(before)
        for kind in before:
            self.side(kind, top, named)
        self.article(top + box)
        for kind in after:
            self.side(kind, top + box if self.coin(0.25) and (named or kind not in PLAIN_PARTS) else top, named)
        return self.blocks, np.array(self.labels, bool)


def lessons(page: str) -> list[tuple[np.ndarray, np.ndarray]]:
    """(inputs, labels) of runs of the page's blocks as they are, and of pages built of their texts."""
    blocks, out = blocks_of(page), []
    if not blocks:
        return out
    spoken = any(n in MAIN_NAMES for b in blocks for n in b.path)
    labels = taught(blocks) if spoken else np.array([len(b.text.split()) >= 15 and 5 * b.linked < len(b.text) for b in blocks])
    x, rng = inputs(blocks), np.random.default_rng(_hash(page))
    stretches = min(WINDOWS, -(-len(blocks) // BLOCKS))
    for k in range(stretches):
        low, high = k * len(blocks) // stretches, (k + 1) * len(blocks) // stretches
        at = int(rng.integers(low, max(low, high - BLOCKS) + 1))
        end = min(at + BLOCKS, high)
        if spoken:
            out.append((x[at:end], labels[at:end]))
        texts = [b.text for b, y in zip(blocks[at:end], labels[at:end], strict=True) if y]
        for _ in range(BUILT if texts else 0):
            first = int(rng.integers(len(texts)))
            built, y = _Builder(texts[first : first + int(rng.integers(1, 13))], rng).page()
            out.append((inputs(built)[:BLOCKS], y[:BLOCKS]))
    return out


def train(pages: DataFrame, sample: int = 300) -> BlockLabeller:
    """Network from at most ``sample`` pages (column ``html``), of which runs of blocks reach the driver as numbers."""

    def teach(drawn: DataFrame) -> DataFrame:
        def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for k in range(batch.num_rows):
                    one = batch.slice(k, 1)
                    made = pickle.dumps(lessons(one.column(1)[0].as_py()))
                    yield pa.RecordBatch.from_arrays([one.column(0), one.column(2), pa.array([made], pa.binary())], names=["all", "__mix", "made"])

        return drawn.select("all", "html", "__mix").mapInArrow(tasks, "all int, __mix long, made binary")

    named = [c for c in ("page_id", "url") if c in pages.columns] or ["html"]
    rows = pages.where("html <> ''").select(F.lit(1).alias("all"), *named, *({"html"} - set(named)))
    got = sorted(bytes(r["made"]) for r in share_of(rows, "all", sample, *named, work=teach).select("made").toLocalIterator())
    seen = [x for made in got for x in pickle.loads(made)]
    model = BlockLabeller()
    if seen:
        model.fit(seen)
    else:
        model.w = {}
    return model


def main_text(pages: DataFrame, model: BlockLabeller) -> DataFrame:
    """``pages`` without html, with text and n_chars."""
    shared = pages.sparkSession.sparkContext.broadcast(model.w)  # of fixed size

    def start():
        own = BlockLabeller()
        own.w = shared.value
        return own.extract

    made = {"text": pa.string(), "n_chars": pa.int64()}
    return with_text_columns(pages, made, "text string, n_chars long", start, "html", keep=False)
