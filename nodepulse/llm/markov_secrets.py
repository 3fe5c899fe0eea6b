"""Secrets in texts: three plain patterns, and strings that look random to two character chains.

The patterns find assignments to a name such as ``password``, access keys and long
hexadecimal runs.  Beyond them a candidate is a whole run of at least ``LEAST``
letters, digits and ``+ _ = -`` that no found span overlaps, with a letter and
``KINDS_LEAST`` different characters.  One Markov chain of order two describes
random strings, another one ordinary identifiers; a candidate is a secret, of
kind ``random``, if the logarithm of their likelihood ratio reaches the model's
limit.

The chains learn from labelled samples (token, random).  ``samples`` takes them
from documents: what the patterns find is random, the other runs of at least
``SHORT`` such characters are ordinary; random strings over the usual alphabets
are added, so that the first chain knows more than the kinds of key at hand, and
ordinary tokens joined as names in programs are, so that the second one does.  A
fifth of the ordinary tokens is held out, and the limit is the 0.999 quantile of
them and their compounds, but at least ``MARGIN``.

Cases: a null text is an empty one and holds nothing; without ordinary samples, as
in an empty table, the chains find nothing and the patterns' spans are all; rows
of equal id are rows of their own; other columns pass through, but for one named
as the new column ``secrets``, which it replaces.
"""

from __future__ import annotations

import re
import string
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nodepulse.llm.common import share_of, slices, with_text_columns

# The patterns that are searched in any case, each with the length that a match must have.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # as runs are maximal, the same as runs of any length of which the short ones go
ASSIGN_LEAST, ACCESS_LEAST = 6, 20
KINDS = ("assign", "access", "hex", "random")

#: Characters of a candidate and of a sample at least, tokens of each label, documents they come from, the limit's
#: least value in nats, and what a shorter context weighs in counts.
LEAST, SHORT, TOKENS, DOCUMENTS, MARGIN, SHARE = 16, 4, 20_000, 20_000, 30.0, 8.0
KINDS_LEAST = 6
#: Longest part of a token that is one sample.
PART = 256

_LETTERS = string.ascii_uppercase + string.ascii_lowercase + string.digits + "+/_.=-"
_START = len(_LETTERS)
_CODE = np.full(128, -1, np.int64)
_CODE[[ord(c) for c in _LETTERS]] = np.arange(_START)
_RUN = re.compile(r"[A-Za-z0-9+_=-]{%d,}" % LEAST)
_SAMPLE = re.compile(r"[A-Za-z0-9+_=-]{%d,}" % SHORT)
#: Alphabets of the added random strings, and their lengths.
ALPHABETS = [
    "0123456789abcdef",
    "0123456789ABCDEF",
    string.ascii_uppercase + "234567",
    string.ascii_lowercase + string.digits,
    string.ascii_letters + string.digits,
    string.ascii_letters + string.digits + "+_",
    string.ascii_letters + string.digits + "-_",
]
SIZES = (16, 64)

Span = tuple[int, int, int]  # place of the kind in KINDS, start, end


def base_spans(text: str) -> list[Span]:
    """What the patterns find, leftmost and non-overlapping in each kind."""
    found = [(0, *m.span()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_LEAST]
    found += [(1, *m.span()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LEAST]
    return found + [(2, *m.span()) for m in HEX.finditer(text)]


def _outside(runs: Iterable[re.Match], spans: list[Span]) -> list[re.Match]:
    """Runs that no span overlaps."""
    runs = list(runs)
    if not spans or not runs:
        return runs
    spans = sorted((a, b) for _, a, b in spans)
    ends = np.maximum.accumulate([b for _, b in spans])  # of all spans up to each
    starts = np.array([a for a, _ in spans])
    before = np.searchsorted(starts, [m.end() for m in runs])
    return [m for m, k in zip(runs, before, strict=True) if k == 0 or ends[k - 1] <= m.start()]


def generated(n: int) -> list[str]:
    """``n`` random strings over ALPHABETS, always the same."""
    rng = np.random.default_rng(12)
    sizes = rng.integers(SIZES[0], SIZES[1] + 1, n)
    return ["".join(rng.choice(list(ALPHABETS[k % len(ALPHABETS)]), size)) for k, size in enumerate(sizes)]


def compounds(words: list[str], n: int) -> list[str]:
    """``n`` names made of two to four of the ``words``, in the usual ways of joining them."""
    rng = np.random.default_rng(13)
    plain = [w for w in words if w.isalpha() and w.isascii()]
    styles = [
        lambda own: "_".join(own).lower(),
        lambda own: "-".join(own).lower(),
        lambda own: "_".join(own).upper(),
        lambda own: "".join([own[0].lower(), *[w.capitalize() for w in own[1:]]]),
        lambda own: "".join(w.capitalize() for w in own),
    ]
    return [styles[k % 5]([plain[j] for j in rng.integers(0, len(plain), 2 + k % 3)]) for k in range(n)] if plain else []


def worth_scoring(token: str) -> bool:
    """Whether a run can be a secret at all: a number or a line of few characters is none."""
    return len(set(token)) >= KINDS_LEAST and any(c.isalpha() for c in token)


def _codes(tokens: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Codes of all tokens, each after two starting states, and the owner of each code."""
    sizes = np.fromiter(map(len, tokens), np.int64, len(tokens))
    owner = np.repeat(np.arange(len(tokens)), sizes + 2)
    first = np.cumsum(sizes + 2) - (sizes + 2)
    out = np.full(len(owner), _START)
    inner = np.ones(len(owner), bool)
    inner[first], inner[first + 1] = False, False
    out[inner] = _CODE[np.frombuffer("".join(tokens).encode(), np.uint8)]
    return out, owner


def _steps(tokens: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(last but one, last, next, owner) of each character."""
    codes, owner = _codes(tokens)
    at = np.flatnonzero(codes != _START)
    return codes[at - 2], codes[at - 1], codes[at], owner[at]


def _chain(tokens: list[str]) -> np.ndarray:
    """Logarithms of the chance of each next character after each pair, smoothed by shorter contexts."""
    n = _START
    a, b, c, _ = _steps(tokens)
    pair = np.bincount((a * (n + 1) + b) * n + c, minlength=(n + 1) ** 2 * n).reshape(n + 1, n + 1, n).astype(float)
    single = pair.sum(0)
    none = (single.sum(0) + 1) / (single.sum() + n)
    single = (single + SHARE * none) / (single.sum(1, keepdims=True) + SHARE)
    return np.log((pair + SHARE * single) / (pair.sum(2, keepdims=True) + SHARE))


class SecretModel:
    """Log-likelihood ratio of each step of the two chains, and the limit of a token's sum."""

    def __init__(self, ratio: np.ndarray | None = None, limit: float = float("inf")):
        self.ratio, self.limit = ratio, limit

    def scores(self, tokens: list[str]) -> np.ndarray:
        """Random against ordinary, in nats, for each token."""
        if self.ratio is None or not tokens:
            return np.full(len(tokens), -np.inf)
        a, b, c, owner = _steps(tokens)
        return np.bincount(owner, self.ratio[a, b, c], len(tokens))

    @classmethod
    def fit(cls, tokens: list[str], random: list[bool]) -> SecretModel:
        """From tokens with their labels, each character one of those of a candidate or of ``/`` and ``.``."""
        ordinary = sorted({t for t, r in zip(tokens, random, strict=True) if not r and t})
        if not ordinary:
            return cls()
        held = [t for t in ordinary if zlib.crc32(t.encode()) % 5 == 0]
        held = [t for t in held + compounds(held, len(held)) if len(t) >= LEAST and worth_scoring(t)]
        taught = [t for t in ordinary if zlib.crc32(t.encode()) % 5]
        taught += compounds(taught, len(taught) // 2)
        strange = sorted({t for t, r in zip(tokens, random, strict=True) if r and t})
        model = cls((_chain(strange + generated(max(2000, len(strange)))) - _chain(taught)).astype(np.float32), MARGIN)
        if held:
            model.limit = max(MARGIN, float(np.quantile(model.scores(held), 0.999)))
        return model

    def spans(self, texts: list[str | None]) -> list[list[tuple[int, int, int, float | None]]]:
        """All spans of each text by start, then kind; the score is that of a random one."""
        texts = [t or "" for t in texts]
        base = [base_spans(t) for t in texts]
        runs = [_outside(_RUN.finditer(t), b) for t, b in zip(texts, base, strict=True)]
        flat = [(k, m) for k, own in enumerate(runs) for m in own if worth_scoring(m[0])]
        out: list[list] = [[(*s, None) for s in own] for own in base]
        scores = self.scores([m[0] for _, m in flat])
        for (k, m), score in zip(flat, scores.tolist(), strict=True):
            if score >= self.limit:
                out[k].append((3, *m.span(), score))
        return [sorted(own, key=lambda s: (s[1], s[0])) for own in out]


def samples(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(token, random) of about DOCUMENTS documents, drawn by a hash; distinct, at most TOKENS of each label."""
    n = docs.count()
    texts = docs.select(F.col(text_col).alias("text")).where("text is not null")
    mix = F.pmod(F.xxhash64("text", F.monotonically_increasing_id()), F.lit(1 << 30))
    drawn = texts.where(mix < (1 << 30) * min(1.0, DOCUMENTS / max(1, n)))

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 0):
                got: set[tuple[str, bool]] = set()
                for text in part.column(0).to_pylist():
                    spans = base_spans(text)
                    told = [m[2] for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
                    told += [text[a:b] for kind, a, b in spans if kind]
                    got.update((t[k : k + PART], True) for t in told for k in range(0, len(t), PART))
                    for m in _outside(_SAMPLE.finditer(text), spans):
                        got.update((m[0][k : k + PART], False) for k in range(0, len(m[0]), PART))
                tokens = sorted(got)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([t for t, _ in tokens], pa.string()), pa.array([r for _, r in tokens], pa.bool_())], names=["token", "random"]
                )

    tokens = drawn.mapInArrow(tasks, "token string, random boolean").distinct()
    return share_of(tokens, "random", TOKENS, "token")


def train(docs: DataFrame, text_col: str = "text") -> SecretModel:
    """Model from the samples that ``docs`` holds; at most 2 * TOKENS of them reach the driver."""
    rows = sorted((r["token"], r["random"]) for r in samples(docs, text_col).toLocalIterator())
    return SecretModel.fit([t for t, _ in rows], [r for _, r in rows])


def secrets(docs: DataFrame, model: SecretModel, text_col: str = "text") -> DataFrame:
    """``docs`` and ``secrets``: kind, start, end (exclusive, code points) and score of all spans, by start, then kind."""
    shared = docs.sparkSession.sparkContext.broadcast((model.ratio, model.limit))  # 69 * 69 * 68 numbers

    def start():
        own = SecretModel(*shared.value)
        names = ("kind", "start", "end", "score")
        return lambda texts: [[[dict(zip(names, (KINDS[k], a, b, s), strict=True)) for k, a, b, s in row] for row in own.spans(texts)]]

    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])
    made = {"secrets": pa.list_(span)}
    return with_text_columns(docs, made, "secrets array<struct<kind:string,start:bigint,end:bigint,score:double>>", start, text_col)
