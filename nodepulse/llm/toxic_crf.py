"""Toxic spans by a linear-chain conditional random field, and scores of texts.

Labels of texts give labels of words: a word of a toxic text is toxic if its
form, or a beginning of it, occurs in enough toxic texts and hardly in others.
On those words a chain with the states clean and toxic is fitted: the weights of
hashed features (the word, beginnings and an end of it) and of state changes, by
gradient steps on the likelihood.  Forward and backward sums give each word's
marginal.  A text's score is a logistic function of its highest marginal, their
sum and the number of words; words whose marginal is one half or more are its offending spans.

A chain is a whole text, however long.  Its sums are taken in rows of ``ROW``
words at once, which are joined afterwards.  Training takes a
bounded number of texts of each label, drawn by a hash from those of any length;
of one of over ``CHARS`` characters it takes windows from all its parts.  Scoring
reads all texts, whole.

Cases: a null or empty text has the score of one without any toxic word; labels
other than 0 and 1, or for unknown documents, teach nothing; without training
rows every score is 0; a document labelled twice counts twice; an empty table
gives no rows; other columns pass through.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nodepulse.llm.byte_bpe import worker_store
from nodepulse.llm.common import excerpt, share_of, with_text_columns

WORD = re.compile(r"[^\W\d_]+")
#: Words in a row of sums, rows summed up at once, buckets of features, characters of a training text, gradient steps,
#: words kept in memory.
ROW, ROWS_AT_ONCE, BUCKETS, CHARS, STEPS, KEPT_WORDS = 64, 2048, 1 << 17, 6_000, 40, 200_000
#: Toxic texts that a word's form must occur in, at least and as a part of all, and the least share of toxic
#: texts among those with it, were both labels equally frequent.
TOXIC_TEXTS, TOXIC_PART, TOXIC_SHARE = 3, 0.008, 0.9
#: What a clean text with a form weighs against a toxic one.
CLEAN_COST = 5


def forms(word: str) -> list[str]:
    """Features of a word: itself, beginnings that something follows, its end."""
    return [f"={word}", *[f"^{word[:k]}+" for k in range(3, 8) if len(word) > k], f"{word[-3:]}$"]


def _bucket(form: str) -> int:
    return zlib.crc32(form.encode("utf-8", "replace")) % BUCKETS


def _grid(values: np.ndarray, sizes: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Values of texts laid out in rows of ``ROW`` places, the index of each value there, and the rows of each text."""
    rows = -(-np.array(sizes, np.int64) // ROW)
    first = np.cumsum(rows) - rows
    within = np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    at = np.repeat(first, sizes) * ROW + within
    grid = np.full(int(rows.sum()) * ROW, np.nan)
    grid[at] = values
    return grid.reshape(-1, ROW), at, rows


class ToxicModel:
    """Weights of the chain and of the score."""

    def __init__(self):
        self.weights = np.zeros(BUCKETS)
        self.bias = -4.0
        self.moves = np.zeros((2, 2))
        self.score = np.array([-20.0, 0.0, 0.0, 0.0])

    def word_weight(self, word: str) -> float:
        return self.bias + sum(self.weights[_bucket(f)] for f in forms(word))

    def marginals(self, emit: np.ndarray, rows: np.ndarray, kind: type = np.float32) -> tuple[np.ndarray, np.ndarray]:
        """Probability of the toxic state in each place, and the expected number of each change of state.

        ``emit`` has the toxic state's scores, a text in as many rows as ``rows`` says, and nan where no word is.
        """
        p, changes = np.zeros(emit.shape, kind), np.zeros((2, 2))
        ends = np.cumsum(rows)
        text = row = 0
        while text < len(rows):
            last = max(text + 1, int(np.searchsorted(ends, row + ROWS_AT_ONCE, "right")))
            stop = int(ends[last - 1])
            if stop > row:
                p[row:stop], more = self._sums(emit[row:stop], rows[text:last], kind)
                changes += more
            text, row = last, stop
        return p, changes

    def _sums(self, emit: np.ndarray, rows: np.ndarray, kind: type) -> tuple[np.ndarray, np.ndarray]:
        """``marginals`` of some whole texts.

        All rows are summed up at once, each from both states that it can be entered in and to both states of its last
        place; then the texts' rows are joined one after the other, which gives the weights of those.
        """
        real = ~np.isnan(emit)
        up = np.where(real, np.exp(np.clip(np.nan_to_num(emit), -30, 30)), 0).astype(kind)
        weight = np.stack([np.ones_like(up), up])  # state, row, place
        move = np.exp(self.moves).astype(kind)
        n, length = emit.shape
        rows = rows[rows > 0]
        first = np.cumsum(rows) - rows
        # place, state, state that the row is entered in (before its own first word), row
        fore = np.empty((length, 2, 2, n), kind)
        state = np.eye(2, dtype=kind)[:, :, None] * weight[:, None, :, 0]
        fore[0] = state / state.sum((0, 1))
        for t in range(1, length):
            state = (move.T @ fore[t - 1].reshape(2, -1)).reshape(2, 2, n) * weight[:, None, :, t]
            fore[t] = state / state.sum((0, 1))
        # place, state, state of the row's last place, row
        back = np.empty((length, 2, 2, n), kind)
        own = back[-1] = np.broadcast_to(np.eye(2, dtype=kind)[:, :, None], (2, 2, n))
        for t in range(length - 2, -1, -1):
            state = (move @ (back[t + 1] * weight[:, None, :, t + 1]).reshape(2, -1)).reshape(2, 2, n)
            back[t] = np.where(real[:, t + 1], state / state.sum((0, 1)), own)
        enter, leave = np.full((2, n), 0.5, kind), np.full((2, n), 0.5, kind)
        most = int(rows.max(initial=0))
        for k in range(1, most):
            at = first[rows > k] + k
            state = move.T @ (fore[-1, :, :, at - 1] * enter[:, at - 1].T[:, None, :]).sum(2).T
            enter[:, at] = state / state.sum(0)
        for k in range(most - 1, 0, -1):
            at = first[rows > k] + k
            state = move @ (weight[:, at, 0] * (back[0, :, :, at] * leave[:, at].T[:, None, :]).sum(2).T)
            leave[:, at - 1] = state / state.sum(0)
        fore, back = (fore * enter[None, None]).sum(2), (back * leave[None, None]).sum(2)
        both = fore * back
        p = np.where(real, (both[:, 1] / both.sum(1)).T, 0)
        right = back * np.moveaxis(weight, 2, 0)
        inner = np.ones(n, bool)
        inner[first] = False
        inner = np.flatnonzero(inner)
        changes = np.zeros((2, 2))
        pairs = [(fore[:-1], right[1:], real[:, 1:].T), (fore[-1:][..., inner - 1], right[:1][..., inner], real[inner, 0])]
        for before, after, counts in pairs:
            joint = before[:, :, None] * move[:, :, None] * after[:, None]
            total = joint.sum((1, 2))
            changes += (joint * (counts / np.where(total > 0, total, 1))[:, None, None]).sum((0, 3))
        return p, changes

    def fit(self, texts: list[str], labels: list[int]) -> None:
        """Learn from texts and their labels."""
        number: dict[str, int] = {}
        numbers = [np.array([number.setdefault(x, len(number)) for x in WORD.findall(t.lower())], np.int32) for t in texts]
        kinds, total = list(number), [max(1, labels.count(0)), max(1, labels.count(1))]
        least = max(TOXIC_TEXTS, TOXIC_PART * total[1])
        held = [np.unique(n).tolist() for n in numbers]
        toxic = Counter()
        for own, y in zip(held, labels, strict=True):
            if y:
                toxic.update({f for k in own for f in forms(kinds[k]) if not f.endswith("$")})
        toxic = {f: n for f, n in toxic.items() if n >= least}
        clean = Counter()  # of those forms only
        for own, y in zip(held, labels, strict=True):
            if not y:
                clean.update({f for k in own for f in forms(kinds[k]) if f in toxic})
        bad = {f for f, n in toxic.items() if n / total[1] >= TOXIC_SHARE * (n / total[1] + clean[f] / total[0])}
        # Many forms go along with each toxic word.  Those are taken that explain most texts no other form explains
        # yet, less what they cost in clean ones; of equal forms a whole word, or the longest.
        left = [{f for k in own for f in forms(kinds[k]) if f in bad} for own, y in zip(held, labels, strict=True) if y]
        cost = {f: CLEAN_COST * clean[f] * total[1] / total[0] for f in bad}
        good: set[str] = set()
        while explained := Counter(f for h in left for f in h):
            form = max(explained, key=lambda f: (explained[f] - cost[f], f[0] == "=", len(f), f))
            if explained[form] - cost[form] < least:
                break
            good.add(form)
            left = [h for h in left if form not in h]
        toxic_kind = np.fromiter((any(f in good for f in forms(x)) for x in kinds), bool, len(kinds))
        owner = np.repeat(np.arange(len(kinds), dtype=np.int32), np.fromiter((len(forms(x)) for x in kinds), np.int32, len(kinds)))
        buckets = np.fromiter((_bucket(f) for x in kinds for f in forms(x)), np.int32, len(owner))
        sizes = [len(n) for n in numbers]
        which = np.concatenate([np.zeros(0, np.int32), *numbers])
        if not len(which):
            return
        gold = toxic_kind[which] & np.repeat(np.array(labels, bool), sizes)
        text = np.repeat(np.arange(len(sizes)), sizes)
        same = text[1:] == text[:-1]
        seen_moves = np.array([[((gold[:-1] == a) & (gold[1:] == b) & same).sum() for b in (0, 1)] for a in (0, 1)], float)
        steps: dict[str, tuple] = {}
        n_words = len(which)

        def move(name: str, value, slope, k: int):
            m, v = steps.get(name, (0.0, 0.0))
            m, v = 0.9 * m + 0.1 * slope, 0.999 * v + 0.001 * slope * slope
            steps[name] = (m, v)
            return value + 0.3 * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.999**k)) + 1e-8)

        for k in range(1, STEPS + 1):
            kind = self.bias + np.bincount(owner, self.weights[buckets], len(kinds))
            emit, at, rows = _grid(kind[which], sizes)
            p, expected = self.marginals(emit, rows)
            p = p.ravel()[at]
            miss = gold - p
            by_kind = np.bincount(which, miss, len(kinds))
            slope = np.bincount(buckets, by_kind[owner], BUCKETS) - 0.05 * self.weights
            self.weights = move("w", self.weights, slope / n_words, k)
            self.bias = move("b", self.bias, miss.sum() / n_words, k)
            self.moves = move("m", self.moves, (seen_moves - expected - 0.5 * self.moves) / n_words, k)
        x = self._inputs(p, sizes)
        target, w = np.array(labels, float), np.zeros(4)
        for _ in range(25):  # Newton steps of a logistic regression
            q = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            w += np.linalg.solve((x.T * (q * (1 - q) + 1e-6)) @ x + 0.05 * np.eye(4), x.T @ (target - q) - 0.05 * w)
        self.score = w

    @staticmethod
    def _inputs(p: np.ndarray, sizes: list[int]) -> np.ndarray:
        """Inputs of a text's score: 1, log-odds of its highest marginal, logs of their sum and of the number of words."""
        sizes = np.array(sizes)
        top, total = np.full(len(sizes), 1e-4), np.zeros(len(sizes))
        some = np.flatnonzero(sizes)
        if len(some):
            starts = (np.cumsum(sizes) - sizes)[some]
            top[some], total[some] = np.maximum.reduceat(p, starts), np.add.reduceat(np.where(p > 0.05, p, 0), starts)
        top = np.clip(top, 1e-4, 1 - 1e-4)
        return np.stack([np.ones(len(sizes)), np.log(top / (1 - top)), np.log1p(total), np.log1p(sizes)], 1)

    def predict(self, texts: list[str | None], known: dict[str, float]) -> tuple[np.ndarray, list, list]:
        """Score, label and offending spans of each text; ``known`` keeps weights of words."""
        texts = [t or "" for t in texts]
        words = [WORD.findall(t.lower()) for t in texts]
        if len(known) > KEPT_WORDS:
            known.clear()
        for x in set().union(*words):
            if x not in known:
                known[x] = self.word_weight(x)
        sizes = [len(w) for w in words]
        values = np.fromiter((known[x] for w in words for x in w), float, sum(sizes))
        grid, at, rows = _grid(values, sizes)
        p = self.marginals(grid, rows)[0].ravel()[at]
        score = 1 / (1 + np.exp(-np.clip(self._inputs(p, sizes) @ self.score, -30, 30)))
        spans: list[list[dict]] = [[] for _ in texts]
        hit = np.flatnonzero(p >= 0.5)
        ends = np.cumsum(sizes)
        for k in np.unique(np.searchsorted(ends, hit, "right")):
            chosen = set((hit[(hit < ends[k]) & (hit >= ends[k] - sizes[k])] - (ends[k] - sizes[k])).tolist())
            # Lower case can change a text's length, so places are counted in the words found.
            places = [m.span() for m in WORD.finditer(texts[k] if len(texts[k].lower()) == len(texts[k]) else texts[k].lower())]
            spans[k] = [{"start": a, "stop": b} for n, (a, b) in enumerate(places) if n in chosen]
        return score, (score >= 0.5).astype(int), spans


def train(docs: DataFrame, labels: DataFrame, toxic: int = 1000, clean: int = 3000) -> ToxicModel:
    """Model from texts and ``labels`` (doc_id, toxic); at most ``toxic`` and ``clean`` texts reach the driver."""
    texts = docs.where("text is not null").select("doc_id", "text")
    known = labels.where("doc_id is not null").select("doc_id", "toxic").join(texts.select("doc_id"), "doc_id", "left_semi")
    got = []
    for label, most in ((1, toxic), (0, clean)):
        # Twice as many ids as texts, two integers each.
        drawn = share_of(known.where(F.col("toxic") == label), "toxic", 2 * most, "doc_id")
        cut = lambda d: d.withColumn("text", excerpt("text", CHARS))
        rows = share_of(texts.join(F.broadcast(drawn), "doc_id"), "toxic", most, "doc_id", "text", work=cut)
        got += sorted((label, r["text"]) for r in rows.toLocalIterator())
    model = ToxicModel()
    if got:
        model.fit([t for _, t in got], [y for y, _ in got])
    return model


def predict(docs: DataFrame, model: ToxicModel) -> DataFrame:
    """``docs`` with score, predicted and spans, from the column ``text``."""
    shared = docs.sparkSession.sparkContext.broadcast(model.__dict__)  # bounded by BUCKETS
    token = zlib.crc32(model.weights.tobytes() + model.moves.tobytes())

    def start():
        own = ToxicModel()
        own.__dict__.update(shared.value)
        store = worker_store(f"toxic words {token}")
        return lambda texts: own.predict(texts, store)

    span = pa.struct([("start", pa.int32()), ("stop", pa.int32())])
    made = {"score": pa.float64(), "predicted": pa.int32(), "spans": pa.list_(span)}
    return with_text_columns(docs, made, "score double, predicted int, spans array<struct<start:int,stop:int>>", start)
