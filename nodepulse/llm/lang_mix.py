"""Language of a text as a mixture of languages.

Character n-grams (1 to 3, with a word border) of labelled texts give each
language a smoothed log-likelihood for a word: the sum over its n-grams.  The
words of a text are taken as draws from a mixture of the languages, and
expectation-maximisation finds the proportions.  Beginning with all languages,
the one with the lowest proportion is left out time after time; of the nested
sets so found the one with the highest penalised likelihood (half of log words
for each language beyond the first) is the text's set.  The prediction is the
set's largest part, the score its proportion.

Proportions say nothing of whether a text is in a learned language at all.  Its
fit does: the mean log-likelihood of its n-grams, each word under the language
that suits it best.  ``least`` is the bound learned from the labelled texts: in
FOLDS parts, each judged by a model of the others, it lies BELOW times as far
under their median fit as the fit that one in a hundred falls short of.  Where
the bound is asked for, model and bound come from all labelled texts, whole:
their n-grams are counted by language and part, equal texts are in one part, and
the ranks of all their fits are exact.

Without the bound, training takes at most ``per_language`` texts of each language, drawn by a hash of
id and text from those of any length; of one of over ``CHARS`` characters it takes
windows from all its parts.  In both ways at most ``languages`` values are learned, each is a
megabyte of the model that goes to all tasks.  Prediction reads all texts, whole.

Cases: a null text, or one without a letter, is ``und`` with score 0; without
training rows every text is ``und``; ties go to the language first in the
alphabet; an empty table gives no rows; columns beside the named ones are not
read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nodepulse.llm.byte_bpe import worker_store
from nodepulse.llm.common import excerpt, kept, share_of, slices, with_text_columns
from nodepulse.operators.order_stats import quantiles_from_ranks, value_at_share, value_ranks

WORD = re.compile(r"[^\W\d_]+")
#: Buckets of n-grams, longest n-gram, characters of a training text, rounds of expectation-maximisation.
BUCKETS, LONGEST, CHARS, ROUNDS = 1 << 18, 3, 10_000, 12
#: Parts of the training texts for the bound of the fit; see the module's text.
FOLDS, BELOW = 4, 3
#: Words of a batch handled at once; tables of counts, of 2 MB each, that a task holds.
WORDS_AT_ONCE, TABLES = 400_000, 32


def gram_buckets(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the n-grams of ``words``, and the number of the word each belongs to."""
    text = " " + " ".join(words) + " "
    codes = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32).astype(np.uint64)
    border = codes == 32
    word = np.cumsum(border) - 1
    buckets, owners = [], []
    borders = np.cumsum(border)
    key = np.zeros(len(codes), np.uint64)
    for n in range(1, LONGEST + 1):
        key = key[: len(codes) - n + 1] * np.uint64(0x9E3779B1) + codes[n - 1 :]
        if n == 1:
            good = ~border
        else:  # an n-gram may begin or end at a border but not reach past one
            good = borders[n - 2 : len(codes) - 1] == borders[: len(codes) - n + 1]
        mixed = (key[good] * np.uint64(0xC2B2AE3D27D4EB4F + 2 * n)) >> np.uint64(64 - 18)
        buckets.append(mixed.astype(np.int64))
        owners.append(word[: len(codes) - n + 1][good])
    return np.concatenate(buckets), np.concatenate(owners)


class LanguageModel:
    """N-gram log-likelihoods of each language."""

    def __init__(self, texts: list[str], langs: list[str]):
        self.langs, self.least = sorted(set(langs)), -np.inf
        counts = np.full((len(self.langs), BUCKETS), 0.05)
        for lang, text in zip(langs, texts, strict=True):
            words = WORD.findall(text.lower())
            if words:
                counts[self.langs.index(lang)] += np.bincount(gram_buckets(words)[0], minlength=BUCKETS)
        self._weigh(counts)

    @classmethod
    def counted(cls, langs: list[str], counts: np.ndarray) -> LanguageModel:
        """The model of ``counts``, a row of n-grams by bucket for each of the sorted ``langs``."""
        model = cls([], [])
        model.langs = langs
        model._weigh(counts + 0.05)
        return model

    def _weigh(self, counts: np.ndarray) -> None:
        self.logs = np.log(counts / counts.sum(axis=1, keepdims=True)).T.astype(np.float32)

    def word_logs(self, words: list[str]) -> np.ndarray:
        """Log-likelihood of each word in each language, mean over its n-grams times its letters."""
        buckets, owner = gram_buckets(words)
        out = np.zeros((len(words), len(self.langs)))
        for k in range(len(self.langs)):
            out[:, k] = np.bincount(owner, self.logs[buckets, k], len(words))
        return out / LONGEST

    def mixtures(self, logs: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Best language and its proportion of each document; ``logs`` by word, documents begin at ``starts``."""
        n_docs, n_langs = len(starts), len(self.langs)
        size = np.diff(np.r_[starts, len(logs)])
        doc = np.repeat(np.arange(n_docs), size)
        top = logs.max(axis=1, keepdims=True)
        like, base = np.exp(logs - top), np.add.reduceat(top[:, 0], starts)
        alive = np.ones((n_docs, n_langs), bool)
        best, best_share = np.full(n_docs, -np.inf), np.zeros((n_docs, n_langs))
        share = np.full((n_docs, n_langs), 1 / n_langs)
        for left in range(n_langs, 0, -1):
            for _ in range(ROUNDS if left > 1 else 0):
                part = like * share[doc]
                part /= part.sum(axis=1, keepdims=True)
                new = np.add.reduceat(part, starts, axis=0) / size[:, None]
                settled = np.abs(new - share).max() < 1e-3
                share = new
                if settled:
                    break
            fit = np.add.reduceat(np.log(np.maximum((like * share[doc]).sum(axis=1), 1e-300)), starts) + base
            fit -= 0.5 * (left - 1) * np.log(size + 1.0)
            better = fit > best
            best[better], best_share[better] = fit[better], share[better]
            if left > 1:
                lowest = np.where(alive, share, np.inf)
                # Of equal proportions the last language leaves.
                out = n_langs - 1 - np.argmin(lowest[:, ::-1], axis=1)
                alive[np.arange(n_docs), out] = False
                share = np.where(alive, np.maximum(share, 1e-6), 0)
                share /= share.sum(axis=1, keepdims=True)
        pick = best_share.argmax(axis=1)
        return pick, best_share[np.arange(n_docs), pick]

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """Language and score of each text."""
        return self.judged(texts)[:2]

    def _weighed(self, texts: list[str | None]) -> Iterator[tuple[list[int], np.ndarray, np.ndarray, np.ndarray]]:
        """Texts with a letter, some at a time: their places, log-likelihoods of their words, where each begins, their fits."""
        found = [WORD.findall(t.lower()) if t else [] for t in texts]
        found = [w if any(map(str.isalpha, w)) else [] for w in found]
        some = [k for k, w in enumerate(found) if w and self.langs]
        at = 0
        while at < len(some):
            group, words = [], []
            while at < len(some) and (not group or len(words) + len(found[some[at]]) <= WORDS_AT_ONCE):
                group.append(some[at])
                words += found[some[at]]
                at += 1
            number, unique = pd.factorize(np.array(words, object))
            own = self.word_logs(list(unique))
            logs = own[number]
            grams = np.bincount(gram_buckets(list(unique))[1], minlength=len(unique))[number]
            starts = np.cumsum([0, *[len(found[k]) for k in group]])[:-1]
            yield group, logs, starts, LONGEST * np.add.reduceat(logs.max(axis=1), starts) / np.add.reduceat(grams, starts)

    def judged(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, score and fit of each text; one without a letter fits nothing."""
        langs, scores, fits = ["und"] * len(texts), np.zeros(len(texts)), np.full(len(texts), -np.inf)
        for group, logs, starts, fit in self._weighed(texts):
            pick, share = self.mixtures(logs, starts)
            for k, p, s, f in zip(group, pick, share, fit, strict=True):
                langs[k], scores[k], fits[k] = self.langs[p], s, f
        return langs, np.clip(scores, 0, 1), fits

    def fits(self, texts: list[str | None]) -> np.ndarray:
        """The fits alone."""
        fits = np.full(len(texts), -np.inf)
        for group, _, _, fit in self._weighed(texts):
            fits[group] = fit
        return fits


def part_of(text: str = "text") -> Column:
    """The part of a labelled text, by its hash."""
    return F.pmod(F.xxhash64(text), F.lit(FOLDS)).cast("int")


def gram_counts(rows: DataFrame, langs: list[str]) -> DataFrame:
    """How often each n-gram bucket occurs in all texts of a language and part: (lang, part, bucket, n).

    ``lang`` is the number in ``langs``.  A task adds up its texts before it gives rows away.
    """
    schema = "lang int, part int, bucket int, n long"
    names, types = ["lang", "part", "bucket", "n"], [pa.int32(), pa.int32(), pa.int32(), pa.int64()]
    numbers = {g: k for k, g in enumerate(langs)}

    def given(tables: dict) -> Iterator[pa.RecordBatch]:
        for (lang, part), table in tables.items():
            at = np.flatnonzero(table)
            columns = [np.full(len(at), lang), np.full(len(at), part), at, table[at]]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)
        tables.clear()

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_store("languages")  # frees what another operator has left
        tables: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for some in slices(batch, 2):
                words: dict[tuple[int, int], Counter] = {}
                for lang, part, text in zip(*[c.to_pylist() for c in some.columns], strict=True):
                    words.setdefault((numbers[lang], part), Counter()).update(WORD.findall(text.lower()))
                for key, times in words.items():
                    if not times:
                        continue
                    if key not in tables and len(tables) == TABLES:
                        yield from given(tables)
                    buckets, owners = gram_buckets(list(times))
                    weights = np.fromiter(times.values(), np.int64, len(times))[owners]
                    table = tables.setdefault(key, np.zeros(BUCKETS, np.int64))
                    table += np.bincount(buckets, weights, BUCKETS).astype(np.int64)
        yield from given(tables)

    counted = rows.select("lang", part_of().alias("part"), "text").mapInArrow(tasks, schema)
    return counted.groupBy("lang", "part", "bucket").agg(F.sum("n").alias("n"))


def model_of(counts: DataFrame, langs: list[str], all_langs: bool = False) -> LanguageModel:
    """The model of counted n-grams; of languages without any only if ``all_langs``.  One language at a time reaches the driver."""
    tables = np.zeros((len(langs), BUCKETS))
    pairs = counts.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).groupBy("lang").agg(F.collect_list(F.struct("bucket", "n")).alias("p"))
    for r in pairs.select("lang", F.col("p.bucket").alias("buckets"), F.col("p.n").alias("n")).toLocalIterator():
        tables[r["lang"], r["buckets"]] = r["n"]
    have = [k for k in range(len(langs)) if all_langs or tables[k].any()]
    return LanguageModel.counted([langs[k] for k in have], tables[have])


def least_fit(rows: DataFrame, counts: DataFrame, langs: list[str]) -> float:
    """The fit under which a text is in none of the languages, from all labelled ``rows``; see the module's text."""

    def judged(part: int) -> DataFrame:
        model = model_of(counts.where(F.col("part") != part), langs)
        shared = rows.sparkSession.sparkContext.broadcast((model.langs, model.logs))  # bounded by BUCKETS x languages
        own = rows.where(part_of() == part).select("text")
        return with_text_columns(own, {"fit": pa.float64()}, "fit double", lambda: _start(shared, lambda m: lambda t: [m.fits(t)]), keep=False)

    fits = reduce(DataFrame.union, [judged(part) for part in range(FOLDS)]).where("fit > double('-infinity')")
    ranks = value_ranks(fits, [], "fit")
    low = value_at_share(ranks, [], 0.01).first()
    if low is None:
        return -np.inf
    middle = quantiles_from_ranks(ranks, [], {"middle": 0.5}).first()["middle"]
    return float(middle - BELOW * (middle - low["value_at"]))


def train(labelled: DataFrame, per_language: int = 800, bound: bool = False, languages: int = 100) -> LanguageModel:
    """Model from rows (doc_id, text, lang), of the ``languages`` most frequent ones; of equally frequent ones those first in the alphabet.

    With ``bound``, model and bound of the fit come from all rows.  Else at most
    ``per_language`` texts of each language reach the driver.
    """
    rows = labelled.where("lang is not null and text is not null").select("doc_id", "lang", "text")
    often = rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(languages)
    often = sorted(r["lang"] for r in often.collect())
    rows = rows.where(F.col("lang").isin(often))
    if bound:
        counts = kept(gram_counts(rows, often), "language-counts")
        model = model_of(counts, often, all_langs=True)
        model.least = least_fit(rows, counts, often) if often else -np.inf
        return model
    drawn = share_of(rows, "lang", per_language, "doc_id", "text", work=lambda d: d.withColumn("text", excerpt("text", CHARS)))
    got = sorted((r["lang"], r["text"]) for r in drawn.toLocalIterator())
    return LanguageModel([t for _, t in got], [g for g, _ in got])


def _start(shared, use):
    """``use`` of the broadcast model, in a task."""
    worker_store("languages")  # frees what another operator has left
    own = LanguageModel.__new__(LanguageModel)
    own.langs, own.logs = shared.value
    return use(own)


def predict(docs: DataFrame, model: LanguageModel, fit: bool = False) -> DataFrame:
    """``docs`` with lang_pred and score, and ``fit`` if asked for, from the column ``text``."""
    shared = docs.sparkSession.sparkContext.broadcast((model.langs, model.logs))  # bounded by BUCKETS x languages

    made = {"lang_pred": pa.string(), "score": pa.float64()} | ({"fit": pa.float64()} if fit else {})
    return with_text_columns(docs, made, "lang_pred string, score double" + (", fit double" if fit else ""), lambda: _start(shared, lambda m: m.judged if fit else m.predict))
