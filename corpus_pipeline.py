"""A corpus from raw documents: toxicity, language, near-duplicates, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame.  All but the last
return the columns of ``docs``; the last returns the pieces of packed sequences.

Cases: documents without text are kept by the first stage and leave with the
second, as nothing can be said about their language; where there is nothing to
learn from, the first two stages keep all; columns that share a name with one
that a stage makes for itself are carried through unharmed.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from nodepulse.llm import lang_mix, packing, simhash_trie, toxic_crf
from nodepulse.llm.common import kept, read, vocabulary


def _where(docs: DataFrame, judge: Callable[[DataFrame], DataFrame], condition: str) -> DataFrame:
    """Rows of ``docs`` for which ``condition`` holds on the columns that ``judge`` adds."""
    plain = docs.toDF(*[c if c == "text" else f"__{k}" for k, c in enumerate(docs.columns)])
    return judge(plain).where(condition).select(plain.columns).toDF(*docs.columns)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the chain model, taught by ``labels``, does not call toxic."""
    model = toxic_crf.train(docs, read(spark, sf_dir, "labels"))
    return _where(docs, lambda d: toxic_crf.predict(d, model), "predicted = 0")


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one or several of the languages that ``lang`` names, judged by how well these fit."""
    model = lang_mix.train(docs, bound=True)
    if not model.langs:
        return docs
    return _where(docs, lambda d: lang_mix.predict(d, model, fit=True), f"lang_pred <> 'und' and fit >= double('{model.least}')")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group linked by fingerprints of four-word windows at 4 bits or fewer."""
    return simhash_trie.representatives(docs, limit=4)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of at most 2048 ids."""
    return packing.packed_documents(docs, vocabulary("byte_bpe_50k.json"), end_id=1, size=2048)


STAGES = [
    ("toxicity", toxicity),
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("packing", packed),
]

#: SQL says none of the stages but the fingerprints; tests hold them against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again before the next."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = kept(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
