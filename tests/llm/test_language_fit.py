"""The language stage's bound on how well the learned languages fit."""

import base64
import random

import corpus_pipeline
import numpy as np
import pytest
from cases import documents

from nodepulse.llm import lang_mix
from nodepulse.llm.common import read


def test_stage_rejects_what_no_language_fits(spark, tables):
    given = read(spark, tables, "documents").select("doc_id", "text", "lang").collect()
    rng = random.Random(1)
    junk = [
        "".join(rng.choice("abcdefghijklmnopqrstuvwxyz     ") for _ in range(400)),
        f"{rng.getrandbits(1600):x}",
        base64.b64encode(rng.randbytes(300)).decode(),
        "мама мыла раму и пошла домой вечером " * 4,
    ]
    of = {g: [r.text for r in given if r.lang == g] for g in ("en", "fr", "de", "es")}
    mixed = " ".join(" ".join(" ".join(t[:5]).split()[:100]) for t in of.values())
    rows = [(r.doc_id, r.text, r.lang) for r in given]
    rows += [(-1 - k, t, None) for k, t in enumerate(junk)] + [(-100, mixed, None)]
    for langs in (("en", "fr", "de", "es"), ("en",)):
        own = [(d, t, g if g in langs else None) for d, t, g in rows if d < 0 or g in langs]
        got = {r.doc_id for r in corpus_pipeline.language(spark, documents(spark, own), tables).collect()}
        assert not got & {-1, -2, -3, -4}
        assert {d for d, t, g in own if g} <= got
        assert len(langs) == 1 or -100 in got


def test_model_and_bound_come_from_all_labelled_texts(spark):
    """More texts than any sample of a language takes, the odd ones among those that one in a hundred is."""
    rng = random.Random(2)
    words = {"a": ["wort", "satz", "haus", "baum", "licht", "stein"], "b": ["mot", "phrase", "maison", "arbre", "pierre"]}
    rows = [(k, " ".join(rng.choices(words[g], k=12)) + (" qqxz" * (k % 70 == 0)), g) for k in range(2600) for g in "ab"]
    rows += [(9000, "long " * 4000 + "zyx" * 9, "a"), (9001, "12 34", "b"), (9002, None, "a"), (9003, "ohne", None)]
    table = documents(spark, rows)
    model = lang_mix.train(table, bound=True)
    known = [(t, g) for _, t, g in rows if t and g]
    plain = lang_mix.LanguageModel([t for t, _ in known], [g for _, g in known])
    assert model.langs == plain.langs and np.array_equal(model.logs, plain.logs)
    part = {r.text: r.part for r in table.select("text", lang_mix.part_of().alias("part")).collect()}
    fits = []
    for fold in range(lang_mix.FOLDS):
        others = [(t, g) for t, g in known if part[t] != fold]
        judge = lang_mix.LanguageModel([t for t, _ in others], [g for _, g in others])
        fits += judge.judged([t for t, _ in known if part[t] == fold])[2].tolist()
    fits = np.array(fits)[np.isfinite(fits)]
    assert len(fits) == 5201
    middle = np.median(fits)
    assert model.least == pytest.approx(middle - lang_mix.BELOW * (middle - np.quantile(fits, 0.01, method="lower")), abs=1e-9)
    assert model.fits(["wort satz", None]).tolist() == model.judged(["wort satz", None])[2].tolist()
