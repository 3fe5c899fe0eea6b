"""Labels that only long texts have are learned too."""

from cases import documents

from nodepulse.llm import lang_mix, toxic_crf
from nodepulse.llm.common import excerpt


def test_language_of_long_texts_only(spark):
    short = "the house and the garden by the river are old "
    long = "talo on suuri ja kaunis mutta kissa istuu ikkunalla "
    rows = [(k, short * (k + 1), "en") for k in range(5)] + [(10 + k, long * (300 + k), "fi") for k in range(5)]
    docs = documents(spark, rows)
    model = lang_mix.train(docs)
    assert model.langs == ["en", "fi"]
    got = {r.doc_id: r.lang_pred for r in lang_mix.predict(docs, model).collect()}
    assert all(got[d] == g for d, _, g in rows)


def test_toxic_texts_that_are_all_long(spark):
    plain = [f"wort{k % 97} satz{k % 31} ding{k % 13}" for k in range(400)]
    rows = [(k, " ".join(plain[k:]), "en") for k in range(40)]
    rows += [(100 + k, " ".join(f"{x} grumpf" for x in plain[k:]) * 2, "en") for k in range(20)]
    assert all(len(t) > toxic_crf.CHARS for d, t, _ in rows if d >= 100)
    labels = spark.createDataFrame([(d, int(d >= 100)) for d, _, _ in rows], "doc_id long, toxic int")
    docs = documents(spark, rows)
    got = toxic_crf.predict(docs, toxic_crf.train(docs, labels)).collect()
    assert all(r.predicted == int(r.doc_id >= 100) for r in got)


def test_excerpt_has_whole_words_of_all_parts(spark):
    text = " ".join(f"w{k}" for k in range(5000))
    df = spark.createDataFrame([(text,), ("short one",), ("x" * 5000,)], "t string")
    got = [r.e for r in df.select(excerpt("t", 1000).alias("e")).collect()]
    places = [int(w[1:]) for w in got[0].split()]
    assert len(got[0]) <= 1010 and set(got[0].split()) <= set(text.split())
    assert places == sorted(places) and {p // 1000 for p in places} == set(range(5))
    assert got[1:] == ["short one", " ".join(["x" * 100] * 10)]
