"""The pipeline's stages, and the queries that SQL can express."""

import os
import zlib

import __spark_entry__ as entry_points
import corpus_pipeline
import numpy as np
import pytest
from cases import CLASH, DOCUMENTS, documents

from nodepulse.llm import byte_bpe, lang_mix, simhash_trie, toxic_crf
from nodepulse.llm.common import read, vocabulary
from nodepulse.llm.queries import QUERIES, SQL


def test_stages_keep_columns_and_odd_rows(spark, tables):
    rows = documents(spark)
    clean = corpus_pipeline.toxicity(spark, rows, tables)
    assert clean.columns == rows.columns
    assert clean.count() == len(DOCUMENTS)
    told = corpus_pipeline.language(spark, clean, tables)
    assert told.columns == rows.columns
    left = told.collect()
    assert len(left) == sum(any(map(str.isalpha, t or "")) for _, t, _ in DOCUMENTS)
    assert all(r[c] == ["kept", c] for r in left for c in CLASH)
    empty = documents(spark, [])
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, tables).count() == 0


def test_pipeline_against_plain_stages(spark, tables):
    docs = read(spark, tables, "documents")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "language", "near_duplicates", "packing"]
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    model = toxic_crf.train(docs, read(spark, tables, "labels"))
    ids = sorted(texts)
    bad = model.predict([texts[k] for k in ids], {})[1]
    ids = [k for k, b in zip(ids, bad, strict=True) if not b]
    known = lang_mix.train(docs.where(docs.doc_id.isin(ids)), bound=True)
    found = known.judged([texts[k] for k in ids])
    ids = [k for k, lang, fit in zip(ids, found[0], found[2], strict=True) if lang != "und" and fit >= known.least]
    prints = np.array([simhash_trie.fingerprint(texts[k]) for k in ids], np.uint64)
    label = np.arange(len(ids))
    near = np.bitwise_count(prints[:, None] ^ prints[None, :]) <= 4
    while True:
        new = np.array([label[row].min() for row in near])
        if (new == label).all():
            break
        label = new
    want = {ids[k] for k in set(label)}
    out = corpus_pipeline.run(spark, tables).collect()
    assert {r.doc_id for r in out} == want
    encoder = byte_bpe.load(vocabulary("byte_bpe_50k.json"))
    for k in want:
        own = np.array([*encoder.encode(texts[k], add_special_tokens=False).ids, 1], "<u4")
        pieces = sorted((r for r in out if r.doc_id == k), key=lambda r: r.start)
        assert sum(r.length for r in pieces) == len(own) and pieces[0].start == 0
        assert all(r.ids_crc32 == zlib.crc32(own[r.start : r.start + r.length].tobytes()) for r in pieces)
    assert all(r.offset + r.length <= 2048 for r in out)


@pytest.mark.parametrize("name", list(SQL))
def test_queries_like_their_sql(spark, tables, duck, name):
    got, want = QUERIES[name](spark, tables).toPandas(), duck.execute(SQL[name]).df()
    columns = sorted(want.columns)
    assert sorted(got.columns) == columns
    got, want = (d[columns].sort_values(columns).reset_index(drop=True) for d in (got, want))
    assert len(got) == len(want)
    assert (got.to_numpy() == want.to_numpy()).all()


def test_all_are_registered():
    names = list(entry_points.queries())
    for n in range(1, 14):
        assert sum(x.startswith(f"op{n}_") for x in names) == 1
    assert "pipeline" in names


def test_every_row_has_a_result(spark, tables):
    n = read(spark, tables, "documents").count()
    for name in ("op1_spotsigs", "op4_language_mix", "op5_suffix_pieces", "op7_bit_packing", "op8_toxic_crf", "op10_simhash_trie", "op12_markov_secrets"):
        ids = [r.doc_id for r in QUERIES[name](spark, tables).select("doc_id").collect()]
        assert len(ids) == len(set(ids)) == n, name


def test_held_out_columns(spark, tables):
    got = QUERIES["op4_language_mix"](spark, tables).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    assert os.path.exists(tables)
