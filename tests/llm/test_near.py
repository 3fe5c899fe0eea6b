"""SimHash components, SpotSigs and exact top-k against brute force."""

import hashlib
import re
import zlib

import numpy as np
import pytest
import xxhash
from cases import DOCUMENTS, documents
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from nodepulse.llm import components, simhash_trie, spotsigs, topk


def plain_fingerprint(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall("[^\x20\x09-\x0d]+", text)
    if not words:
        return 0
    runs = [" ".join(words[k : k + 4]) for k in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(near):
    label = np.arange(len(near))
    while True:
        new = np.array([label[row].min() for row in near])
        if (new == label).all():
            return label
        label = new


def test_fingerprints(spark):
    for _, text, _ in DOCUMENTS:
        assert simhash_trie.fingerprint(text or "") == plain_fingerprint(text)


@given(st.integers(0, 2**32 - 1), st.integers(0, 6), st.integers(1, 400))
@settings(max_examples=40, deadline=None)
def test_trie_join_finds_all_groups(seed, limit, n):
    rng = np.random.default_rng(seed)
    centre = rng.integers(0, 2**64, 3, dtype=np.uint64)
    v = centre[rng.integers(0, 3, n)]
    for _ in range(int(rng.integers(0, 9))):
        v = v ^ (np.uint64(1) << rng.integers(0, 64, n).astype(np.uint64))
    v = np.unique(v)
    want = plain_groups(np.bitwise_count(v[:, None] ^ v[None, :]) <= limit)
    trie = simhash_trie.TrieJoin(v, limit)
    trie.walk((0, len(v), 0, len(v), 0), 0)
    assert (trie.label == want).all()


def test_components_of_random_graphs(spark):
    rng = np.random.default_rng(5)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 300, (170, 2))] + [(k, k + 1) for k in range(1000, 1060)] + [(7, 7)]
    got = {r.node: r.root for r in components.star_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    root = {x: x for e in edges if e[0] != e[1] for x in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        if a != b:
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    assert got == {x: find(x) for x in root}


def test_near_components(spark):
    rng = np.random.default_rng(2)
    words = [f"w{k}" for k in range(500)]
    base = [" ".join(rng.choice(words, 300)) for _ in range(6)]
    more = []
    for k in range(60):
        parts = base[k % 6].split()
        parts[int(rng.integers(len(parts)))] = "changed"
        more.append((100 + k, " ".join(parts), None))
    rows = DOCUMENTS + more
    got = simhash_trie.near_components(documents(spark, rows)).collect()
    prints = np.array([plain_fingerprint(t) for _, t, _ in rows], np.uint64)
    label = plain_groups(np.bitwise_count(prints[:, None] ^ prints[None, :]) <= 4)
    ids = [d for d, _, _ in rows]
    first = {k: min((ids[n] for n in np.flatnonzero(label == k) if ids[n] is not None), default=None) for k in set(label)}
    want = sorted((str(d), int(p.astype(np.int64)), str(first[k])) for d, p, k in zip(ids, prints, label, strict=True))
    assert sorted((str(r.doc_id), r.fp, str(r.component_id)) for r in got) == want
    kept = simhash_trie.representatives(documents(spark, rows))
    assert kept.columns == documents(spark, rows).columns
    left = [r.doc_id for r in kept.collect()]
    assert sorted(left, key=str) == sorted((first[k] for k in set(label)), key=str)


def test_one_row_of_each_group_where_ids_repeat(spark):
    far = [f"text {k} of its own with words like w{k * 7} w{k * 11} w{k * 13} and w{k * 17} at the end" for k in range(4)]
    rows = [(3, far[0], "a"), (5, far[0], "b"), (5, far[1], "c"), (5, far[1], "c"), (5, far[2], "d"), (None, far[2], "e"), (None, far[3], "f"), (None, far[3], "g")]
    got = simhash_trie.representatives(spark.createDataFrame(rows, "doc_id long, text string, said string"))
    assert got.columns == ["doc_id", "text", "said"]
    got = sorted((r.text, r.doc_id, r.said) for r in got.collect())
    assert [g[:2] for g in got] == [(far[0], 3), (far[1], 5), (far[2], 5), (far[3], None)]
    assert [g[2] for g in got][:3] == ["a", "c", "d"]


def test_no_documents(spark):
    assert simhash_trie.near_components(documents(spark, [])).count() == 0
    assert spotsigs.spotsigs(documents(spark, [])).count() == 0


def test_spotsigs(spark):
    rows = [r for r in DOCUMENTS if r[0] != 5] + [(5, DOCUMENTS[4][1], "de")]
    got = {r.doc_id: r for r in spotsigs.spotsigs(documents(spark, rows)).collect()}
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    assert len(got) == len(rows)
    for (d, text, _), (_, after, _) in zip(ordered, ordered[1:] + ordered[:1], strict=True):
        text, after = text or "", after or ""
        new = spotsigs.edited(text, after)
        a, b, c = map(spotsigs.signatures, (text, new, after))
        r = got[d]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(new.encode()).hexdigest())
        assert (r.fingerprint, r.edited_fingerprint) == (spotsigs.fingerprint(a), spotsigs.fingerprint(b))
        assert r.near_edited == pytest.approx(spotsigs.likeness(a, b))
        assert r.near_next == pytest.approx(spotsigs.likeness(a, c))
    assert got[1].fingerprint == got[4].fingerprint
    assert got[2].fingerprint == got[3].fingerprint == ""


def test_spotsigs_of_one_document_and_of_repeated_ids(spark):
    one = spotsigs.spotsigs(documents(spark, [(3, "abcdefgh ijkl", None)])).collect()
    assert [(r.doc_id, r.n_chars) for r in one] == [(3, 13)]
    assert one[0].near_next == 1
    same = spotsigs.spotsigs(documents(spark, [(3, "the first text", None)] * 5 + [(4, "another text", None)])).collect()
    assert sorted(r.doc_id for r in same) == [3] * 5 + [4]


@pytest.mark.parametrize("hot", [5, None])
def test_rows_of_a_hot_id_are_dealt_out(spark, hot):
    rows = [(hot, f"the text number {k} of the hot id and {k * k} more") for k in range(60)] + [(hot, "the same of the hot id")] * 3
    rows += [((1 << 62) + k, f"a text of its own, {k} and the rest") for k in range(10)] + [(None, "no id and the end")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    ranges, first, _ = spotsigs._ranges(frame.selectExpr(f"coalesce(doc_id, {spotsigs.LOWEST + 1}L - 1L) as doc_id", "text", "xxhash64(text) as tie"), 4)
    assert len(ranges.ids) == 3 and first == spotsigs.LOWEST and len(set(ranges.ids.tolist())) < 3
    ordered = [(r.doc_id, r.text) for r in frame.selectExpr("*", "xxhash64(text) as tie").orderBy("doc_id", "tie").collect()]
    want = []
    for (d, text), (_, after) in zip(ordered, ordered[1:] + ordered[:1], strict=True):
        want.append((str(d), hashlib.sha256(spotsigs.edited(text, after).encode()).hexdigest()))
    got = spotsigs.spotsigs(frame).collect()
    assert sorted((str(r.doc_id), r.edited_sha256) for r in got) == sorted(want)
    parts = spotsigs.in_order(frame, "doc_id", "text").selectExpr("copy", "spark_partition_id() as part").where("not copy")
    assert max(r["count"] for r in parts.groupBy("part").count().collect()) < 40


def plain_signatures(text):
    """The module's rule, written out for one text."""
    words = re.findall(r"[^\W\d_]+", text.lower())
    out, gap = [], 8
    for k, word in enumerate(words):
        anchor = word in spotsigs.ANCHORS
        gap = 0 if anchor else gap + 1
        chain = [w for w in words[k + 1 :] if w not in spotsigs.ANCHORS][:2]
        if (anchor or gap > 8) and len(chain) == 2:
            out.append(" ".join([word, *chain]))
    if len(words) < 24:
        out += [f"{a} {b}" for a, b in zip(words, words[1:], strict=False)]
    if len(words) < 5 and text:
        out += [text[k : k + 3] for k in range(max(1, len(text) - 2))]
    return {zlib.crc32(s.encode(), 0 if (n := out[:k].count(s)) == 0 else n + 1) for k, s in enumerate(out)}


TEXTS = st.lists(st.sampled_from(["the", "and", "of", "house", "river", "old", "stone", "Town", "é", "x1", "."]), max_size=60).map(" ".join)


@given(TEXTS)
@settings(max_examples=200, deadline=None)
def test_signatures_by_the_rule(text):
    assert spotsigs.signatures(text) == plain_signatures(text)


@given(st.frozensets(st.integers(0, 40)), st.frozensets(st.integers(0, 400), max_size=300))
@settings(max_examples=200, deadline=None)
def test_likeness_is_exact(a, b):
    assert spotsigs.likeness(a, b) == (len(a & b) / len(a | b) if a | b else 1.0)


@pytest.mark.parametrize("floor, bucket", [(0.8, 2000), (0.5, 2000), (0.5, 3), (0.3, 1)])
def test_search_equals_brute_force(spark, monkeypatch, floor, bucket):
    monkeypatch.setattr(spotsigs, "BUCKET", bucket)
    rng = np.random.default_rng(int(floor * 10) + bucket)
    words = ["the", "of", "and", *[f"{a}{b}" for a in "abcdefgh" for b in "aeiou"]]
    base = [list(rng.choice(words, int(n))) for n in rng.integers(1, 120, 25)]
    base += [["the", "same", "line", "of", "licence", "and", "terms"] * 3 + list(rng.choice(words, 12)) for _ in range(25)]
    rows = []
    for k in range(160):
        own = list(base[int(rng.integers(50))])
        for _ in range(int(rng.integers(0, 6))):
            own[int(rng.integers(len(own)))] = str(rng.choice(words))
        rows.append((k // 2 if k > 150 else k, " ".join(own)))
    rows += [(200, None), (201, ""), (202, "1 2 3"), (None, rows[0][1]), (None, "x")]
    sets = [plain_signatures(t or "") for _, t in rows]
    kinds = sorted({tuple(sorted(s)) for s in sets})
    near = {
        (a, b): len(set(a) & set(b)) / len(set(a) | set(b)) for a in kinds for b in kinds if a < b and len(set(a) & set(b)) >= floor * len(set(a) | set(b)) - 1e-9 and a
    }
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = spotsigs.signature_sets(frame)
    name = {r.key: tuple(sorted(r.sigs)) for r in found.collect()}
    got = {tuple(sorted((name[r.a], name[r.b]))): r.likeness for r in spotsigs.links(found, floor).collect()}
    assert got.keys() == near.keys()
    assert all(got[p] == pytest.approx(near[p]) for p in got)
    group = {s: s for s in kinds}

    def root(s):
        return s if group[s] == s else root(group[s])

    for a, b in near:
        x, y = sorted((root(a), root(b)))
        group[y] = x
    first, count = {}, {s: sum(s in p for p in near) for s in kinds}
    for (d, _), s in zip(rows, sets, strict=True):
        r = root(tuple(sorted(s)))
        first[r] = min((x for x in (d, first.get(r)) if x is not None), default=None)
    want = sorted((str(d), str(first[root(tuple(sorted(s)))]), count[tuple(sorted(s))]) for (d, _), s in zip(rows, sets, strict=True))
    classes = spotsigs.near_classes(frame, floor).collect()
    assert sorted((str(r.doc_id), str(r.class_id), r.n_links) for r in classes) == want


def test_search_in_nothing(spark):
    none = documents(spark, [])
    assert spotsigs.near_classes(none).count() == 0


def plain_top(rows, k, is_query):
    out = []
    sound = [(i, [int(np.floor(1024 * float(x))) for x in v]) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    for q, v in sound:
        if is_query(q):
            scores = [(-sum(x * y for x, y in zip(v, w, strict=True)), i) for i, w in sound if i != q and len(w) == len(v)]
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(sorted(scores)[:k])]
    return sorted(out)


@pytest.mark.parametrize("seed", [0, 1])
def test_top_k(spark, monkeypatch, seed):
    monkeypatch.setattr(topk, "CANDIDATES", 40)
    monkeypatch.setattr(topk, "QUERIES", 4)
    monkeypatch.setattr(topk, "BINS", 16)
    rng = np.random.default_rng(seed)
    rows = [(int(i), rng.normal(0, 0.3, 5).round(2 if seed else 6).astype(float).tolist()) for i in range(200)]
    rows += [(300 + i, rows[10][1]) for i in range(60)] + [(10, rows[10][1]), (20, [0.5] * 5)]
    rows += [(400, None), (410, []), (420, [None] * 5), (430, [float("nan")] * 5), (440, [float("inf")] * 5), (None, [0.1] * 5)]
    rows += [(500, [0.5, 0.25]), (510, [1.0, 1.0]), (520, [1e5] * 5), (530, [-1e5] * 5)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("score", F.lit("x")).withColumn("low", F.lit(1))
    got = topk.top_k(df, "vec_id % 10 = 0", k=7, scale=1024).collect()
    want = plain_top(rows, 7, lambda q: q % 10 == 0)
    assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in got) == want


def test_top_k_of_no_vectors(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert topk.top_k(empty, "vec_id % 10 = 0").count() == 0
    one = spark.createDataFrame([(10, [1.0])], "vec_id long, embedding array<float>")
    assert topk.top_k(one, "vec_id % 10 = 0").count() == 0
