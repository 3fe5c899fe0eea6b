"""Term pipeline, secrets and whitening against plain versions."""

import math
import re
import string
from collections import Counter, defaultdict

import numpy as np
import pytest
from cases import DOCUMENTS, documents
from hypothesis import given, settings
from hypothesis import strategies as st

from nodepulse.llm import markov_secrets, term_pipeline, whitening

# ---- ranked lexical search


def plain_terms(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", text)


def plain_ranks(docs, items, k):
    """{item: [(doc_id, score), ...]} with equal scores and ids in any order."""
    docs = [(i, Counter(plain_terms(t))) for i, t in docs]
    n = sum(bool(c) for _, c in docs)
    length = sum(sum(c.values()) for _, c in docs)
    df = Counter(t for _, c in docs for t in c)
    asked = defaultdict(list)
    for i, t in items:
        if i is not None:
            asked[i] += plain_terms(t)
    out = {}
    for item, terms in asked.items():
        scored = []
        for i, c in docs:
            m = 100 - 25 + (25 * sum(c.values()) * n) // length if length else 0
            score = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 12 * m)) for t in terms if t in c
            )
            if score > 0:
                scored.append((-score, i is None, i or 0))
        out[item] = [(None if u else i, -s) for s, u, i in sorted(scored)[:k]]
    return {i: r for i, r in out.items() if r}


def got_ranks(df):
    out = defaultdict(list)
    for r in sorted(df.collect(), key=lambda r: (r.item_id, r["rank"])):
        out[r.item_id].append((r.doc_id, r.score))
        assert r["rank"] == len(out[r.item_id])
    return dict(out)


ITEMS = [
    (1, "The old MAN and the sea, sea sea"),
    (2, None),
    (3, "!!!"),
    (4, "größe 你好 satz7 wort12 the"),
    (4, "house"),
    (None, "the"),
    (5, "x x x 12"),
    (6, "nothing here that_any text has zzz"),
]


def test_ranks_of_odd_documents(spark):
    items = spark.createDataFrame([(*i, ["kept"], "x") for i in ITEMS], "item_id int, text string, rank array<string>, doc_id string")
    docs = documents(spark).repartition(3)
    assert got_ranks(term_pipeline.ranked(docs, items, k=3)) == plain_ranks([(d[0], d[1]) for d in DOCUMENTS], ITEMS, 3)


def test_ranks_over_many_blocks_and_passes(spark, monkeypatch):
    rng = np.random.default_rng(3)
    words = [f"w{min(int(x), 400)}" for x in rng.pareto(0.6, 60_000)]
    sizes = rng.integers(0, 40, 1500)
    docs = [(int(k) % 1200, " ".join(words[int(rng.integers(0, 59_000)) :][: int(s)])) for k, s in enumerate(sizes)]
    items = [(k, " ".join(words[int(rng.integers(0, 59_000)) :][: int(rng.integers(1, 30))])) for k in range(60)]
    want = plain_ranks(docs, items, 5)
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    asked = spark.createDataFrame(items, "item_id long, text string")
    monkeypatch.setattr(term_pipeline, "PAIRS", 200)
    monkeypatch.setattr(term_pipeline, "CELLS", 500)
    assert got_ranks(term_pipeline.ranked(frame, asked, k=5)) == want


def test_ranks_of_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string, item_id int")
    some = spark.createDataFrame([(1, "a", 1)], "doc_id long, text string, item_id int")
    for docs, items in ((none, some), (some, none), (none, none)):
        df = term_pipeline.ranked(docs, items)
        assert df.dtypes == [("item_id", "int"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]
        assert df.collect() == []


# ---- secrets


def plain_base(text):
    """The contract's patterns, with runs of any length that are dropped afterwards."""
    out = []
    key = r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])"""
    for m in re.finditer(key + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text):
        if len(m[2]) >= 6:
            out.append((0, *m.span()))
    out += [(1, *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    return out + [(2, *m.span()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]


PIECES = ["password", "PassWd", "secret", "toKen", "api_key", "apikey", "=", ":", " ", "'", '"', "AKIA", "AB12", "0123456789abcdef", "abc", "é", "K", "ſ", "/", "x.y", "\n"]


@given(st.lists(st.sampled_from(PIECES), max_size=40))
@settings(max_examples=300, deadline=None)
def test_base_spans(parts):
    text = "".join(parts)
    assert markov_secrets.base_spans(text) == plain_base(text)


def learned():
    rng = np.random.default_rng(1)
    parts = ["get", "user", "name", "house", "ing", "tion", "berg", "lich", "able", "ter", "man", "value"]
    ordinary = ["".join(rng.choice(parts, 4)) for _ in range(3000)]
    return markov_secrets.SecretModel.fit(ordinary + ["0f" * 20], [False] * 3000 + [True])


def test_chain_is_a_plain_sum():
    model = learned()
    chars = string.ascii_uppercase + string.ascii_lowercase + string.digits + "+/_.=-"
    for token in ("a", "getUser_0", "Zz/=+-.9"):
        codes = [68, 68, *[chars.index(c) for c in token]]
        want = sum(float(model.ratio[a, b, c]) for a, b, c in zip(codes, codes[1:], codes[2:], strict=False))
        assert model.scores([token])[0] == pytest.approx(want, rel=1e-5)
    assert np.exp(markov_secrets._chain(["abc", "abd"])).sum(2) == pytest.approx(1)


def test_random_strings_are_told_from_names():
    model = learned()
    rng = np.random.default_rng(99)
    letters = list(string.ascii_letters + string.digits)
    strange = ["".join(rng.choice(letters, 32)) for _ in range(200)]
    names = ["userNameValue", "get_house_able_value", "mantionberglich", "HOUSE_TER_USER_MAN", "4111111111111111", "=" * 40, "z" * 40]
    found = model.spans([f"see ({x}) there" for x in strange])
    assert sum(s[:1] == [(3, 5, 37, s[0][3] if s else None)] for s in found) >= 195
    assert model.spans([f"see ({x}) there" for x in names]) == [[]] * len(names)
    assert model.spans([None, "", "token=" + strange[0]])[:2] == [[], []]
    assert [s[0] for s in model.spans(["token=" + strange[0]])[0]] == [0]  # the pattern's span stays alone


def test_overlaps():
    runs = list(re.finditer("x+", "xx_xxx_xxxx"))
    for spans, left in (([], 3), ([(0, 1, 4)], 1), ([(0, 0, 11)], 0), ([(0, 2, 3)], 3), ([(1, 3, 4), (0, 0, 2)], 1)):
        assert len(markov_secrets._outside(runs, spans)) == left


def test_secrets_of_odd_documents(spark):
    model = markov_secrets.train(documents(spark))
    out = markov_secrets.secrets(documents(spark), model)
    assert out.columns == [*documents(spark).columns, "secrets"]
    rows = out.collect()
    assert len(rows) == len(DOCUMENTS) and all(r.score == ["kept", "score"] for r in rows)
    assert all([(s.start, s.end) for s in r.secrets if s.kind != "random"] == [x[1:] for x in plain_base(r.text or "")] for r in rows)
    empty = documents(spark, [])
    assert markov_secrets.secrets(empty, markov_secrets.train(empty)).collect() == []
    bare = markov_secrets.secrets(documents(spark, [(1, "token: abcdefgh9 Zk39dkfJ38dkfjD93kdjf", None)]), markov_secrets.SecretModel()).collect()
    assert [s.kind for s in bare[0].secrets] == ["assign"]


# ---- whitening


@given(st.integers(0, 2**32 - 1))
@settings(max_examples=150, deadline=None)
def test_rank_one_update(seed):
    rng = np.random.default_rng(seed)
    k = int(rng.integers(1, 24))
    values = np.sort(rng.normal(size=k) ** 2 * 10.0 ** rng.integers(-6, 6))
    if seed % 3 == 0:
        values[: k // 2] = values[0] * (seed % 2)
    values.sort()
    vectors = np.linalg.qr(rng.normal(size=(k, k)))[0]
    v = rng.normal(size=k) * 10.0 ** rng.integers(-4, 4)
    if seed % 4 == 0:
        v = vectors[:, : max(1, k // 2)] @ rng.normal(size=max(1, k // 2))
    rho = float(rng.random())
    got, turned = whitening.rank_one(values, vectors, v, rho)
    want = vectors @ np.diag(values) @ vectors.T + rho * np.outer(v, v)
    assert np.abs(turned @ np.diag(got) @ turned.T - want).max() <= 1e-12 * np.abs(want).max()
    assert np.abs(turned.T @ turned - np.eye(k)).max() < 1e-12
    assert (np.diff(got) >= 0).all()


def test_spectra_combine():
    rng = np.random.default_rng(4)
    x = (np.floor(64 * rng.normal(size=(400, 7)) * np.arange(1, 8)) + 1_000_000).astype(np.int64)
    parts = [x[:1], x[1:50], x[50:50], x[50:]]
    whole = whitening.Spectrum(7)
    for part in parts:
        own = whitening.Spectrum(7)
        own.add(part)
        whole.merge(whitening.Spectrum.unpack(**own.pack()))
    off = x - x.mean(0)
    assert whole.n == 400 and whole.sums == x.sum(0).tolist()
    assert whole.values == pytest.approx(np.linalg.eigvalsh(off.T @ off), rel=1e-9)


def vectors(spark, rows, kind="float"):
    return spark.createDataFrame([(i, v, ["kept"]) for i, v in rows], f"vec_id long, embedding array<{kind}>, n array<string>")


def test_whitened_equals_plain_eigenvectors(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(500, 40)) @ rng.normal(size=(40, 40))
    rows = [(k // 2, [float(c) for c in v]) for k, v in enumerate(x)]
    odd = [(7, None), (8, []), (9, [None] * 40), (10, [math.nan] * 40), (11, [math.inf] * 40), (12, [1e300] * 40), (13, [1.0, 2.0]), (None, [0.5] * 40)]
    df = whitening.whitened(vectors(spark, rows + odd, "double").repartition(19))
    whole = np.floor(64 * np.array([v for _, v in rows] + [[0.5] * 40])).astype(np.int64) + 1_000_000
    n, sums = len(whole), whole.sum(0)
    off = whole - sums / n
    values, axes = np.linalg.eigh(off.T @ off / n)
    values, axes = values[::-1], axes[:, ::-1]
    want = off @ axes / np.sqrt(values)
    got = df.toPandas()
    assert len(got) == n * 32 and (got["n"] == n).all() and got["identity_error"].between(0, 1e-9).all()
    ids = [i for i, _ in rows] + [-1]
    exact = sorted((i, int(d)) for i, d in zip(ids, ((n * whole - sums) ** 2).sum(1), strict=True))
    first = got[got["component"] == 1]
    assert sorted((int(i) if i == i else -1, d) for i, d in zip(first["vec_id"], first["deviation"], strict=True)) == exact
    for c in (1, 5, 32):
        own = got[got["component"] == c]
        assert own["explained"].to_numpy() == pytest.approx(values[c - 1] / values.sum(), rel=1e-10)
        a, b = np.sort(own["whitened"]), np.sort(want[:, c - 1])
        assert a == pytest.approx(b, abs=1e-7) or a == pytest.approx(-b[::-1], abs=1e-7)


def test_whitening_without_components(spark):
    for rows in ([], [(1, [1.0, 2.0])], [(k, [1.0, 2.0]) for k in range(9)], [(1, None)]):
        assert whitening.whitened(vectors(spark, rows)).collect() == []
    few = whitening.whitened(vectors(spark, [(k, [float(k), 2.0 * k, 5.0]) for k in range(9)])).collect()
    assert len(few) == 9 and {r.component for r in few} == {1}
    assert few[0].explained == pytest.approx(1) and few[0].identity_error < 1e-12


def test_deviations_beyond_64_bits():
    x = np.array([[0], [1 << 45]], np.int64)
    sums = [(1 << 45) * 1000]
    assert whitening.deviations(x, 2000, sums) == [None, None]
    assert whitening.deviations(x >> 30, 2, [1 << 15]) == [1 << 30, 1 << 30]
