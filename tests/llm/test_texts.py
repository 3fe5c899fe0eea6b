"""Language, toxicity, pages, pieces and conversations against plain versions."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest
from cases import CLASH, DOCUMENTS, documents
from hypothesis import given, settings
from hypothesis import strategies as st
from pages import PAGES

from nodepulse.llm import html_blocks, lang_mix, reply_trees, suffix_pieces, toxic_crf
from nodepulse.llm.common import vocabulary

PIECES = vocabulary("piece_bpe_32k.model")


# -- language ---------------------------------------------------------------


@pytest.fixture(scope="module")
def corpus(tables):
    docs = pq.read_table(f"{tables}/documents.parquet").to_pandas()
    return docs, np.array([zlib.crc32(str(d).encode()) % 4 == 2 for d in docs.doc_id])


def test_held_out_languages(corpus):
    docs, held_out = corpus
    model = lang_mix.LanguageModel(docs.text[~held_out].tolist(), docs.lang[~held_out].tolist())
    langs, scores = model.predict(docs.text[held_out].tolist())
    assert (np.array(langs) == docs.lang[held_out].to_numpy()).mean() > 0.95
    assert ((scores >= 0) & (scores <= 1)).all()


def test_mixed_text_has_both_languages_parts(corpus):
    docs, _ = corpus
    model = lang_mix.LanguageModel(docs.text.tolist(), docs.lang.tolist())
    of = {g: " ".join(docs.text[docs.lang == g].head(4)).split()[:300] for g in ("en", "fr")}
    langs, scores = model.predict([" ".join(of["en"] + of["fr"][:150]), " ".join(of["en"])])
    assert langs == ["en", "en"]
    assert scores[0] == pytest.approx(2 / 3, abs=0.06)
    assert scores[1] > 0.95


def plain_mixture(logs, rounds):
    """Language and share of one text, place by place: the rule of the module in plain numbers."""
    langs = list(range(len(logs[0])))
    alive, share = set(langs), {g: 1 / len(langs) for g in langs}
    best = None
    while alive:
        for _ in range(rounds if len(alive) > 1 else 0):
            new = dict.fromkeys(langs, 0.0)
            for word in logs:
                part = {g: share[g] * math.exp(word[g]) for g in alive}
                for g in alive:
                    new[g] += part[g] / sum(part.values()) / len(logs)
            moved = max(abs(new[g] - share[g]) for g in langs)
            share = new
            if moved < 1e-3:
                break
        fit = sum(math.log(sum(share[g] * math.exp(word[g]) for g in alive)) for word in logs)
        fit -= 0.5 * (len(alive) - 1) * math.log(len(logs) + 1)
        if best is None or fit > best[0]:
            best = (fit, max(langs, key=lambda g: (share[g], -g)), max(share.values()))
        out = min(alive, key=lambda g: (share[g], -g))
        alive = alive - {out}
        total = sum(max(share[g], 1e-6) for g in alive)
        share = {g: max(share[g], 1e-6) / total if g in alive else 0.0 for g in langs}
    return best[1:]


@given(st.integers(0, 2**32 - 1), st.integers(1, 30), st.integers(1, 5))
@settings(max_examples=80, deadline=None)
def test_mixtures_by_the_rule(seed, words, langs):
    rng = np.random.default_rng(seed)
    logs = rng.normal(-3, 1.5, (words, langs))
    model = lang_mix.LanguageModel.__new__(lang_mix.LanguageModel)
    model.langs = [str(g) for g in range(langs)]
    pick, share = model.mixtures(logs, np.array([0]))
    want = plain_mixture(logs.tolist(), lang_mix.ROUNDS)
    assert (pick[0], share[0]) == (want[0], pytest.approx(want[1], abs=1e-9))


def test_most_frequent_languages_only(spark):
    rows = documents(spark, [(k, f"wort{k} satz haus", g) for k, g in enumerate(["b", "b", "c", "a", "a", "d"])])
    assert lang_mix.train(rows, languages=3).langs == ["a", "b", "c"]


def test_grams_stay_inside_words():
    one = lang_mix.gram_buckets(["abc"])[0]
    two, owner = lang_mix.gram_buckets(["abc", "de", "abc"])
    for k in (0, 2):
        assert sorted(two[owner == k]) == sorted(one)
    # a, b, c; " a", ab, bc, "c "; " ab", abc, "bc "
    assert len(one) == 10


def test_language_rows(spark):
    rows = documents(spark)
    model = lang_mix.train(rows)
    got = lang_mix.predict(rows, model)
    assert set(got.columns) == set(rows.columns) | {"lang_pred", "score"}
    got = got.collect()
    assert len(got) == len(DOCUMENTS)
    for r in got:
        assert (r.lang_pred == "und") == (not any(map(str.isalpha, r.text or "")))
        assert 0 <= r.score <= 1
        assert r.length == ["kept", "length"]
    assert {r.score for r in got if r.lang_pred == "und"} == {0.0}
    none = lang_mix.train(documents(spark, []))
    assert {r.lang_pred for r in lang_mix.predict(rows, none).collect()} == {"und"}
    assert lang_mix.predict(documents(spark, []), model).count() == 0


# -- toxicity ---------------------------------------------------------------


def toy(n=300, seed=0):
    """Texts with bad words, bare stems that are harmless, and mistaken labels."""
    rng = random.Random(seed)
    words = [f"{a}{b}{c}" for a in ("mo", "ta", "ri", "lu") for b in ("ne", "ka", "so") for c in ("", "la", "mi", "ter")]
    texts, labels = [], []
    for k in range(n):
        text = [rng.choice(words) for _ in range(rng.randint(5, 150))]
        bad = k % 4 == 0
        if bad:
            text[rng.randrange(len(text))] = rng.choice(["grumpf", "zogger" + rng.choice(words)])
        elif k % 7 == 0:
            text[0] = "zogger"
        texts.append(" ".join(text))
        labels.append(int(bad))
    return texts, labels


def test_toxic_spans():
    texts, labels = toy()
    model = toxic_crf.ToxicModel()
    model.fit(texts, labels)
    texts, labels = toy(seed=1)
    score, predicted, spans = model.predict(texts, {})
    assert (predicted == np.array(labels)).mean() > 0.98
    assert ((score >= 0) & (score <= 1)).all()
    for text, label, found in zip(texts, labels, spans, strict=True):
        if label:
            assert any(re.match("grumpf|zogger.", text[s["start"] : s["stop"]]) for s in found)


def plain_marginals(emit, moves):
    """Toxic marginals and expected changes of one chain, by sums of logarithms place by place."""
    score = np.stack([np.zeros(len(emit)), emit], 1)
    fore, back = score.copy(), np.zeros_like(score)
    for t in range(1, len(emit)):
        fore[t] += np.logaddexp(*(fore[t - 1] + moves.T).T)
    for t in range(len(emit) - 2, -1, -1):
        back[t] = np.logaddexp(*(moves + score[t + 1] + back[t + 1]).T)
    total = np.logaddexp(*fore[-1])
    changes = sum(np.exp(fore[t][:, None] + moves + score[t + 1] + back[t + 1] - total) for t in range(len(emit) - 1))
    return np.exp(fore + back - total)[:, 1], changes


@pytest.mark.parametrize("kind", [np.float64, np.float32])
def test_chains_are_whole_texts(kind, monkeypatch):
    monkeypatch.setattr(toxic_crf, "ROWS_AT_ONCE", 9)
    rng = np.random.default_rng(2)
    model = toxic_crf.ToxicModel()
    model.moves = rng.normal(0, 2, (2, 2))
    sizes = [1000, 0, 1, 63, 64, 65, 128, 129, 700, 3]
    values = rng.normal(-1, 3, sum(sizes))
    grid, at, rows = toxic_crf._grid(values, sizes)
    p, changes = model.marginals(grid, rows, kind)
    plain = [plain_marginals(v, model.moves) for v in np.split(values, np.cumsum(sizes)[:-1]) if len(v)]
    close = 1e-9 if kind is np.float64 else 2e-4
    assert p.ravel()[at] == pytest.approx(np.concatenate([m for m, _ in plain]), abs=close)
    assert changes == pytest.approx(sum(c for _, c in plain), rel=close)


def test_a_word_in_front_changes_nothing_far_away():
    texts, labels = toy()
    model = toxic_crf.ToxicModel()
    model.fit(texts, labels)
    text = " ".join(texts[:40])
    (_, _, (before, after)) = model.predict([text, "house " + text], {})
    assert before and [(s["start"] + 6, s["stop"] + 6) for s in before] == [(s["start"], s["stop"]) for s in after]


def test_marginals_are_those_of_all_paths():
    rng = np.random.default_rng(0)
    model = toxic_crf.ToxicModel()
    model.moves = rng.normal(0, 1, (2, 2))
    emit = rng.normal(0, 2, (3, 7))
    got, changes = model.marginals(emit, np.array([1, 1, 1]), np.float64)
    expected = np.zeros((2, 2))
    for row in range(3):
        weight, on, both = 0.0, np.zeros(7), np.zeros((6, 2, 2))
        for path in np.ndindex(*[2] * 7):
            w = np.exp(sum(emit[row, t] for t in range(7) if path[t]) + sum(model.moves[a, b] for a, b in zip(path, path[1:], strict=False)))
            weight += w
            on += w * np.array(path)
            for t in range(6):
                both[t, path[t], path[t + 1]] += w
        assert got[row] == pytest.approx(on / weight)
        expected += both.sum(0) / weight
    assert changes == pytest.approx(expected)


def test_toxicity_rows(spark, tables):
    rows = documents(spark)
    labels = spark.createDataFrame([(1, 0, "x"), (4, 0, "x"), (13, 1, "x"), (13, 1, "x"), (99, 1, "x"), (None, 1, "x"), (2, None, "x")], "doc_id long, toxic int, text string")
    model = toxic_crf.train(rows, labels)
    got = toxic_crf.predict(rows, model).collect()
    assert len(got) == len(DOCUMENTS)
    assert len({r.score for r in got if not (r.text or "").strip()}) == 1
    assert all(r.predicted == int(r.score >= 0.5) and r.length == ["kept", "length"] for r in got)
    none = toxic_crf.train(documents(spark, []), labels)
    assert all(r.score < 1e-6 for r in toxic_crf.predict(rows, none).collect())
    assert toxic_crf.predict(documents(spark, []), model).count() == 0


def test_held_out_toxicity(spark, corpus, tables):
    docs, _ = corpus
    labels = pq.read_table(f"{tables}/labels.parquet").to_pandas()
    both = docs.merge(labels, on="doc_id")
    model = toxic_crf.ToxicModel()
    model.fit(both.text.tolist(), both.toxic.tolist())
    got = model.predict(both.text.tolist(), {})[1]
    assert (got == both.toxic.to_numpy()).mean() > 0.9


# -- pages ------------------------------------------------------------------

PAGE = """<!DOCTYPE html><html><head><title>No &amp; title</title><style>p{x:"</p>"}</style></head><body class="x">
<header><a href="/">Home</a></header><nav><ul><li><a href=1>One<li><a href=2>Two</a></ul></nav>
<div class="sidebar"><p>aside words</div><article class="post"><h1>A &quot;head&quot;</h1>
<p>First&nbsp;line <b>bold
  words</b>.<br>same block<p>Second &lt;p&gt; &#233;<script>var a="<p>no</p>";</script> end.</p>
<div class="advert">Buy now</div><ul><li>item one<li>item two</ul><form><label>Mail</label></form>
<!-- <p>hidden</p> --></p></article><section class="comments"><p>I disagree</p></section>
<footer>&copy; all</footer><script>open("""


def test_blocks_of_a_page():
    blocks = html_blocks.blocks_of(PAGE)
    want = ["No & title", "Home", "One", "Two", "aside words", 'A "head"', "First line bold words. same block", "Second <p> \xe9 end.", "Buy now"]
    want += ["item one", "item two", "Mail", "I disagree", "\xa9 all"]
    assert [b.text for b in blocks] == want
    main = [b.text for b, y in zip(blocks, html_blocks.taught(blocks), strict=True) if y]
    assert main == [want[k] for k in (5, 6, 7, 9, 10)]


@given(st.text(st.sampled_from('<>/"\'= pabdivscriptstyle!-&;#x1\n'), max_size=80))
@settings(max_examples=300, deadline=None)
def test_any_page_can_be_cut(page):
    for b in html_blocks.blocks_of(page):
        assert b.text == " ".join(b.text.split())
        assert 0 <= b.linked <= len(b.text)


def test_gradients_of_the_labeller():
    rng = np.random.default_rng(0)
    n = html_blocks.PATH + html_blocks.WORDS + html_blocks.NUMBERS
    xs, ys = [rng.normal(0, 1, (k, n)).astype(np.float32) for k in (5, 3)], [rng.integers(0, 2, k) for k in (5, 3)]
    model = html_blocks.BlockLabeller()
    x, mask, y = html_blocks._padded(xs, ys)

    def loss():
        p = model.probabilities(x, mask)
        return float(-np.where(mask, y * np.log(p) + (1 - y) * np.log(1 - p), 0).sum() / mask.sum())

    traces = {"f": [], "b": []}
    both = np.concatenate([model._run(w, x, mask, traces[w]) for w in "fb"], 2)
    p = html_blocks._sigmoid(both @ model.w["o"] + x @ model.w["s"] + model.w["k"])
    d = np.where(mask, p - y, 0) / mask.sum()
    grad = {k: 0 * v for k, v in model.w.items()}
    for n_, way in enumerate("fb"):
        slope = d[:, :, None] * model.w["o"][n_ * html_blocks.CELLS : (n_ + 1) * html_blocks.CELLS]
        model._back(way, x, mask, traces[way], slope, grad)
    for name in ("xf", "hf", "cf", "xb", "hb", "cb"):
        flat, g = model.w[name].reshape(-1), grad[name].reshape(-1)
        for k in rng.integers(0, len(flat), 6):
            old, step = flat[k], 1e-5
            flat[k] = old + step
            up = loss()
            flat[k] = old - step
            down = loss()
            flat[k] = old
            assert g[k] == pytest.approx((up - down) / (2 * step), abs=1e-6)


def test_main_text_of_all_pages(spark, tables):
    pages = spark.read.parquet(f"{tables}/pages.parquet")
    odd = [(-1, None, None), (-2, "u", ""), (-3, "u", "<p>"), (-4, "u", PAGE), (-5, "u", PAGE), (-6, "u", "&amp" * 50_000)]
    more = pages.unionByName(spark.createDataFrame(odd, "page_id long, url string, html string")).withColumnRenamed("url", "text")
    model = html_blocks.train(more)
    got = {r.page_id: r for r in html_blocks.main_text(more, model).collect()}
    assert len(got) == more.count()
    wrong = 0
    for r in pages.collect():
        blocks = html_blocks.blocks_of(r.html)
        want = "\n".join(b.text for b, y in zip(blocks, html_blocks.taught(blocks), strict=True) if y)
        wrong += got[r.page_id].text != want
        assert got[r.page_id].n_chars == len(got[r.page_id].text)
    assert wrong == 0
    assert [got[k].text for k in (-1, -2, -3)] == ["", "", ""]
    assert got[-4].text == got[-5].text
    assert html_blocks.main_text(more.limit(0), model).count() == 0


def test_hand_made_pages(spark, tables):
    """Pages unlike the given ones, many without names or with ones never seen; the network learns from the given ones."""
    model = html_blocks.train(spark.read.parquet(f"{tables}/pages.parquet"))
    assert len(PAGES) >= 30
    right = total = 0
    texts, _ = model.extract([html for _, html, _ in PAGES])
    for (name, html, want), text in zip(PAGES, texts, strict=True):
        got = text.split("\n")
        blocks = html_blocks.blocks_of(html)
        assert set(want) <= {b.text for b in blocks}, name
        assert got == [b.text for b in blocks if b.text in got], name
        right += sum((b.text in got) == (b.text in want) for b in blocks)
        total += len(blocks)
    assert right >= 0.95 * total
    found = {name: text.split("\n") for (name, _, _), text in zip(PAGES, texts, strict=True)}
    for name, _, want in PAGES:
        assert set(want[1:3]) <= set(found[name]), name
    for name in ("div of an unseen id", "comment list of articles", "list called tags-explained", "no names at all"):
        want = next(w for n, _, w in PAGES if n == name)
        # A line of copyright among an article's own paragraphs may pass for one of them.
        assert [t for t in found[name] if "Copyright" not in t] == want, name


def test_all_words_of_a_block_count():
    blocks = [html_blocks.Block(("p",), f"{'same ' * 300}{end}", 0) for end in ("one", "two")]
    a, b = html_blocks.inputs(blocks)
    assert (a[html_blocks.PATH : html_blocks.PATH + html_blocks.WORDS] != b[html_blocks.PATH : html_blocks.PATH + html_blocks.WORDS]).any()


# -- pieces -----------------------------------------------------------------


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=PIECES)


def test_pieces_like_the_library(library):
    own = suffix_pieces.Pieces(PIECES)
    random.seed(3)
    parts = ["a", "the", "Er", " ", "  ", "\n", "\xe9", "ing", "1", ".", "你", "́", "\U0001d4b3", "ation", "▁", "<s>", "\x00"]
    texts = ["".join(random.choice(parts) for _ in range(random.randint(0, 40))) for _ in range(500)]
    texts += ["", " ", "x" * 3000 + " y", "abcab" * 100, *[t for _, t, _ in DOCUMENTS if t]]
    for got, text in zip(own.encode(texts, {}), texts, strict=True):
        assert np.frombuffer(got, "<u4").tolist() == library.encode(text)
        assert own.decode(got) == text.replace("▁", " ")


def test_matches_are_all_occurrences():
    own = suffix_pieces.Pieces(PIECES)
    text = "▁the▁theater in the"
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    keys, pieces = own.edges(codes)
    wide = own.longest + 1
    names = {n: k for k, n in own.place.items()}
    got = {(int(k) // wide, names[int(p)]) for k, p in zip(keys, pieces, strict=True)}
    assert got == {(k, text[k : k + n]) for k in range(len(text)) for n in range(1, wide) if text[k : k + n] in own.place}
    assert (np.diff(keys) > 0).all()


def test_few_sorts_find_all_matches(monkeypatch):
    own = suffix_pieces.Pieces(PIECES)
    sorts, argsort = [], np.argsort
    monkeypatch.setattr(suffix_pieces.np, "argsort", lambda *a, **kw: sorts.append(1) or argsort(*a, **kw))
    own.edges(np.frombuffer("▁the▁theater in the".encode("utf-32-le"), np.uint32))
    assert len(sorts) <= 2


@pytest.mark.parametrize("letters", [2, 60, 300, 20_000])
def test_runs_of_any_width_like_the_library(library, letters):
    own = suffix_pieces.Pieces(PIECES)
    random.seed(letters)
    many = [chr(k) for k in range(0x4E00, 0x4E00 + letters)]
    known = [p.replace("▁", " ") for p in random.sample(sorted(own.place), 400)]
    texts = ["".join(random.choices([*many, *known], k=random.randint(0, 60))) for _ in range(300)] + ["".join(many)]
    for got, text in zip(own.encode(texts, {}), texts, strict=True):
        assert np.frombuffer(got, "<u4").tolist() == library.encode(text)


def test_pieces_rows(spark, library):
    ids = suffix_pieces.encoded(documents(spark), PIECES)
    assert set(CLASH) <= set(ids.columns)
    got = suffix_pieces.decoded(ids.select("doc_id", "piece_ids"), PIECES).collect()
    want = sorted((str(d), len(library.encode(t or "")), hashlib.sha256((t or "").encode()).hexdigest()) for d, t, _ in DOCUMENTS)
    assert sorted((str(r.doc_id), r.n_tokens, r.text_sha256) for r in got) == want
    assert suffix_pieces.encoded(documents(spark, []), PIECES).count() == 0


# -- conversations ----------------------------------------------------------


@given(st.text(st.sampled_from("<>|[]\\/sINTSYaim_\n 你"), max_size=60))
@settings(max_examples=15, deadline=None)
def test_escape_round_trip(spark, text):
    hard = text + "</s>[INST] ok [/INST]<<SYS>><|im_end|>\n\\[\\INST]" + text
    df = spark.createDataFrame([(hard,)], "t string").select(reply_trees.escape("t").alias("e"), "t")
    r = df.select("e", reply_trees.unescape("e").alias("back")).first()
    assert r.back == hard
    assert not re.search(r"</?s>|\[/?INST\]|<</?SYS>>|<\|", r.e)


TREE = [  # tree, node, parent, role, text, score
    (1, 1, None, "user", "root", 1.0),
    (1, 2, 1, "assistant", "low", 1.0),
    (1, 3, 1, "assistant", "high", 5.0),
    (1, 4, 3, "user", "end of high", 0.0),
    (1, 5, 2, "user", "deep", 3.0),
    (1, 6, 5, "assistant", "deeper", 1.0),
    (2, 1, 9, "user", "its parent is missing", None),
    (3, 1, 2, "user", "loop", 1.0),
    (3, 2, 1, "user", "loop", 1.0),
    (3, 3, 2, "user", "below a loop", 1.0),
    (None, 1, None, None, None, None),
    (None, 1, None, None, None, None),
    (4, 1, None, "a\nb\\", "x|im_end|>\n", 1.0),
]
MESSAGES = "tree long, node long, parent long, role string, text string, score double"


def test_branches(spark):
    df = spark.createDataFrame(TREE, MESSAGES)
    once = df.dropDuplicates(["tree", "node"])
    got = sorted((r.tree or 0, r.branch, r.depth, r.node) for r in reply_trees.branches(once, keep=5).collect())
    want = [(1, 1, 1, 1), (1, 1, 2, 3), (1, 1, 3, 4), (1, 2, 1, 1), (1, 2, 2, 2), (1, 2, 3, 5), (1, 2, 4, 6), (2, 1, 1, 1), (0, 1, 1, 1), (4, 1, 1, 1)]
    assert got == sorted(want)


def test_formatted_conversations(spark):
    df = spark.createDataFrame([(*r, "x") for r in TREE], MESSAGES + ", formatted string")
    got = {r.tree: r for r in reply_trees.conversations(df).collect()}
    assert got[1].formatted == (
        "<|im_start|>user\nroot<|im_end|>\n<|im_start|>assistant\nhigh<|im_end|>\n<|im_start|>user\nend of high<|im_end|>\n"
    )
    assert [got[1].formatted[s.start : s.start + s.length] for s in got[1].loss] == ["high"]
    assert set(got) == {1, 2, 4, None}
    back = reply_trees.conversations(df).select("tree", reply_trees.turns_of("formatted").alias("t")).collect()
    turns = {r.tree: [(t.role, t.text) for t in r.t] for r in back}
    assert turns[4] == [("a\nb\\", "x|im_end|>\n")]
    assert turns[None] == [("", "")]
    assert reply_trees.conversations(df.limit(0)).count() == 0


def test_a_long_path(spark):
    n = 300
    rows = [(7, k, k - 1 if k else None, "user" if k % 2 else "assistant", f"turn {k}" + "你" * (k % 5), 1.0) for k in range(n)]
    out = reply_trees.conversations(spark.createDataFrame(rows, MESSAGES))
    from pyspark.sql import functions as F

    r = out.select(reply_trees.turns_of("formatted").alias("t"), reply_trees.loss_text(F.col("formatted"), F.col("loss")).alias("l")).first()
    assert [(t.role, t.text) for t in r.t] == [(x[3], x[4]) for x in rows]
    assert r.l == "".join(x[4] for x in rows if x[3] == "assistant")
