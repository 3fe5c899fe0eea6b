"""Packing and bit-packed files against plain encoding."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from cases import DOCUMENTS, documents
from hypothesis import given, settings
from hypothesis import strategies as st

from nodepulse.llm import bitpack, byte_bpe, packing
from nodepulse.llm.byte_bpe import ByteBpe, load
from nodepulse.llm.common import vocabulary
from nodepulse.session import scratch_path

PATH = vocabulary("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return load(PATH)


def plain(tokenizer, text):
    return np.array(tokenizer.encode(text or "", add_special_tokens=False).ids, "<u4")


@given(st.lists(st.text(st.sampled_from("aB é1.'s\n\t 　\x1c\x85你<|>"), max_size=20), max_size=6))
@settings(max_examples=150, deadline=None)
def test_chunks_encode_like_the_whole_text(texts):
    texts = [*texts, "a <|endoftext|> b", "it's  we'll\n \n x"]
    tokenizer, encoder = load(PATH), ByteBpe(PATH)
    assert encoder.encode(texts) == [plain(tokenizer, t).tobytes() for t in texts]


@given(st.integers(1, 32), st.integers(0, 9000), st.integers(0, 2**32 - 1))
@settings(max_examples=60, deadline=None)
def test_bits_round_trip(bits, count, seed):
    ids = np.random.default_rng(seed).integers(0, 1 << bits, count).astype(np.uint32)
    raw = bitpack.pack_bits(ids, bits)
    assert len(raw) == -(-count * bits // 64) * 8
    assert (bitpack.unpack_bits(raw, count, bits) == ids).all()


def test_too_wide_an_id_is_refused():
    with pytest.raises(ValueError, match="more than 3 bits"):
        bitpack.pack_bits(np.array([8], np.uint32), 3)


@pytest.mark.parametrize("bits", [7, 15, 16, 17])
def test_random_access(tmp_path, bits):
    rng = np.random.default_rng(1)
    docs = [rng.integers(0, 1 << bits, n).astype(np.uint32) for n in (0, 1, 5000, 3, 12000)]
    writer = bitpack.TokenWriter(str(tmp_path / "a.tok"), bits)
    writer.add([4, None, 6], docs[:3])
    writer.add([7, 8], docs[3:])
    writer.close()
    reader = bitpack.TokenReader(str(tmp_path / "a.tok"))
    assert [d if k else None for d, k in zip(reader.docs.tolist(), reader.known, strict=True)] == [4, None, 6, 7, 8]
    for k, want in enumerate(docs):
        assert (reader.document(k) == want).all()
    whole = np.concatenate(docs)
    for a, b in ((0, 0), (4095, 4097), (17, 16000), (0, len(whole))):
        assert (reader.ids(a, b) == whole[a:b]).all()


def test_token_files(spark, tokenizer):
    manifest = bitpack.write_token_files(documents(spark), scratch_path(spark, "t"), PATH, end_id=0)
    got = bitpack.read_token_files(spark, manifest).collect()
    want = Counter()
    for d, text, _ in DOCUMENTS:
        ids = np.r_[plain(tokenizer, text), 0].astype("<u4")
        want[(d, len(ids), zlib.crc32(ids.tobytes()))] += 1
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == want
    in_order = sorted(got, key=lambda r: r.start)
    assert [r.start for r in in_order] == np.cumsum([0, *[r.n_tokens for r in in_order]])[:-1].tolist()
    ids = [r.doc_id for r in in_order]
    assert ids == sorted(ids, key=lambda k: (k is not None, k or 0))


def test_token_files_of_no_documents(spark):
    manifest = bitpack.write_token_files(documents(spark, []), scratch_path(spark, "t"), PATH)
    assert bitpack.read_token_files(spark, manifest).count() == 0


def pieces_are_whole(rows, size):
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for doc, start, length, seq, offset, cap in rows:
        by_doc[doc].append((start, length))
        by_seq[seq].append((offset, length, cap))
    for parts in by_doc.values():
        at = 0
        for start, length in sorted(parts):
            assert start == at and length > 0
            at += length
    for parts in by_seq.values():
        at = 0
        for offset, length, _ in sorted(parts):
            assert offset == at
            at += length
        assert at == parts[0][2] <= size
        assert at == size or at & (at - 1) == 0
    return {d: sum(n for _, n in p) for d, p in by_doc.items()}


@given(st.lists(st.integers(0, 300), max_size=60), st.sampled_from([1, 7, 64]))
@settings(max_examples=100, deadline=None)
def test_packing_places_each_id_once(lengths, size):
    got = pieces_are_whole(packing.pack(lengths, size), size)
    assert got == {k: n for k, n in enumerate(lengths) if n}


def test_packing_balances_cost():
    lengths = [1000] * 8 + [10] * 600
    rows = packing.pack(lengths, 2000)
    cost = Counter()
    for _, _, n, seq, _, cap in rows:
        if cap == 2000:
            cost[seq] += n + n * n / 2048
    assert max(cost.values()) < 1.6 * min(cost.values())


def test_packed_documents(spark, tokenizer):
    got = packing.packed_documents(documents(spark), PATH, end_id=1, size=64, group_tokens=5000).collect()
    ids = {d: np.r_[plain(tokenizer, t), 1].astype("<u4") for d, t, _ in DOCUMENTS}
    for r in got:
        own = ids[r.doc_id]
        assert r.doc_tokens == len(own)
        assert r.ids_crc32 == zlib.crc32(own[r.start : r.start + r.length].tobytes())
    assert sum(r.length for r in got) == sum(len(ids[d]) for d, _, _ in DOCUMENTS)
    once = [r for r in got if r.doc_id != 5]  # a row that repeats is two documents of one id
    filled = defaultdict(int)
    for r in got:
        filled[(r.sequence_id, r.capacity)] += r.length
    assert all(n == cap for (_, cap), n in filled.items())
    assert {d: sum(r.length for r in once if r.doc_id == d) for d in {r.doc_id for r in once}} == {
        d: len(x) for d, x in ids.items() if d != 5
    }
    assert packing.packed_documents(documents(spark, []), PATH).count() == 0


class Counted(dict):
    """A dict that counts look-ups."""

    looked = 0

    def get(self, *a):
        Counted.looked += 1
        return super().get(*a)

    def __getitem__(self, key):
        Counted.looked += 1
        return super().__getitem__(key)

    def __contains__(self, key):
        Counted.looked += 1
        return super().__contains__(key)


def test_known_chunks_are_looked_up_once():
    path = vocabulary("byte_bpe_50k.json")
    encoder, plain = byte_bpe.ByteBpe(path), byte_bpe.load(path)
    encoder.known = Counted()
    words = [f"w{k}x{k * k}" + ("\n" * (k % 97 == 0)) + "é," * (k % 3) for k in range(1500)] + ["\nbegins", "\tso"]
    texts = ["First " + " ".join(words), "", " ".join(words[::-1]), "two  spaces \n here", "one"]
    want = [np.array(plain.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert encoder.encode(texts) == want
    Counted.looked = 0
    assert encoder.encode(texts) == want
    assert Counted.looked <= sum(len(byte_bpe.chunks_of(t)) for t in texts)


class Spy:
    def __init__(self, tokenizer):
        self.tokenizer, self.seen = tokenizer, []

    def encode_batch_fast(self, texts, **kw):
        self.seen += texts
        return self.tokenizer.encode_batch_fast(texts, **kw)


def test_a_word_is_learned_once_whatever_marks_end_it():
    library, encoder = byte_bpe.load(PATH), byte_bpe.ByteBpe(PATH)
    encoder.tokenizer, encoder.known = Spy(encoder.tokenizer), Counted()
    words = ["wörx,", "wörx", "wörx.", "wörx!?", "wörx&&&", "wörx's", "wörx',", "7,", "你,", ".", "x\n,"]
    texts = ["so " + " ".join(words * 5), "", "one " + " ".join(words[::-1])]
    Counted.looked = 0
    assert encoder.encode(texts) == [plain(library, t).tobytes() for t in texts]
    # Alone, with 's, and with an apostrophe among the marks.
    assert sum(t.count("wörx") for t in encoder.tokenizer.seen) == 3
    assert Counted.looked < sum(len(byte_bpe.chunks_of(t)) for t in texts)


def test_texts_are_encoded_in_parts(monkeypatch):
    library, encoder = byte_bpe.load(PATH), byte_bpe.ByteBpe(PATH)
    monkeypatch.setattr(byte_bpe, "CHARS_AT_ONCE", 20)
    texts = ["", "a word, and a word.", "x" * 50, "", "two  runs \n of spaces", "é" * 19, "b", "one two", ""]
    assert encoder.encode(texts) == [plain(library, t).tobytes() for t in texts]
    assert encoder.encode([]) == []
