"""Whole texts to ids of a byte-level BPE vocabulary, with the tokenizers library.

A text is cut before a space that follows a non-space; no token of a byte-level
BPE crosses such a place.  Arrow finds the distinct chunks of many texts, only
they are looked up in memory, and the library sees those that are not there; an
id sequence is the chunks' ids, gathered by numpy.
"""

from __future__ import annotations

import os
import re
import sys
import types

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Chunks kept in a worker's memory; when it is full it is emptied.
KEPT_CHUNKS = 600_000
#: New chunks encoded as one text; more make the library slower for each.
LEARNED_AT_ONCE = 64
#: Texts that operators hand over at once, and characters whose chunks are looked up together.
TEXTS_AT_ONCE, CHARS_AT_ONCE = 2048, 1 << 22

_SPACE_RUN = re.compile(r" (?<=\s\s)")
_CUT = re.compile(r"(?<=\S)(?= )")
#: Marks that no token shares with a letter before them (an apostrophe may, with letters behind it), and such letters.
_MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
_LETTERS = frozenset(c for c in map(chr, range(0x180)) if c.isalpha())


def worker_store(owner: str) -> dict:
    """A dict that outlives a task, as long as its Python worker does and no other owner asks for one."""
    module = sys.modules.setdefault("_nodepulse_llm_store", types.ModuleType("_nodepulse_llm_store"))
    if getattr(module, "owner", None) != owner:
        module.owner, module.kept = owner, {}
    return module.kept


def load(path: str):
    """The tokenizer in the file ``path``; special strings count as ordinary text."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    return tokenizer


def chunks_of(text: str) -> list[str]:
    """``text`` cut at spaces where no token crosses; joined by a space they give the text."""
    if _SPACE_RUN.search(text):
        first, *rest = _CUT.split(text)
        return [first, *[x[1:] for x in rest]]
    return text.split(" ")


class ByteBpe:
    """Encoder with a memory of chunks.

    New chunks are encoded as one long text, each with its leading space.  The
    ids of a chunk begin at an id whose token begins with a space; a chunk with
    another space inside (white-space runs) is encoded by itself.  A word with
    marks at its end is made of the ids of both, if the tokenizer cuts there, so
    that a word is learned once whatever marks it is met with.
    """

    def __init__(self, path: str):
        store = worker_store("byte pairs")
        if path not in store:
            tokenizer = load(path)
            opens = np.zeros(tokenizer.get_vocab_size(), bool)
            opens[[i for token, i in tokenizer.get_vocab().items() if token.startswith("\u0120")]] = True
            cut = tokenizer.pre_tokenizer.pre_tokenize_str
            cuts = tokenizer.normalizer is None and all([w for w, _ in cut(f" a{m}")] == ["\u0120a", m] for m in _MARKS)
            store[path] = (tokenizer, opens, {}, _MARKS if cuts else "")
        self.tokenizer, self.opens, self.known, self.marks = store[path]

    def _alone(self, texts: list[str]) -> list[bytes]:
        got = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(g.ids, "<u4").tobytes() for g in got]

    def _learn(self, chunks: list[str]) -> None:
        """Put the ids of the new ``chunks`` into memory."""
        marked = []
        for c in chunks:
            word = c.rstrip(self.marks)
            if len(word) < len(c) and word and word[-1] in _LETTERS:
                marked.append((c, word, c[len(word) :]))
        if marked:
            words = {word for _, word, _ in marked}.difference(self.known)
            self._learn_whole(list(words.union(chunks).difference([c for c, _, _ in marked])))
            tails = list({tail for _, _, tail in marked})
            ids = dict(zip(tails, self._alone(tails), strict=True))
            self.known.update((c, self.known[word] + ids[tail]) for c, word, tail in marked)
        else:
            self._learn_whole(chunks)

    def _learn_whole(self, chunks: list[str]) -> None:
        odd = [c for c in chunks if " " in c]
        self.known.update(zip(odd, self._alone([" " + c for c in odd]), strict=True))
        plain = [c for c in chunks if " " not in c]
        for at in range(0, len(plain), LEARNED_AT_ONCE):
            part = plain[at : at + LEARNED_AT_ONCE]
            ids = np.array(self.tokenizer.encode_batch_fast([" " + " ".join(part)], add_special_tokens=False)[0].ids, "<u4")
            starts = np.flatnonzero(self.opens[ids])
            if len(starts) != len(part):  # a chunk that begins with white space, say
                self.known.update(zip(part, self._alone([" " + c for c in part]), strict=True))
                continue
            raw, cuts = ids.tobytes(), [*(4 * starts).tolist(), 4 * len(ids)]
            self.known.update(zip(part, [raw[a:b] for a, b in zip(cuts, cuts[1:], strict=False)], strict=True))

    def _ids(self, chunks: list[str], used: np.ndarray) -> list[bytes]:
        """Ids of distinct ``chunks``; those not ``used`` have none."""
        if len(self.known) > KEPT_CHUNKS:
            self.known.clear()
        got = list(map(self.known.get, chunks))
        new = [k for k, ids in enumerate(got) if ids is None and used[k]]
        self._learn([chunks[k] for k in new])
        for k in new:
            got[k] = self.known[chunks[k]]
        return [ids or b"" for ids in got]

    def _encode(self, texts: list[str]) -> list[bytes]:
        if any(map(_SPACE_RUN.search, texts)):
            parts = pa.array([chunks_of(t) for t in texts], pa.large_list(pa.large_string()))
        else:
            parts = pc.split_pattern(pa.array(texts, pa.large_string()), " ").cast(pa.large_list(pa.large_string()))
        size = pc.list_value_length(parts).to_numpy()
        ends = np.cumsum(size)
        flat = parts.flatten()
        coded = flat.dictionary_encode()
        chunks, code = coded.dictionary.to_numpy(zero_copy_only=False).tolist(), coded.indices.to_numpy().astype(np.int64)
        # The first chunk of a text has no space before it, and is a row of its own.
        code[ends - size] = len(chunks) + np.arange(len(texts))
        used = np.bincount(code, minlength=len(chunks)) > 0
        rows = self._ids(chunks, used) + self._alone(flat.take(pa.array(ends - size)).to_numpy(zero_copy_only=False).tolist())
        width = np.fromiter(map(len, rows), np.int64, len(rows)) // 4
        first, ids = np.cumsum(width) - width, np.frombuffer(b"".join(rows), "<u4")
        count = width[code]
        after = np.cumsum(count)
        at = np.repeat(first[code] - (after - count), count)
        at += np.arange(len(at))
        raw, cuts = ids[at].tobytes(), [0, *(4 * after[ends - 1]).tolist()]
        return [raw[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as unsigned 32-bit little-endian bytes."""
        sizes = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)))
        cuts = [0, *(np.flatnonzero(np.diff(sizes // CHARS_AT_ONCE)) + 1).tolist(), len(texts)]
        return [ids for a, b in zip(cuts, cuts[1:], strict=False) if a < b for ids in self._encode(texts[a:b])]
