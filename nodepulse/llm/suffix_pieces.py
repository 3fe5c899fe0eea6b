"""SentencePiece encoding by suffix-array matching, and decoding.

The distinct units of a batch of texts (a run of spaces and what follows it up
to the next space; no piece of the vocabulary reaches further) are put together
to one text.  Its suffixes are sorted by as many characters as the longest piece
has, and every piece is looked up by binary search: its occurrences are a range.
Occurrences, sorted by position, are the edges that relaxation works on: each
unit begins as single characters, and time after time the edge of the best score
that spans exactly two neighbouring symbols replaces them, the leftmost of
equals, which is how a byte-pair model of this kind encodes.  Characters that no
piece covers become their UTF-8 bytes.

The vocabulary is read with the sentencepiece library; encoding and decoding are
done here, and tests hold them against it.

Cases: a null or empty text has no ids; U+2581 stands for a space and is read
back as one; text comes back exactly otherwise; repeated rows stay; an empty
table gives no rows; other columns pass through.
"""

from __future__ import annotations

import hashlib
import heapq
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from nodepulse.llm.byte_bpe import worker_store
from nodepulse.llm.common import with_text_columns

SPACE = "\u2581"
#: Units kept in memory; characters indexed at once; characters beyond which a unit is relaxed by itself; no edge.
KEPT_UNITS, AT_ONCE, LONG, NONE = 500_000, 300_000, 48, np.iinfo(np.int32).max
_UNIT = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")
_BREAK = np.uint32(0xFFFFFFFF)


class Pieces:
    """A vocabulary: pieces that match text, ids of bytes, and what each id stands for."""

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [sp.id_to_piece(k) for k in range(sp.get_piece_size())]
        plain = [k for k in range(len(names)) if not (sp.is_control(k) or sp.is_unknown(k) or sp.is_byte(k) or sp.is_unused(k))]
        if any(SPACE in names[k].lstrip(SPACE) for k in plain):
            raise ValueError("a piece reaches over a space: texts cannot be cut there")
        # The place of a piece in the order of scores decides between edges.
        plain.sort(key=lambda k: (-sp.get_score(k), k))
        self.ids = np.array(plain, np.uint32)
        self.place = {names[k]: n for n, k in enumerate(plain)}
        self.lengths = np.array([len(names[k]) for k in plain], np.int64)
        self.longest = int(self.lengths.max())
        self.codes = np.zeros((len(plain), self.longest), np.uint32)
        for n, k in enumerate(plain):
            self.codes[n, : len(names[k])] = np.frombuffer(names[k].encode("utf-32-le"), np.uint32)
        self.bytes = np.zeros(256, np.uint32)
        self.raw = [b""] * len(names)
        for k, name in enumerate(names):
            if sp.is_byte(k):
                self.bytes[int(name[1:-1], 16)] = k
                self.raw[k] = bytes([int(name[1:-1], 16)])
            elif not (sp.is_control(k) or sp.is_unknown(k)):
                self.raw[k] = name.replace(SPACE, " ").encode()

    # -- matching ---------------------------------------------------------

    def words(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, int, int]:
        """``codes`` as runs of characters in one 64-bit number for each position, smaller numbers before larger.

        Also the distinct characters, and the bits and the number of characters of a run.  Breaks and what lies past
        the end are the largest character.
        """
        alphabet, rank = np.unique(codes, return_inverse=True)
        top = len(alphabet)
        bits = (top + 1).bit_length()
        run = max(1, min(64 // bits, self.longest))
        padded = np.r_[rank.astype(np.uint64) + np.uint64(1), np.full(run, top + 1, np.uint64)]
        word = np.zeros(len(codes), np.uint64)
        for k in range(run):
            word = word << np.uint64(bits) | padded[k : k + len(codes)]
        return word, alphabet, bits, run

    def suffixes(self, word: np.ndarray, run: int) -> np.ndarray:
        """Positions sorted by the characters that a piece can have (prefix doubling from runs on)."""
        order, known = np.argsort(word), run
        key = word
        while known < self.longest:
            sorted_ = key[order]
            rank = np.empty(len(key), np.int64)
            rank[order] = np.cumsum(np.r_[True, sorted_[1:] != sorted_[:-1]][: len(key)])
            next_ = np.r_[rank[known:], np.full(min(known, len(rank)), len(rank) + 1)]  # past the end sorts last, as a break does
            key = rank * (len(rank) + 2) + next_
            order = np.argsort(key)
            known *= 2
        return order

    def ranges(self, word: np.ndarray, order: np.ndarray, alphabet: np.ndarray, bits: int, run: int) -> tuple[np.ndarray, np.ndarray]:
        """For each piece the range of sorted suffixes that begin with it, by binary search, a run of characters at a time."""
        low, high = np.zeros(len(self.ids), np.int64), np.full(len(self.ids), len(order), np.int64)
        place = np.minimum(np.searchsorted(alphabet, self.codes), len(alphabet) - 1) if len(alphabet) else np.zeros(self.codes.shape, np.int64)
        within = np.arange(self.longest) < self.lengths[:, None]
        if len(alphabet):
            high[((alphabet[place] != self.codes) & within).any(1)] = 0  # a character that does not occur
        place = np.where(within, place + 1, 0).astype(np.uint64)
        ones = np.uint64((1 << bits) - 1)
        for first in range(0, self.longest, run):
            least, most = np.zeros(len(low), np.uint64), np.zeros(len(low), np.uint64)
            for k in range(first, first + run):
                inside = within[:, k] if k < self.longest else np.zeros(len(low), bool)
                c = place[:, k] if k < self.longest else np.uint64(0)
                least = least << np.uint64(bits) | np.where(inside, c, np.uint64(0))
                most = most << np.uint64(bits) | np.where(inside, c, ones)
            open_ = np.flatnonzero((low < high) & (self.lengths > first))
            if not first:
                sorted_ = word[order]
                low[open_] = np.searchsorted(sorted_, least[open_], "left")
                high[open_] = np.searchsorted(sorted_, most[open_], "right")
                continue
            # Within a range all runs before are equal, so it is sorted by this one.
            later = np.r_[word, np.full(first, np.iinfo(np.uint64).max)][first:]
            begin = self._first(later, order, low[open_], high[open_], least[open_], False)
            high[open_] = self._first(later, order, begin, high[open_], most[open_], True)
            low[open_] = begin
        return low, high

    def _first(self, word: np.ndarray, order: np.ndarray, low: np.ndarray, high: np.ndarray, want: np.ndarray, above: bool) -> np.ndarray:
        """First place of each range with a number of at least ``want``, or ``above`` it, for many ranges at once."""
        low, high = low.copy(), high.copy()
        while (open_ := np.flatnonzero(low < high)).size:
            mid = (low[open_] + high[open_]) // 2
            at = word[order[mid]]
            below = at <= want[open_] if above else at < want[open_]
            low[open_[below]] = mid[below] + 1
            high[open_[~below]] = mid[~below]
        return low

    def edges(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Occurrences sorted by position and length: keys, and the pieces' places in the order of scores."""
        word, alphabet, bits, run = self.words(codes)
        order = self.suffixes(word, run)
        low, high = self.ranges(word, order, alphabet, bits, run)
        count = high - low
        piece = np.repeat(np.arange(len(count)), count)
        at = order[np.repeat(low - (np.cumsum(count) - count), count) + np.arange(len(piece))]
        # Key and piece in one number: a sort moves them together.
        shift = len(count).bit_length()
        both = np.sort((at * (self.longest + 1) + self.lengths[piece]) << shift | piece)
        return both >> shift, (both & ((1 << shift) - 1)).astype(np.int32)

    # -- relaxing ---------------------------------------------------------

    def encode_units(self, units: list[str]) -> list[bytes]:
        """Ids of each unit, as unsigned 32-bit little-endian bytes."""
        if not units:
            return []
        sizes = np.fromiter(map(len, units), np.int64, len(units))
        text = np.frombuffer("".join(units).encode("utf-32-le", "surrogatepass"), np.uint32)
        first = np.cumsum(sizes + 1) - (sizes + 1)
        codes = np.full(int((sizes + 1).sum()), _BREAK)
        inside = np.repeat(first, sizes) + np.arange(len(text)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        codes[inside] = text
        keys, pieces = self.edges(codes)
        wide, longest = self.longest + 1, self.longest
        table = np.full(len(codes) * wide, NONE, np.int32)
        table[keys] = pieces

        def look(start: np.ndarray, length: np.ndarray) -> np.ndarray:
            return np.where(length < wide, table[start * wide + np.minimum(length, longest)], NONE)

        # Symbols of all units side by side; the last of a unit has no edge to the right.
        start, unit = inside, np.repeat(np.arange(len(units)), sizes)
        size = np.ones(len(start), np.int64)
        last = np.r_[unit[1:] != unit[:-1], True] if len(unit) else np.zeros(0, bool)
        long_ = sizes > LONG
        edge = np.where(last, NONE, look(start, np.r_[size[:-1] + size[1:], 1]))
        done_start, done_size = [], []
        for k in np.flatnonzero(long_):
            a, b = self._relax_one(int(first[k]), int(sizes[k]), look)
            done_start.append(a)
            done_size.append(b)
        live = ~long_[unit]
        start, unit, size, edge = start[live], unit[live], size[live], edge[live]
        while len(start):
            heads = np.flatnonzero(np.r_[True, unit[1:] != unit[:-1]])
            best = np.minimum.reduceat(edge, heads)
            count = np.diff(np.r_[heads, len(start)])
            going = np.repeat(best < NONE, count)
            if not going.all():
                done_start.append(start[~going])
                done_size.append(size[~going])
                start, unit, size, edge = start[going], unit[going], size[going], edge[going]
                continue
            is_best = np.flatnonzero(edge == np.repeat(best, count))
            left = is_best[np.r_[True, unit[is_best[1:]] != unit[is_best[:-1]]]]  # the leftmost of each unit
            size[left] += size[left + 1]
            keep = np.ones(len(start), bool)
            keep[left + 1] = False
            start, unit, size, edge = start[keep], unit[keep], size[keep], edge[keep]
            left = left - np.arange(len(left))  # one symbol went from each unit before
            for at in (left, left - 1):
                at = at[(at >= 0)]
                pair = at[at + 1 < len(start)]
                pair = pair[unit[pair] == unit[pair + 1]]
                edge[at] = np.where(unit[at] == unit[np.minimum(at + 1, len(unit) - 1)], edge[at], NONE)
                edge[pair] = look(start[pair], size[pair] + size[pair + 1])
                ends = at[at + 1 >= len(start)]
                edge[ends] = NONE
        start, size = np.concatenate(done_start), np.concatenate(done_size)
        by_place = np.argsort(start)
        start, size = start[by_place], size[by_place]
        piece = look(start, size)
        ids = np.where(piece < NONE, self.ids[np.minimum(piece, len(self.ids) - 1)], 0).astype("<u4")
        width = np.ones(len(ids), np.int64)
        for k in np.flatnonzero(piece == NONE):  # single characters without a piece
            width[k] = len(chr(codes[start[k]]).encode("utf-8", "replace"))
        out = np.repeat(ids, width)
        to = np.cumsum(width) - width
        for k in np.flatnonzero(piece == NONE):
            raw = chr(codes[start[k]]).encode("utf-8", "replace")
            out[to[k] : to[k] + width[k]] = self.bytes[list(raw)]
        cuts = np.r_[to, len(out)][np.searchsorted(start, np.r_[first, len(codes)])] * 4
        raw = out.tobytes()
        return [raw[a:b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]

    def _relax_one(self, first: int, size: int, look) -> tuple[np.ndarray, np.ndarray]:
        """Relax one long unit with a queue of edges."""
        after = list(range(1, size + 1))
        before = list(range(-1, size - 1))
        length = [1] * size
        starts = np.arange(first, first + size - 1)
        queue = [(int(e), k, k + 1, 2) for k, e in enumerate(look(starts, np.full(size - 1, 2))) if e < NONE]
        heapq.heapify(queue)

        def offer(a: int) -> None:
            b = after[a]
            if b < size:
                whole = length[a] + length[b]
                e = int(look(np.array([first + a]), np.array([whole]))[0])
                if e < NONE:
                    heapq.heappush(queue, (e, a, b, whole))

        while queue:
            _, a, b, whole = heapq.heappop(queue)
            if not length[a] or after[a] != b or b >= size or length[a] + length[b] != whole:
                continue
            length[a], length[b], after[a] = whole, 0, after[b]
            if after[b] < size:
                before[after[b]] = a
            offer(a)
            if before[a] >= 0:
                offer(before[a])
        at = np.flatnonzero(np.array(length))
        return first + at, np.array(length)[at]

    # -- texts ------------------------------------------------------------

    def units_of(self, text: str) -> list[str]:
        """Units of a text, each without the one space that stands before it."""
        if not text:
            return []
        if "  " in text or SPACE in text or text[0] == " " or text[-1] == " ":
            return [u[1:] for u in _UNIT.findall(SPACE + text.replace(" ", SPACE))]
        return text.split(" ")

    def encode(self, texts: list[str | None], known: dict[str, bytes]) -> list[bytes]:
        """Ids of each text; ``known`` keeps those of units."""
        parts = [self.units_of(t or "") for t in texts]
        if len(known) > KEPT_UNITS:
            known.clear()
        new = list({u for p in parts for u in p if u not in known})
        ends = np.cumsum([len(u) + 2 for u in new])
        cuts = [0, *np.flatnonzero(np.diff(ends // AT_ONCE)) + 1, len(new)]
        for a, b in zip(cuts, cuts[1:], strict=False):
            known.update(zip(new[a:b], self.encode_units([SPACE + u for u in new[a:b]]), strict=True))
        return [b"".join([known[u] for u in p]) for p in parts]

    def decode(self, ids: bytes) -> str:
        """The text of ids given as unsigned 32-bit little-endian bytes."""
        raw = self.raw
        return b"".join([raw[k] for k in np.frombuffer(ids, "<u4").tolist()]).decode("utf-8", "replace")[1:]


def pieces(path: str) -> tuple[Pieces, dict[str, bytes]]:
    """The vocabulary in ``path`` and the units known to this worker."""
    store = worker_store("pieces")
    if path not in store:
        store[path] = (Pieces(path), {})
    return store[path]


def encoded(docs: DataFrame, path: str, keep: bool = True) -> DataFrame:
    """``docs`` with piece_ids: the ids of the column ``text`` as unsigned 32-bit little-endian bytes."""

    def start():
        own, known = pieces(path)
        return lambda texts: [own.encode(texts, known)]

    return with_text_columns(docs, {"piece_ids": pa.binary()}, "piece_ids binary", start, keep=keep)


def decoded(ids: DataFrame, path: str) -> DataFrame:
    """``ids`` with the text of the column piece_ids in place of it, and n_tokens, ids_crc32, text_sha256, n_chars."""

    def start():
        own, _ = pieces(path)

        def work(rows: list[bytes | None]) -> list:
            rows = [r or b"" for r in rows]
            texts = [own.decode(r) for r in rows]
            shas = [hashlib.sha256(t.encode("utf-8", "replace")).hexdigest() for t in texts]
            return [texts, [len(r) // 4 for r in rows], [zlib.crc32(r) for r in rows], shas, [len(t) for t in texts]]

        return work

    made = {"text": pa.string(), "n_tokens": pa.int64(), "ids_crc32": pa.int64(), "text_sha256": pa.string(), "n_chars": pa.int64()}
    schema = "text string, n_tokens long, ids_crc32 long, text_sha256 string, n_chars long"
    return with_text_columns(ids, made, schema, start, "piece_ids", keep=False)
