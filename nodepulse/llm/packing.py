"""Cost-balanced packing of tokenised documents into sequences.

A document costs ``linear * n + quadratic * n * n`` (attention stays inside a
document).  Documents of a group are taken longest first, and each goes to the
open sequence that costs least so far.  What does not fit there is cut off and
queued again by its own length, so each cut fills a sequence.

Groups are runs of documents of one input partition of about ``group_tokens``
ids: nothing is shuffled, a task holds one group, and a lost task gives the same
rows again.  A group gets as many full sequences as its ids fill; the rest goes
to sequences whose lengths are the powers of two that sum up to it, which need
no padding.

Cases: a null or empty text is its end id alone; a null doc_id stays null;
repeated rows are documents of their own; an empty table gives no rows; columns
beside the two named ones are not read.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame

from nodepulse.llm.byte_bpe import TEXTS_AT_ONCE, ByteBpe

SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, capacity long"
)


def capacities(total: int, size: int) -> list[int]:
    """Lengths of the sequences for ``total`` ids: full ones, then powers of two."""
    rest = total % size
    return [size] * (total // size) + [1 << b for b in reversed(range(rest.bit_length())) if rest >> b & 1]


def pack(
    lengths: list[int], size: int, linear: float = 1.0, quadratic: float = 1 / 2048
) -> list[tuple[int, int, int, int, int, int]]:
    """(document, start, length, sequence, offset, capacity) of each piece, ids of a document in order."""

    def cost(n: int) -> float:
        return linear * n + quadratic * n * n

    room = capacities(sum(lengths), size)
    held = room[:]
    # A short sequence starts with the cost of what it lacks.
    open_ = [(cost(size - r), k) for k, r in enumerate(room)]
    heapq.heapify(open_)
    todo = [(-n, d, 0) for d, n in enumerate(lengths) if n]
    heapq.heapify(todo)
    pieces = []
    while todo:
        left, doc, start = heapq.heappop(todo)
        spent, seq = heapq.heappop(open_)
        take = min(-left, room[seq])
        pieces.append((doc, start, take, seq, held[seq] - room[seq], held[seq]))
        room[seq] -= take
        if room[seq]:
            heapq.heappush(open_, (spent + cost(take), seq))
        if take < -left:
            heapq.heappush(todo, (left + take, doc, start + take))
    return pieces


def packed_documents(
    docs: DataFrame,
    tokenizer_path: str,
    end_id: int = 1,
    size: int = 2048,
    group_tokens: int = 4_000_000,
    linear: float = 1.0,
    quadratic: float = 1 / 2048,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row for each piece of each document; see the module's text.

    ``start`` counts the document's ids before the piece, ``offset`` its place in
    the sequence, ``capacity`` is the sequence's length.  ``quadratic`` weighs
    the attention of a full sequence as much as its linear part by default.
    """

    def tasks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder, end = ByteBpe(tokenizer_path), end_id.to_bytes(4, "little")
        base, made = TaskContext.get().partitionId() << 32, 0
        ids: list[int] = []
        raw: list[bytes] = []
        waiting = 0

        def group() -> pd.DataFrame:
            nonlocal made
            rows = pack([len(r) // 4 for r in raw], size, linear, quadratic)
            out = pd.DataFrame(
                [
                    (ids[d], s, n, zlib.crc32(memoryview(raw[d])[4 * s : 4 * (s + n)]), len(raw[d]) // 4, base + made + q, at, cap)
                    for d, s, n, q, at, cap in rows
                ],
                columns=[c.split()[0] for c in SCHEMA.split(", ")],
            )
            made += 1 + max((r[3] for r in rows), default=-1)
            out["doc_id"] = out["doc_id"].astype("Int64")
            return out

        for batch in batches:
            texts = [t if isinstance(t, str) else "" for t in batch["text"]]
            keys = [None if pd.isna(k) else int(k) for k in batch["doc_id"]]
            for at in range(0, len(texts), TEXTS_AT_ONCE):
                some = slice(at, at + TEXTS_AT_ONCE)
                for key, got in zip(keys[some], encoder.encode(texts[some]), strict=True):
                    ids.append(key)
                    raw.append(got + end)
                    waiting += len(raw[-1]) // 4
                    if waiting >= group_tokens:
                        yield group()
                        ids, raw, waiting = [], [], 0
        if raw:
            yield group()

    return docs.selectExpr(f"cast(`{id_col}` as long) as doc_id", f"`{text_col}` as text").mapInPandas(tasks, SCHEMA)
