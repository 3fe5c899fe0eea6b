"""Ranked lexical search by pipelined term owners.

Documents lie in blocks of neighbouring rows; a block's index lists, for each
term that an item asks for, the block's documents with it.  Terms are dealt to
owners, rare ones to the first, so that each owner has about as many postings.
An item's bundle carries sparse accumulators, one for each document that has got
a score; it visits one owner after the other, by a cogroup with the postings that
owner has of the same block, and each adds its terms' integer contributions.  A
block has all its documents' scores after the last owner and hands on its best;
the best of all blocks are ranked.

A frequent term's postings are spread over all blocks, so no task holds a term.
An accumulator is left out only where all that its later owners could add, a
million times the weight for each term, leaves it below the k-th of its own block
as that is already: such a document cannot be among the k best.

Items come in passes of a bounded number of (item, term) pairs, whose vocabulary
goes to all tasks; an item with more of them than that is a pass of its own.

Cases: a null text has no terms; documents without an id count and rank like
others, after those with one among equal scores; rows that share a doc_id are
documents of their own; rows of one item are one item with the terms of all its
rows; items without an id or a term get no rows; empty tables give none; columns
beside the named ones are not read.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import reduce
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from nodepulse.llm.common import kept, slices

#: Owners, documents in a block at most, cells (documents x items) of a block aimed at, (item, term) pairs of a pass.
OWNERS, ROWS, CELLS, PAIRS = 4, 2048, 1 << 22, 1 << 19
#: No contribution of a term to a document reaches this many times the term's weight.
PEAK = 1_000_000

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Bytes of UTF-8: small letters, digits and all beyond ASCII stay, capitals become small, the rest a space.
_TABLE = bytes(b if b > 127 or chr(b).isalnum() else 32 for b in range(256)).lower()


def terms_of(text: str | None) -> list[bytes]:
    """The terms of a text in their order, as UTF-8."""
    return (text or "").encode("utf-8", "replace").translate(_TABLE).split()


def _asked(items: DataFrame, item_col: str, text_col: str) -> DataFrame:
    """(item, term, times) of all items with an id."""
    lower = F.translate(F.col(text_col), _UPPER, _UPPER.lower())
    rows = items.where(F.col(item_col).isNotNull()).select(
        F.col(item_col).alias("item"), F.explode(F.regexp_extract_all(lower, F.lit(f"({_TERM})"), F.lit(1))).alias("term")
    )
    return rows.groupBy("item", "term").agg(F.count("*").alias("times"))


def _passes(asked: DataFrame) -> list[DataFrame]:
    """``asked`` in parts of whole items, each of about PAIRS rows at most, or of one larger item."""
    n, largest = asked.groupBy("item").agg(F.count("*").alias("n")).agg(F.sum("n"), F.max("n")).first()
    if not n:
        return []
    parts = -(-n // PAIRS)
    while True:
        part = F.pmod(F.xxhash64("item"), F.lit(parts))
        if parts == 1 or asked.groupBy(part.alias("part")).count().agg(F.max("count")).first()[0] <= 2 * max(PAIRS, largest):
            return [asked.where(part == k) for k in range(parts)]
        parts *= 2


def _lists(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """Little-endian bytes of ``values`` from each bound to the next."""
    data = np.ascontiguousarray(values)
    offsets = (bounds * data.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def _block(number: int, ids: list, sizes: list[int], found: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    """Rows of the index of a block: the first, of term -1, has the ids, the others a term each."""
    size = np.array(sizes, np.int64)
    doc = np.repeat(np.arange(len(ids), dtype=np.int32), [len(t) for t, _ in found])
    term = np.concatenate([np.zeros(0, np.int32), *[t for t, _ in found]])
    tf = np.concatenate([np.zeros(0, np.int64), *[f for _, f in found]])
    order = np.argsort(term, kind="stable")
    doc, term, tf = doc[order], term[order], tf[order]
    first = np.flatnonzero(np.r_[True, term[1:] != term[:-1]]) if len(term) else np.zeros(0, np.int64)
    bounds = np.r_[first, len(term)]
    known = np.array([i is not None for i in ids], np.uint8)
    head = pa.array([np.array([i or 0 for i in ids], np.int64).tobytes()], pa.binary())
    columns = [
        pa.array(np.full(len(first) + 1, number)),
        pa.array(np.r_[-1, term[first]], pa.int32()),
        pa.concat_arrays([head, _lists(doc, bounds)]),
        pa.concat_arrays([pa.array([known.tobytes()], pa.binary()), _lists(tf.astype(np.int32), bounds)]),
        pa.concat_arrays([pa.array([b""], pa.binary()), _lists(size[doc].astype(np.int32), bounds)]),
        pa.array(np.r_[(size > 0).sum(), np.diff(bounds)], pa.int64()),
        pa.array(np.r_[size.sum(), np.zeros(len(first), np.int64)], pa.int64()),
    ]
    return pa.RecordBatch.from_arrays(columns, names=["block", "term", "docs", "tf", "size", "n", "terms"])


def _index(docs: DataFrame, vocabulary: dict[bytes, int], rows: int) -> DataFrame:
    """Index of all documents for the terms of ``vocabulary``, in blocks of ``rows`` documents."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)  # bounded by a pass

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = shared.value.get
        block = TaskContext.get().partitionId() << 32
        ids, sizes, found = [], [], []
        for batch in batches:
            for part in slices(batch, 1):
                for i, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    words = terms_of(text)
                    at = np.fromiter(map(number, words, repeat(-1)), np.int32, len(words))
                    ids.append(i)
                    sizes.append(len(words))
                    found.append(np.unique(at[at >= 0], return_counts=True))
                    if len(ids) == rows:
                        yield _block(block, ids, sizes, found)
                        block, ids, sizes, found = block + 1, [], [], []
        if ids:
            yield _block(block, ids, sizes, found)

    return docs.mapInArrow(tasks, "block long, term int, docs binary, tf binary, size binary, n long, terms long")


class _Plan:
    """What the owners of a pass know: all of it grows with the pass only."""

    def __init__(self, items: list, wanted: list[list[tuple[int, int]]], df: dict[int, int], n: int, length: int):
        self.items, self.n, self.length = items, n, length
        self.weight = {t: math.floor(1000 * math.log((2 * n + 2) / (2 * d + 1))) for t, d in df.items()}
        self.owner, seen, total = {}, 0, sum(df.values())
        for t in sorted(df, key=lambda t: (df[t], t)):
            self.owner[t] = min(OWNERS - 1, OWNERS * seen // total)
            seen += df[t]
        self.wanted = [[[] for _ in items] for _ in range(OWNERS)]
        self.rest = np.zeros((OWNERS, len(items)))  # floats: a bound, rounded up below
        for k, terms in enumerate(wanted):
            for t, times in terms:
                if t in df and self.weight[t] > 0:
                    self.wanted[self.owner[t]][k].append((t, times * self.weight[t]))
                    self.rest[: self.owner[t], k] += times * self.weight[t] * PEAK
        self.rest *= 1 + 1e-9


def _many(raw: pd.Series, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """All values of the byte strings, and where each string's begin and the last's end."""
    sizes = np.fromiter(map(len, raw), np.int64, len(raw)) // np.dtype(kind).itemsize
    return np.frombuffer(b"".join(raw), kind), np.r_[0, np.cumsum(sizes)]


def _visit(plan: _Plan, owner: int, k: int, bundles: pd.DataFrame, index: pd.DataFrame):
    """Documents and scores of each item in one block after ``owner`` has added its terms: (item, docs, scores) in turn."""
    index = index[index["term"] >= 0]
    docs, bounds = _many(index["docs"], np.int32)
    tf, size = (_many(index[c], np.int32)[0].astype(np.int64) for c in ("tf", "size"))
    length = 100 - 25 + (25 * size * plan.n) // max(1, plan.length)
    part = (1_000_000_000 * tf) // (1000 * tf + 12 * length)
    place = {t: (bounds[i], bounds[i + 1]) for i, t in enumerate(index["term"].tolist())}
    carried = {i: (d, s) for i, d, s in zip(bundles["item"], bundles["docs"], bundles["scores"], strict=True)}
    for i, wanted in enumerate(plan.wanted[owner]):
        here = [(place[t], w) for t, w in wanted if t in place]
        if not here and i not in carried:
            continue
        score = np.zeros(ROWS, np.int64)
        if i in carried:
            score[np.frombuffer(carried[i][0], np.int32)] = np.frombuffer(carried[i][1], np.int64)
        for (a, b), w in here:
            score[docs[a:b]] += w * part[a:b]
        at = np.flatnonzero(score)
        got = score[at]
        if len(at) > k:
            stays = got + plan.rest[owner, i] >= np.partition(got, -k)[-k]
            at, got = at[stays], got[stays]
        yield i, at, got


def _pass(docs: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """(item, doc_id, score) with the k best of each block for each item of one pass."""
    spark = docs.sparkSession
    rows = asked.collect()  # bounded by a pass
    items = sorted({r["item"] for r in rows})
    terms = sorted({r["term"] for r in rows})
    item_no, term_no = {x: n for n, x in enumerate(items)}, {x: n for n, x in enumerate(terms)}
    wanted: list[list[tuple[int, int]]] = [[] for _ in items]
    for r in rows:
        wanted[item_no[r["item"]]].append((term_no[r["term"]], r["times"]))
    index = kept(_index(docs, {t.encode(): n for t, n in term_no.items()}, max(16, min(ROWS, CELLS // len(items)))), "index")
    counts = {r["term"]: r for r in index.groupBy("term").agg(F.sum("n").alias("n"), F.sum("terms").alias("terms")).collect()}
    whole = counts.pop(-1, {"n": 0, "terms": 0})
    plan = _Plan(items, wanted, {t: r["n"] for t, r in counts.items()}, whole["n"], whole["terms"])
    shared = spark.sparkContext.broadcast(plan)

    def add(owner: int) -> Callable:
        def visit(bundles: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
            block = (bundles if len(bundles) else own)["block"].iloc[0]
            out = [(block, i, at.astype(np.int32).tobytes(), got.tobytes()) for i, at, got in _visit(shared.value, owner, k, bundles, own)]
            return pd.DataFrame(out, columns=["block", "item", "docs", "scores"])

        return visit

    def best(bundles: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
        head = own[own["term"] < 0]
        ids = np.frombuffer(head["docs"].iloc[0], np.int64)
        unknown = np.frombuffer(head["tf"].iloc[0], np.uint8) == 0
        out: dict[str, list] = {"item": [], "doc_id": [], "score": []}
        for i, at, got in _visit(shared.value, OWNERS - 1, k, bundles, own):
            order = np.lexsort((ids[at], unknown[at], -got))[:k]
            out["item"] += [shared.value.items[i]] * len(order)
            out["doc_id"] += [None if unknown[x] else int(ids[x]) for x in at[order]]
            out["score"] += got[order].tolist()
        return pd.DataFrame(out).astype({"doc_id": "Int64"})

    of = spark.createDataFrame([(t, o) for t, o in plan.owner.items()], "term int, owner int")  # bounded by a pass
    owned = index.join(F.broadcast(of), "term", "left").drop("n", "terms")
    bundles = spark.createDataFrame([], "block long, item int, docs binary, scores binary")
    for owner in range(OWNERS - 1):
        own = owned.where(F.col("owner") == owner).drop("owner")
        bundles = bundles.groupBy("block").cogroup(own.groupBy("block")).applyInPandas(add(owner), bundles.schema)
    last = owned.where((F.col("owner") == OWNERS - 1) | (F.col("term") < 0)).drop("owner")
    kind = asked.schema["item"].dataType.simpleString()
    return bundles.groupBy("block").cogroup(last.groupBy("block")).applyInPandas(best, f"item {kind}, doc_id long, score long")


def ranked(
    docs: DataFrame, items: DataFrame, k: int = 20, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """(item_id, rank, doc_id, score): each item's ``k`` documents of the highest scores above 0; see the module's text."""
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    asked = kept(_asked(items, item_col, item_text), "asked")
    parts = [_pass(texts, part, k) for part in _passes(asked)]
    if not parts:
        kind = asked.schema["item"].dataType.simpleString()
        return docs.sparkSession.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    found = reduce(DataFrame.unionByName, parts)
    place = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))
    return found.withColumn("rank", place).where(F.col("rank") <= k).select(F.col("item").alias("item_id"), "rank", "doc_id", "score")
