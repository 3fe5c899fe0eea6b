"""SimHash near-duplicates by a self-join of a binary trie.

A text is lower-cased in A-Z and cut into words at ASCII white space; each
window of four words is hashed (XXH64, seed 42), and a bit of the fingerprint is
1 if it is set in over half the hashes.  A text of fewer words is one window; a
text without words has fingerprint 0.

Distinct fingerprints are a binary trie.  Its nodes at a depth that follows
their number are dealt out as pairs whose prefixes differ in few enough bits;
each task walks a pair of subtries together, adds up differing bits and leaves a
pair of nodes once the budget is spent, or once all below both is in one group
already.  The budget grows from 1 to the limit, so that dense groups close early
and are never written out as pairs.  A task returns stars, whose components are
those of all links.

Cases: a null text is an empty one and links like any other; rows of equal
doc_id are separate rows with one id; a null doc_id has a component but cannot
name it; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nodepulse.llm.byte_bpe import worker_store
from nodepulse.llm.common import kept, slices
from nodepulse.llm.components import star_components

#: Node pairs handled at once, pairs of leaves compared directly, fingerprints in a node as aimed at.
AT_ONCE, SMALL, NODE = 1 << 16, 32, 50_000


def window_hashes(text: str, words: int) -> np.ndarray:
    """Hash of each window of ``words`` words of ``text``; none for a text without words."""
    parts = text.encode("utf-8", "replace").lower().split()
    if not parts:
        return np.zeros(0, "<u8")
    line = b" ".join(parts)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
    starts = np.r_[0, ends[:-1] + 1]
    last = ends[words - 1 :] if len(parts) >= words else ends[-1:]
    return np.array(
        [xxhash.xxh64_intdigest(line[a:b], 42) for a, b in zip(starts.tolist(), last.tolist(), strict=False)], "<u8"
    )


def fingerprint(text: str, words: int = 4) -> int:
    """Unsigned 64-bit fingerprint of ``text``."""
    hashes = window_hashes(text, words)
    if not len(hashes):
        return 0
    set_ = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        bits = np.unpackbits(hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        set_ += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * set_ > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp, said) of every row: fp as signed 64-bit integer, said a hash that tells texts of one id apart."""

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_store("fingerprints")  # frees what another operator has left
        for batch in batches:
            for part in slices(batch, 1):
                got = np.array([fingerprint(t or "") for t in part.column(1).to_pylist()], np.uint64)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(got.view(np.int64)), part.column(2)], names=["doc_id", "fp", "said"])

    rows = docs.selectExpr(f"cast(`{id_col}` as long) as doc_id", f"`{text_col}` as text", f"xxhash64(`{text_col}`) as said")
    return rows.mapInArrow(tasks, "doc_id long, fp long, said long")


class TrieJoin:
    """Groups of the sorted distinct values ``v`` that links of at most ``limit`` bits make."""

    def __init__(self, v: np.ndarray, limit: int):
        self.v, self.limit = v, limit
        self.ones: dict[int, np.ndarray] = {}
        self.label = np.arange(len(v))
        self._mark()

    def _mark(self) -> None:
        """Where the group changes along the sorted values: tells whether a node lies in one group."""
        self.change = np.r_[0, np.cumsum(self.label[1:] != self.label[:-1])]

    def _ones(self, level: int) -> np.ndarray:
        """Running count of values whose bit at ``level`` is 1."""
        if level not in self.ones:
            bit = (self.v >> np.uint64(63 - level)) & np.uint64(1)
            self.ones[level] = np.r_[0, np.cumsum(bit.astype(np.int32))].astype(np.int32)
        return self.ones[level]

    def _unite(self, i: np.ndarray, j: np.ndarray) -> None:
        label = self.label
        while True:
            a, b = label[i], label[j]
            if not (differ := a != b).any():
                break
            i, j, a, b = i[differ], j[differ], a[differ], b[differ]
            np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
            while (label[label] != label).any():
                label = label[label]
        self.label = label
        self._mark()

    def _open(self, pairs: tuple[np.ndarray, ...]) -> tuple[np.ndarray, ...]:
        """Pairs that may still join two groups."""
        al, ah, bl, bh, _ = pairs
        one = (self.change[al] == self.change[ah - 1]) & (self.change[bl] == self.change[bh - 1])
        keep = ~(one & (self.label[al] == self.label[bl]))
        return tuple(x[keep] for x in pairs)

    def _compare(self, pairs: tuple[np.ndarray, ...], budget: int) -> None:
        """Compare all leaves below small nodes."""
        al, ah, bl, bh, _ = pairs
        width = bh - bl
        size = (ah - al) * width
        which = np.repeat(np.arange(len(size)), size)
        within = np.arange(len(which)) - np.repeat(np.cumsum(size) - size, size)
        i, j = al[which] + within // width[which], bl[which] + within % width[which]
        near = np.bitwise_count(self.v[i] ^ self.v[j]) <= budget
        if near.any():
            self._unite(i[near], j[near])

    def walk(self, root: tuple[int, int, int, int, int], level: int) -> None:
        """Join the node pair ``root`` (two index ranges and their differing bits) at depth ``level``."""
        for budget in range(min(1, self.limit), self.limit + 1):
            stack = [(level, tuple(np.array([x]) for x in root))]
            while stack:
                at, pairs = stack.pop()
                if len(pairs[0]) > AT_ONCE:
                    stack.append((at, tuple(x[AT_ONCE:] for x in pairs)))
                    pairs = tuple(x[:AT_ONCE] for x in pairs)
                pairs = self._open(tuple(x[pairs[4] <= budget] for x in pairs))
                al, ah, bl, bh, d = pairs
                small = ((ah - al) * (bh - bl) <= SMALL) | (at == 64)
                if small.any():
                    self._compare(tuple(x[small] for x in pairs), budget)
                    al, ah, bl, bh, d = (x[~small] for x in pairs)
                if not len(al):
                    continue
                ones = self._ones(at)
                am, bm = ah - (ones[ah] - ones[al]), bh - (ones[bh] - ones[bl])
                other = (al != bl) | (ah != bh)  # a node with itself has one mixed pair, not two
                next_ = [
                    np.concatenate(x)
                    for x in zip(
                        (al, am, bl, bm, d),
                        (am, ah, bm, bh, d),
                        (al, am, bm, bh, d + 1),
                        tuple(x[other] for x in (am, ah, bl, bm, d + 1)),
                        strict=True,
                    )
                ]
                full = (next_[0] < next_[1]) & (next_[2] < next_[3]) & (next_[4] <= budget)
                stack.append((at + 1, tuple(x[full] for x in next_)))


def join_stars(low: np.ndarray, high: np.ndarray | None, depth: int, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Stars (value, smallest value of its group) of the links between two nodes, or within one."""
    v = low if high is None else np.concatenate([low, high])
    trie = TrieJoin(v, limit)
    if high is None:
        trie.walk((0, len(v), 0, len(v), 0), depth)
    else:
        apart = int(np.bitwise_count((low[0] ^ high[0]) >> np.uint64(64 - depth)))
        trie.walk((0, len(low), len(low), len(v), apart), depth)
    out = np.flatnonzero(trie.label != np.arange(len(v)))
    return v[out], v[trie.label[out]]


def near_links(prints: DataFrame, limit: int = 4) -> DataFrame:
    """Links (a, b) between distinct values of ``fp`` with the components of all pairs within ``limit`` bits."""
    distinct = kept(prints.select("fp").distinct(), "fingerprints")
    depth = min(16, max(5, int(np.ceil(np.log2(max(1, distinct.count()) / NODE)))))
    masks = f"explode(filter(sequence(0L, {(1 << depth) - 1}L), m -> bit_count(m) <= {limit}))"

    def node(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        values = np.sort(rows["fp"].to_numpy(np.int64).view(np.uint64))
        return pd.DataFrame({"node": [key[0]], "raw": [values.tobytes()]})

    def join(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("node")
        parts = [np.frombuffer(r, np.uint64) for r in rows["raw"]]
        a = b = np.zeros(0, np.uint64)
        if rows["low"].iloc[0] == rows["high"].iloc[0]:
            a, b = join_stars(parts[0], None, depth, limit)
        elif len(parts) == 2:
            a, b = join_stars(parts[0], parts[1], depth, limit)
        return pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})

    nodes = (
        distinct.withColumn("node", F.shiftrightunsigned("fp", 64 - depth))
        .groupBy("node")
        .applyInPandas(node, "node long, raw binary")
    )
    pairs = nodes.withColumn("mask", F.expr(masks)).selectExpr(
        "node", "raw", "least(node, node ^ mask) as low", "greatest(node, node ^ mask) as high"
    )
    # A pair of nodes is few bytes and much work: their number, not their size, deals them out.
    parts = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return pairs.repartition(parts, "low", "high").groupBy("low", "high").applyInPandas(join, "a long, b long")


def _classes(prints: DataFrame, limit: int) -> DataFrame:
    """(fp, root, first) of every fingerprint: root names its group, first is the smallest doc_id with that fingerprint."""
    roots = star_components(near_links(prints, limit))
    first = prints.groupBy("fp").agg(F.min("doc_id").alias("first"))
    member = first.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    return kept(member, "members")


def near_components(docs: DataFrame, limit: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp, component_id) of every row; see the module's text.

    A group of equal texts is one fingerprint in all steps but the last, a join
    on it that adaptive execution splits where one fingerprint is frequent.
    """
    prints = kept(fingerprints(docs, id_col, text_col), "simhash")
    member = _classes(prints, limit)
    named = member.groupBy("root").agg(F.min("first").alias("component_id"))
    classes = member.join(named, "root").select("fp", "component_id")
    return prints.join(classes, "fp").select("doc_id", "fp", "component_id")


def representatives(docs: DataFrame, limit: int = 4) -> DataFrame:
    """One row of ``docs`` (all its columns) of each group, that of the smallest doc_id.

    Of several texts with that id the one of the smaller hash stays, of several
    such rows any one.  Rows without an id come after all others of their group,
    so one stays only where the group has no id at all.
    """
    plain = docs.toDF(*[c if c in ("doc_id", "text") else f"c{k}" for k, c in enumerate(docs.columns)])
    plain = plain.withColumn("key", F.col("doc_id").cast("long")).withColumn("said", F.xxhash64("text"))
    prints = kept(fingerprints(plain), "simhash")
    rooted = prints.join(_classes(prints, limit).select("fp", "root"), "fp")
    best = rooted.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "said")).alias("best"))
    best = best.select(F.col("best.doc_id").alias("best_id"), F.col("best.said").alias("best_said"))
    # Rows alike in both are one before any of them meet.
    rows = plain.dropDuplicates(["key", "said"])
    left = rows.join(best, F.col("key").eqNullSafe(F.col("best_id")) & (F.col("said") == F.col("best_said")), "left_semi")
    return left.drop("key", "said").toDF(*docs.columns)
