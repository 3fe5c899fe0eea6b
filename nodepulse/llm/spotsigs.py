"""SpotSigs: fingerprints from the content words that follow common words.

Each common word (an anchor) in a text starts a signature: the anchor and the
chain of content words after it, hashed to 32 bits.  Where ``GAP`` words have
passed without an anchor, each further word is taken for one; in a text of under
``SHORT`` words each word starts a chain as well, and in one of under ``TINY``
words each run of three characters is a signature.  A signature that occurs again
is hashed with its number, so that sets are compared as multisets.  The
fingerprint is the sorted set, eight hex digits each.  A text of one or two characters is
a signature itself; an empty one has none.

Two sets of lengths a <= b have a Jaccard likeness of at most a / b.  ``links``
finds all pairs of sets that reach a floor: sets are dealt into partitions by
length, so that only those of the same and of neighbouring partitions can reach
it, and within one by the signatures that are rarest in the table, of which two
such sets share at least one among the first few.  Pairs that meet are held
against the floor by lengths first, then by their common signatures.  A signature
with more than ``BUCKET`` sets of a partition is split.  The fingerprints of two
given texts are compared without a floor.

Cases: a null text is an empty one; equal texts have likeness 1; ids that repeat
stay rows of their own, ordered by a hash of their texts; a null id comes first;
after the last document comes the first; an empty table gives no rows; columns
beside the two named ones are not read.
"""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nodepulse.llm.common import kept, slices
from nodepulse.llm.components import star_components

# Common words of English, German, French and Spanish.
ANCHORS = frozenset(
    """
    a an and are as at be but by for from had has have he in is it not of on or that the this to was with you
    als auf das dem den der des die ein eine er für ich ist mit nicht sich sie und von zu
    au avec ce dans de des du elle en est et il la le les ne par pas pour que qui se sur un une
    al como con de del el en es la las lo los más no para por que se su un una y
    """.split()
)

WORD = re.compile(r"[^\W\d_]+")
#: Content words in a chain; words without an anchor after which any word is one; words under which a text is short, or tiny.
CHAIN, GAP, SHORT, TINY = 2, 8, 24, 5
#: Sets of one partition and signature that meet in one place.
BUCKET = 2000
#: Stands for a missing id.
LOWEST = -(1 << 63)
#: Kinds of rows drawn for each partition, to find bounds of equal parts.
SAMPLED = 100


def signatures(text: str, chain: int = CHAIN) -> frozenset[int]:
    """The signatures of ``text``."""
    words = WORD.findall(text.lower())
    content = [w for w in words if w not in ANCHORS]
    tails = list(map(" ".join, zip(*[content[k:] for k in range(chain)], strict=False)))
    found = []
    seen, gap = 0, GAP
    for word in words:
        if word in ANCHORS:
            gap = 0
        else:
            seen += 1
            gap += 1
            if gap <= GAP:
                continue
        if seen < len(tails):
            found.append(f"{word} {tails[seen]}")
    if len(words) < SHORT:
        found += map(" ".join, zip(words, words[1:], strict=False))
    if len(words) < TINY and text:
        found += [text[k : k + 3] for k in range(max(1, len(text) - 2))]
    times: dict[str, int] = {}
    out = []
    for s in found:
        n = times[s] = times.get(s, 0) + 1
        out.append(zlib.crc32(s.encode("utf-8", "replace"), 0 if n == 1 else n))
    return frozenset(out)


def fingerprint(found: frozenset[int]) -> str:
    """Signatures as text: sorted, eight hex digits each."""
    return np.sort(np.fromiter(found, ">u4", len(found))).astype(">u4").tobytes().hex()


def length_part(size: Column, floor: float) -> Column:
    """Number of a length's partition: each spans a factor of ``1 / floor``, so sets that reach it are in the same or the next."""
    return F.floor(F.log(size) / -math.log(floor) + 1e-9).cast("int")


def likeness(a: frozenset[int], b: frozenset[int]) -> float:
    """Jaccard likeness; two empty sets are alike."""
    if a == b:
        return 1.0
    common = len(a & b)
    return common / (len(a) + len(b) - common)


def edited(text: str, following: str) -> str:
    """The last quarter of ``text`` replaced by as much of ``following``."""
    quarter = len(text) // 4
    return text[: len(text) - quarter] + following[:quarter]


SCHEMA = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double, n_signatures long"
)


class _Ranges:
    """Ranges of (id, hash of text): range k lies before bound k, and each bound is its range's first row."""

    def __init__(self, bounds: list[tuple[int, int]]):
        self.ids, self.ties = (np.array([b[k] for b in bounds], np.int64) for k in (0, 1))

    def place(self, ids: np.ndarray, ties: np.ndarray) -> np.ndarray:
        """Range of each row."""
        out = np.searchsorted(self.ids, ids, "right")
        for i in np.unique(self.ids[np.isin(self.ids, ids)]):
            own = np.flatnonzero(ids == i)
            low, high = np.searchsorted(self.ids, i, "left"), np.searchsorted(self.ids, i, "right")
            out[own] = low + np.searchsorted(self.ties[low:high], ties[own], "right")
        return out

    def first_rows(self, ids: np.ndarray, ties: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows that begin a range, one of each kind, and the ranges before those."""
        found = [(np.flatnonzero((ids == self.ids[k]) & (ties == self.ties[k]))[:1], k) for k in np.flatnonzero(np.isin(self.ids, ids))]
        found = [(int(rows[0]), int(k)) for rows, k in found if len(rows)]
        return np.array([r for r, _ in found], np.int64), np.array([k for _, k in found], np.int64)


def _ranges(rows: DataFrame, parts: int) -> tuple[_Ranges, int | None, int | None]:
    """About ``parts`` ranges of equal numbers of rows, and the id and hash of the very first row.

    The bounds are quantiles of at most about SAMPLED kinds of rows for each part, drawn by a hash.
    """
    got = rows.agg(F.count("*").alias("n"), F.min(F.struct("doc_id", "tie")).alias("first")).first()
    if got["first"] is None:
        return _Ranges([]), None, None
    rate = min(1.0, SAMPLED * parts / got["n"])
    drawn = rows.where(F.pmod(F.xxhash64("doc_id", "tie"), F.lit(1 << 30)) < rate * (1 << 30))
    kinds = sorted(tuple(r) for r in drawn.groupBy("doc_id", "tie").count().collect())
    seen = np.cumsum([n for _, _, n in kinds])
    places = np.searchsorted(seen, [k * seen[-1] / parts for k in range(1, parts)]) if len(kinds) else []
    first = tuple(got["first"])
    return _Ranges(sorted({kinds[p][:2] for p in places} - {first})), *first


def in_order(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, text, copy) dealt out by ranges of (id, hash of text) and sorted; each range also gets, as a copy, the document after it.

    The bounds of the ranges are rows of the table, at most one for each
    partition, so the row after a range is the row at its bound.
    """
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(LOWEST)).alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("tie"))
    ranges, first, first_tie = _ranges(rows, parts)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, ties = batch.column(0).to_numpy(), batch.column(2).to_numpy()
            begins, before = ranges.first_rows(ids, ties)
            at_first = np.flatnonzero((ids == first) & (ties == first_tie))[:1]
            take = np.concatenate([np.arange(len(ids)), begins, at_first])
            to = np.concatenate([ranges.place(ids, ties), before, np.full(len(at_first), len(ranges.ids))])
            out = batch.take(pa.array(take))
            copy = np.arange(len(take)) >= len(ids)
            yield pa.RecordBatch.from_arrays(
                [*out.columns, pa.array(copy), pa.array(to.astype(np.int32))], names=["doc_id", "text", "tie", "copy", "dest"]
            )

    dealt = rows.mapInArrow(deal, "doc_id long, text string, tie long, copy boolean, dest int")
    return (
        dealt.repartitionById(len(ranges.ids) + 1, "dest")
        .sortWithinPartitions("copy", "doc_id", "tie")
        .select("doc_id", "text", "copy")
    )


def spotsigs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of texts and of their edited forms, and how near they are; see the module's text."""

    def tasks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last = None  # id, text and signatures of the document that waits for its next one
        done = False
        for batch in batches:
            rows = []
            for key, text, copy in zip(batch["doc_id"].to_list(), batch["text"], batch["copy"], strict=True):
                if done:
                    break
                own = signatures(text)
                if last:
                    known, old, sigs = last
                    new = edited(old, text)
                    changed = signatures(new) if new != old else sigs
                    rows.append(
                        (
                            known,
                            len(old),
                            hashlib.sha256(new.encode("utf-8", "replace")).hexdigest(),
                            fingerprint(sigs),
                            fingerprint(changed),
                            likeness(sigs, changed),
                            likeness(sigs, own),
                            len(sigs),
                        )
                    )
                last, done = (key, text, own), bool(copy)
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in SCHEMA.split(", ")])

    out = in_order(docs, id_col, text_col).mapInPandas(tasks, SCHEMA)
    return out.withColumn("doc_id", F.expr(f"nullif(doc_id, {-(1 << 63) + 1}L - 1L)"))


def signature_sets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, key, sigs) of every row: the sorted signatures of its text, and their number as a set."""

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1):
                found = [np.sort(np.fromiter(own, np.int64, len(own))) for own in map(signatures, ((t or "") for t in part.column(1).to_pylist()))]
                keys = [xxhash.xxh64_intdigest(f.tobytes(), 3) - (1 << 63) for f in found]
                ends = np.cumsum([0, *map(len, found)])
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([np.zeros(0, np.int64), *found])))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(keys, pa.int64()), lists], names=["doc_id", "key", "sigs"])

    rows = docs.selectExpr(f"cast(`{id_col}` as long) as doc_id", f"`{text_col}` as text")
    return rows.mapInArrow(tasks, "doc_id long, key long, sigs array<long>")


def links(sets: DataFrame, floor: float = 0.8) -> DataFrame:
    """(a, b, likeness) of all pairs of different sets (key, sigs) that reach ``floor``, between 0 and 1; empty sets have none."""
    sets = kept(sets.where("size(sigs) > 0").select("key", "sigs").dropDuplicates(["key"]), "sets")
    single = sets.select("key", F.size("sigs").alias("n"), F.explode("sigs").alias("sig"))
    often = single.groupBy("sig").agg(F.count("*").alias("often"))
    in_order = F.array_sort(F.collect_list(F.struct("often", "sig")))
    ranked = single.join(often, "sig").groupBy("key", "n").agg(in_order.alias("ranked"))
    # Two sets that share ceil(floor * n) of n signatures share one of the n - that + 1 rarest of both.
    few = F.slice("ranked", 1, (F.col("n") - F.ceil(F.col("n") * floor - 1e-9) + 1).cast("int"))
    part = length_part(F.col("n"), floor)
    index = ranked.select("key", "n", part.alias("part"), F.explode(few["sig"]).alias("sig"))
    index = kept(index, "prefixes")
    # The larger set of a pair lies in the partition of the smaller one or in the next.  It is in one piece of a bucket,
    # the smaller one meets all pieces.
    pieces = index.groupBy("part", "sig").agg(F.ceil(F.count("*") / BUCKET).cast("int").alias("pieces")).where("pieces > 1")
    large = index.join(pieces, ["part", "sig"], "left").withColumn(
        "piece", F.coalesce(F.pmod(F.xxhash64("key"), F.col("pieces")).cast("int"), F.lit(0))
    )
    small = index.withColumn("part", F.explode(F.array(F.col("part"), F.col("part") + 1)))
    small = small.join(pieces, ["part", "sig"], "left").withColumn(
        "piece", F.explode(F.sequence(F.lit(0), F.coalesce("pieces", F.lit(1)) - 1))
    )
    small = small.select("part", "sig", "piece", F.col("key").alias("a"), F.col("n").alias("na"))
    large = large.select("part", "sig", "piece", F.col("key").alias("b"), F.col("n").alias("nb"))
    met = small.join(large, ["part", "sig", "piece"]).where(F.col("na") >= F.col("nb") * floor - 1e-9).where("na < nb or na = nb and a < b")
    pairs = met.select("a", "b").distinct()
    both = pairs.join(sets.toDF("a", "sa"), "a").join(sets.toDF("b", "sb"), "b")
    common = F.size(F.array_intersect("sa", "sb"))
    alike = both.select("a", "b", (common / (F.size("sa") + F.size("sb") - common)).alias("likeness"))
    return alike.where(F.col("likeness") >= floor - 1e-12)


def near_classes(docs: DataFrame, floor: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, class_id, n_links) of every row: the smallest id that links of ``floor`` reach, and its set's links to other sets."""
    rows = kept(signature_sets(docs, id_col, text_col), "signatures")
    found = kept(links(rows, floor), "alike")
    counted = found.select(F.explode(F.array("a", "b")).alias("key")).groupBy("key").agg(F.count("*").alias("n_links"))
    roots = star_components(found.select("a", "b"))
    first = rows.groupBy("key").agg(F.min("doc_id").alias("first"))
    member = first.join(roots.withColumnRenamed("node", "key"), "key", "left").withColumn("root", F.coalesce("root", "key"))
    named = member.join(member.groupBy("root").agg(F.min("first").alias("class_id")), "root").join(counted, "key", "left")
    named = named.select("key", "class_id", F.coalesce("n_links", F.lit(0)).alias("n_links"))
    return rows.select("doc_id", "key").join(named, "key").select("doc_id", "class_id", "n_links")
