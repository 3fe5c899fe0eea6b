"""Token ids in files of fixed-width bits.

A file holds the ids of a run of documents, each id in the fewest bits that hold
the vocabulary.  Layout, all numbers little-endian:

    payload   blocks of ``BLOCK`` ids; bits fill 64-bit words from the lowest
    footer    doc ids int64[docs], known uint8[docs] (0: the id is null),
              first id uint64[docs + 1], block offsets uint64[blocks + 1]
    tail      footer offset uint64, docs uint64, ids uint64, bits uint32,
              ids in a block uint32, b"NPTOKEN1"

Block offsets give random access: any range of ids is read from the blocks that
hold it, and numpy unpacks a block at once.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from nodepulse.llm.byte_bpe import TEXTS_AT_ONCE, ByteBpe
from nodepulse.llm.common import kept

BLOCK = 4096
MAGIC = b"NPTOKEN1"
TAIL, TAIL_BYTES = "<QQQII8s", 40


def bits_for(vocabulary: int) -> int:
    """The fewest bits that hold ids 0 to ``vocabulary`` - 1."""
    return max(1, (vocabulary - 1).bit_length())


def pack_bits(ids: np.ndarray, bits: int) -> bytes:
    """``ids`` in ``bits`` bits each, filled up to whole 64-bit words."""
    if not len(ids):
        return b""
    ids = ids.astype(np.uint64)
    if int(ids.max()) >> bits:
        raise ValueError(f"an id needs more than {bits} bits")
    at = np.arange(len(ids), dtype=np.uint64) * np.uint64(bits)
    word, shift = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
    words = np.zeros(int(word[-1]) + 2, np.uint64)
    starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
    words[word[starts]] = np.bitwise_or.reduceat(ids << shift, starts)
    over = shift + np.uint64(bits) > np.uint64(64)  # at most one id crosses a word's end
    words[word[over] + 1] |= ids[over] >> (np.uint64(64) - shift[over])
    return words[: (len(ids) * bits + 63) // 64].astype("<u8").tobytes()


def unpack_bits(raw: bytes, count: int, bits: int) -> np.ndarray:
    """The first ``count`` ids of :func:`pack_bits`, as uint32."""
    words = np.r_[np.frombuffer(raw, "<u8").astype(np.uint64), np.uint64(0)]
    at = np.arange(count, dtype=np.uint64) * np.uint64(bits)
    word, shift = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
    low = words[word] >> shift
    high = np.where(shift > 0, words[word + 1] << (np.uint64(64) - np.maximum(shift, np.uint64(1))), np.uint64(0))
    return ((low | high) & np.uint64((1 << bits) - 1)).astype(np.uint32)


def storage(path: str):
    """File system and path of a local path or a URI."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path)


class TokenWriter:
    """Writes one file; ids of the open block are all it holds beside the footer."""

    def __init__(self, path: str, bits: int):
        self.fs, self.path = storage(path)
        self.out, self.bits = self.fs.open_output_stream(self.path), bits
        self.docs: list[int | None] = []
        self.first, self.blocks, self.rest = [0], [0], np.zeros(0, np.uint32)

    def _block(self, ids: np.ndarray) -> None:
        raw = pack_bits(ids, self.bits)
        self.out.write(raw)
        self.blocks.append(self.blocks[-1] + len(raw))

    def add(self, docs: list[int | None], ids: list[np.ndarray]) -> None:
        """Append documents."""
        self.docs += docs
        for x in ids:
            self.first.append(self.first[-1] + len(x))
        self.rest = np.concatenate([self.rest, *ids])
        whole = len(self.rest) // BLOCK * BLOCK
        for at in range(0, whole, BLOCK):
            self._block(self.rest[at : at + BLOCK])
        self.rest = self.rest[whole:]

    def close(self) -> None:
        """Write the last block, the footer and the tail."""
        if len(self.rest):
            self._block(self.rest)
        known = np.array([d is not None for d in self.docs], np.uint8)
        footer = self.blocks[-1]
        self.out.write(np.array([d or 0 for d in self.docs], "<i8").tobytes() + known.tobytes())
        self.out.write(np.array(self.first, "<u8").tobytes() + np.array(self.blocks, "<u8").tobytes())
        self.out.write(struct.pack(TAIL, footer, len(self.docs), self.first[-1], self.bits, BLOCK, MAGIC))
        self.out.close()


class TokenReader:
    """Reads ids of a file by place."""

    def __init__(self, path: str):
        fs, name = storage(path)
        self.file = fs.open_input_file(name)
        size = self.file.size()
        footer, docs, self.n_ids, self.bits, self.block, magic = struct.unpack(
            TAIL, self.file.read_at(TAIL_BYTES, size - TAIL_BYTES)
        )
        if magic != MAGIC:
            raise ValueError(f"{path} is no token file")
        raw = self.file.read_at(size - TAIL_BYTES - footer, footer)
        blocks = -(-self.n_ids // self.block)
        self.docs, at = np.frombuffer(raw, "<i8", docs), 8 * docs
        self.known, at = np.frombuffer(raw, np.uint8, docs, at).astype(bool), at + docs
        self.first, at = np.frombuffer(raw, "<u8", docs + 1, at).astype(np.int64), at + 8 * (docs + 1)
        self.blocks = np.frombuffer(raw, "<u8", blocks + 1, at).astype(np.int64)

    def ids(self, start: int, stop: int) -> np.ndarray:
        """Ids ``start`` to ``stop`` - 1 of the file."""
        if stop <= start:
            return np.zeros(0, np.uint32)
        a, b = start // self.block, -(-stop // self.block)
        raw = self.file.read_at(int(self.blocks[b] - self.blocks[a]), int(self.blocks[a]))
        parts = [
            unpack_bits(
                raw[self.blocks[k] - self.blocks[a] : self.blocks[k + 1] - self.blocks[a]],
                min(self.block, self.n_ids - k * self.block),
                self.bits,
            )
            for k in range(a, b)
        ]
        return np.concatenate(parts)[start - a * self.block : stop - a * self.block]

    def document(self, k: int) -> np.ndarray:
        """Ids of the file's document ``k``."""
        return self.ids(int(self.first[k]), int(self.first[k + 1]))


def write_token_files(
    docs: DataFrame, folder: str, tokenizer_path: str, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Encode whole texts, close each with ``end_id``, write them in ascending id order.

    Runs at once.  Returns the manifest, which is kept: (shard, path, docs, ids).
    Each task writes under a name of its own, and only what the manifest lists
    counts, so a repeated task leaves no double rows.

    A null text is an empty one; null ids come first; rows of one id are ordered
    by a hash of their texts, so that rows that share an id can be dealt out.
    """
    spark = docs.sparkSession

    def tasks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder, end = ByteBpe(tokenizer_path), np.array([end_id], "<u4")
        bits, writer = bits_for(encoder.tokenizer.get_vocab_size()), None
        shard = TaskContext.get().partitionId()
        for batch in batches:
            texts = [t if isinstance(t, str) else "" for t in batch["text"]]
            keys = [None if pd.isna(k) else int(k) for k in batch["doc_id"]]
            for at in range(0, len(texts), TEXTS_AT_ONCE):
                if writer is None:
                    path = f"{folder}/{shard:08d}-{uuid.uuid4().hex[:12]}.tok"
                    fs, name = storage(path)
                    fs.create_dir(name.rpartition("/")[0], recursive=True)
                    writer = TokenWriter(path, bits)
                got = encoder.encode(texts[at : at + TEXTS_AT_ONCE])
                writer.add(keys[at : at + TEXTS_AT_ONCE], [np.concatenate([np.frombuffer(g, "<u4"), end]) for g in got])
        if writer:
            writer.close()
            yield pd.DataFrame({"shard": [shard], "path": [path], "docs": [len(writer.docs)], "ids": [writer.first[-1]]})

    dealt = (
        docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
        .withColumn("tie", F.xxhash64("text"))
        .repartitionByRange("doc_id", "tie")
        .sortWithinPartitions("doc_id", "tie")
        .select("doc_id", "text")
    )
    return kept(dealt.mapInPandas(tasks, "shard long, path string, docs long, ids long"), "token-files")


def read_token_files(spark: SparkSession, manifest: DataFrame) -> DataFrame:
    """Per document, from the files: doc_id, start, n_tokens, ids_crc32.

    ``start`` counts ids before the document over all files.  The manifest has a
    row for each file, so its running sum is short.
    """

    def tasks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, base in zip(batch["path"], batch["base"], strict=True):
                reader = TokenReader(path)
                step = 512  # documents read at once
                for a in range(0, len(reader.docs), step):
                    b = min(a + step, len(reader.docs))
                    first = reader.first[a : b + 1]
                    raw = memoryview(reader.ids(int(first[0]), int(first[-1])).astype("<u4").tobytes())
                    cut = (4 * (first - first[0])).tolist()
                    yield pd.DataFrame(
                        {
                            "doc_id": pd.array(np.where(reader.known[a:b], reader.docs[a:b], 0), "Int64"),
                            "start": first[:-1] + base,
                            "n_tokens": np.diff(first),
                            "ids_crc32": [zlib.crc32(raw[x:y]) for x, y in zip(cut, cut[1:], strict=False)],
                            "known": reader.known[a:b],
                        }
                    )

    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    files = manifest.select("path", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("base"))
    files = files.repartition(spark.sparkContext.defaultParallelism, "path")
    rows = files.mapInPandas(tasks, "doc_id long, start long, n_tokens long, ids_crc32 long, known boolean")
    return rows.withColumn("doc_id", F.expr("if(known, doc_id, null)")).drop("known")
