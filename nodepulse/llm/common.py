"""What several operators of this package share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from nodepulse.session import scratch_path


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The table ``name`` below ``sf_dir``."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def kept(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back.

    For a small derived table that several steps read.  The files survive lost
    executors, and the new plan begins at them.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def vocabulary(name: str) -> str:
    """Place of a public vocabulary file on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def remainder(key: str, of: int):
    """crc32 of a column's text, modulo ``of``; a null key counts as the empty text."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit(""))) % of


def slices(batch: pa.RecordBatch, at: int, limit: int = 1 << 22) -> Iterator[pa.RecordBatch]:
    """The batch in parts of about ``limit`` bytes in its string column number ``at``; a longer text is a part alone."""
    sizes = pc.fill_null(pc.binary_length(batch.column(at)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes, dtype=np.int64)
    first, before = 0, 0
    while first < batch.num_rows:
        last = max(first + 1, int(np.searchsorted(ends, before + limit, "right")))
        yield batch.slice(first, last - first)
        first, before = last, int(ends[last - 1])


def with_text_columns(
    df: DataFrame, made: dict[str, pa.DataType], schema: str, start: Callable[[], Callable], text_col: str = "text", keep: bool = True
) -> DataFrame:
    """``df`` and the columns ``made``, computed from the column ``text_col``.

    ``start`` is called once in a task and returns a function of a list of texts
    that returns the new columns in their order; ``schema`` declares them.
    Other columns pass through as they are, but for those of a new one's name,
    which it replaces; ``text_col`` goes unless ``keep``.
    """
    df = df.drop(*made)
    at, names, types = df.columns.index(text_col), df.columns, list(made.values())

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = start()
        for batch in batches:
            for part in slices(batch, at):
                new = work(part.column(at).to_pylist())
                old = [c for k, c in enumerate(part.columns) if keep or k != at]
                arrays = [*old, *[pa.array(x, t) for x, t in zip(new, types, strict=True)]]
                yield pa.RecordBatch.from_arrays(arrays, names=[*names, *made])

    names = [n for n in names if keep or n != text_col]
    old = "".join(f"`{n}` {df.schema[n].dataType.simpleString()}, " for n in names)
    return df.mapInArrow(tasks, old + schema)


def excerpt(column: str, most: int, pieces: int = 10):
    """A text of at most ``most`` characters whole, else ``pieces`` windows of it, of whole words where there are gaps.

    Each lies in a stretch of its own of the text, at a place drawn by a hash, so that all parts can be met.
    """
    size, text = most // pieces, F.col(column)
    stretch = F.floor(F.char_length(text) / pieces).cast("int")

    def window(k):
        first = k * stretch + F.pmod(F.xxhash64(text, k), stretch - size + 1).cast("int") + 1
        return F.regexp_replace(F.substring(text, first, F.lit(size)), r"^\S*\s+|\s+\S*$", "")

    windows = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(pieces - 1)), window), " ")
    return F.when(F.char_length(text) <= most, text).otherwise(windows)


def share_of(rows: DataFrame, group: str, most: int, *mixed: str, work: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """At most ``most`` rows of each of the few values of ``group``, drawn by a hash of the columns ``mixed``.

    A hash threshold from the group's count leaves about as many rows as needed
    before any are ranked, so no group meets in one task.  ``work`` is done on
    those rows; it keeps ``group`` and ``__mix``.
    """
    size = rows.groupBy(group).agg(F.count("*").alias("n"))  # one row for each value, few
    rate = {r[group]: min(1.0, 1.2 * most / r["n"] + 1e-9) for r in size.collect()}
    bound = F.lit(0.0)
    for value, share in rate.items():
        bound = F.when(F.col(group) == F.lit(value), share).otherwise(bound)
    drawn = rows.withColumn("__mix", F.xxhash64(*mixed)).where(F.pmod("__mix", F.lit(1 << 30)) < bound * (1 << 30))
    drawn = work(drawn) if work else drawn
    place = F.row_number().over(Window.partitionBy(group).orderBy("__mix"))
    return drawn.withColumn("__place", place).where(F.col("__place") <= most).drop("__mix", "__place")
