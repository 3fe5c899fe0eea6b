"""Reading days, windows of days, and CSV tables.

Tables are parquet directories partitioned by ``date``.  Filters name ``date``
next to the time column, as only the partition column prunes directories.
"""

from __future__ import annotations

import io
from datetime import date, timedelta

import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.missing import nan_to_null
from ..functions.timegrid import as_timestamp, seconds_of


#: No parquet file without rows is larger.
EMPTY_BYTES = 1 << 20


def _day(day: str | date) -> date:
    return day if isinstance(day, date) else date.fromisoformat(day)


def read_table(
    spark: SparkSession,
    path: str,
    columns: list[str] | None = None,
    schema: T.StructType | None = None,
    ignore_corrupt: bool = False,
) -> DataFrame:
    """A parquet table, chosen columns only; unreadable files may be passed over."""
    reader = spark.read.option("ignoreCorruptFiles", str(ignore_corrupt).lower())
    reader = reader.schema(schema) if schema is not None else reader
    df = reader.parquet(path)
    return nan_to_null(df.select(*columns) if columns else df)


def read_day(
    spark: SparkSession, path: str, day: str | date, columns: list[str] | None = None, ignore_corrupt: bool = False
) -> DataFrame:
    """One day of a table partitioned by ``date``."""
    df = spark.read.option("ignoreCorruptFiles", str(ignore_corrupt).lower()).parquet(path)
    df = df.filter(F.col("date") == F.lit(_day(day)))
    return nan_to_null(df.select(*columns) if columns else df)


def day_window(df: DataFrame, day: str | date, previous: int = 1, following: int = 1) -> DataFrame:
    """The rows of a day and of its neighbours; days without data just have no rows."""
    first, last = _day(day) - timedelta(days=previous), _day(day) + timedelta(days=following)
    return df.filter(F.col("date").between(F.lit(first), F.lit(last)))


def day_files(spark: SparkSession, path: str) -> DataFrame:
    """Days of a stored table with the number of their files and bytes, from the list of files alone.

    No file is opened: a file's name has its day, and its content is not asked for.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path)
    return files.groupBy("date").agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"))


def corrupt_files(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Files (path, length) of a table that :func:`read_table` passes over, as they cannot be read.

    These are the listed files that no row comes from, but for sound ones
    without rows.  A file of no bytes is no file to Spark; one that breaks off
    inside gives the rows before and is not named.
    """
    listed = spark.read.format("binaryFile").load(path)
    seen = spark.read.option("ignoreCorruptFiles", "true").schema(schema).parquet(path)
    # The two sources spell local names differently after the scheme.
    name = lambda c: F.regexp_replace(F.url_decode(F.replace(c, F.lit("+"), F.lit("%2B"))), "^file:/+", "file:/")
    seen = seen.select(name(F.col("_metadata.file_path")).alias("file")).distinct()
    silent = listed.withColumn("file", name(F.col("path"))).join(seen, "file", "left_anti")

    @F.pandas_udf("boolean")
    def sound(contents: pd.Series) -> pd.Series:
        return contents.map(_is_parquet)

    # A sound file without rows is little more than its schema; larger ones need no look inside.
    small = F.when(F.col("length") <= EMPTY_BYTES, F.col("content"))
    return silent.where(~sound(small)).select("path", "length")


def _is_parquet(content: bytes | None) -> bool:
    if content is None:
        return False
    try:
        return pq.read_metadata(io.BytesIO(content)) is not None
    except (pa.ArrowInvalid, OSError):
        return False


def available_days(df: DataFrame, skip: Column | None = None, first_n: int | None = None) -> DataFrame:
    """Days that have rows, in order, without those to skip; ``first_n`` ends the list early.

    ``df`` is any table with ``date``; :func:`day_files` gives one without reading the data.
    """
    days = df.select("date").distinct()
    days = days if skip is None else days.filter(~skip)
    days = days.orderBy("date")
    return days if first_n is None else days.limit(first_n)


def read_day_with_spill(df: DataFrame, day: str | date, margin: str = "1 minute", time_col: str = "timestamp", arrival: str = "arrived") -> DataFrame:
    """Rows whose *time* is in the day, from files that *arrived* up to ``margin`` off it.

    ``arrival`` is the file's minute; ``date`` is the day of arrival and prunes.
    """
    start = _day(day)
    seconds = seconds_of(margin)
    begin, end = F.lit(start).cast("timestamp"), F.lit(start + timedelta(days=1)).cast("timestamp")
    gap = F.make_interval(secs=F.lit(seconds))
    arrived = as_timestamp(arrival)
    days = -(-seconds // 86400)
    return df.filter(
        F.col("date").between(F.lit(start - timedelta(days=days)), F.lit(start + timedelta(days=days)))
        & (arrived >= begin - gap)
        & (arrived < end + gap)
        & (as_timestamp(time_col) >= begin)
        & (as_timestamp(time_col) < end)
    )


def read_csv_typed(spark: SparkSession, path: str | list[str], schema: T.StructType | str, header: bool = True) -> DataFrame:
    """CSV files with a declared schema; one path, a glob, or a list of them.

    With a header the columns may stand in any order and be more than asked for.
    """
    if not header:
        return spark.read.schema(schema).csv(path)
    wanted = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    raw = spark.read.option("header", True).csv(path)
    return raw.select(*[F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in wanted])


def read_many(spark: SparkSession, pattern: str, schema: T.StructType | str) -> DataFrame:
    """The union of all CSV files that match a glob."""
    return read_csv_typed(spark, pattern, schema)


def date_range(spark: SparkSession, start: str | date, end: str | date) -> DataFrame:
    """Every day from ``start`` to ``end``, both included."""
    first, last = _day(start), _day(end)
    days = max((last - first).days + 1, 0)
    return spark.range(days).select(F.date_add(F.lit(first), F.col("id").cast("int")).alias("date"))
