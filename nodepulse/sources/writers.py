"""Writing results by day, compacting small files, finding days still to do."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.timegrid import floor_to
from .readers import day_files
from .schemas import apply_schema

#: Ending of the folder beside a table that has the marks of its finished days.
MARKS = "-finished"


def with_date(df: DataFrame, time_col: str = "timestamp") -> DataFrame:
    return df if "date" in df.columns else df.withColumn("date", F.to_date(time_col))


def by_day(df: DataFrame, time_col: str = "timestamp") -> DataFrame:
    """Rows of a day together, for writing by day.

    The rebalance hint lets Spark cut a day that is much larger than the others
    into several tasks and put small days into one.
    """
    return with_date(df, time_col).hint("rebalance", F.col("date")).sortWithinPartitions("date", time_col)


def write_partitioned(
    df: DataFrame,
    path: str,
    schema: T.StructType | None = None,
    time_col: str = "timestamp",
    max_rows_per_file: int = 0,
) -> None:
    """Parquet by day, sorted by time.  Only the days present in ``df`` are replaced."""
    typed = df if schema is None else apply_schema(df, schema)
    (
        by_day(typed, time_col)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", max_rows_per_file)
        .partitionBy("date")
        .parquet(path)
    )


def write_daily_csv(df: DataFrame, path: str, time_col: str = "timestamp", separator: str = " ") -> None:
    """CSV by day; arrays are written as text, times with all their microseconds."""
    dated = with_date(df, time_col)
    flat = dated.select(
        *[
            F.array_join(F.col(f.name).cast("array<string>"), separator).alias(f.name)
            if isinstance(f.dataType, T.ArrayType)
            else F.col(f.name)
            for f in dated.schema
        ]
    )
    (
        flat.write.mode("overwrite")
        .option("header", True)
        .option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("date")
        .csv(path)
    )


def repartition_by_time(df: DataFrame, resolution: str = "1 minute", time_col: str = "timestamp", partitions: int | None = None) -> DataFrame:
    """Range partitions whose limits fall on the grid: a minute is never split."""
    key = floor_to(time_col, resolution)
    ranged = df.repartitionByRange(key) if partitions is None else df.repartitionByRange(partitions, key)
    return ranged.sortWithinPartitions(time_col)


def compact(spark: SparkSession, source: str, target: str, time_col: str = "timestamp", max_rows_per_file: int = 0) -> None:
    """Rewrite a table of many small files with few large ones per day.

    Nothing is dropped, and the committer shows the new files only when all are
    complete.  Spark's advisory partition size sets how large a file gets.
    """
    write_partitioned(spark.read.parquet(source), target, None, time_col, max_rows_per_file)


def _marks(path: str) -> str:
    return path.rstrip("/") + MARKS


def write_finished(df: DataFrame, path: str, schema: T.StructType | None = None, time_col: str = "timestamp") -> None:
    """:func:`write_partitioned`, and then a mark for each of the days written: how many files and bytes it has.

    A day counts as finished only with its mark, and only as long as its files
    are those of the mark; what a broken job leaves behind has none.
    """
    seen = Observation()
    write_partitioned(with_date(df, time_col).observe(seen, F.collect_set("date").alias("days")), path, schema, time_col)
    days = seen.get["days"]
    if days:
        marks = day_files(df.sparkSession, path).where(F.col("date").isin(days)).coalesce(1)
        marks.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("date").parquet(_marks(path))


def finished_days(spark: SparkSession, path: str) -> DataFrame:
    """Days of a table that are marked and have just the files of their mark."""
    try:
        marks = spark.read.schema("files long, bytes long, date date").parquet(_marks(path))
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "date date")
    return marks.join(day_files(spark, path), ["date", "files", "bytes"], "left_semi").select("date")


def pending_days(source: DataFrame, done: DataFrame | None) -> DataFrame:
    """Days of ``source`` that ``done`` does not have, both any tables with ``date``.

    For stored tables these are :func:`day_files` and :func:`finished_days`, which open no data.
    """
    days = source.select("date").distinct()
    return days if done is None else days.join(done.select("date").distinct(), "date", "left_anti")
