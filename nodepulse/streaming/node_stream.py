"""The first two aggregation steps over files as they arrive.

A minute file may hold rows a little late or early.  The watermark waits
``lateness`` for them; a bin is written once, when no more rows can come.  State
is one row of sums per node and open bin, kept from one micro-batch to the next.

When a micro-batch starts, the watermark is the latest time of all earlier ones
less ``lateness``.  It closes bins that end by then; a row counts unless the
micro-batch before has closed its bin already.  :func:`left_out` tells how many
rows that cost.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions.missing import nan_to_null
from ..functions.timegrid import as_timestamp, floor_to, seconds_of
from ..operators.cluster import POWER_KINDS
from ..operators.hier_agg import moments
from ..operators.order_stats import stats_of


def read_stream(
    spark: SparkSession, path: str, schema: T.StructType, file_glob: str | None = None, files_per_trigger: int | None = None
) -> DataFrame:
    """New parquet files of a folder, in the order they appear."""
    reader = spark.readStream.schema(schema)
    reader = reader.option("pathGlobFilter", file_glob) if file_glob else reader
    reader = reader.option("maxFilesPerTrigger", files_per_trigger) if files_per_trigger else reader
    return nan_to_null(reader.parquet(path))


def stream_init_agg(
    stream: DataFrame,
    resolution: str,
    values: list[str],
    lateness: str = "1 minute",
    time_col: str = "timestamp",
    host: str = "hostname",
) -> DataFrame:
    """Mergeable aggregates per node and bin, as ``init_agg`` gives them."""
    timed = stream.withColumn(time_col, as_timestamp(time_col)).withWatermark(time_col, lateness)
    bins = F.window(time_col, f"{seconds_of(resolution)} seconds")
    grouped = timed.groupBy(bins.alias("bin"), host).agg(*[c for v in values for c in moments(v)])
    return grouped.select(F.col("bin.start").alias(time_col), *[c for c in grouped.columns if c != "bin"])


def stream_cluster_power(
    stream: DataFrame,
    resolution: str,
    series: dict[str, str],
    lateness: str = "1 minute",
    time_col: str = "timestamp",
) -> DataFrame:
    """Cluster power statistics per bin over the rows written by the first step.

    ``series`` maps short names to columns.  Exact quantiles keep the bin's
    values, one per node, until the bin is written.
    """
    timed = stream.withColumn(time_col, as_timestamp(time_col)).withWatermark(time_col, lateness)
    bins = F.window(time_col, f"{seconds_of(resolution)} seconds")
    grouped = timed.groupBy(bins.alias("bin")).agg(
        *[c for name, col in series.items() for c in stats_of(col, name, POWER_KINDS)]
    )
    return grouped.select(F.col("bin.start").alias(time_col), *[c for c in grouped.columns if c != "bin"])


def stream_power_of_readings(
    stream: DataFrame,
    resolution: str,
    series: dict[str, str],
    lateness: str = "1 minute",
    time_col: str = "timestamp",
    host: str = "hostname",
) -> DataFrame:
    """Readings to cluster power statistics in one query: two aggregates with state, one after the other.

    ``series`` maps short names to sensors.  Nodes' bins leave the first state
    when the watermark closes them and are then one row each in the second one's
    group, which the same watermark closes.
    """
    timed = stream.withColumn(time_col, as_timestamp(time_col)).withWatermark(time_col, lateness)
    bins = F.window(time_col, f"{seconds_of(resolution)} seconds")
    values = list(dict.fromkeys(series.values()))
    nodes = timed.groupBy(bins.alias("bin"), host).agg(*[F.avg(F.col(v).cast("double")).alias(v) for v in values])
    again = F.window("bin", f"{seconds_of(resolution)} seconds")
    grouped = nodes.groupBy(again.alias("tick")).agg(*[c for name, v in series.items() for c in stats_of(v, name, POWER_KINDS)])
    return grouped.select(F.col("tick.start").alias(time_col), *[c for c in grouped.columns if c != "tick"])


def left_out(
    arrived: DataFrame, written: DataFrame, resolution: str, value: str, time_col: str = "timestamp", host: str = "hostname"
) -> DataFrame:
    """Rows of each written bin and node that came too late to count.

    ``arrived`` holds all rows that came, ``written`` what :func:`stream_init_agg`
    made of them.  Where no row of a node's bin was in time it has not been
    written, and all its rows are left out.  Bins after the last written one are
    still open.
    """
    binned = arrived.select(floor_to(time_col, resolution).alias(time_col), host, value)
    came = binned.groupBy(time_col, host).agg(F.count(value).alias("came"))
    counted = written.select(time_col, host, F.col(f"{value}_count").alias("counted"))
    last = written.agg(F.max(time_col).alias("last"))
    both = came.join(counted, [time_col, host], "left").withColumn("counted", F.coalesce("counted", F.lit(0)))
    closed = both.join(F.broadcast(last), F.col(time_col) <= F.col("last")).drop("last")  # one row
    return closed.withColumn("left_out", F.col("came") - F.col("counted"))


def write_stream(df: DataFrame, path: str, checkpoint: str, time_col: str = "timestamp", once: bool = True) -> StreamingQuery:
    """Append finished bins to a table partitioned by day.

    The file sink and the checkpoint together write each bin exactly once, also
    after a restart.  ``once`` processes what is there and stops.
    """
    writer = (
        df.withColumn("date", F.to_date(time_col))
        .writeStream.outputMode("append")
        .format("parquet")
        .partitionBy("date")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    return (writer.trigger(availableNow=True) if once else writer).start()


def run_to_table(
    spark: SparkSession, build: Callable[[], DataFrame], path: str, checkpoint: str, time_col: str = "timestamp"
) -> DataFrame:
    """Run a streaming job over the files present, and on from its checkpoint, and return the table it wrote."""
    query = write_stream(build(), path, checkpoint, time_col)
    query.awaitTermination()
    return spark.read.parquet(path)
