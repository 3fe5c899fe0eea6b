"""Joins between points in time and job intervals.

Spark has no range index, so an interval is written once for each time bucket
it touches, and a point looks only into its own bucket.  The join key is then
(host, bucket): an ordinary equi-join that shuffles evenly even when one host
holds much of the data, because its rows are spread over the buckets.  A point
lies in exactly one bucket, so no match comes out twice.

Readings and job series meet at ticks.  There both sides are laid out by the tick
alone, so that what is made for each job and tick afterwards needs no shuffle of
the matches, which are many times the readings where a node runs many jobs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.timegrid import as_timestamp, ceil_to, floor_to, micros_of, round_to, steps_between


def explode_buckets(df: DataFrame, begin: str, end: str, bucket: str, out: str = "__bucket") -> DataFrame:
    """One row per bucket an interval touches; reversed or open intervals give none."""
    step = micros_of(bucket)
    first, last = F.unix_micros(floor_to(begin, bucket)), F.unix_micros(floor_to(end, bucket))
    good = df.filter(as_timestamp(begin) <= as_timestamp(end))
    # Spark's size estimate does not see the rows that explode adds, so it must
    # not choose to broadcast this side on the strength of it.
    return good.withColumn(out, F.explode(steps_between(first, last, step))).hint("merge")


def bucket_of(time_col: str | Column, bucket: str) -> Column:
    return F.unix_micros(floor_to(time_col, bucket))


#: The tick that rows are laid out by.
TICK = "__tick"
#: Partitions of such a layout for each one of the session: ticks are few and large, so they are dealt out finely.
FINER = 4


def with_tick(df: DataFrame, resolution: str, time_col: str = "timestamp") -> DataFrame:
    """``df`` with the tick of its time; a table that has it already stays as it is."""
    return df if TICK in df.columns else df.withColumn(TICK, bucket_of(time_col, resolution))


def tick_of(df: DataFrame, keys: list[str]) -> list[str]:
    """The tick, if ``df`` is laid out by it: a key beside ``keys`` that splits no group of a time."""
    return [TICK] if TICK in df.columns and TICK not in keys else []


def by_tick(df: DataFrame) -> DataFrame:
    """``df`` laid out by its tick."""
    parts = FINER * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(parts, TICK)


def by_job(df: DataFrame) -> DataFrame:
    """``df`` laid out by its job, in as many partitions as the session has.

    Adaptive execution leaves a number that is given as it is.  Else it would join partitions by their compressed
    bytes, and a task would hold some twenty times as much where it groups or sorts the rows of so many jobs.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), "allocation_id")


def at_each_tick(df: DataFrame, begin: str, end: str, resolution: str, bucket: str) -> DataFrame:
    """One row for each tick of an interval whose ends lie on the grid, bucket after bucket."""
    step, width = micros_of(resolution), micros_of(bucket)
    first = F.greatest(F.unix_micros(begin), F.unix_micros(ceil_to(F.timestamp_micros("__bucket"), resolution)))
    last = F.least(F.unix_micros(end), F.col("__bucket") + F.lit(width - 1))
    parts = explode_buckets(df, begin, end, bucket)
    return parts.withColumn(TICK, F.explode(steps_between(first, last, step))).drop("__bucket")


def join_jobs_by_time(
    telemetry: DataFrame,
    pernode: DataFrame,
    resolution: str,
    bucket: str = "1 hour",
    time_col: str = "timestamp",
    carry: list[str] = ("allocation_id", "node_name", "num_nodes"),
    ends: str = "outward",
) -> DataFrame:
    """Each node reading with every job that ran on the node at that tick.

    The job interval is widened ``outward`` to the grid, or its ends go to the
    ``nearest`` tick; both ends belong to it.  A node and job that the table has several times counts once, from the
    earliest begin to the latest end.

    A job goes to its ticks with the list of its nodes.  The result lies by :data:`TICK`, a column that it has beside the others.
    """
    keys = ["allocation_id", "node_name"]
    to_begin, to_end = {"outward": (floor_to, ceil_to), "nearest": (round_to, round_to)}[ends]
    jobs = (
        pernode.groupBy(*keys)
        .agg(
            F.min("begin_time").alias("__b"),
            F.max("end_time").alias("__e"),
            *[F.min(c).alias(c) for c in carry if c not in keys],
        )
        .select(
            F.col("node_name").alias("__host"),
            to_begin("__b", resolution).alias("__begin"),
            to_end("__e", resolution).alias("__end"),
            *carry,
        )
    )
    shared = ["__begin", "__end", *[c for c in carry if c != "node_name"]]
    jobs = jobs.groupBy(*shared).agg(F.collect_list("__host").alias("__hosts"))
    jobs = by_tick(at_each_tick(jobs, "__begin", "__end", resolution, bucket))
    jobs = jobs.withColumn("__host", F.explode("__hosts")).withColumnRenamed(TICK, "__job_tick")
    jobs = jobs.select(*[F.col("__host").alias(c) if c == "node_name" else c for c in carry], "__begin", "__end", "__host", "__job_tick")
    points = by_tick(with_tick(telemetry, resolution, time_col))
    hit = (
        (F.col(TICK) == F.col("__job_tick"))
        & (F.col("hostname") == F.col("__host"))
        & F.col(time_col).between(F.col("__begin"), F.col("__end"))
    )
    return points.join(jobs.hint("merge"), hit).drop("__job_tick", "__begin", "__end", "__host")


def expand_job_ticks(pernode: DataFrame, resolution: str, time_col: str = "timestamp") -> DataFrame:
    """Every tick of every job on each of its nodes.

    The ends are rounded to the nearest tick.  The result is the product of
    jobs, nodes and ticks; to *join* with readings use
    :func:`join_jobs_by_time`, which never builds it.
    """
    ticks = pernode.select(
        "allocation_id",
        F.col("node_name").alias("hostname"),
        round_to("begin_time", resolution).alias("__first"),
        round_to("end_time", resolution).alias("__last"),
    )
    at = F.explode(steps_between(F.unix_micros("__first"), F.unix_micros("__last"), micros_of(resolution)))
    return (
        ticks.withColumn("__us", at)
        .select(F.timestamp_micros("__us").alias(time_col), "hostname", "allocation_id")
        # Spark's size estimate does not see the rows that explode adds.
        .hint("merge")
    )


def join_ticks(telemetry: DataFrame, ticks: DataFrame, time_col: str = "timestamp") -> DataFrame:
    """Node readings at the ticks of the jobs running there."""
    return telemetry.join(ticks, [time_col, "hostname"])


def jobs_at(
    events: DataFrame,
    pernode: DataFrame,
    time_col: str,
    bucket: str = "1 hour",
    host: str = "hostname",
    carry: list[str] = ("allocation_id",),
) -> DataFrame:
    """Jobs on the event's node whose interval (begin, end] holds the event.

    A node and job that the table has several times counts once, from the
    earliest begin to the latest end.
    """
    jobs = pernode.groupBy(F.col("node_name").alias("__host"), *carry).agg(
        F.min(as_timestamp("begin_time")).alias("__begin"), F.max(as_timestamp("end_time")).alias("__end")
    )
    jobs = explode_buckets(jobs, "__begin", "__end", bucket)
    points = events.withColumn("__at", bucket_of(time_col, bucket))
    hit = (
        (F.col(host) == F.col("__host"))
        & (F.col("__at") == F.col("__bucket"))
        & (as_timestamp(time_col) > F.col("__begin"))
        & (as_timestamp(time_col) <= F.col("__end"))
    )
    return points.join(jobs, hit).drop("__at", "__bucket", "__begin", "__end", "__host")


def exactly_one(matches: DataFrame, by: list[str]) -> DataFrame:
    """Only the rows whose key was matched exactly once.

    A ``groupBy`` with partial aggregation: a key with very many matches costs
    one partial row per task.
    """
    rest = [c for c in matches.columns if c not in by]
    picked = matches.groupBy(*by).agg(
        F.count(F.lit(1)).alias("__n"), F.min(F.struct(*rest)).alias("__row")
    )
    return picked.filter(F.col("__n") == 1).select(*by, *[F.col(f"__row.`{c}`").alias(c) for c in rest])


def with_facility(df: DataFrame, plant: DataFrame, time_col: str = "timestamp") -> DataFrame:
    """Add the cooling-plant readings of the same tick, where there are any."""
    return df.join(plant, time_col, "left")
