"""Power and energy of jobs.

A job at a tick has at most one row per node it holds, which bounds the group.

The series have one row per (timestamp, allocation_id); a job therefore has at
most as many rows as the recorded time has ticks, whatever the machine's size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.derive import account_domain, add_component_power
from ..functions.timegrid import seconds_between
from .cluster import COMPONENT_SPECS, POWER_KINDS, missing_sums
from .intervals import join_jobs_by_time
from .order_stats import grouped_stats


def _node_counts() -> list:
    return [
        F.count("hostname").alias("count_hostname"),
        F.count("node_name").alias("count_node_name"),
        F.min("num_nodes").alias("job_sch_node_num"),
    ]


def job_power_ts(
    nodes: DataFrame,
    pernode: DataFrame,
    resolution: str = "10 seconds",
    bucket: str = "1 hour",
    time_col: str = "timestamp",
) -> DataFrame:
    """Input and total power statistics of each job at each tick."""
    slim = nodes.select(time_col, "hostname", "input_power_mean", "total_power_mean")
    joined = join_jobs_by_time(slim, pernode, resolution, bucket, time_col)
    specs = [("input_power_mean", "inp", POWER_KINDS), ("total_power_mean", "top", POWER_KINDS)]
    return grouped_stats(joined, [time_col, "allocation_id"], specs, _node_counts())


def job_component_ts(
    nodes: DataFrame,
    pernode: DataFrame,
    resolution: str = "10 seconds",
    bucket: str = "1 hour",
    time_col: str = "timestamp",
) -> DataFrame:
    """CPU and GPU power statistics of each job at each tick."""
    slim = add_component_power(nodes).select(time_col, "hostname", "cpu_power", "cpu_nan", "gpu_power", "gpu_nan")
    joined = join_jobs_by_time(slim, pernode, resolution, bucket, time_col)
    extra = [*_node_counts(), *missing_sums()]
    return grouped_stats(joined, [time_col, "allocation_id"], COMPONENT_SPECS, extra)


def job_power_summary(series: DataFrame, time_col: str = "timestamp") -> DataFrame:
    """One row per job from its power series."""
    return series.groupBy("allocation_id").agg(
        F.max("sum_top").alias("max_sum_top"),
        F.max("sum_inp").alias("max_sum_inp"),
        F.avg("sum_inp").alias("mean_sum_inp"),
        F.max("max_inp").alias("max_max_inp"),
        F.min("min_inp").alias("min_min_inp"),
        F.max("count_inp").alias("max_hosts_count"),
        F.max("size_inp").alias("max_hosts_size"),
        F.min(time_col).alias("begin_time"),
        F.max(time_col).alias("end_time"),
    )


def job_component_summary(series: DataFrame, time_col: str = "timestamp") -> DataFrame:
    """One row per job from its component series; the count is that of the first tick."""
    aggs = []
    for part in ("cpu", "gpu"):
        mean = f"mean_{part}_power"
        aggs += [
            F.avg(mean).alias(f"mean_mean_{part}_pwr"),
            F.max(mean).alias(f"max_mean_{part}_pwr"),
            F.min(mean).alias(f"min_mean_{part}_pwr"),
            F.max(f"max_{part}_power").alias(f"max_max_{part}_pwr"),
            F.min_by(f"count_{part}_power", time_col).alias(f"count_{part}_power"),
        ]
    aggs += [F.min(time_col).alias("begin_time"), F.max(time_col).alias("end_time")]
    return series.groupBy("allocation_id").agg(*aggs)


def first_day_jobs(series: DataFrame, horizon_days: int | None = None, time_col: str = "timestamp") -> DataFrame:
    """Assign every row of a job to the day the job was first seen.

    With ``horizon_days`` rows later than that many days after the first day are
    dropped, which is how per-day processing sees long jobs.
    """
    per_job = Window.partitionBy("allocation_id")
    df = series.withColumn("first_date", F.min(F.to_date(time_col)).over(per_job))
    if horizon_days is not None:
        df = df.filter(F.to_date(time_col) <= F.date_add("first_date", horizon_days))
    return df


def _ran_the_day_before(series: DataFrame, time_col: str) -> DataFrame:
    """Adds ``date`` and whether the job has rows on the day before; one sort, no self-join."""
    dated = series.withColumn("date", F.to_date(time_col))
    yesterday = Window.partitionBy("allocation_id").orderBy(F.unix_date("date")).rangeBetween(-1, -1)
    return dated.withColumn("__ran", F.count(F.lit(1)).over(yesterday) > 0)


def continued_jobs(series: DataFrame, time_col: str = "timestamp") -> DataFrame:
    """Rows of a job on the day after a day it also ran."""
    return _ran_the_day_before(series, time_col).filter("__ran").drop("__ran")


def new_jobs(series: DataFrame, time_col: str = "timestamp") -> DataFrame:
    """Rows of a job on a day it did not run the day before."""
    return _ran_the_day_before(series, time_col).filter("not __ran").drop("__ran")


def job_energy(pernode: DataFrame) -> DataFrame:
    """Energy and size of each job.

    Fields that are the same on all rows of a job are taken by ``min``, which
    does not depend on row order.
    """
    return (
        pernode.groupBy("allocation_id", "primary_job_id")
        .agg(
            F.coalesce(F.sum("energy"), F.lit(0.0)).alias("energy"),
            F.coalesce(F.sum("gpu_energy"), F.lit(0.0)).alias("gpu_energy"),
            F.min("num_nodes").alias("num_nodes"),
            F.min("num_gpus").alias("num_gpus"),
            F.min("begin_time").alias("begin_time"),
            F.min("end_time").alias("end_time"),
            F.min("account").alias("account"),
        )
        .withColumn("job_domain", account_domain("account"))
        .withColumn("job_time", seconds_between("begin_time", "end_time"))
    )


def job_sizes(pernode: DataFrame, out: str = "size") -> DataFrame:
    """Node rows per job."""
    return pernode.groupBy("allocation_id").agg(F.count(F.lit(1)).alias(out))


def with_job_size(jobs: DataFrame, pernode: DataFrame) -> DataFrame:
    """Jobs that have node rows, with their number and the node-hours used."""
    hours = seconds_between("begin_time", "end_time") / F.lit(3600.0) * F.col("size")
    return jobs.join(job_sizes(pernode), "allocation_id").withColumn("node_hours", hours)
