"""Whole jobs, from stored tables to stored tables.

Each is one logical plan; a stage is written where later jobs read it again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..functions import sensors
from ..functions.derive import add_node_maxima, add_node_sums
from ..functions.missing import nan_to_null
from ..operators import hier_agg
from ..operators.intervals import TICK, join_jobs_by_time, with_facility, with_tick
from ..operators.jobs import job_component_summary, job_component_ts, job_power_summary, job_power_ts
from ..operators.segments import power_segments, segment_profile
from ..operators.thermal import comptype_stats, thermal_bands


def load_readings(raw: DataFrame) -> DataFrame:
    """Raw readings with per-node sums and maxima."""
    return add_node_maxima(add_node_sums(nan_to_null(raw)))


def node_aggregates(
    readings: DataFrame, resolution: str = "10 seconds", values: list[str] | None = None
) -> DataFrame:
    """Readings to mean, std, min and max per node and tick."""
    groups = ["timestamp", "hostname"]
    values = values or hier_agg.value_columns(readings, groups)

    return hier_agg.finalize_agg(hier_agg.init_agg(readings, resolution, values=values), groups)


def job_power(nodes: DataFrame, pernode: DataFrame, resolution: str = "10 seconds") -> tuple[DataFrame, DataFrame]:
    """Series and summary of every job."""
    series = job_power_ts(nodes, pernode, resolution)
    return series, job_power_summary(series)


def job_components(nodes: DataFrame, pernode: DataFrame, resolution: str = "10 seconds") -> tuple[DataFrame, DataFrame]:
    series = job_component_ts(nodes, pernode, resolution)
    return series, job_component_summary(series)


def cluster_thermal(
    nodes: DataFrame, plant: DataFrame, cores: list[str] | None = None, mems: list[str] | None = None
) -> DataFrame:
    """Band counts of the machine with the cooling plant beside them."""
    return with_facility(thermal_bands(nodes, ["timestamp"], cores, mems), plant)


def job_thermal(nodes: DataFrame, pernode: DataFrame, plant: DataFrame, resolution: str = "10 seconds") -> DataFrame:
    """Band counts of each job; limits are open at both ends here."""
    joined = join_jobs_by_time(nodes, pernode, resolution, ends="nearest")
    bands = thermal_bands(joined, ["timestamp", "allocation_id"], value_range=sensors.JOB_BAND_RANGE)
    return with_facility(bands, plant)


def cluster_comptypes(nodes: DataFrame, plant: DataFrame, groups: dict[str, list[str]] | None = None) -> DataFrame:
    """Component statistics of the machine with the cooling plant beside them."""
    return with_facility(comptype_stats(nodes, ["timestamp"], groups), plant)


def job_comptypes(
    nodes: DataFrame,
    pernode: DataFrame,
    plant: DataFrame,
    resolution: str = "10 seconds",
    groups: dict[str, list[str]] | None = None,
) -> DataFrame:
    """Component statistics of each job with the cooling plant beside them."""
    nodes = with_tick(nodes, resolution)
    joined = join_jobs_by_time(nodes.select("timestamp", "hostname", TICK), pernode, resolution, ends="nearest")
    return with_facility(comptype_stats(nodes, ["timestamp", "allocation_id"], groups, members=joined), plant)


def power_dynamics(power: DataFrame, thermal: DataFrame, metrics: list[str], **limits) -> DataFrame:
    """Profile of all metrics around the edges of the machine's power; ``limits`` go to :func:`power_segments`."""
    series = power.join(thermal, "timestamp")
    return segment_profile(power_segments(series, metrics, **limits), metrics)
