"""Power of the whole machine over time.

Input rows are node aggregates: one row per (timestamp, hostname), so a tick
has as many rows as the machine has nodes, whatever the recorded time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.derive import add_component_power, add_supply_sum
from .order_stats import grouped_stats

POWER_KINDS = ("count", "size", "sum", "mean", "std", "max", "min", "q25", "q50", "q75")
COMPONENT_KINDS = ("mean", "std", "min", "max", "q25", "q50", "q75", "count", "size")

#: Short name of each power series and the sensor behind it.
SERIES = {
    "inp": "input_power_mean",
    "top": "total_power_mean",
    "ps0": "ps0_input_power_mean",
    "ps1": "ps1_input_power_mean",
    "ps_1_2": "ps_1_2_input_power_mean",
}

COMPONENT_SPECS = [(f"{part}_power", f"{part}_power", COMPONENT_KINDS) for part in ("cpu", "gpu")]


def missing_sums() -> list:
    """Missing CPU and GPU sensors of all nodes of a group."""
    return [F.sum(f"{part}_nan").alias(f"{part}_nans") for part in ("cpu", "gpu")]


def cluster_power_ts(nodes: DataFrame, time_col: str = "timestamp") -> DataFrame:
    """Five power series, ten statistics each, per tick."""
    df = add_supply_sum(nodes).select(time_col, *SERIES.values())
    specs = [(col, name, POWER_KINDS) for name, col in SERIES.items()]
    return grouped_stats(df, [time_col], specs)


def cluster_component_ts(nodes: DataFrame, time_col: str = "timestamp") -> DataFrame:
    """CPU and GPU power statistics per tick, with the number of missing sensors."""
    df = add_component_power(nodes).select(time_col, "cpu_power", "cpu_nan", "gpu_power", "gpu_nan")
    return grouped_stats(df, [time_col], COMPONENT_SPECS, missing_sums())
