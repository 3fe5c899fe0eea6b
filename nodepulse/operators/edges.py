"""Power edges, their durations, and dominant frequencies of single jobs.

A job series has one row per tick the job ran, so a job is never longer than the
recorded time (a year of 10 s ticks is 3.2 million numbers).  All windows are
per job and share one sort by (allocation_id, timestamp).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.derive import node_class
from ..functions.sensors import FULL_MACHINE_NODES, NODE_CUTS
from ..session import settle
from .intervals import by_job

EDGE_WATTS = 4_000_000.0
SPECTRUM_WATTS = 400_000.0
RETURN_SHARE = 0.8


def number_ticks(
    series: DataFrame,
    power: str = "sum_inp",
    count: str = "count_inp",
    size: str = "size_inp",
    time_col: str = "timestamp",
    cuts=NODE_CUTS,
) -> DataFrame:
    """Per job: tick index, length, change to the next tick, nodes at the start, gaps."""
    at = Window.partitionBy("allocation_id").orderBy(time_col)
    whole = Window.partitionBy("allocation_id")
    return by_job(series).select(
        "allocation_id",
        F.col(time_col),
        F.col(power).alias("power"),
        (F.row_number().over(at) - 1).alias("idx"),
        F.count(F.lit(1)).over(whole).alias("rows"),
        (F.lead(power).over(at) - F.col(power)).alias("diff"),
        F.first_value(count).over(at).alias("nodes"),
        F.max((F.col(count) != F.col(size)).cast("int")).over(whole).alias("has_gap"),
    ).withColumn("class", node_class("nodes", cuts))


def clean_jobs(numbered: DataFrame) -> DataFrame:
    """Jobs whose every tick has all readings, and that last more than one tick."""
    return numbered.filter((F.col("has_gap") == 0) & (F.col("rows") > 1))


def _threshold(watts: float, full_size: int) -> Column:
    return F.lit(watts) * F.col("nodes") / F.lit(float(full_size))


def mark_edges(clean: DataFrame, watts: float = EDGE_WATTS, full_size: int = FULL_MACHINE_NODES) -> DataFrame:
    """Direction of each tick's change when it is large for the job's size.

    ``direction`` is 1, -1 or 0.  ``starts`` is true for the first of a run of
    edges in the same direction.
    """
    limit = _threshold(watts, full_size)
    direction = F.when(F.col("diff") > limit, 1).when(F.col("diff") < -limit, -1).otherwise(0)
    marked = clean.withColumn("direction", direction)
    before = F.lag("direction").over(Window.partitionBy("allocation_id").orderBy("idx"))
    fresh = F.coalesce(before, F.lit(0)) != F.col("direction")
    return marked.withColumn("starts", (F.col("direction") != 0) & fresh)


def job_edges(series: DataFrame, watts: float = EDGE_WATTS, full_size: int = FULL_MACHINE_NODES, cuts=NODE_CUTS) -> DataFrame:
    """The edges themselves."""
    marked = mark_edges(clean_jobs(number_ticks(series, cuts=cuts)), watts, full_size)
    return marked.filter(F.col("direction") != 0).select(
        "allocation_id", "class", "idx", "direction", "starts", "diff", "power"
    )


def distinct_edges(edges: DataFrame) -> DataFrame:
    """One edge per run of neighbouring edges in the same direction."""
    return edges.filter("starts")


def edges_per_job(series: DataFrame, watts: float = EDGE_WATTS, full_size: int = FULL_MACHINE_NODES, cuts=NODE_CUTS) -> DataFrame:
    """Edges of each clean job by direction, with 0 where there are none."""
    marked = mark_edges(clean_jobs(number_ticks(series, cuts=cuts)), watts, full_size)

    def total(direction: int, only_starts: bool) -> Column:
        hit = F.col("direction") == direction
        return F.sum((hit & F.col("starts") if only_starts else hit).cast("int"))

    wide = marked.groupBy("allocation_id", "class").agg(
        total(1, False).alias("rise_all"),
        total(1, True).alias("rise_starts"),
        total(-1, False).alias("fall_all"),
        total(-1, True).alias("fall_starts"),
    )
    return wide.select(
        "allocation_id",
        "class",
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(label).alias("type"),
                        F.col(f"{part}_all").alias("n_edges"),
                        F.col(f"{part}_starts").alias("n_distinct_edges"),
                    )
                    for label, part in (("Rising", "rise"), ("Falling", "fall"))
                ]
            )
        ),
    )


class RangeTable:
    """Lowest value of each aligned stretch of a series, for finding the next low value in steps of the logarithm.

    Node 1 spans the whole series, node k the two halves 2k and 2k+1; ``size`` is the number of the first leaf.
    """

    def __init__(self, values: np.ndarray):
        self.length = len(values)
        self.size = 1 << max(0, self.length - 1).bit_length()
        self.lowest = np.full(2 * self.size, np.inf)
        self.lowest[self.size : self.size + self.length] = values
        half = self.size
        while half > 1:
            level = self.lowest[half : 2 * half]
            half //= 2
            self.lowest[half : 2 * half] = np.minimum(level[::2], level[1::2])

    def next_at_most(self, start: np.ndarray, limit: np.ndarray) -> np.ndarray:
        """First place from ``start`` on with a value of at most ``limit``, for many searches at once; else the length."""
        node = np.where(start < self.length, start + self.size, 0)
        open_ = np.flatnonzero((node > 0) & ~(self.lowest[node] <= limit))
        while len(open_):
            after = node[open_] + 1
            after //= after & -after  # the largest stretch that begins there
            after[after == 1] = 0  # past the end
            node[open_] = after
            open_ = open_[(after > 0) & ~(self.lowest[after] <= limit[open_])]
        inner = np.flatnonzero((node > 0) & (node < self.size))
        while len(inner):
            left = 2 * node[inner]
            node[inner] = left + ~(self.lowest[left] <= limit[inner])
            inner = inner[node[inner] < self.size]
        return np.where(node > 0, node - self.size, self.length)


def _lengths(power: np.ndarray, edges_at, share: float) -> list[int]:
    """Duration of each edge of one job, in ticks.

    The search is for the first value on another side of the level (above, at or
    below it) than the first value after the edge.
    """
    begin, at = power[:-1], np.asarray(edges_at, np.int64)
    if not len(begin):
        return [1] * len(at)
    level, start = share * begin[at], at + 1
    later = len(begin) - start
    first = np.where(later > 0, begin[np.minimum(start, len(begin) - 1)], level)
    side = np.sign(first - level)
    # A missing value is on no side.
    low = RangeTable(np.where(np.isnan(begin), -np.inf, begin))
    high = RangeTable(np.where(np.isnan(begin), -np.inf, -begin))
    down = np.where(side == 0, np.nextafter(level, -np.inf), level)
    up = np.where(side == 0, np.nextafter(-level, -np.inf), -level)
    below = low.next_at_most(np.where(side >= 0, start + 1, len(begin)), down)
    above = high.next_at_most(np.where(side <= 0, start + 1, len(begin)), up)
    found = np.minimum(below, above)
    found = np.where(np.isnan(side), np.minimum(start + 1, len(begin)), found)
    ticks = np.where(later > 0, found - start, 0)
    # A crossing at position p ends the stretch after p ticks; no crossing adds one.
    return np.where(ticks == np.maximum(later, 0), ticks + 1, ticks).tolist()


def _as_arrays(ticks: DataFrame, cols: list[str]) -> DataFrame:
    """One row per job with its ticks in order, as an array of structs.

    The ticks are partitioned by job already.  A job's array is as long as the
    job, never longer than the recorded time.
    """
    return ticks.groupBy("allocation_id", "class").agg(F.array_sort(F.collect_list(F.struct(*cols))).alias("ticks"))


def edge_durations(
    series: DataFrame,
    watts: float = EDGE_WATTS,
    full_size: int = FULL_MACHINE_NODES,
    share: float = RETURN_SHARE,
    cuts=NODE_CUTS,
    ticks_per_minute: float = 6.0,
) -> DataFrame:
    """How long the power stays on its side of ``share`` times the power before the edge.

    The search ends one tick before the job's last.  Each edge looks for its own
    level, which no window frame can do, so the search runs in numpy: on arrays,
    many jobs to a call, and only for jobs that have an edge.  All edges of a job
    search together in a table of ranges, in time of the job's ticks plus the
    edges times their logarithm.
    """
    marked = mark_edges(clean_jobs(number_ticks(series, cuts=cuts)), watts, full_size)
    mark = F.when(F.col("starts"), F.col("direction")).otherwise(0)
    jobs = _as_arrays(marked.withColumn("mark", mark), ["idx", "power", "mark"])

    @F.pandas_udf("array<bigint>")
    def measure(power: pd.Series, edges_at: pd.Series) -> pd.Series:
        return pd.Series([_lengths(np.asarray(p, float), at, share) for p, at in zip(power, edges_at)])

    edges = F.filter("ticks", lambda t: t["mark"] != 0)
    measured = (
        jobs.filter(F.exists("ticks", lambda t: t["mark"] != 0))
        .select("allocation_id", "class", F.col("ticks.power").alias("power"), edges.alias("edges"))
        .withColumn("duration", measure("power", F.col("edges.idx")))
    )
    pairs = F.arrays_zip(F.col("edges.idx").alias("idx"), F.col("edges.mark").alias("mark"), F.col("duration"))
    return measured.select("allocation_id", "class", F.inline(pairs)).select(
        "allocation_id",
        "class",
        "idx",
        F.when(F.col("mark") > 0, "Rising").otherwise("Falling").alias("type"),
        "duration",
        (F.col("duration") / F.lit(ticks_per_minute)).alias("minutes"),
    )


def edge_snapshots(
    series: DataFrame,
    reach: int = 15,
    watts: float = EDGE_WATTS,
    min_nodes: int = 2764,
    count: str = "count_inp",
) -> DataFrame:
    """Changes from ``reach`` ticks before to ``reach + 1`` after the large edges of large jobs.

    The threshold is not scaled by job size.  Edges without a full stretch are
    left out before runs are reduced to their first edge.  The ticks of the large
    jobs are read twice and so settled.
    """
    large = settle(clean_jobs(number_ticks(series.filter(F.col(count) > min_nodes))))
    direction = F.when(F.col("diff") > watts, 1).when(F.col("diff") < -watts, -1).otherwise(0)
    whole = (F.col("idx") >= reach) & (F.col("idx") + reach + 1 < F.col("rows") - 1)
    marked = large.withColumn("direction", F.when(whole, direction).otherwise(0))
    before = F.lag("direction", 1, 0).over(Window.partitionBy("allocation_id").orderBy("idx"))
    starts = marked.withColumn("__before", before).filter(
        (F.col("direction") != 0) & (F.col("__before") != F.col("direction"))
    )
    wanted = starts.select(
        "allocation_id",
        F.when(F.col("direction") > 0, "Rising").otherwise("Falling").alias("type"),
        F.col("idx").alias("edge_index"),
        F.col("diff").alias("edge_diff"),
        F.explode(F.sequence(F.lit(-reach), F.lit(reach + 1))).alias("offset"),
    ).withColumn("idx", F.col("edge_index") + F.col("offset"))
    return wanted.join(large.select("allocation_id", "idx", "diff"), ["allocation_id", "idx"]).drop("idx")


def reintegrate(snapshots: DataFrame) -> DataFrame:
    """Power relative to the first tick of each snapshot: running sum of the changes before."""
    at = Window.partitionBy("allocation_id", "type", "edge_index").orderBy("offset")
    total = F.sum("diff").over(at.rowsBetween(Window.unboundedPreceding, -1))
    return snapshots.withColumn("relative_power", F.coalesce(total, F.lit(0.0)))


def edge_extremes(edges: DataFrame, diff: str = "diff") -> DataFrame:
    """Steepest rise and steepest fall."""
    return edges.agg(F.max(diff).alias("steepest_rise"), F.min(diff).alias("steepest_fall"))


def _spectrum_input(series: DataFrame, watts: float, drop_watts: float, full_size: int, cuts) -> DataFrame:
    per_job = Window.partitionBy("allocation_id")
    clean = clean_jobs(number_ticks(series, cuts=cuts))
    largest = F.max(F.abs("diff")).over(per_job)
    kept = clean.withColumn("__largest", largest).filter(F.col("__largest") >= _threshold(watts, full_size))
    small = F.abs("diff") < _threshold(drop_watts, full_size)
    return kept.filter(F.col("diff").isNotNull()).select(
        "allocation_id", "class", "rows", "idx", F.when(small, F.lit(0.0)).otherwise(F.col("diff")).alias("diff")
    )


def _strongest(changes: np.ndarray, top_n: int, tick_seconds: float) -> tuple[list[float], list[float]]:
    """Frequencies and squared amplitudes of one job, strongest first, without zeros."""
    strength = np.abs(np.fft.rfft(changes)) ** 2
    if strength.max() == 0:
        return [], []
    freq = np.fft.rfftfreq(len(changes), tick_seconds)
    ranked = np.lexsort((freq, -np.round(strength / strength.max(), 9)))
    picked = [k for k in ranked[:top_n] if strength[k] > 0]
    return list(freq[picked]), list(strength[picked])


def job_spectrum(
    series: DataFrame,
    top_n: int = 1,
    watts: float = SPECTRUM_WATTS,
    drop_watts: float = 0.0,
    tick_seconds: float = 10.0,
    full_size: int = FULL_MACHINE_NODES,
    cuts=NODE_CUTS,
) -> DataFrame:
    """The ``top_n`` strongest frequencies in the changes of each job's power.

    Jobs without a change that is large for their size are filtered out before
    any row leaves the JVM.  Of frequencies equally strong (up to rounding) the
    lowest wins.
    """
    kept = _spectrum_input(series, watts, drop_watts, full_size, cuts).filter(F.col("rows") - 1 > 2 * top_n)
    jobs = _as_arrays(kept, ["idx", "diff"])

    @F.pandas_udf("freq array<double>, amp array<double>")
    def strongest(changes: pd.Series) -> pd.DataFrame:
        found = [_strongest(np.asarray(c, float), top_n, tick_seconds) for c in changes]
        return pd.DataFrame({"freq": [f for f, _ in found], "amp": [a for _, a in found]})

    top = jobs.withColumn("top", strongest("ticks.diff"))
    pairs = F.arrays_zip(F.col("top.freq").alias("freq"), F.col("top.amp").alias("amp"))
    ticks = (F.size("ticks") + 1).cast("bigint").alias("ticks")
    return top.select("allocation_id", "class", ticks, F.inline(pairs))


def spectrum_features(spectrum: DataFrame, ticks_per_minute: float = 6.0) -> DataFrame:
    """Logarithm of the amplitude, and job length in minutes."""
    return spectrum.filter(F.col("amp") != 0).withColumns(
        {"amp_log": F.log10(F.sqrt("amp")), "minutes": F.col("ticks") / F.lit(ticks_per_minute)}
    )


def job_tallies(
    series: DataFrame, top_n: int = 1, watts: float = SPECTRUM_WATTS, full_size: int = FULL_MACHINE_NODES, cuts=NODE_CUTS
) -> DataFrame:
    """Per class: jobs, and how many the spectrum leaves out for which reason."""
    jobs = (
        number_ticks(series, cuts=cuts)
        .groupBy("allocation_id", "class", "nodes", "rows", "has_gap")
        .agg(F.max(F.abs("diff")).alias("largest"))
    )
    gap = F.col("has_gap") == 1
    short = ~gap & (F.col("rows") <= 1)
    quiet = ~gap & ~short & (F.col("largest") < _threshold(watts, full_size))
    few = ~gap & ~short & ~quiet & (F.col("rows") - 1 <= 2 * top_n)
    flags = {"sensor_errors": gap, "short": short, "below_threshold": quiet, "too_short": few}
    return jobs.groupBy("class").agg(
        F.count(F.lit(1)).alias("jobs"), *[F.sum(flag.cast("int")).alias(name) for name, flag in flags.items()]
    )


def leadership_jobs(
    series: DataFrame, min_nodes: int = 4000, time_col: str = "timestamp", ticks_per_minute: float = 6.0
) -> DataFrame:
    """Power curves of the largest jobs by minute since their first tick."""
    at = Window.partitionBy("allocation_id").orderBy(time_col)
    return series.filter(F.col("job_sch_node_num") > min_nodes).select(
        "allocation_id",
        F.col(time_col),
        ((F.row_number().over(at) - 1) / F.lit(ticks_per_minute)).alias("minute"),
        "sum_inp",
    )
