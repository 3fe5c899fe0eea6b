"""Temperature bands, hot components and component-type statistics."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import sensors
from ..functions.bands import band_counts, hot_mask
from ..functions.missing import any_null
from .intervals import TICK, tick_of
from .moments import group_numbers

COMPTYPE_KINDS = ("mean", "std", "min", "max", "q25", "q50", "q75", "size", "count")
#: Temperature that deviations are summed up around.
MIDDLE = 50
#: Temperatures that are sorted at once.
CELLS = 1 << 20


def add_thermal_flags(
    df: DataFrame,
    cores: list[str],
    mems: list[str],
    host: str = "hostname",
    cuts=sensors.BAND_CUTS,
    low: float | None = None,
    high: float | None = None,
) -> DataFrame:
    """Per node row: missing flag, hot mask, and components per band."""
    return df.withColumns(
        {
            "any_nan": any_null(cores + mems),
            "hot_gpus": hot_mask(host, cores + mems, cuts[1], low, high),
            **band_counts(cores, "n_cores", cuts, low, high),
            **band_counts(mems, "n_mems", cuts, low, high),
        }
    )


def thermal_bands(
    df: DataFrame,
    keys: list[str],
    cores: list[str] | None = None,
    mems: list[str] | None = None,
    host: str = "hostname",
    value_range: tuple[float | None, float | None] = sensors.CLUSTER_BAND_RANGE,
) -> DataFrame:
    """Nodes, nodes with missing sensors, hot masks and band totals per group.

    The list of masks is the result asked for; it has at most one entry per node
    of the group, and none for nodes without a hot component.
    """
    cores = cores or sensors.mean_of(sensors.GPU_CORE_TEMPS)
    mems = mems or sensors.mean_of(sensors.GPU_MEM_TEMPS)
    tick = tick_of(df, keys)
    keys = [*keys, *tick]
    ids = [*keys, *([] if host in keys else [host])]
    low, high = value_range
    flagged = add_thermal_flags(df.select(*ids, *cores, *mems), cores, mems, host, low=low, high=high)
    counts = [f"n_{part}_band{k}" for part in ("cores", "mems") for k in range(len(sensors.BAND_CUTS) + 1)]
    return flagged.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("nodes"),
        F.sum(F.col("any_nan").cast("int")).alias("any_nan"),
        F.array_sort(F.collect_list("hot_gpus")).alias("hot_gpus"),
        *[F.sum(c).alias(c) for c in counts],
    ).drop(*tick)


def counted_values(df: DataFrame, keys: list[str], groups: dict[str, list[str]]) -> DataFrame:
    """How often each temperature occurs: ``keys``, ``comptype``, ``temp`` (missing ones too) and ``n``.

    A state that merges by putting tables together: days, or the two halves of a
    day, may be counted apart.  Each Arrow batch is counted by numpy, so a
    reading never becomes a row for each of its sensors; nodes of one tick have
    mostly the same few hundred temperatures.
    """
    columns = [c for cols in groups.values() for c in cols]
    rows = df.select(*keys, *[F.col(f"`{c}`").cast("double").alias(f"__{i}") for i, c in enumerate(columns)])
    ends = np.cumsum([len(keys), *[len(cols) for cols in groups.values()]]).tolist()
    parts = list(zip(groups, ends, ends[1:], strict=False))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place, first = group_numbers([batch.column(k) for k in range(len(keys))])
            for kind, a, b in parts:
                temps = np.column_stack([batch.column(k).to_numpy(zero_copy_only=False) for k in range(a, b)])
                values, number = np.unique(temps, return_inverse=True)
                pairs = np.repeat(place, b - a) * len(values) + number.ravel()
                pairs, n = np.unique(pairs, return_counts=True)
                group, value = np.divmod(pairs, max(1, len(values)))
                at = pa.array(first[group])
                made = [pa.array([kind] * len(n), pa.string()), pa.array(values[value], from_pandas=True), pa.array(n, pa.int64())]
                yield pa.RecordBatch.from_arrays([*[batch.column(k).take(at) for k in range(len(keys))], *made], names=names)

    names = [*keys, "comptype", "temp", "n"]
    types = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rows.schema[: len(keys)])
    return rows.mapInArrow(count, types + "comptype string, temp double, n long")


def stats_of_counts(state: DataFrame, keys: list[str], kinds: list[str]) -> DataFrame:
    """``type_kind`` statistics of each group from (any number of) tables of :func:`counted_values`.

    Deviations are summed up around a fixed temperature, so that partial sums
    add and the square of the mean cancels little.
    """
    cols = []
    for kind in kinds:
        own = f"filter (where comptype = '{kind}')"
        n = f"sum(if(temp is null, 0L, n)) {own}"
        off = f"(sum((temp - {MIDDLE}D) * n) {own})"
        squares = f"(sum((temp - {MIDDLE}D) * (temp - {MIDDLE}D) * n) {own})"
        quartiles = f"percentile(temp, array(0.25D, 0.5D, 0.75D), n) {own}"
        make = {
            "mean": f"{MIDDLE}D + try_divide({off}, {n})",
            "std": f"if({n} > 1, sqrt(greatest({squares} - {off} * {off} / {n}, 0D) / ({n} - 1)), null)",
            "min": f"min(temp) {own}",
            "max": f"max(temp) {own}",
            "q25": f"({quartiles})[0]",
            "q50": f"({quartiles})[1]",
            "q75": f"({quartiles})[2]",
            "size": f"sum(n) {own}",
            "count": n,
        }
        cols += [F.expr(f"{make[k]} as `{kind}_{k}`") for k in COMPTYPE_KINDS]
    return state.groupBy(*keys).agg(*cols)


class Ranked:
    """The temperatures of a tick's readings as their places among the tick's different ones, missing last, and each reading's own sums."""

    def __init__(self, temps: np.ndarray):
        self.values, number = np.unique(temps, return_inverse=True)
        self.number = number.reshape(temps.shape).astype(np.int32 if len(self.values) < 1 << 31 else np.int64)
        there = ~np.isnan(temps)
        off = np.where(there, temps - MIDDLE, 0.0)
        self.sums = there.sum(axis=1), off.sum(axis=1), (off * off).sum(axis=1)

    def stats(self, rows: np.ndarray, starts: np.ndarray) -> list[np.ndarray]:
        """COMPTYPE_KINDS of each group of readings; the groups lie in ``rows`` one after another.

        Sums are put together from those of the readings.  Groups of as many readings are a matrix, of which each row is
        sorted, about CELLS temperatures at a time.
        """
        size = np.diff(np.r_[starts, len(rows)])
        width = self.number.shape[1]
        n, total, squares = (np.add.reduceat(x[rows], starts) for x in self.sums)
        quartiles = np.full((5, len(starts)), np.nan)
        by_size = np.argsort(size, kind="stable")
        for same in np.split(by_size, np.flatnonzero(np.diff(size[by_size])) + 1):
            readings = size[same[0]]
            most = max(1, CELLS // (readings * width))
            for some in (same[k : k + most] for k in range(0, len(same), most)):
                ranks = self.number[rows[starts[some][:, None] + np.arange(readings)]].reshape(len(some), -1)
                ranks.sort(axis=1)
                last, each = np.maximum(n[some] - 1, 0), np.arange(len(some))
                for k, share in enumerate((0.0, 1.0, 0.25, 0.5, 0.75)):
                    place = share * last
                    low = np.floor(place).astype(np.int64)
                    below, above = self.values[ranks[each, low]], self.values[ranks[each, np.ceil(place).astype(np.int64)]]
                    quartiles[k, some] = np.where(above == below, below, below + (above - below) * (place - low))
        with np.errstate(all="ignore"):
            mean = MIDDLE + total / np.where(n > 0, n, np.nan)
            std = np.sqrt(np.maximum(squares - total * total / n, 0) / np.where(n > 1, n - 1, np.nan))
        return [mean, std, *quartiles, size * width, n]


def member_stats(df: DataFrame, members: DataFrame, keys: list[str], groups: dict[str, list[str]], host: str = "hostname") -> DataFrame:
    """:func:`comptype_stats` of the groups that ``members`` (``keys``, ``host``, tick) makes of the readings ``df``.

    The readings of a tick meet its members in one call, a row for each node
    there and for each job and node here; a reading is looked up for each of its
    groups and never written again.  Of a node's time, both tables have the tick.
    """
    time = next(k for k in keys if k in df.columns)
    columns = [c for cols in groups.values() for c in cols]
    readings = df.select(TICK, time, host, *[F.col(f"`{c}`").cast("double").alias(f"__{i}") for i, c in enumerate(columns)])
    ends = np.cumsum([3, *[len(cols) for cols in groups.values()]]).tolist()
    parts = list(zip(ends, ends[1:], strict=False))
    names = [*keys, *[f"{kind}_{k}" for kind in groups for k in COMPTYPE_KINDS]]
    whole = {"size", "count"}

    def of_tick(left: pa.Table, right: pa.Table) -> pa.Table:
        # A node's readings of one time lie together; a member wants all of them.
        place, _ = group_numbers([pa.chunked_array([*left[c].chunks, *right[f"__of_{c}"].chunks]).combine_chunks() for c in (time, host)])
        here, there = place[: left.num_rows], place[left.num_rows :]
        order = np.argsort(here, kind="stable")
        held = np.bincount(here, minlength=int(place.max()) + 1)
        ids = [right[f"__of_{k}"].combine_chunks() for k in keys]
        group, first = group_numbers(ids)
        # The same node and time counts once in a group.
        pairs = np.sort(group * len(held) + there)
        group, there = np.divmod(pairs[np.r_[True, np.diff(pairs) != 0][: len(pairs)]], len(held))
        low, many = (np.cumsum(held) - held)[there], held[there]
        rows = order[np.repeat(low, many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)]
        group = np.repeat(group, many)
        starts = np.flatnonzero(np.r_[True, np.diff(group) != 0]) if len(group) else np.zeros(0, np.int64)
        found = group[starts]
        made: list[pa.Array] = []
        for a, b in parts:
            temps = np.column_stack([left.column(k).to_numpy() for k in range(a, b)])
            got = Ranked(temps).stats(rows, starts) if len(starts) else [np.zeros(0)] * len(COMPTYPE_KINDS)
            for kind, column in zip(COMPTYPE_KINDS, got, strict=True):
                made.append(pa.array(column.astype(np.int64)) if kind in whole else pa.array(column, pa.float64(), from_pandas=True))
        at = pa.array(first[found])
        return pa.Table.from_arrays([*[k.take(at) for k in ids], *made], names=names)

    types = [f"`{k}` {members.schema[k].dataType.simpleString()}" for k in keys]
    types += [f"`{kind}_{k}` {'long' if k in whole else 'double'}" for kind in groups for k in COMPTYPE_KINDS]
    # Columns of both tables may come from one, so these get names of their own.
    wanted = members.select(*[F.col(c).alias(f"__of_{c}") for c in dict.fromkeys([TICK, time, host, *keys])])
    return readings.groupBy(TICK).cogroup(wanted.groupBy(f"__of_{TICK}")).applyInArrow(of_tick, ", ".join(types))


def comptype_stats(
    df: DataFrame, keys: list[str], groups: dict[str, list[str]] | None = None, members: DataFrame | None = None
) -> DataFrame:
    """Statistics of all temperatures of each component type, ``type_kind`` columns.

    One pass and one shuffle, of partial counts.  A group has at most as many
    different temperatures as readings of a tick.  With ``members``, the matches
    of :func:`join_jobs_by_time`, groups are theirs; see :func:`member_stats`.
    """
    groups = groups or {kind: sensors.mean_of(cols) for kind, cols in sensors.COMPONENT_TYPES.items()}
    if members is not None:
        return member_stats(df, members, keys, groups)
    return stats_of_counts(counted_values(df, keys, groups), keys, list(groups))
