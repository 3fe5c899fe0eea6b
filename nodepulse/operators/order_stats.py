"""Exact ranks and quantiles.

Two situations, two plans:

* Many groups of bounded size (one tick of one machine: a row per node).  The
  built-in exact ``percentile`` is one aggregate among others; see
  :func:`stats_of`.
* Few groups of any size (a size class, a project, a week: one may hold a third
  of all rows).  :func:`value_ranks` counts equal values first, deals the counts
  out by ranges of (keys, value), sums the parts, and ranks inside a part only.
  How many parts there are is the cluster's own setting; no task sees a group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import settle
from .intervals import tick_of


def stats_of(col: str, name: str, kinds) -> list[Column]:
    """Aggregates ``kind_name`` of one column.

    ``sum`` of nothing is 0, ``size`` counts rows and ``count`` readings;
    quantiles interpolate between neighbours.  All quantiles of a column are
    taken from one ``percentile``, so its values are held once.
    """
    x = f"cast(`{col}` as double)"
    quartiles = f"percentile({x}, array(0.25D, 0.5D, 0.75D))"
    make = {
        "count": f"count({x})",
        "size": "count(1)",
        "sum": f"coalesce(sum({x}), 0D)",
        "mean": f"avg({x})",
        "std": f"stddev_samp({x})",
        "min": f"min({x})",
        "max": f"max({x})",
        "q25": f"{quartiles}[0]",
        "q50": f"{quartiles}[1]",
        "q75": f"{quartiles}[2]",
    }
    return [F.expr(f"{make[k]} as `{k}_{name}`") for k in kinds]


def _same(keys: list[str], left: str, right: str) -> Column:
    """Join condition on ``keys`` and the part."""
    condition = F.col(f"{left}.__part") == F.col(f"{right}.__part")
    for k in keys:
        condition = condition & F.col(f"{left}.`{k}`").eqNullSafe(F.col(f"{right}.`{k}`"))
    return condition


def dealt_values(df: DataFrame, keys: list[str], col: str) -> DataFrame:
    """How often each value occurs in its group (``n``), dealt out by ranges of (keys, value), ``__part`` each.

    Settled: which range is which partition is decided once, and the input is
    computed once however often the values are read.
    """
    x = df.select(*keys, F.col(col).cast("double").alias("value")).filter(F.col("value").isNotNull())
    counts = x.groupBy(*keys, "value").agg(F.count(F.lit(1)).alias("n"))
    return settle(counts.repartitionByRange(*keys, "value").withColumn("__part", F.spark_partition_id()))


def value_ranks(df: DataFrame, keys: list[str], col: str) -> DataFrame:
    """:func:`ranks_of` the values of a column."""
    return ranks_of(dealt_values(df, keys, col), keys)


def ranks_of(dealt: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct values per group with their place in the sorted group.

    Result columns: ``keys``, ``value``, ``n`` (rows with this value), ``before``
    (rows below it), ``total`` (rows in the group) and ``__part``, the range
    partition.  Missing values take no rank.
    """
    # One row per group and part.
    totals = dealt.groupBy(*keys, "__part").agg(F.sum("n").alias("__rows"))
    in_order = Window.partitionBy(*keys).orderBy("__part")
    offsets = totals.select(
        *keys,
        "__part",
        F.coalesce(F.sum("__rows").over(in_order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__offset"),
        F.sum("__rows").over(Window.partitionBy(*keys)).alias("total"),
    )
    inside = Window.partitionBy(*keys, "__part").orderBy("value").rowsBetween(Window.unboundedPreceding, -1)
    below = F.coalesce(F.sum("n").over(inside), F.lit(0))
    joined = dealt.alias("c").join(offsets.alias("o"), _same(keys, "c", "o")).select("c.*", "o.__offset", "o.total")
    return joined.select(*keys, "value", "n", (F.col("__offset") + below).alias("before"), "total", "__part")


def quantiles_from_ranks(ranks: DataFrame, keys: list[str], probs: dict[str, float]) -> DataFrame:
    """Interpolated quantiles, one column per entry of ``probs``."""
    aggs = []
    first, last = F.col("before"), F.col("before") + F.col("n") - 1
    for name, p in probs.items():
        place = F.lit(p) * (F.col("total") - 1)
        low, high = F.floor(place), F.ceil(place)
        value_at = lambda at: F.max(F.when((first <= at) & (at <= last), F.col("value")))
        aggs += [
            value_at(low).alias(f"__{name}_low"),
            value_at(high).alias(f"__{name}_high"),
            F.max(place - low).alias(f"__{name}_part"),
        ]
    found = ranks.groupBy(*keys).agg(*aggs)
    return found.select(
        *keys,
        *[
            (
                F.col(f"__{n}_low") + (F.col(f"__{n}_high") - F.col(f"__{n}_low")) * F.col(f"__{n}_part")
            ).alias(n)
            for n in probs
        ],
    )


def exact_quantiles(df: DataFrame, keys: list[str], col: str, probs: dict[str, float]) -> DataFrame:
    """Exact interpolated quantiles for few groups of any size."""
    return quantiles_from_ranks(value_ranks(df, keys, col), keys, probs)


def value_at_share(ranks: DataFrame, keys: list[str], share: float, out: str = "value_at") -> DataFrame:
    """The value at 0-based position ``int((total - 1) * share)`` of each group."""
    at = F.floor((F.col("total") - 1) * F.lit(share))
    hit = (F.col("before") <= at) & (at < F.col("before") + F.col("n"))
    return ranks.filter(hit).select(*keys, F.col("value").alias(out), F.col("total").alias("n"))


def grouped_stats(
    df: DataFrame, keys: list[str], specs: list[tuple[str, str, tuple[str, ...]]], extra: list[Column] = ()
) -> DataFrame:
    """Statistics ``kind_name`` of several columns per group, quantiles included.

    ``specs`` lists (column, name, kinds).  One ``groupBy`` for groups that have
    a bound by their nature: a tick of the machine or of a job has at most a row
    for each node, or one for each sensor of each node.  For groups without such
    a bound use :func:`exact_quantiles`.  Rows that lie by their tick are grouped where they lie.
    """
    tick = tick_of(df, keys)
    return df.groupBy(*keys, *tick).agg(*extra, *[c for col, name, kinds in specs for c in stats_of(col, name, kinds)]).drop(*tick)
