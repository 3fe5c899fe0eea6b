"""Mergeable time aggregates.

``init_agg``      raw rows           -> count, sum, tot_sq_dev, min, max per bin
``coarsen_agg``   those, finer bins  -> those, coarser bins
``finalize_agg``  those              -> mean, std, min, max

``tot_sq_dev`` is the sum of squared deviations from the bin's own mean.  With
it two bins can be merged without going back to the raw rows.

All reduce rows before the only shuffle, so a host with far too many rows costs
one partial row per task and bin.  Few columns are a plain ``groupBy``; more than
``PLAIN``, and merges, are matrices, see :mod:`.moments`.
"""

from __future__ import annotations


from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.timegrid import floor_to
from .moments import KINDS, reduced

#: Columns whose five aggregates still fit generated code.
PLAIN = 16
FINAL_KINDS = ("mean", "std", "min", "max")


def value_columns(df: DataFrame, groups: list[str]) -> list[str]:
    """Numeric columns that are not grouping columns."""
    return [f.name for f in df.schema if f.name not in groups and isinstance(f.dataType, T.NumericType)]


def agg_columns(variables: list[str], kind: str) -> list[str]:
    return [f"{v}_{kind}" for v in variables]


def variables_of(df: DataFrame, groups: list[str]) -> list[str]:
    """The variables a frame of mergeable aggregates was made from."""
    return [c[: -len("_tot_sq_dev")] for c in df.columns if c.endswith("_tot_sq_dev") and c not in groups]


def moments(v: str) -> list[Column]:
    """The five mergeable aggregates of one column."""
    x = f"cast(`{v}` as double)"
    return [
        F.expr(f"count({x}) as `{v}_count`"),
        F.expr(f"sum({x}) as `{v}_sum`"),
        F.expr(f"if(count({x}) = 1, 0D, var_samp({x}) * (count({x}) - 1)) as `{v}_tot_sq_dev`"),
        F.expr(f"min({x}) as `{v}_min`"),
        F.expr(f"max({x}) as `{v}_max`"),
    ]


def init_agg(
    df: DataFrame,
    resolution: str,
    time_col: str = "timestamp",
    before: list[str] = (),
    after: list[str] = ("hostname",),
    values: list[str] | None = None,
) -> DataFrame:
    """Aggregate raw rows into bins of ``resolution`` per group.

    A bin without a single reading has count 0 and all else missing.  Rows
    without a time or a group belong to no bin.
    """
    groups = [*before, time_col, *after]
    values = list(values) if values is not None else value_columns(df, groups)
    binned = df.select(*before, floor_to(time_col, resolution).alias(time_col), *after, *values)
    binned = binned.dropna(subset=groups)
    if len(values) > PLAIN:
        return reduced(binned, groups, values, merge=False)
    return binned.groupBy(*groups).agg(*[c for v in values for c in moments(v)])


def coarsen_agg(
    df: DataFrame,
    resolution: str,
    time_col: str = "timestamp",
    before: list[str] = (),
    after: list[str] = ("hostname",),
) -> DataFrame:
    """Merge bins into coarser ones.

    Squared deviations of the parts add, and so do those of the parts' means
    from the common mean.
    """
    groups = [*before, time_col, *after]
    return reduced(df.withColumn(time_col, floor_to(time_col, resolution)), groups, variables_of(df, groups), merge=True)


def finalize_agg(df: DataFrame, groups: list[str], keep_count: bool = False) -> DataFrame:
    """Mean, sample standard deviation, minimum and maximum; a plain projection."""
    cols = [f"`{g}`" for g in groups]
    for v in variables_of(df, groups):
        n = f"`{v}_count`"
        cols += [
            f"try_divide(`{v}_sum`, {n}) as `{v}_mean`",
            f"if({n} > 1, sqrt(`{v}_tot_sq_dev` / ({n} - 1)), null) as `{v}_std`",
            f"`{v}_min`",
            f"`{v}_max`",
        ]
        cols += [n] if keep_count else []
    return df.selectExpr(*cols)
