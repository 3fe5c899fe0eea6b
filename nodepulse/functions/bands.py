"""Temperature bands and the mask of hot components."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

from .sensors import BAND_CUTS, CLUSTER_BAND_RANGE, HOT_FROM


def band(col: Column | str, cuts=BAND_CUTS, low: float | None = None, high: float | None = None) -> Column:
    """Number of the band a temperature falls in, from 0.

    A cut belongs to the upper of its two bands.  Outside ``[low, high)`` and for
    missing readings the result is NULL; a limit of None is open.
    """
    t = F.col(col) if isinstance(col, str) else col
    inside = t.isNotNull()
    if low is not None:
        inside = inside & (t >= low)
    if high is not None:
        inside = inside & (t < high)
    number = reduce(add, [(t >= cut).cast("int") for cut in cuts])
    return F.when(inside, number)


def _limits_sql(col: str, low: float | None, high: float | None) -> str:
    """SQL text that is true, or NULL for a missing reading, inside ``[low, high)``."""
    lower = f" and `{col}` >= {low}" if low is not None else ""
    upper = f" and `{col}` < {high}" if high is not None else ""
    return f"`{col}` is not null{lower}{upper}"


def band_counts(cols: list[str], prefix: str, cuts=BAND_CUTS, low=None, high=None) -> dict[str, Column]:
    """For each band, how many of ``cols`` are in it.

    A band's count is the number of readings at or above its lower limit, less
    the number at or above the next one's.
    """
    reached = [
        " + ".join(f"cast({_limits_sql(c, limit, high)} as int)" for c in cols) for limit in (low, *cuts)
    ]
    counts = [f"({a}) - ({b})" for a, b in zip(reached, reached[1:])] + [reached[-1]]
    return {f"{prefix}_band{k}": F.expr(n) for k, n in enumerate(counts)}


def hot_mask(
    host: str,
    cols: list[str],
    threshold: float = HOT_FROM,
    low: float | None = CLUSTER_BAND_RANGE[0],
    high: float | None = CLUSTER_BAND_RANGE[1],
) -> Column:
    """``host:bits`` when a component is at or above ``threshold``, else NULL.

    There is one bit per component; a missing reading, or one outside the range,
    shows as 0.
    """
    lowest = threshold if low is None else max(low, threshold)
    hot = [_limits_sql(c, lowest, high) for c in cols]
    bits = ", ".join(f"if({h}, '1', '0')" for h in hot)
    return F.expr(f"case when {' or '.join(f'({h})' for h in hot)} then concat(`{host}`, ':', {bits}) end")
