"""Time on a fixed grid.

Grid points are multiples of the resolution since 1970-01-01 UTC, computed with
whole microseconds, so that no fraction is ever lost.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

# Seconds in each unit a resolution may be given in.
UNIT_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 604800}

#: Monday 1970-01-05: weeks start here, all finer units are unaffected.
WEEK_ORIGIN_MICROS = 4 * 86400 * 1_000_000


def seconds_of(resolution: str | int) -> int:
    """``'10 seconds'``, ``'1 hour'`` or a number of seconds, as seconds."""
    if isinstance(resolution, int):
        return resolution
    amount, unit = resolution.split()
    return int(amount) * UNIT_SECONDS[unit.rstrip("s").lower()]


def micros_of(resolution: str | int) -> int:
    return seconds_of(resolution) * 1_000_000


def origin_of(resolution: str | int) -> int:
    """Microseconds at which the grid starts: a Monday for whole weeks, else the epoch."""
    return WEEK_ORIGIN_MICROS if seconds_of(resolution) % UNIT_SECONDS["week"] == 0 else 0


def as_timestamp(col: Column | str) -> Column:
    """Zone-less timestamps become instants in the session zone (UTC)."""
    return (F.col(col) if isinstance(col, str) else col).cast("timestamp")


def micros(col: Column | str) -> Column:
    return F.unix_micros(as_timestamp(col))


def floor_to(col: Column | str, resolution: str | int) -> Column:
    """Latest grid point not after the time."""
    step, origin = micros_of(resolution), origin_of(resolution)
    us = micros(col)
    return F.timestamp_micros(us - F.pmod(us - F.lit(origin), F.lit(step)))


def ceil_to(col: Column | str, resolution: str | int) -> Column:
    """Earliest grid point not before the time."""
    step, origin = micros_of(resolution), origin_of(resolution)
    us = micros(col)
    return F.timestamp_micros(us + F.pmod(F.lit(origin) - us, F.lit(step)))


def round_to(col: Column | str, resolution: str | int) -> Column:
    """Nearest grid point; a time exactly between two goes to the even one."""
    step = micros_of(resolution)
    us = micros(col)
    rest = F.pmod(us, F.lit(step))
    is_odd = F.pmod(us - rest, F.lit(2 * step)) != 0
    up = (rest * 2 > F.lit(step)) | ((rest * 2 == F.lit(step)) & is_odd)
    return F.timestamp_micros(us - rest + F.when(up, F.lit(step)).otherwise(F.lit(0)))


def steps_between(first: Column, last: Column, step: int) -> Column:
    """Whole numbers from ``first`` to ``last`` by ``step``; empty if reversed.

    ``sequence`` refuses reversed ends even in a branch that is not taken.
    """
    points = F.sequence(first, F.greatest(first, last), F.lit(step))
    return F.when(first <= last, points).otherwise(F.array().cast("array<bigint>"))


def grid_between(first: Column, last: Column, resolution: str | int) -> Column:
    """Array of grid points from ``first`` to ``last``, both included; empty if reversed."""
    step = micros_of(resolution)
    lo, hi = micros(ceil_to(first, resolution)), micros(floor_to(last, resolution))
    return F.transform(steps_between(lo, hi, step), F.timestamp_micros)


def between_times(col: Column | str, start: datetime | str, end: datetime | str) -> Column:
    """Both ends belong to the range."""
    return as_timestamp(col).between(F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp"))


def at_times(col: Column | str, times: list[datetime | str]) -> Column:
    """Rows at any of the listed instants."""
    return as_timestamp(col).isin([F.lit(t).cast("timestamp") for t in times])


def local_to_utc(col: Column | str, zone: str = "US/Eastern") -> Column:
    """Wall-clock time of ``zone`` to UTC."""
    return F.to_utc_timestamp(as_timestamp(col), zone)


def calendar_parts(col: Column | str) -> dict[str, Column]:
    """Year, month, ISO week and day of month."""
    ts = as_timestamp(col)
    return {
        "year": F.year(ts),
        "month": F.month(ts),
        "week": F.weekofyear(ts),
        "day": F.dayofmonth(ts),
    }


def seconds_between(start: Column | str, end: Column | str) -> Column:
    """Seconds from ``start`` to ``end`` as a double."""
    return (micros(end) - micros(start)) / F.lit(1_000_000.0)
