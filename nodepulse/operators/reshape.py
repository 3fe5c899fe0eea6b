"""Wide to long, long to wide, and counts of what is present."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def melt(df: DataFrame, ids: list[str], cols: list[str], name: str = "variable", value: str = "value") -> DataFrame:
    """One row per id and column; values come out as doubles."""
    typed = df.select(*ids, *[F.col(c).cast("double").alias(c) for c in cols])
    return typed.unpivot(ids, cols, name, value)


def pivot_fixed(df: DataFrame, index: list[str], col: str, value: str, values: list, fill=None) -> DataFrame:
    """Columns for a known list of values, so that no extra job looks for them.

    ``(index, col)`` is expected to be unique; of several rows the largest wins.
    """
    wide = df.groupBy(*index).pivot(col, values).agg(F.max(value))
    return wide if fill is None else wide.fillna(fill, subset=[str(v) for v in values])


def non_null_counts(df: DataFrame, cols: list[str]) -> DataFrame:
    """Number of rows, and of present values of each column."""
    return df.agg(F.count(F.lit(1)).alias("rows"), *[F.count(c).alias(f"count_{c}") for c in cols])


def value_counts(df: DataFrame, cols: list[str], out: str = "n") -> DataFrame:
    """Rows per distinct combination, the most frequent first; equally frequent ones in their own order."""
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias(out)).orderBy(F.desc(out), *cols)


def union_tolerant(*frames: DataFrame | None) -> DataFrame:
    """Union by name of the frames that exist; columns one lacks become NULL."""
    present = [f for f in frames if f is not None]
    result = present[0]
    for frame in present[1:]:
        result = result.unionByName(frame, allowMissingColumns=True)
    return result


def keep_members(df: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """Rows whose key occurs in ``keys``."""
    return df.join(keys.select(*on), on, "left_semi")


def drop_members(df: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """Rows whose key does not occur in ``keys``."""
    return df.join(keys.select(*on), on, "left_anti")
