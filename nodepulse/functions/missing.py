"""Rules for missing readings.

Only NULL means "missing": float NaN is turned into NULL where data enters, as
Spark's sum and max do not skip NaN.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def nan_to_null(df: DataFrame) -> DataFrame:
    """Replace NaN by NULL in every float and double column."""
    floats = {f.name: f.dataType.simpleString() for f in df.schema if isinstance(f.dataType, (T.FloatType, T.DoubleType))}
    return df.selectExpr(
        *[f"nanvl(`{c}`, cast(null as {floats[c]})) as `{c}`" if c in floats else f"`{c}`" for c in df.columns]
    )


def number_or_null(col: Column | str, kind: str = "double") -> Column:
    """Text or number to a number; what cannot be read becomes NULL."""
    col = F.col(col) if isinstance(col, str) else col
    number = col.try_cast(kind)
    return F.when(~F.isnan(number), number)


def null_count(cols: list[str]) -> Column:
    """How many of ``cols`` are missing in the row."""
    return F.expr(" + ".join(f"cast(`{c}` is null as int)" for c in cols))


def any_null(cols: list[str]) -> Column:
    """True when at least one of ``cols`` is missing in the row."""
    return F.expr(" or ".join(f"`{c}` is null" for c in cols))


def sum_present(cols: list[str]) -> Column:
    """Row sum over the readings present; NULL only when none is."""
    total = " + ".join(f"coalesce(cast(`{c}` as double), 0D)" for c in cols)
    none = " and ".join(f"`{c}` is null" for c in cols)
    return F.expr(f"case when not ({none}) then {total} end")


def sum_strict(cols: list[str], kind: str = "double") -> Column:
    """Row sum that is NULL as soon as one reading is missing."""
    return F.expr(" + ".join(f"cast(`{c}` as {kind})" for c in cols))


def max_present(cols: list[str]) -> Column:
    """Row maximum over the readings present."""
    return F.greatest(*[F.col(c) for c in cols]) if len(cols) > 1 else F.col(cols[0])


def is_true(condition: Column) -> Column:
    """A comparison with a missing value counts as False."""
    return F.coalesce(condition, F.lit(False))
