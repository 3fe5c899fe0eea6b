"""Named queries, each with the SQL it is checked against where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

Run = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    run: Run
    sql: str | None


REGISTRY: dict[str, Query] = {}


def query(name: str, sql: str | None = None) -> Callable[[Run], Run]:
    """Register a query under ``name``."""

    def add(run: Run) -> Run:
        if name in REGISTRY:
            raise ValueError(f"query {name} is registered twice")
        REGISTRY[name] = Query(name, run, sql)
        return run

    return add


def tidy(df: DataFrame, digits: int = 6, **by_column: int) -> DataFrame:
    """Round float columns, so that the last bits of a sum do not count."""
    return df.selectExpr(
        *[
            f"round(cast(`{f.name}` as double), {by_column.get(f.name, digits)}) + 0D as `{f.name}`"
            if isinstance(f.dataType, (T.DoubleType, T.FloatType))
            else f"`{f.name}`"
            for f in df.schema
        ]
    )


def check_sql(body: str, *ctes: str, doubles: list[str] = (), digits: int = 6, **by_column: int) -> str:
    """SQL text: common tables, body, and the rounding of :func:`tidy`."""
    head = f"with {', '.join(ctes)}\n" if ctes else ""
    if not doubles:
        return head + body
    rounded = ", ".join(f"round({c}, {by_column.get(c, digits)}) + 0.0 as {c}" for c in doubles)
    return f"{head}select * replace ({rounded}) from ({body}) t"
