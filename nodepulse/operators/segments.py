"""Power edges of the whole machine and the stretch of time around each.

The cluster series has one row per tick, so a day has at most 86,400 seconds /
resolution rows; every window here stays inside one day.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import settle

#: Rows before an edge, rows from the edge on, and ticks an edge may take.
FRONT, REAR, LAG = 12, 64, 4
#: Watts per amplitude class, and the classes kept.
BAND_WATTS, CLASSES = 1_000_000.0, (1, 13)


def lag_diff(col: str, rows: int, keys: list[str], order: str) -> Column:
    """Value minus the value ``rows`` earlier; a negative number looks ahead instead."""
    at = Window.partitionBy(*keys).orderBy(order)
    return F.col(col) - F.lag(col, rows).over(at) if rows > 0 else F.lead(col, -rows).over(at) - F.col(col)


def number_rows(
    series: DataFrame,
    power: str = "sum_inp",
    nodes: str = "count_inp",
    time_col: str = "timestamp",
    front: int = FRONT,
    rear: int = REAR,
    lag: int = LAG,
) -> DataFrame:
    """Per day: row index, day length, lagged difference, fewest nodes around the row.

    All four come from one sort of the day's rows.
    """
    dated = series.withColumn("date", F.to_date(time_col))
    at = Window.partitionBy("date").orderBy(time_col)
    return dated.withColumns(
        {
            "rn": F.row_number().over(at) - 1,
            "day_rows": F.count(F.lit(1)).over(Window.partitionBy("date")),
            "diff": F.col(power) - F.lag(power, lag).over(at),
            "fewest_nodes": F.min(nodes).over(at.rowsBetween(-front, rear - 1)),
        }
    )


def find_edges(
    numbered: DataFrame,
    power: str = "sum_inp",
    time_col: str = "timestamp",
    front: int = FRONT,
    rear: int = REAR,
    band: float = BAND_WATTS,
    classes: tuple[int, int] = CLASSES,
    min_nodes: int = 4626 - 200,
) -> DataFrame:
    """Rows that end a large change and have a full, well-covered stretch around them."""
    size = F.floor(F.abs("diff") / F.lit(band)).cast("int")
    whole = (F.col("rn") >= front) & (F.col("rn") < F.col("day_rows") - rear)
    return (
        numbered.filter(whole & (F.col("fewest_nodes") >= min_nodes))
        .withColumn("amplitude_class", size)
        .filter(F.col("amplitude_class").between(*classes))
        .select(
            "date",
            F.when(F.col("diff") > 0, "rise").otherwise("fall").alias("type"),
            F.col("rn").alias("edge_index"),
            F.col(time_col).alias("edge_timestamp"),
            (F.col(power) / F.lit(band)).cast("int").alias("start_class"),
            F.col("diff").alias("amplitude"),
            "amplitude_class",
        )
    )


def suppress_overlaps(edges: DataFrame, front: int = FRONT, rear: int = REAR) -> DataFrame:
    """Keep the largest edges whose stretches hold no other kept edge.

    Edges are visited by class, largest first, then by position; whether one is
    kept depends on those kept before it, which no window function can say.  A
    group is the edges of one day and direction: fewer than the day has ticks.
    """

    def pick(group: pd.DataFrame) -> pd.DataFrame:
        order = group.sort_values(["amplitude_class", "edge_index"], ascending=[False, True], kind="stable")
        kept_rows, kept_at = [], set()
        for label, index in zip(order.index, order["edge_index"]):
            if kept_at.isdisjoint(range(index - front, index + rear)):
                kept_at.add(index)
                kept_rows.append(label)
        return order.loc[kept_rows]

    return edges.groupBy("date", "type").applyInPandas(pick, edges.schema)


def carve_segments(
    numbered: DataFrame, edges: DataFrame, metrics: list[str], front: int = FRONT, rear: int = REAR, time_col: str = "timestamp"
) -> DataFrame:
    """The rows around each edge, by offset from the start of its stretch.

    Each edge writes the row numbers it wants, so this is an equi-join on
    (date, row number) and not a range join.
    """
    wanted = edges.withColumn("offset", F.explode(F.sequence(F.lit(0), F.lit(front + rear - 1)))).withColumn(
        "rn", F.col("edge_index") - front + F.col("offset")
    )
    rows = numbered.select("date", "rn", F.col(time_col), *metrics)
    return wanted.join(rows, ["date", "rn"]).drop("rn")


def power_segments(
    series: DataFrame,
    metrics: list[str],
    power: str = "sum_inp",
    nodes: str = "count_inp",
    time_col: str = "timestamp",
    front: int = FRONT,
    rear: int = REAR,
    lag: int = LAG,
    band: float = BAND_WATTS,
    classes: tuple[int, int] = CLASSES,
    min_nodes: int = 4626 - 200,
) -> DataFrame:
    """Series to carved, non-overlapping segments.

    The numbered series, one row per tick, is read for the edges and again for
    their stretches; it is settled so that it is computed once.
    """
    slim = series.select(*dict.fromkeys([time_col, power, nodes, *metrics]))
    numbered = settle(number_rows(slim, power, nodes, time_col, front, rear, lag))
    edges = find_edges(numbered, power, time_col, front, rear, band, classes, min_nodes)
    return carve_segments(numbered, suppress_overlaps(edges, front, rear), metrics, front, rear, time_col)


def segment_profile(segments: DataFrame, metrics: list[str]) -> DataFrame:
    """Mean and 95 % interval of each metric per type, class and offset.

    The interval is the normal one, mean +- 1.96 s / sqrt(n).
    """
    aggs = [F.count(F.lit(1)).alias("n")]
    for m in metrics:
        half = F.lit(1.96) * F.stddev_samp(m) / F.sqrt(F.count(m))
        aggs += [F.avg(m).alias(f"{m}_mean"), (F.avg(m) - half).alias(f"{m}_low"), (F.avg(m) + half).alias(f"{m}_high")]
    return segments.groupBy("type", "amplitude_class", "offset").agg(*aggs)


def segment_counts(segments: DataFrame) -> DataFrame:
    """Segments and rows per type and class."""
    return segments.groupBy("type", "amplitude_class").agg(
        F.sum((F.col("offset") == 0).cast("int")).alias("segments"), F.count(F.lit(1)).alias("rows")
    )
