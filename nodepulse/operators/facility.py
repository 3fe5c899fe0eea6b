"""Cooling plant, switch boards and meters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.timegrid import as_timestamp, floor_to, micros, micros_of, steps_between


#: Bins written from one row.
GRID_RUN = 10_000


def resample_mean(
    df: DataFrame, resolution: str, cols: list[str], keys: list[str] = (), time_col: str = "timestamp"
) -> DataFrame:
    """Mean per bin, with a row for every bin between the first and the last.

    Bins without rows come out with missing means.  The bins are written from
    the ends of each key's own range, in runs of ``GRID_RUN``.
    """
    keys = list(keys)
    binned = df.select(*keys, floor_to(time_col, resolution).alias(time_col), *cols)
    means = binned.groupBy(*keys, time_col).agg(*[F.avg(c).alias(c) for c in cols])
    spans = means.groupBy(*keys).agg(F.min(time_col).alias("__a"), F.max(time_col).alias("__z"))
    step = micros_of(resolution)
    first, last = F.unix_micros("__a"), F.unix_micros("__z")
    runs = spans.filter(F.col("__a").isNotNull()).select(
        *keys, last.alias("__last"), F.explode(steps_between(first, last, step * GRID_RUN)).alias("__run")
    )
    end = F.least(F.col("__last"), F.col("__run") + F.lit(step * (GRID_RUN - 1)))
    ticks = F.explode(steps_between(F.col("__run"), end, step)).alias("__us")
    grid = runs.select(*keys, ticks).select(*keys, F.timestamp_micros("__us").alias(time_col))
    return grid.join(means, [*keys, time_col], "left")


def interpolate_to_grid(
    df: DataFrame, resolution: str, cols: list[str], time_col: str = "timestamp"
) -> DataFrame:
    """Linear interpolation of an irregular series onto the grid.

    Of the readings between two grid points only the first and the last matter,
    so they are reduced to one row per column and grid cell before anything is
    sorted.  The last reading of a cell and the first of the next cell that has
    any then write the grid points between them.  Cells are paired day by day;
    the pair across midnight looks the next day up in a table of one row per
    day.  Readings at the same time are averaged.
    """
    step = micros_of(resolution)
    pairs = [F.struct(F.lit(c).alias("series"), F.col(c).cast("double").alias("v")) for c in cols]
    long = (
        df.select(micros(time_col).alias("t"), F.explode(F.array(*pairs)).alias("p"))
        .select("t", "p.series", "p.v")
        .filter(F.col("v").isNotNull())
        .groupBy("series", "t")
        .agg(F.avg("v").alias("v"))
    )
    cells = (
        long.groupBy("series", (F.col("t") - F.pmod("t", F.lit(step))).alias("cell"))
        .agg(F.min(F.struct("t", "v")).alias("first"), F.max(F.struct("t", "v")).alias("last"))
        .withColumn("day", F.floor(F.col("cell") / F.lit(micros_of("1 day"))))
    )
    # One row per series and day that has readings: bounded by the calendar.
    days = cells.groupBy("series", "day").agg(F.min("first").alias("opening"))
    by_day = Window.partitionBy("series").orderBy("day")
    after = days.select("series", "day", F.lead("opening").over(by_day).alias("opening_after"))
    by_cell = Window.partitionBy("series", "day").orderBy("cell")
    paired = (
        cells.withColumn("next", F.lead("first").over(by_cell))
        .join(after, ["series", "day"])
        .withColumn("next", F.coalesce("next", "opening_after"))
    )
    own = F.when(F.col("first.t") == F.col("cell"), F.array("cell")).otherwise(F.array().cast("array<bigint>"))
    stop = F.coalesce(F.col("next.t") - 1, F.col("cell"))
    between = steps_between(F.col("cell") + F.lit(step), stop - F.pmod(stop, F.lit(step)), step)
    share = (F.col("us") - F.col("last.t")) / (F.col("next.t") - F.col("last.t"))
    blended = F.col("last.v") + (F.col("next.v") - F.col("last.v")) * share
    value = F.when(F.col("us") == F.col("first.t"), F.col("first.v")).otherwise(blended)
    ticks = paired.withColumn("us", F.explode(F.concat(own, between))).select(
        F.timestamp_micros("us").alias(time_col), "series", value.alias("v")
    )
    return ticks.groupBy(time_col).agg(*[F.max(F.when(F.col("series") == c, F.col("v"))).alias(c) for c in cols])


def with_msb(df: DataFrame, dim: DataFrame) -> DataFrame:
    """Add the switch board that feeds the node; unknown nodes are dropped."""
    return df.join(dim.select("hostname", "msb"), "hostname")


def msb_power(nodes: DataFrame, dim: DataFrame | None = None, time_col: str = "timestamp") -> DataFrame:
    """Hosts seen and summed power of each switch board per tick."""
    df = nodes if dim is None else with_msb(nodes, dim)
    return df.groupBy(time_col, "msb").agg(
        F.count("hostname").alias("hosts"),
        F.coalesce(F.sum("total_power_mean"), F.lit(0.0)).alias("total_power"),
        F.coalesce(F.sum("input_power_mean"), F.lit(0.0)).alias("input_power"),
    )


def hosts_seen(power: DataFrame, resolution: str, time_col: str = "timestamp") -> DataFrame:
    """Mean number of hosts seen per board on a coarser grid: shows data loss."""
    return resample_mean(power, resolution, ["hosts"], ["msb"], time_col)


def meter_vs_summation(
    meter: DataFrame, summed: DataFrame, resolution: str, time_col: str = "timestamp", watts_per_unit: float = 1000.0
) -> DataFrame:
    """Meter reading, summed sensors and their difference per board and bin, in kW."""
    metered = resample_mean(meter, resolution, ["kw"], ["msb"], time_col).withColumnRenamed("kw", "meter")
    sensors = resample_mean(summed, resolution, ["input_power"], ["msb"], time_col)
    sensors = sensors.select(time_col, "msb", (F.col("input_power") / F.lit(watts_per_unit)).alias("summation"))
    return sensors.join(metered, [time_col, "msb"], "left").withColumn("diff", F.col("meter") - F.col("summation"))


def method_long(comparison: DataFrame, time_col: str = "timestamp") -> DataFrame:
    """Meter and summation below each other."""
    return comparison.select(time_col, "msb", "meter", "summation").unpivot(
        [time_col, "msb"], ["meter", "summation"], "method", "kw"
    )


def meter_diff_summary(diff: DataFrame, keys: list[str] = (), col: str = "diff") -> DataFrame:
    """Mean difference, and geometric mean of the negative ones with its sign."""
    below = F.when(F.col(col) < 0, F.log(-F.col(col)))
    return diff.groupBy(*keys).agg(
        F.count(col).alias("n"),
        F.avg(col).alias("diff_mean"),
        (-F.exp(F.avg(below))).alias("negative_diff_gmean"),
    )


def weekly_extrema(plant: DataFrame, col: str = "k100_total_power", time_col: str = "timestamp", factor: float = 0.001) -> DataFrame:
    """Highest and lowest value per ISO week; a lowest value not above 0 counts as 0."""
    low = F.min(col)
    return plant.groupBy(F.weekofyear(as_timestamp(time_col)).alias("week")).agg(
        (F.max(col) * F.lit(factor)).alias("max_power"),
        (F.when(low > 0, low).otherwise(F.lit(0.0)) * F.lit(factor)).alias("min_power"),
    )


def pue_summary(plant: DataFrame, summer: Column, col: str = "k100_pue") -> DataFrame:
    """Average PUE over everything and over the rows where ``summer`` holds."""
    return plant.agg(
        F.avg(col).alias("pue_year"),
        F.avg(F.when(summer, F.col(col))).alias("pue_summer"),
        F.count(col).alias("n"),
    )
