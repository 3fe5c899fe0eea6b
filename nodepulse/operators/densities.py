"""Gaussian densities of few classes with any number of rows.

A row is added to the moments of the box it lies in; boxes are half as wide as
the kernel's scale, ``sqrt(2)`` bandwidths.  The kernel's sum over a box's rows is
then a series: the moments times Hermite functions at the grid point, cut after
``ORDER`` terms.  So rows are never multiplied by grid points, only boxes are, of
which there are about as many as bandwidths between the extremes.

With |s| <= 1/4 for a row's place in its box a term of order k is at most
1.09 * (1/4)^k * sqrt(2^k / k!).  That leaves an error under 3e-12 of the kernel's
peak on a line and under 2e-9 on a plane, whatever the rows are; usual data stay
far below, as rows lie on both sides of their box's middle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import few, settle
from .moments import group_numbers

#: Terms of the series, boxes whose grid values are computed at once.
ORDER, AT_ONCE = 14, 256
#: A box's width in units of the kernel's scale.
WIDTH = 0.5


def _hermite(t: np.ndarray) -> Iterator[np.ndarray]:
    """Hermite functions of order 0, 1, ... at ``t``: derivatives of exp(-t^2) with alternating signs taken out."""
    before, now = np.zeros_like(t), np.exp(-t * t)
    for k in range(ORDER):
        yield now
        before, now = now, 2 * t * now - 2 * k * before


def _factorials() -> np.ndarray:
    return np.cumprod([1.0, *range(1, ORDER)])


def _power(name: str, k: int) -> str:
    return " * ".join([f"`{name}`"] * k) if k else "1D"


def _grid_sums(boxes: DataFrame, key: str, points: int, extra: list[str], values) -> DataFrame:
    """Sums over all boxes of each class at each grid point: ``key``, ``i`` and ``total``.

    ``values`` gives a matrix, boxes by grid points, for some rows of the columns ``extra``.
    """

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place, first = group_numbers([batch.column(0)])
            sums = np.zeros((len(first), points))
            for a in range(0, batch.num_rows, AT_ONCE):
                part = batch.slice(a, AT_ONCE)
                columns = {c: part.column(1 + k).to_numpy(zero_copy_only=False) for k, c in enumerate(extra)}
                np.add.at(sums, place[a : a + AT_ONCE], values(columns))
            keys = batch.column(0).take(pa.array(np.repeat(first, points)))
            at = pa.array(np.tile(np.arange(points, dtype=np.int32), len(first)))
            yield pa.RecordBatch.from_arrays([keys, at, pa.array(sums.ravel())], names=[key, "i", "total"])

    kind = boxes.schema[key].dataType.simpleString()
    partial = boxes.select(key, *extra).mapInArrow(add, f"`{key}` {kind}, i int, total double")
    return partial.groupBy(key, "i").agg(F.sum("total").alias("total"))


def kde_1d(
    df: DataFrame, key: str, col: str, grid: tuple[float, float, int] | None = None, cut: float = 3.0, points: int = 200
) -> DataFrame:
    """Gaussian density per class, each normalised on its own: ``key``, ``i``, ``x``, ``density``.

    Bandwidth is s n^(-1/5).  Without ``grid`` (low, high, points) each class
    gets its own, reaching ``cut`` bandwidths past its extremes.  A class whose
    values are all equal has none.
    """
    rows = settle(df.select(key, F.col(col).cast("double").alias("x")).filter(F.col("x").isNotNull()))
    shape = rows.groupBy(key).agg(
        F.count("x").alias("n"), F.stddev_samp("x").alias("s"), F.min("x").alias("a"), F.max("x").alias("z")
    )
    shape = shape.withColumn("h", F.col("s") * F.pow("n", F.lit(-0.2))).filter(F.col("h") > 0)
    low = F.col("a") - cut * F.col("h") if grid is None else F.lit(float(grid[0]))
    high = F.col("z") + cut * F.col("h") if grid is None else F.lit(float(grid[1]))
    steps = (points if grid is None else grid[2]) - 1
    shape = few(shape.select(key, "n", "h", "a", low.alias("low"), ((high - low) / F.lit(steps)).alias("step")))
    unit = F.col("h") * float(np.sqrt(2))
    box = F.floor((F.col("x") - F.col("a")) / (unit * WIDTH))
    boxed = rows.join(shape, key).withColumn("box", box)
    boxed = boxed.withColumn("s", (F.col("x") - F.col("a")) / unit - (F.col("box") + 0.5) * WIDTH)
    kept = ["n", "h", "a", "low", "step"]
    sums = [F.expr(f"sum({_power('s', k)}) as m{k}") for k in range(ORDER)]
    boxes = boxed.groupBy(key, *kept, "box").agg(*sums)

    def values(c: dict[str, np.ndarray]) -> np.ndarray:
        unit = c["h"] * np.sqrt(2)
        at = c["low"][:, None] + np.arange(steps + 1) * c["step"][:, None]
        t = (at - c["a"][:, None]) / unit[:, None] - (c["box"][:, None] + 0.5) * WIDTH
        return sum((c[f"m{k}"] / f)[:, None] * h for k, (h, f) in enumerate(zip(_hermite(t), _factorials(), strict=True)))

    total = _grid_sums(boxes, key, steps + 1, ["h", "a", "low", "step", "box", *[f"m{k}" for k in range(ORDER)]], values)
    scale = F.col("n") * F.col("h") * float(np.sqrt(2 * np.pi))
    return total.join(shape, key).select(key, "i", (F.col("low") + F.col("i") * F.col("step")).alias("x"), (F.col("total") / scale).alias("density"))


def kde_2d(
    df: DataFrame, key: str, x: str, y: str, x_grid: tuple[float, float, int], y_grid: tuple[float, float, int]
) -> DataFrame:
    """Gaussian density over a plane per class, with the class's own covariance: ``key``, ``x``, ``y``, ``density``.

    The covariance is scaled by n^(-1/3).  Points are turned into coordinates in
    which it is the identity, where the kernel is a product of two.  A class
    whose points lie on a line has no density.
    """
    rows = settle(df.select(key, F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y")).dropna(subset=["x", "y"]))
    shape = rows.groupBy(key).agg(
        F.count(F.lit(1)).alias("n"),
        F.var_samp("x").alias("sxx"),
        F.var_samp("y").alias("syy"),
        F.covar_samp("x", "y").alias("sxy"),
        F.avg("x").alias("mx"),
        F.avg("y").alias("my"),
    )
    factor = F.pow(F.col("n").cast("double"), F.lit(-1.0 / 3.0))
    shape = shape.select(key, "n", "mx", "my", *[(F.col(c) * factor).alias(c) for c in ("sxx", "syy", "sxy")])
    shape = shape.filter("sxx * syy - sxy * sxy > 0").selectExpr(
        f"`{key}`", "n", "mx", "my", "sqrt(sxx) as lx", "sxy / sqrt(sxx) as ly", "sqrt(syy - sxy * sxy / sxx) as lz"
    )
    shape = few(shape)
    root = float(np.sqrt(2))

    def turned(px: Column, py: Column) -> tuple[Column, Column]:
        u = (px - F.col("mx")) / F.col("lx")
        return u / root, (py - F.col("my") - F.col("ly") * u) / F.col("lz") / root

    boxed = rows.join(shape, key)
    u, v = turned(F.col("x"), F.col("y"))
    boxed = boxed.withColumns({"u": u, "v": v})
    boxed = boxed.withColumns({"bu": F.floor(F.col("u") / WIDTH), "bv": F.floor(F.col("v") / WIDTH)})
    boxed = boxed.withColumns({"s": F.col("u") - (F.col("bu") + 0.5) * WIDTH, "t": F.col("v") - (F.col("bv") + 0.5) * WIDTH})
    kept = ["mx", "my", "lx", "ly", "lz"]
    orders = [(k, m) for k in range(ORDER) for m in range(ORDER - k)]
    sums = [F.expr(f"sum({_power('s', k)} * {_power('t', m)}) as m{k}_{m}") for k, m in orders]
    boxes = boxed.groupBy(key, *kept, "bu", "bv").agg(*sums)
    gx, gy = (np.linspace(g[0], g[1], g[2]) for g in (x_grid, y_grid))
    px, py = np.repeat(gx, len(gy)), np.tile(gy, len(gx))
    factorials = _factorials()

    def values(c: dict[str, np.ndarray]) -> np.ndarray:
        u = (px - c["mx"][:, None]) / c["lx"][:, None]
        v = (py - c["my"][:, None] - c["ly"][:, None] * u) / c["lz"][:, None]
        hu = list(_hermite(u / root - (c["bu"][:, None] + 0.5) * WIDTH))
        hv = list(_hermite(v / root - (c["bv"][:, None] + 0.5) * WIDTH))
        out = np.zeros_like(u)
        for k in range(ORDER):
            inner = sum((c[f"m{k}_{m}"] / (factorials[k] * factorials[m]))[:, None] * hv[m] for m in range(ORDER - k))
            out += hu[k] * inner
        return out

    total = _grid_sums(boxes, key, len(px), [*kept, "bu", "bv", *[f"m{k}_{m}" for k, m in orders]], values)
    scale = F.col("n") * F.col("lx") * F.col("lz") * float(2 * np.pi)

    def axis(grid: tuple[float, float, int], i: Column) -> Column:
        return F.lit(float(grid[0])) + i * F.lit((grid[1] - grid[0]) / (grid[2] - 1))

    return total.join(shape, key).select(
        key,
        axis(x_grid, F.floor(F.col("i") / len(gy))).alias("x"),
        axis(y_grid, F.col("i") % len(gy)).alias("y"),
        (F.col("total") / scale).alias("density"),
    )
