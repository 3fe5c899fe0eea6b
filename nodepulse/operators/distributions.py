"""Box plots, distribution functions, histograms and correlations.

Groups here are few and large (classes, weeks, domains), so everything that
needs an order goes through ``order_stats.value_ranks``, and everything else is
a sum that combines before the shuffle.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import sensors
from ..functions.places import node_location
from ..functions.timegrid import at_times
from ..session import few
from .order_stats import dealt_values, quantiles_from_ranks, ranks_of, value_at_share, value_ranks


def box_summary(df: DataFrame, keys: list[str], col: str, reach: float = 1.5) -> DataFrame:
    """Quartiles, whiskers (furthest values within ``reach`` IQR of the box) and extremes."""
    dealt = dealt_values(df, keys, col)
    # One row per group, beside each of its values.
    box = few(quantiles_from_ranks(ranks_of(dealt, keys), keys, {"q1": 0.25, "median": 0.5, "q3": 0.75}))
    same = F.lit(True)
    for k in keys:
        same = same & F.col(f"d.`{k}`").eqNullSafe(F.col(f"b.`{k}`"))
    joined = dealt.alias("d").join(box.alias("b"), same).select("d.*", "b.q1", "b.median", "b.q3")
    iqr = F.col("q3") - F.col("q1")
    low_ok = F.col("value") >= F.col("q1") - reach * iqr
    high_ok = F.col("value") <= F.col("q3") + reach * iqr
    return joined.groupBy(*keys).agg(
        F.sum("n").alias("n"),
        F.max("q1").alias("q1"),
        F.max("median").alias("median"),
        F.max("q3").alias("q3"),
        F.min(F.when(low_ok, F.col("value"))).alias("whisker_low"),
        F.max(F.when(high_ok, F.col("value"))).alias("whisker_high"),
        F.min("value").alias("lowest"),
        F.max("value").alias("highest"),
    )


def iqr_spread(df: DataFrame, keys: list[str], col: str) -> DataFrame:
    """Distance between the two outlier limits: four times the interquartile range."""
    q = quantiles_from_ranks(value_ranks(df, keys, col), keys, {"q25": 0.25, "q75": 0.75})
    return q.withColumn("spread", (F.col("q75") - F.col("q25")) * 4)


def ecdf(df: DataFrame, keys: list[str], col: str) -> DataFrame:
    """Empirical distribution in percent.

    Equal values share a row that holds the positions of the first and the last.
    """
    ranks = value_ranks(df, keys, col)
    percent = lambda at: F.try_divide(at * F.lit(100.0), F.col("total") - 1)
    return ranks.select(
        *keys,
        "value",
        "n",
        percent(F.col("before")).alias("cdf_first"),
        percent(F.col("before") + F.col("n") - 1).alias("cdf_last"),
    )


def ecdf_mark(df: DataFrame, keys: list[str], col: str, share: float = 0.8) -> DataFrame:
    """The value below which about ``share`` of the rows lie."""
    return value_at_share(value_ranks(df, keys, col), keys, share)


def groups_by_median(df: DataFrame, key: str, col: str) -> DataFrame:
    """Groups with their median, highest first."""
    medians = quantiles_from_ranks(value_ranks(df, [key], col), [key], {"median": 0.5})
    return medians.orderBy(F.desc("median"), F.asc(key))


def hist_fixed(df: DataFrame, keys: list[str], col: str, width: float) -> DataFrame:
    """Rows per bin of fixed width; a bin is named by its lower end."""
    x = df.filter(F.col(col).isNotNull())
    low = F.floor(F.col(col) / F.lit(width)) * F.lit(width)
    return x.groupBy(*keys, low.cast("double").alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def hist_cumulative(df: DataFrame, keys: list[str], col: str, width: float) -> DataFrame:
    """Share of a class at or below each bin."""
    bins = hist_fixed(df, keys, col, width)
    whole = Window.partitionBy(*keys)
    upto = whole.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    return bins.withColumn("share", F.sum("n").over(upto) / F.sum("n").over(whole))


def stacked_bars(rates: DataFrame, labels: DataFrame) -> DataFrame:
    """Failures per node-hour by project label and kind."""
    return (
        rates.join(labels, "account")
        .groupBy("label", F.col("xid"))
        .agg(F.sum("freq").alias("height"))
    )


def gpu_long(df: DataFrame, ids: list[str], suffix: str = "_mean", maxima: bool = True) -> DataFrame:
    """One row per node and GPU: power beside core temperature."""
    entries = []
    for slot, power in enumerate(sensors.GPU_POWERS):
        fields = [
            F.lit(slot).alias("gpu"),
            F.col(power + suffix).alias("gpu_power"),
            F.col(sensors.GPU_CORE_TEMPS[slot] + suffix).alias("gpu_core"),
        ]
        if maxima:
            fields.append(F.col(sensors.GPU_CORE_TEMPS[slot] + "_max").alias("gpu_max"))
        entries.append(F.struct(*fields))
    return df.select(*ids, F.inline(F.array(*entries)))


def rack_heatmap(long: DataFrame, times: list[str] | None = None, time_col: str = "timestamp") -> DataFrame:
    """Mean and highest GPU temperature per rack at chosen instants."""
    df = long if times is None else long.filter(at_times(time_col, times))
    place = node_location("hostname")
    return df.groupBy(F.col(time_col), place["row"].alias("row"), place["rack"].alias("rack")).agg(
        F.avg("gpu_core").alias("core_mean"), F.max("gpu_max").alias("core_max")
    )


def corr_matrix(counts: DataFrame, id_col: str, kind: str, value: str, kinds: list) -> DataFrame:
    """Pearson correlation of every two kinds over all ids; absent counts are 0.

    ``kinds`` is the known list of kinds.  One pivot and one aggregate with a sum
    of products per pair, exact for whole counts; nothing is joined with itself.  Kinds that never occur or
    never vary have no row.
    """
    wide = counts.filter(F.col(kind).isin(list(kinds))).groupBy(id_col).pivot(kind, list(kinds)).agg(F.sum(value))
    zero = wide.selectExpr(*[f"cast(coalesce(`{k}`, 0) as double) as k{i}" for i, k in enumerate(kinds)])
    pairs = list(combinations(range(len(kinds)), 2))

    def part(a: str, b: str) -> str:
        return f"(count(1) * sum({a} * {b}) - sum({a}) * sum({b}))"

    def pearson(i: int, j: int) -> str:
        x, y = f"k{i}", f"k{j}"
        return f"try_divide({part(x, y)}, sqrt({part(x, x)} * {part(y, y)}))"

    one = zero.agg(F.count(F.lit(1)).alias("n"), *[F.expr(f"{pearson(i, j)} as r{i}_{j}") for i, j in pairs])
    rows = ", ".join(f"'{kinds[i]}', '{kinds[j]}', r{i}_{j}" for i, j in pairs)
    long = one.select("n", F.expr(f"stack({len(pairs)}, {rows}) as (kind_a, kind_b, corr)"))
    return long.filter(F.col("corr").isNotNull()).select("kind_a", "kind_b", "corr", "n")


def _upper_tail(t: np.ndarray, df: np.ndarray) -> np.ndarray:
    """Two-sided p-value of Student's t by its continued fraction."""
    from math import lgamma

    a, b = df / 2.0, 0.5
    x = df / (df + t * t)
    flip = x > (a + 1) / (a + b + 2)
    p, q, z = np.where(flip, b, a), np.where(flip, a, b), np.where(flip, 1 - x, x)
    log_beta = np.array([lgamma(u) + lgamma(v) - lgamma(u + v) for u, v in zip(p, q)])
    with np.errstate(divide="ignore", invalid="ignore"):
        front = np.exp(p * np.log(z) + q * np.log1p(-z) - log_beta) / p
    tiny = 1e-300
    c, d = np.ones_like(z), 1.0 - (p + q) * z / (p + 1)
    d = 1.0 / np.where(np.abs(d) < tiny, tiny, d)
    h = d.copy()
    for m in range(1, 300):
        for term in (
            m * (q - m) * z / ((p + 2 * m - 1) * (p + 2 * m)),
            -(p + m) * (p + q + m) * z / ((p + 2 * m) * (p + 2 * m + 1)),
        ):
            d = 1.0 + term * d
            d = 1.0 / np.where(np.abs(d) < tiny, tiny, d)
            c = 1.0 + term / c
            c = np.where(np.abs(c) < tiny, tiny, c)
            h = h * d * c
    value = np.where(z <= 0, 0.0, front * h)
    return np.where(flip, 1.0 - value, value)


def corr_significance(corr: DataFrame, alpha: float = 0.05 / 13 / 14) -> DataFrame:
    """t statistic, two-sided p-value and significance of each correlation.

    There is one row per pair of kinds, so the p-value's few numbers go through
    a pandas function.
    """

    @F.pandas_udf("double")
    def p_of(t: pd.Series, freedom: pd.Series) -> pd.Series:
        t, freedom = t.to_numpy(float), freedom.to_numpy(float)
        out = np.full(len(t), np.nan)
        out[freedom > 0] = _upper_tail(t[freedom > 0], freedom[freedom > 0])
        return pd.Series(out)

    r = F.col("corr")
    t = F.when(F.abs(r) < 1, r * F.sqrt((F.col("n") - 2) / (1 - r * r)))
    with_t = corr.withColumn("t", t)
    p = F.when(F.col("t").isNull(), F.lit(0.0)).otherwise(p_of(F.coalesce("t", F.lit(0.0)), (F.col("n") - 2).cast("double")))
    p = F.when(F.col("n") > 2, p)  # two nodes always lie on a line: no p-value
    return with_t.withColumn("p_value", p).withColumn("significant", F.col("p_value") < alpha)
