"""Columns derived from other columns of the same row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import sensors
from ..session import few
from .missing import max_present, null_count, number_or_null, sum_present, sum_strict


def add_node_sums(df: DataFrame, suffix: str = "", sums: dict[str, list[str]] | None = None) -> DataFrame:
    """Per-node totals; a total is missing when one of its parts is.

    Totals whose parts the frame does not carry at all are left out.
    """
    sums = sums or sensors.NODE_SUMS
    have = set(df.columns)
    return df.withColumns(
        {
            total + suffix: sum_strict([p + suffix for p in parts])
            for total, parts in sums.items()
            if have.issuperset(p + suffix for p in parts)
        }
    )


def add_node_maxima(df: DataFrame, suffix: str = "", maxima: dict[str, list[str]] | None = None) -> DataFrame:
    """Per-node highest temperature of each part family, over the sensors that report."""
    maxima = maxima or sensors.NODE_MAXIMA
    have = set(df.columns)
    found = {name: [p + suffix for p in parts if p + suffix in have] for name, parts in maxima.items()}
    return df.withColumns({name + suffix: max_present(parts) for name, parts in found.items() if parts})


def add_component_power(df: DataFrame, suffix: str = "_mean") -> DataFrame:
    """CPU and GPU power of a node over the sensors that report, and how many do not."""
    cpu = [c + suffix for c in sensors.CPU_POWERS]
    gpu = [c + suffix for c in sensors.GPU_POWERS]
    return df.withColumns(
        {
            "cpu_power": sum_present(cpu),
            "cpu_nan": null_count(cpu),
            "gpu_power": sum_present(gpu),
            "gpu_nan": null_count(gpu),
        }
    )


def add_supply_sum(df: DataFrame, suffix: str = "_mean", name: str = "ps_1_2_input_power") -> DataFrame:
    """Sum of both power supplies; unreadable text counts as missing."""
    first, second = (number_or_null(c + suffix) for c in sensors.SUPPLY_POWERS)
    return df.withColumn(name + suffix, first + second)


def compute_nodes_only(df: DataFrame, host: str = "hostname") -> DataFrame:
    """Drop login and batch hosts."""
    keep = F.lit(True)
    for prefix in sensors.LOGIN_PREFIXES:
        keep = keep & ~F.col(host).startswith(prefix)
    return df.filter(keep)


def valid_intervals(df: DataFrame, begin: str = "begin_time", end: str = "end_time") -> DataFrame:
    """Rows with both ends known and not reversed."""
    return df.filter(F.col(begin) <= F.col(end))


def node_class(nodes: Column | str, cuts=sensors.NODE_CUTS, labels=None) -> Column:
    """Scheduler size class of a job.

    ``cuts`` are inclusive upper limits in rising order.  Without ``labels`` the
    smallest jobs get the highest number, as the scheduler counts.
    """
    nodes = F.col(nodes) if isinstance(nodes, str) else nodes
    labels = list(labels) if labels is not None else list(range(len(cuts) + 1, 0, -1))
    chain = F.when(nodes <= cuts[0], F.lit(labels[0]))
    for cut, label in zip(cuts[1:], labels[1:]):
        chain = chain.when(nodes <= cut, F.lit(label))
    return chain.when(nodes.isNotNull(), F.lit(labels[-1]))


def log_positive(df: DataFrame, col: str, out: str, base: float | None = 10.0, offset: float = 1.0) -> DataFrame:
    """Logarithm of ``col + offset``; rows that do not come out above zero are dropped."""
    shifted = F.col(col) + F.lit(offset)
    logged = F.log(shifted) if base is None else F.log10(shifted) if base == 10 else F.log(base, shifted)
    return df.filter(F.col(col) >= 0).withColumn(out, logged).filter(F.col(out) > 0)


def to_unit(col: Column | str, factor: float) -> Column:
    """Linear change of unit: kW to MW is 0.001, seconds to hours 1/3600."""
    return (F.col(col) if isinstance(col, str) else col) * F.lit(factor)


def node_hours(nodes: Column | str, seconds: Column | str) -> Column:
    nodes = F.col(nodes) if isinstance(nodes, str) else nodes
    seconds = F.col(seconds) if isinstance(seconds, str) else seconds
    return nodes * seconds / F.lit(3600.0)


def account_domain(account: Column | str) -> Column:
    """The science domain is the first three letters of the account."""
    return F.substring(account, 1, 3)


def pick_by_index(cols: list[str], index: Column | str) -> Column:
    """The value of the ``index``-th column, counting from zero; NULL outside."""
    index = F.col(index) if isinstance(index, str) else index
    return F.get(F.array(*[F.col(c) for c in cols]), index)


def lookup(df: DataFrame, dim: DataFrame, key: str, value: str, out: str) -> DataFrame:
    """Replace a code by its description, or keep the code where there is none.

    ``dim`` holds one row per code; of several the smallest description counts.
    """
    pairs = few(dim.groupBy(key).agg(F.min(value).alias("__value")))
    return df.join(pairs, key, "left").withColumn(out, F.coalesce("__value", F.col(key))).drop("__value")


def from_map(col: Column | str, names: dict) -> Column:
    """Short fixed dictionaries stay an expression; unknown keys give NULL."""
    col = F.col(col) if isinstance(col, str) else col
    pairs = [F.lit(x) for pair in names.items() for x in pair]
    return F.try_element_at(F.create_map(*pairs), col)


def with_dotted_names(df: DataFrame) -> DataFrame:
    """Output form ``sensor.statistic`` of the aggregate columns."""
    kinds = ("count", "sum", "tot_sq_dev", "min", "max", "mean", "std")
    renames = {}
    for c in df.columns:
        for kind in kinds:
            if c.endswith("_" + kind):
                renames[c] = f"{c[: -len(kind) - 1]}.{kind}"
                break
    return df.withColumnsRenamed(renames)
