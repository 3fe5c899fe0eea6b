"""GPU failures: where, how often, for whom, how hot."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import sensors
from ..functions.derive import from_map, pick_by_index, valid_intervals
from ..functions.places import node_location, nvlink_id, pci_address
from ..functions.timegrid import round_to
from ..session import few, settle
from .intervals import exactly_one, jobs_at
from .jobs import with_job_size
from .thermal import comptype_stats


def failure_name(xid: Column | str) -> Column:
    return from_map(xid, sensors.XID_NAMES)


def failure_counts(failures: DataFrame, by: list[str]) -> DataFrame:
    """Failures per group."""
    return failures.groupBy(*by).agg(F.count(F.lit(1)).alias("freq"))


def failure_node_max(failures: DataFrame) -> DataFrame:
    """Per kind of failure: all of them, the most on one node, and nodes hit."""
    per_node = failure_counts(failures, ["xid", "hostname"])
    return per_node.groupBy("xid").agg(
        F.sum("freq").alias("total"), F.max("freq").alias("max_per_node"), F.count(F.lit(1)).alias("nodes")
    )


def frequent_xids(failures: DataFrame, at_least: int) -> DataFrame:
    """Codes seen at least that often."""
    return failure_counts(failures, ["xid"]).filter(F.col("freq") >= at_least)


def of_frequent_xids(failures: DataFrame, at_least: int) -> DataFrame:
    """Failures whose code is frequent."""
    return failures.join(few(frequent_xids(failures, at_least).select("xid")), "xid", "left_semi")


def node_pci_sets(failures: DataFrame) -> DataFrame:
    """The bus addresses seen on each node, sorted, as one string.

    Addresses are made distinct before they are collected, so a noisy node
    collects as many entries as it has addresses, not messages.
    """
    distinct = failures.select("hostname", pci_address("message").alias("pci")).distinct()
    sorted_set = F.array_sort(F.collect_list("pci"))
    short = F.transform(sorted_set, lambda p: F.substring(p, 3, 5))
    return distinct.groupBy("hostname").agg(F.array_join(short, " ").alias("pcis"))


def modal_pci(failures: DataFrame) -> DataFrame:
    """The most common set of addresses; of equally common ones the first in order."""
    sets = node_pci_sets(failures)
    return (
        sets.groupBy("pcis")
        .agg(F.count(F.lit(1)).alias("nodes"))
        .orderBy(F.desc("nodes"), F.asc("pcis"))
        .limit(1)
    )


def on_good_nodes(failures: DataFrame) -> DataFrame:
    """Failures on the nodes with the most common set of addresses."""
    good = node_pci_sets(failures).join(modal_pci(failures).select("pcis"), "pcis", "left_semi")
    return failures.join(good.select("hostname"), "hostname", "left_semi")


def gpu_slot(message: Column | str) -> Column:
    """GPU number from the bus address in the message; NULL for others."""
    slots = {address: slot for slot, address in enumerate(sensors.GPU_PCI_ADDRESSES)}
    return from_map(pci_address(message), slots)


def failures_by_slot(failures: DataFrame, exclude: str | None = sensors.OUTLIER_HOST) -> DataFrame:
    """Failures per code and GPU slot."""
    df = failures if exclude is None else failures.filter(F.col("hostname") != exclude)
    return df.groupBy("xid", gpu_slot("message").alias("gpu_slot")).agg(F.count(F.lit(1)).alias("n"))


def nvlink_breakdown(failures: DataFrame, exclude: str | None = sensors.OUTLIER_HOST) -> DataFrame:
    """Link errors per GPU slot and link."""
    df = failures.filter(F.col("xid") == sensors.NVLINK_XID)
    df = df if exclude is None else df.filter(F.col("hostname") != exclude)
    return df.groupBy(gpu_slot("message").alias("gpu_slot"), nvlink_id("message").alias("link")).agg(
        F.count(F.lit(1)).alias("n")
    )


def failures_by_location(failures: DataFrame, var: str) -> DataFrame:
    """Failures per code along ``row``, ``rack`` or ``height``."""
    return failures.groupBy("xid", node_location("hostname")[var].alias(var)).agg(F.count(F.lit(1)).alias("n"))


def project_node_hours(jobs: DataFrame, pernode: DataFrame) -> DataFrame:
    """Node-hours of each project over its valid jobs."""
    sized = with_job_size(jobs.select("allocation_id", "account", "begin_time", "end_time"), pernode).dropna()
    return valid_intervals(sized).groupBy("account").agg(F.sum("node_hours").alias("node_hours"))


def failures_per_project(
    failures: DataFrame, jobs: DataFrame, pernode: DataFrame, xids: tuple[int, ...] | None = None
) -> DataFrame:
    """Failures per node-hour by project and code, with the project's total rate."""
    df = failures.select("account", "xid").dropna()
    if xids is not None:
        df = df.filter(F.col("xid").isin(list(xids)))
    counts = df.groupBy("account", "xid").agg(F.count(F.lit(1)).alias("n"))
    rates = counts.join(project_node_hours(jobs, pernode), "account").withColumn(
        "freq", F.try_divide(F.col("n").cast("double"), F.col("node_hours"))
    )
    # At most one row per code in a project.
    return rates.withColumn("total_freq", F.sum("freq").over(Window.partitionBy("account")))


def top_projects(rates: DataFrame, n: int = 15) -> DataFrame:
    """All rows of the ``n`` projects with the highest total rate."""
    best = (
        rates.groupBy("account").agg(F.max("total_freq").alias("t")).orderBy(F.desc("t"), F.asc("account")).limit(n)
    )
    return rates.join(best.select("account"), "account", "left_semi")


def sheet_letters(place: Column) -> Column:
    """A to Z, then AA, AB and so on, for numbers from 1."""
    digits = F.lit("")
    for power in range(6):  # six letters number 300 million
        # Numbers of at least power + 1 letters begin at 1 + 26 + ... + 26**power.
        first = sum(26**k for k in range(power + 1))
        letter = F.char(F.pmod(F.floor((place - first) / 26**power), F.lit(26)).cast("long") + 65)
        digits = F.concat(F.when(place >= first, letter).otherwise(F.lit("")), digits)
    return digits


def project_labels(accounts: DataFrame, domains: DataFrame) -> DataFrame:
    """Neutral project names: domain description and a letter, in account order.

    ``domains`` has one row (domain, description) per domain.
    """
    distinct = accounts.select("account").distinct().withColumn("domain", F.substring("account", 1, 3))
    named = distinct.join(domains, "domain", "left")
    place = F.dense_rank().over(Window.partitionBy("domain").orderBy("account")).cast("long")
    return named.select(
        "account",
        F.concat(F.coalesce("description", "domain"), F.lit(" "), sheet_letters(place)).alias("label"),
    )


def failure_zscores(
    failures: DataFrame,
    nodes: DataFrame,
    pernode: DataFrame,
    resolution: str = "10 seconds",
    id_col: str = "event_id",
    exact_time: str = "exact",
    gpu_col: str = "gpu",
    temps: list[str] | None = None,
    bucket: str = "1 hour",
    max_missing: float = 0.2,
) -> DataFrame:
    """Temperature of the failing GPU against all GPUs of its job at that tick.

    Every failure is kept.  A step that finds no match, or more than one, leaves
    its columns and all later ones missing; so does a job with more than
    ``max_missing`` of its sensors silent, for the z-score.

    The failures' jobs are found first.  A tick and a job then name the readings
    that are wanted, so that readings are only filtered by ticks and joined by
    (tick, host): no job's statistics are made but those of a failure.
    """
    temps = temps or sensors.mean_of(sensors.GPU_CORE_TEMPS)
    base = failures.withColumn("timestamp", round_to(exact_time, resolution))

    at_node = base.select(id_col, "timestamp", "hostname", gpu_col).join(
        nodes.select("timestamp", "hostname", *temps), ["timestamp", "hostname"]
    )
    at_node = at_node.select(id_col, pick_by_index(temps, gpu_col).alias("temp"))
    # One row per failure, read again below: settled, so the readings are scanned once.
    with_temp = settle(base.join(exactly_one(at_node, [id_col]), id_col, "left"))

    hot = with_temp.filter(F.col("temp").isNotNull()).select(id_col, "hostname", exact_time)
    job = exactly_one(jobs_at(hot, pernode, exact_time, bucket).select(id_col, "allocation_id"), [id_col])
    with_job = with_temp.join(job, id_col, "left")

    with_job = settle(with_job)

    wanted = with_job.select("timestamp", "allocation_id").dropna().distinct()
    runs = pernode.groupBy("allocation_id", "node_name").agg(F.min("begin_time").alias("__b"), F.max("end_time").alias("__e"))
    on = wanted.join(runs, "allocation_id")
    on = on.where(F.col("timestamp").between(round_to("__b", resolution), round_to("__e", resolution)))
    on = on.select("timestamp", F.col("node_name").alias("hostname"), "allocation_id")
    at_ticks = nodes.select("timestamp", "hostname", *temps).join(few(wanted.select("timestamp").distinct()), "timestamp", "left_semi")
    stats = comptype_stats(at_ticks.join(on, ["timestamp", "hostname"]), ["timestamp", "allocation_id"], {"gpu_core": temps})
    of_job = stats.select(
        "timestamp",
        "allocation_id",
        F.col("gpu_core_mean").alias("mean"),
        F.col("gpu_core_std").alias("std"),
        (F.lit(1.0) - F.col("gpu_core_count") / F.col("gpu_core_size")).alias("__missing"),
    )
    joined = with_job.join(of_job, ["timestamp", "allocation_id"], "left")
    z = F.when(F.col("__missing") <= max_missing, F.try_divide(F.col("temp") - F.col("mean"), F.col("std")))
    return joined.withColumn("z", z).drop("__missing")
