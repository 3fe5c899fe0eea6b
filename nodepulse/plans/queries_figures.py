"""Checked queries: the numbers behind the figures."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import sensors
from ..functions.derive import lookup, node_class, to_unit
from ..functions.places import node_location
from ..operators import densities
from ..operators import distributions as dist
from ..operators import edges as ed
from ..operators import reshape
from ..operators.jobs import job_component_summary
from ..operators.order_stats import exact_quantiles
from . import fixtures as fx
from .queries_edges import DURATION_CTES, SPECTRUM_CTES, _JOB, durations, spectrum
from .queries_failures import failures
from .queries_jobs import (
    COMPONENT_SUMMARY_CTES,
    POWER_ENERGY_CTES,
    job_component_series,
    job_power_series,
    power_energy_table,
)
from .queries_nodes import class_sql
from .registry import check_sql, query, tidy

CLASSED_SQL = f"""classed as (select p.*, {class_sql("num_nodes", (5, 4, 3, 2, 1))} as class,
  {class_sql("num_nodes", sensors.NODE_CLASS_NAMES)} as node_cat, coalesce(description, job_domain) as job_group
  from power_energy p left join domains on domain = job_domain)"""
_CLASSED = (*POWER_ENERGY_CTES, fx.DOMAINS_SQL, CLASSED_SQL)


def classed(spark, sf):
    df = power_energy_table(spark, sf).withColumns(
        {
            "class": node_class("num_nodes", fx.CUTS),
            "node_cat": node_class("num_nodes", fx.CUTS, sensors.NODE_CLASS_NAMES),
        }
    )
    return lookup(df.withColumnRenamed("job_domain", "domain"), fx.domains(spark, sf), "domain", "description", "job_group")


def box_sql(table: str, keys: str, col: str) -> str:
    k = keys.split(", ")
    on = " and ".join(f"t.{c} is not distinct from q.{c}" for c in k)
    return f"""select {", ".join("t." + c for c in k)}, count(*) as n, max(q1) as q1, max(median) as median, max(q3) as q3,
    min(v) filter (where v >= q1 - 1.5 * (q3 - q1)) as whisker_low, max(v) filter (where v <= q3 + 1.5 * (q3 - q1)) as whisker_high,
    min(v) as lowest, max(v) as highest from (select {keys}, {col} as v from {table} where {col} is not null) t
    join (select {keys}, quantile_cont({col}, 0.25) as q1, quantile_cont({col}, 0.5) as median, quantile_cont({col}, 0.75) as q3
      from {table} group by all) q on {on} group by {", ".join("t." + c for c in k)}"""


_BOX = ["q1", "median", "q3", "whisker_low", "whisker_high", "lowest", "highest"]
_WEEKLY = ["k100_total_power", "k100_pue", "cep_outside_air_wet_bulb_temp", "cep_mtw_tons", "cep_chilled_water_tons"]


@query(
    "weekly_boxplot",
    check_sql(
        box_sql("weekly", "week, metric", "value"),
        fx.COOLING_SQL,
        "weekly as (" + " union all ".join(f"select cast(week(timestamp) as int) as week, '{c}' as metric, {c} as value from cooling" for c in _WEEKLY) + ")",
        doubles=_BOX,
    ),
)
def weekly_boxplot(spark, sf):
    plant = fx.cooling(spark, sf).withColumn("week", F.weekofyear("timestamp"))
    return tidy(dist.box_summary(reshape.melt(plant, ["week"], _WEEKLY, "metric"), ["week", "metric"], "value"))


@query(
    "boxplot_by_domain",
    check_sql(box_sql("classed", "class, job_group", "max_sum_inp"), *_CLASSED, doubles=_BOX),
)
def boxplot_by_domain(spark, sf):
    return tidy(dist.box_summary(classed(spark, sf), ["class", "job_group"], "max_sum_inp"))


@query(
    "domains_by_median",
    check_sql("select job_group, quantile_cont(energy, 0.5) as median from classed group by job_group", *_CLASSED, doubles=["median"]),
)
def domains_by_median(spark, sf):
    return tidy(dist.groups_by_median(classed(spark, sf), "job_group", "energy"))


GPU_LONG_SQL = "gpu_long as (" + " union all ".join(
    f"select timestamp, hostname, {k} as gpu, {p}_mean as gpu_power, {t}_mean as gpu_core, {t}_max as gpu_max from nodes"
    for k, (p, t) in enumerate(zip(sensors.GPU_POWERS, sensors.GPU_CORE_TEMPS))
) + ")"
_GPU_CTES = (fx.NODES_SQL, GPU_LONG_SQL)


def gpu_long_table(spark, sf):
    nodes = fx.nodes(spark, sf, sensors.GPU_POWERS + sensors.GPU_CORE_TEMPS)
    return dist.gpu_long(nodes, ["timestamp", "hostname"])


@query("gpu_long", check_sql("select * from gpu_long", *_GPU_CTES, doubles=["gpu_power", "gpu_core", "gpu_max"]))
def gpu_long(spark, sf):
    return tidy(gpu_long_table(spark, sf))


@query(
    "boxplot_per_day",
    check_sql(
        box_sql("daily", "day", "gpu_power"),
        *_GPU_CTES,
        "daily as (select cast(cast(timestamp as date) as varchar) as day, gpu_power from gpu_long)",
        doubles=_BOX,
    ),
)
def boxplot_per_day(spark, sf):
    long = gpu_long_table(spark, sf).withColumn("day", F.to_date("timestamp").cast("string"))
    return tidy(dist.box_summary(long, ["day"], "gpu_power"))


@query(
    "iqr_spread",
    check_sql(
        """select metric, quantile_cont(value, 0.25) as q25, quantile_cont(value, 0.75) as q75,
        4 * (quantile_cont(value, 0.75) - quantile_cont(value, 0.25)) as spread from (
        select 'gpu_power' as metric, gpu_power as value from gpu_long union all select 'gpu_core', gpu_core from gpu_long) m group by metric""",
        *_GPU_CTES,
        doubles=["q25", "q75", "spread"],
    ),
)
def iqr_spread(spark, sf):
    long = reshape.melt(gpu_long_table(spark, sf), [], ["gpu_power", "gpu_core"], "metric")
    return tidy(dist.iqr_spread(long, ["metric"], "value"))


@query(
    "value_quantiles",
    check_sql(
        """select l_returnflag, quantile_cont(l_extendedprice, 0.01) as q01, quantile_cont(l_extendedprice, 0.5) as q50,
        quantile_cont(l_extendedprice, 0.999) as q999 from lineitem group by l_returnflag""",
        doubles=["q01", "q50", "q999"],
        digits=4,
    ),
)
def value_quantiles(spark, sf):
    """Quantiles of three large groups: no task sorts a group."""
    probs = {"q01": 0.01, "q50": 0.5, "q999": 0.999}
    return tidy(exact_quantiles(fx.table(spark, sf, "lineitem"), ["l_returnflag"], "l_extendedprice", probs), 4)


# ---- distribution functions

_METRICS = {
    "max_power": "max_sum_inp / 1000000",
    "mean_power": "mean_sum_inp / 1000000",
    "minutes": "job_time / 60",
    "hours": "job_time / 3600",
    "nodes": "num_nodes",
    "node_hours": "node_hours",
    "max_less_mean": "(max_sum_inp - mean_sum_inp) / 1000000",
}
METRICS_SQL = "metrics as (" + " union all ".join(
    f"select node_cat, '{m}' as metric, round(cast({e} as double), 12) as value from classed" for m, e in _METRICS.items()
) + ")"


def metrics_long(spark, sf):
    df = classed(spark, sf).select("node_cat", *[F.round(F.expr(e).cast("double"), 12).alias(m) for m, e in _METRICS.items()])
    return reshape.melt(df, ["node_cat"], list(_METRICS), "metric")


@query(
    "ecdf",
    check_sql(
        """select node_cat, metric, value, count(*) as n, 100.0 * (min(r) - 1) / nullif(max(total) - 1, 0) as cdf_first,
        100.0 * (max(r) - 1) / nullif(max(total) - 1, 0) as cdf_last from (select *, row_number() over (partition by node_cat, metric order by value) as r,
        count(*) over (partition by node_cat, metric) as total from metrics where value is not null) m group by node_cat, metric, value""",
        *_CLASSED,
        METRICS_SQL,
        doubles=["value", "cdf_first", "cdf_last"],
        digits=9,
        value=12,
    ),
)
def ecdf(spark, sf):
    return tidy(dist.ecdf(metrics_long(spark, sf), ["node_cat", "metric"], "value"), 9, value=12)


@query(
    "cdf_80",
    check_sql(
        """select node_cat, metric, value as value_at, total as n from (select *, row_number() over (partition by node_cat, metric order by value) - 1 as place,
        count(*) over (partition by node_cat, metric) as total from metrics where value is not null) m where place = floor((total - 1) * 0.8)""",
        *_CLASSED,
        METRICS_SQL,
        doubles=["value_at"],
    ),
)
def cdf_80(spark, sf):
    return tidy(dist.ecdf_mark(metrics_long(spark, sf), ["node_cat", "metric"], "value", 0.8))


# ---- densities

_POINTS = 32


def kde_sql(table: str, key: str, col: str) -> str:
    return f"""select s.{key}, cast(i as int) as i, low + i * step as x, sum(exp(-0.5 * pow((low + i * step - v) / h, 2))) / (max(n * h) * sqrt(2 * pi())) as density
    from (select {key}, n, h, a - 3.0 * h as low, (z + 3.0 * h - (a - 3.0 * h)) / {_POINTS - 1} as step from (
      select {key}, count({col}) as n, stddev_samp({col}) * pow(count({col}), -0.2) as h, min({col}) as a, max({col}) as z from {table} group by {key}) b where h > 0) s
    join (select {key}, {col} as v from {table} where {col} is not null) t on t.{key} = s.{key}
    join range({_POINTS}) g(i) on 1 = 1 group by all"""


LOGGED_SQL = "logged as (select class, log10(energy + 1) as log_energy, log10(max_sum_inp + 1) as log_power from classed where energy >= 0 and log10(max_sum_inp + 1) > 0)"


def logged(spark, sf):
    df = classed(spark, sf).filter("energy >= 0")
    return df.select(
        "class", F.log10(F.col("energy") + 1).alias("log_energy"), F.log10(F.col("max_sum_inp") + 1).alias("log_power")
    ).filter("log_power > 0")


@query("kde_1d", check_sql(kde_sql("logged", "class", "log_power"), *_CLASSED, LOGGED_SQL, doubles=["x", "density"]))
def kde_1d(spark, sf):
    return tidy(densities.kde_1d(logged(spark, sf), "class", "log_power", points=_POINTS))


@query("kde_frequency", check_sql(kde_sql("spectrum", "class", "freq"), *SPECTRUM_CTES, doubles=["x", "density"], digits=5))
def kde_frequency(spark, sf):
    return tidy(densities.kde_1d(spectrum(spark, sf), "class", "freq", points=_POINTS), 5)


@query(
    "kde_location",
    check_sql(kde_sql("places", "xid", "place"), fx.NODE_SQL, fx.FAILURES_SQL,
              "places as (select xid, cast(substr(hostname, 2, 2) as int) as place from failures)", doubles=["x", "density"]),
)
def kde_location(spark, sf):
    df = failures(spark, sf).select("xid", node_location("hostname")["rack"].alias("place"))
    return tidy(densities.kde_1d(df, "xid", "place", points=_POINTS))


_XG, _YG = (0.0, 6.0, 13), (0.0, 6.0, 13)


def kde2_sql(table: str, key: str, x: str, y: str, xg, yg) -> str:
    px, py = (f"{g[0]} + {i} * {(g[1] - g[0]) / (g[2] - 1)}" for g, i in ((xg, "i"), (yg, "j")))
    dx, dy = f"({px} - px)", f"({py} - py)"
    return f"""select s.{key}, {px} as x, {py} as y,
    sum(exp(-0.5 * (syy * {dx} * {dx} - 2 * sxy * {dx} * {dy} + sxx * {dy} * {dy}) / det)) / (max(n * sqrt(det)) * 2 * pi()) as density
    from (select *, sxx * syy - sxy * sxy as det from (select {key}, n, a * f as sxx, b * f as syy, c * f as sxy from (
      select {key}, count(*) as n, var_samp({x}) as a, var_samp({y}) as b, covar_samp({x}, {y}) as c, pow(count(*), -1.0 / 3) as f from {table} group by {key}) v) w) s
    join (select {key}, {x} as px, {y} as py from {table}) t on t.{key} = s.{key}
    join range({xg[2]}) g(i) on 1 = 1 join range({yg[2]}) h(j) on 1 = 1 where det > 0 group by s.{key}, i, j"""


@query(
    "kde_2d",
    check_sql(kde2_sql("logged", "class", "log_power", "log_energy", _XG, _YG), *_CLASSED, LOGGED_SQL, doubles=["x", "y", "density"]),
)
def kde_2d(spark, sf):
    return tidy(densities.kde_2d(logged(spark, sf), "class", "log_power", "log_energy", _XG, _YG))


_CG, _GG = (0.0, 2000.0, 9), (0.0, 3000.0, 9)


@query(
    "kde_cpu_gpu",
    check_sql(
        kde2_sql("parts", "class", "cpu", "gpu", _CG, _GG),
        *COMPONENT_SUMMARY_CTES,
        f"""parts as (select {class_sql("num_nodes", (5, 4, 3, 2, 1))} as class, mean_mean_cpu_pwr as cpu, mean_mean_gpu_pwr as gpu
        from component_summary s join (select distinct allocation_id, num_nodes from pernode) p on p.allocation_id = s.allocation_id
        where mean_mean_cpu_pwr is not null and mean_mean_gpu_pwr is not null)""",
        doubles=["x", "y", "density"],
        density=10,
    ),
)
def kde_cpu_gpu(spark, sf):
    sizes = fx.pernode_jobs(spark, sf).select("allocation_id", "num_nodes").distinct()
    df = job_component_summary(job_component_series(spark, sf)).join(sizes, "allocation_id")
    df = df.withColumn("class", node_class("num_nodes", fx.CUTS))
    return tidy(densities.kde_2d(df, "class", "mean_mean_cpu_pwr", "mean_mean_gpu_pwr", _CG, _GG), density=10)


# ---- histograms


@query(
    "hist_fixed",
    check_sql(
        "select xid, floor(gpu_temp / 2) * 2 as bin, count(*) as n from (select xid, 60 + (event_id * 7) % 40 as gpu_temp from failures) f group by all",
        fx.NODE_SQL,
        fx.FAILURES_SQL,
        doubles=["bin"],
    ),
)
def hist_fixed(spark, sf):
    df = failures(spark, sf).withColumn("gpu_temp", F.lit(60) + F.col("event_id") * 7 % 40)
    return tidy(dist.hist_fixed(df, ["xid"], "gpu_temp", 2))


@query(
    "hist_cumulative",
    check_sql(
        """select class, bin, n, cast(sum(n) over (partition by class order by bin) as double) / sum(n) over (partition by class) as share from (
        select class, floor(minutes / 0.25) * 0.25 as bin, count(*) as n from (select class, duration / 6 as minutes from durations) m group by all) h""",
        *DURATION_CTES,
        doubles=["bin", "share"],
    ),
)
def hist_cumulative(spark, sf):
    return tidy(dist.hist_cumulative(durations(spark, sf), ["class"], "minutes", 0.25))


@query(
    "edge_count_cumulative",
    check_sql(
        """select class, bin, n, cast(sum(n) over (partition by class order by bin) as double) / sum(n) over (partition by class) as share from (
        select class, cast(edges as double) as bin, count(*) as n from (select allocation_id, class, sum(cast(direction = d as int)) as edges
          from marked join (values (1), (-1)) t(d) on 1 = 1 group by allocation_id, class, d) e where edges <> 0 group by all) h""",
        *DURATION_CTES,
        doubles=["bin", "share"],
    ),
)
def edge_count_cumulative(spark, sf):
    counts = ed.edges_per_job(job_power_series(spark, sf), **_JOB).filter("n_edges <> 0")
    return tidy(dist.hist_cumulative(counts, ["class"], "n_edges", 1))


# ---- racks

_INSTANTS = ["2024-01-05 03:00:00", "2024-01-17 12:00:00"]
_PLACE = "ascii(substr(hostname, 1, 1)) - ascii('a') + 1 as row, cast(substr(hostname, 2, 2) as int) as rack"


@query(
    "rack_heatmap",
    check_sql(f"select timestamp, {_PLACE}, avg(gpu_core) as core_mean, max(gpu_max) as core_max from gpu_long group by all", *_GPU_CTES, doubles=["core_mean", "core_max"]),
)
def rack_heatmap(spark, sf):
    return tidy(dist.rack_heatmap(gpu_long_table(spark, sf)))


@query(
    "rack_heatmap_wide",
    check_sql(
        "select timestamp, rack, " + ", ".join(f"max(core_mean) filter (where row = {r}) as row_{r}" for r in range(1, 9)) +
        f" from (select timestamp, {_PLACE}, avg(gpu_core) as core_mean from gpu_long where timestamp in ({', '.join(f'timestamp {t!r}' for t in _INSTANTS)}) group by all) h group by timestamp, rack",
        *_GPU_CTES,
        doubles=[f"row_{r}" for r in range(1, 9)],
    ),
)
def rack_heatmap_wide(spark, sf):
    heat = dist.rack_heatmap(gpu_long_table(spark, sf), _INSTANTS)
    wide = reshape.pivot_fixed(heat, ["timestamp", "rack"], "row", "core_mean", list(range(1, 9)))
    return tidy(wide.withColumnsRenamed({str(r): f"row_{r}" for r in range(1, 9)}))


@query(
    "facility_units",
    check_sql("select timestamp, k100_total_power / 1000 as total_mw from cooling", fx.COOLING_SQL, doubles=["total_mw"]),
)
def facility_units(spark, sf):
    return tidy(fx.cooling(spark, sf).select("timestamp", to_unit("k100_total_power", 0.001).alias("total_mw")))
