"""Checked queries: jobs, intervals, thermal summaries, cooling plant, meters."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import places, sensors
from ..functions.derive import compute_nodes_only, node_hours
from ..operators import cluster, facility, intervals, jobs, reshape, thermal
from ..session import settle
from . import fixtures as fx
from .queries_nodes import (
    COMPONENT_DOUBLES,
    COMPONENT_SENSORS,
    COMPONENT_SQL,
    COMPONENT_STATS_SQL,
    band_count_sql,
    mask_sql,
    stats_doubles,
    stats_sql,
)
from . import jobs as whole
from .registry import check_sql, query, tidy

_HOUR_FLOOR = "date_trunc('hour', begin_time)"
_HOUR_CEIL = "case when end_time = date_trunc('hour', end_time) then end_time else date_trunc('hour', end_time) + interval 1 hour end"
SPANS_SQL = f"""spans as (select distinct allocation_id, node_name, num_nodes, {_HOUR_FLOOR} as b, {_HOUR_CEIL} as e from pernode)"""


def joined_sql(table: str, name: str) -> str:
    return f"""{name} as (select t.*, s.allocation_id, s.node_name, s.num_nodes from {table} t
    join spans s on t.hostname = s.node_name and t.timestamp between s.b and s.e)"""


# ---- interval joins


@query(
    "job_interval_join",
    check_sql(
        "select timestamp, hostname, allocation_id, num_nodes, input_power_mean from joined",
        fx.NODES_SQL,
        fx.PERNODE_SQL,
        SPANS_SQL,
        joined_sql("nodes", "joined"),
        doubles=["input_power_mean"],
    ),
)
def job_interval_join(spark, sf):
    df = intervals.join_jobs_by_time(fx.nodes(spark, sf, ["input_power"]), fx.pernode_jobs(spark, sf), fx.HOUR, "6 hours")
    return tidy(df.select("timestamp", "hostname", "allocation_id", "num_nodes", "input_power_mean"))


TICKS_SQL = """ticks as (
  select unnest(generate_series(b, e, interval 1 hour)) as timestamp, node_name as hostname, allocation_id from (
    select allocation_id, node_name,
      make_timestamp(cast(round_even(cast(epoch_us(begin_time) as double) / 3600000000, 0) as bigint) * 3600000000) as b,
      make_timestamp(cast(round_even(cast(epoch_us(end_time) as double) / 3600000000, 0) as bigint) * 3600000000) as e
    from pernode) r where b <= e)"""


TICKED_SQL = "ticked as (select n.*, t.allocation_id from nodes n join ticks t on t.timestamp = n.timestamp and t.hostname = n.hostname)"


def _ticks(spark, sf):
    return intervals.expand_job_ticks(fx.pernode_jobs(spark, sf), fx.HOUR)


@query("job_ticks", check_sql("select * from ticks", fx.NODE_SQL, fx.PERNODE_SQL, TICKS_SQL))
def job_ticks(spark, sf):
    return _ticks(spark, sf)


@query(
    "join_ticks",
    check_sql(
        "select n.timestamp, n.hostname, t.allocation_id, n.input_power_mean from nodes n join ticks t on t.timestamp = n.timestamp and t.hostname = n.hostname",
        fx.NODES_SQL,
        fx.PERNODE_SQL,
        TICKS_SQL,
        doubles=["input_power_mean"],
    ),
)
def join_ticks(spark, sf):
    df = intervals.join_ticks(fx.nodes(spark, sf, ["input_power"]), _ticks(spark, sf))
    return tidy(df.select("timestamp", "hostname", "allocation_id", "input_power_mean"))


FAILURE_JOBS_SQL = """failure_jobs as (select f.event_id, f.hostname, p.allocation_id from failures f
  join (select distinct allocation_id, node_name, begin_time, end_time from pernode) p
  on p.node_name = f.hostname and f.exact > p.begin_time and f.exact <= p.end_time)"""


def _failures(spark, sf):
    return compute_nodes_only(fx.gpu_failures(spark, sf))


@query(
    "failure_jobs",
    check_sql("select * from failure_jobs", fx.NODE_SQL, fx.PERNODE_SQL, fx.FAILURES_SQL, FAILURE_JOBS_SQL),
)
def failure_jobs(spark, sf):
    df = intervals.jobs_at(_failures(spark, sf), fx.pernode_jobs(spark, sf), "exact")
    return df.select("event_id", "hostname", "allocation_id")


@query(
    "exactly_one_job",
    check_sql(
        "select event_id, min(hostname) as hostname, min(allocation_id) as allocation_id from failure_jobs group by event_id having count(*) = 1",
        fx.NODE_SQL,
        fx.PERNODE_SQL,
        fx.FAILURES_SQL,
        FAILURE_JOBS_SQL,
    ),
)
def exactly_one_job(spark, sf):
    matches = intervals.jobs_at(_failures(spark, sf), fx.pernode_jobs(spark, sf), "exact")
    return intervals.exactly_one(matches.select("event_id", "hostname", "allocation_id"), ["event_id"])


# ---- job series

_NODE_COUNTS_SQL = (
    "count(hostname) as count_hostname, count(node_name) as count_node_name, min(num_nodes) as job_sch_node_num"
)
JOB_POWER_SQL = f"""job_power as (select timestamp, allocation_id, {_NODE_COUNTS_SQL},
  {stats_sql("input_power_mean", "inp", cluster.POWER_KINDS)}, {stats_sql("total_power_mean", "top", cluster.POWER_KINDS)}
  from joined group by timestamp, allocation_id)"""
JOB_POWER_CTES = (fx.NODES_SQL, fx.PERNODE_SQL, SPANS_SQL, joined_sql("nodes", "joined"), JOB_POWER_SQL)


def job_power_series(spark, sf):
    nodes = fx.nodes(spark, sf, ["input_power", "total_power"])
    return jobs.job_power_ts(nodes, fx.pernode_jobs(spark, sf), fx.HOUR, "6 hours")


@query(
    "job_power_ts",
    check_sql("select * from job_power", *JOB_POWER_CTES, doubles=stats_doubles(["inp", "top"], cluster.POWER_KINDS)),
)
def job_power_ts(spark, sf):
    return tidy(job_power_series(spark, sf))


JOB_COMPONENT_SQL = f"""job_component as (select timestamp, allocation_id, {_NODE_COUNTS_SQL}, {COMPONENT_STATS_SQL}
  from joined group by timestamp, allocation_id)"""
_COMPONENT_CTES = (fx.NODES_SQL, fx.PERNODE_SQL, SPANS_SQL, COMPONENT_SQL, joined_sql("component", "joined"), JOB_COMPONENT_SQL)


def job_component_series(spark, sf):
    nodes = fx.nodes(spark, sf, COMPONENT_SENSORS)
    return jobs.job_component_ts(nodes, fx.pernode_jobs(spark, sf), fx.HOUR, "6 hours")


@query("job_component_ts", check_sql("select * from job_component", *_COMPONENT_CTES, doubles=COMPONENT_DOUBLES))
def job_component_ts(spark, sf):
    return tidy(job_component_series(spark, sf))


SUMMARY_SQL = """job_summary as (select allocation_id, max(sum_top) as max_sum_top, max(sum_inp) as max_sum_inp,
  avg(sum_inp) as mean_sum_inp, max(max_inp) as max_max_inp, min(min_inp) as min_min_inp, max(count_inp) as max_hosts_count,
  max(size_inp) as max_hosts_size, min(timestamp) as begin_time, max(timestamp) as end_time from job_power group by allocation_id)"""
_SUMMARY_DOUBLES = ["max_sum_top", "max_sum_inp", "mean_sum_inp", "max_max_inp", "min_min_inp"]


@query(
    "job_power_summary",
    check_sql("select * from job_summary", *JOB_POWER_CTES, SUMMARY_SQL, doubles=_SUMMARY_DOUBLES),
)
def job_power_summary(spark, sf):
    return tidy(jobs.job_power_summary(job_power_series(spark, sf)))


COMPONENT_SUMMARY_SQL = "component_summary as (select allocation_id, " + ", ".join(
    f"avg(mean_{p}_power) as mean_mean_{p}_pwr, max(mean_{p}_power) as max_mean_{p}_pwr, min(mean_{p}_power) as min_mean_{p}_pwr, "
    f"max(max_{p}_power) as max_max_{p}_pwr, arg_min(count_{p}_power, timestamp) as count_{p}_power"
    for p in ("cpu", "gpu")
) + ", min(timestamp) as begin_time, max(timestamp) as end_time from job_component group by allocation_id)"
COMPONENT_SUMMARY_CTES = (*_COMPONENT_CTES, COMPONENT_SUMMARY_SQL)


@query(
    "job_component_summary",
    check_sql(
        "select * from component_summary",
        *COMPONENT_SUMMARY_CTES,
        doubles=[f"{k}_{p}_pwr" for k in ("mean_mean", "max_mean", "min_mean", "max_max") for p in ("cpu", "gpu")],
        digits=8,
    ),
)
def job_component_summary(spark, sf):
    return tidy(jobs.job_component_summary(job_component_series(spark, sf)), 8)


_SLIM = ["timestamp", "allocation_id", "sum_inp"]


@query(
    "job_first_day",
    check_sql(
        """select * replace (cast(first_date as varchar) as first_date) from (
        select timestamp, allocation_id, sum_inp, min(cast(timestamp as date)) over (partition by allocation_id) as first_date from job_power) x
        where cast(timestamp as date) <= first_date + 1""",
        *JOB_POWER_CTES,
        doubles=["sum_inp"],
    ),
)
def job_first_day(spark, sf):
    df = jobs.first_day_jobs(job_power_series(spark, sf), horizon_days=1)
    return tidy(df.select(*_SLIM, F.col("first_date").cast("string")))


@query(
    "job_all_days_summary",
    check_sql(
        "select cast(min(cast(timestamp as date)) as varchar) as first_date, allocation_id, max(sum_inp) as max_sum_inp, count(*) as ticks from job_power group by allocation_id",
        *JOB_POWER_CTES,
        doubles=["max_sum_inp"],
    ),
)
def job_all_days_summary(spark, sf):
    df = jobs.first_day_jobs(job_power_series(spark, sf))
    return tidy(
        df.groupBy(F.col("first_date").cast("string").alias("first_date"), "allocation_id").agg(F.max("sum_inp").alias("max_sum_inp"), F.count(F.lit(1)).alias("ticks"))
    )


_RAN_SQL = "(select 1 from job_power q where q.allocation_id = p.allocation_id and cast(q.timestamp as date) = cast(p.timestamp as date) - 1)"


@query(
    "continued_jobs",
    check_sql(
        f"select timestamp, allocation_id, sum_inp, cast(cast(timestamp as date) as varchar) as date from job_power p where exists {_RAN_SQL}",
        *JOB_POWER_CTES,
        doubles=["sum_inp"],
    ),
)
def continued_jobs(spark, sf):
    return tidy(jobs.continued_jobs(job_power_series(spark, sf)).select(*_SLIM, F.col("date").cast("string")))


@query(
    "new_jobs",
    check_sql(
        f"select timestamp, allocation_id, sum_inp, cast(cast(timestamp as date) as varchar) as date from job_power p where not exists {_RAN_SQL}",
        *JOB_POWER_CTES,
        doubles=["sum_inp"],
    ),
)
def new_jobs(spark, sf):
    return tidy(jobs.new_jobs(job_power_series(spark, sf)).select(*_SLIM, F.col("date").cast("string")))


ENERGY_SQL = """energy as (select *, substr(account, 1, 3) as job_domain, (epoch_us(end_time) - epoch_us(begin_time)) / 1000000 as job_time from (
  select allocation_id, primary_job_id, sum(energy) as energy, sum(gpu_energy) as gpu_energy, min(num_nodes) as num_nodes,
  min(num_gpus) as num_gpus, min(begin_time) as begin_time, min(end_time) as end_time, min(account) as account
  from pernode group by allocation_id, primary_job_id) g)"""


def energy(spark, sf):
    return jobs.job_energy(fx.pernode_jobs(spark, sf))


@query(
    "job_energy",
    check_sql("select * from energy", fx.NODE_SQL, fx.PERNODE_SQL, ENERGY_SQL, doubles=["energy", "gpu_energy", "job_time"]),
)
def job_energy(spark, sf):
    return tidy(energy(spark, sf))


POWER_ENERGY_SQL = """power_energy as (select e.allocation_id, e.energy, e.num_nodes, e.job_domain, e.job_time,
  e.num_nodes * e.job_time / 3600 as node_hours, s.max_sum_inp, s.max_sum_top, s.mean_sum_inp
  from energy e join job_summary s on s.allocation_id = e.allocation_id)"""
POWER_ENERGY_CTES = (*JOB_POWER_CTES, SUMMARY_SQL, ENERGY_SQL, POWER_ENERGY_SQL)


def power_energy_table(spark, sf):
    left = energy(spark, sf).select("allocation_id", "energy", "num_nodes", "job_domain", "job_time")
    right = jobs.job_power_summary(job_power_series(spark, sf)).select("allocation_id", "max_sum_inp", "max_sum_top", "mean_sum_inp")
    return left.withColumn("node_hours", node_hours("num_nodes", "job_time")).join(right, "allocation_id")


@query(
    "power_energy_join",
    check_sql(
        "select * from power_energy",
        *POWER_ENERGY_CTES,
        doubles=["energy", "job_time", "node_hours", "max_sum_inp", "max_sum_top", "mean_sum_inp"],
    ),
)
def power_energy_join(spark, sf):
    return tidy(power_energy_table(spark, sf))


@query(
    "job_size_join",
    check_sql(
        """select j.allocation_id, j.account, c.size, (epoch_us(j.end_time) - epoch_us(j.begin_time)) / 1000000 / 3600 * c.size as node_hours
        from jobs j join (select allocation_id, count(*) as size from pernode group by 1) c on c.allocation_id = j.allocation_id""",
        fx.NODE_SQL,
        fx.PERNODE_SQL,
        doubles=["node_hours"],
    ),
)
def job_size_join(spark, sf):
    df = jobs.with_job_size(fx.jobs(spark, sf), fx.pernode_jobs(spark, sf))
    return tidy(df.select("allocation_id", "account", "size", "node_hours"))


_FULL_SQL = "(select p.node_name from pernode p where p.num_nodes >= 20)"


@query(
    "nodes_of_large_jobs",
    check_sql(f"select event_id, hostname from telemetry where hostname in {_FULL_SQL}", fx.TELEMETRY_SQL, fx.PERNODE_SQL),
)
def nodes_of_large_jobs(spark, sf):
    large = fx.pernode_jobs(spark, sf).filter("num_nodes >= 20").select(F.col("node_name").alias("hostname"))
    return reshape.keep_members(fx.telemetry(spark, sf).select("event_id", "hostname"), large, ["hostname"])


@query(
    "nodes_outside_project",
    check_sql(
        "select node_id, hostname from node_dim where hostname not in (select node_name from pernode where account = 'asc000')",
        fx.NODE_SQL,
        fx.PERNODE_SQL,
    ),
)
def nodes_outside_project(spark, sf):
    project = fx.pernode_jobs(spark, sf).filter("account = 'asc000'").select(F.col("node_name").alias("hostname"))
    return reshape.drop_members(fx.node_dim(spark, sf).select("node_id", "hostname"), project, ["hostname"])


# ---- thermal

_CORES, _MEMS = sensors.mean_of(sensors.GPU_CORE_TEMPS), sensors.mean_of(sensors.GPU_MEM_TEMPS)
_TEMPS = sensors.GPU_CORE_TEMPS + sensors.GPU_MEM_TEMPS


def flags_sql(table: str, keys: str, low, high) -> str:
    return f"""flags as (select {keys}, ({' or '.join(f'{c} is null' for c in _CORES + _MEMS)}) as any_nan,
    {mask_sql(_CORES + _MEMS, low, high)} as hot_gpus, {band_count_sql(_CORES, 'n_cores', low, high)},
    {band_count_sql(_MEMS, 'n_mems', low, high)} from {table})"""


def bands_sql(keys: str) -> str:
    sums = ", ".join(f"cast(sum({p}_band{k}) as bigint) as {p}_band{k}" for p in ("n_cores", "n_mems") for k in range(5))
    return f"""select {keys}, count(*) as nodes, cast(sum(cast(any_nan as int)) as bigint) as any_nan,
    coalesce(array_to_string(list_sort(list(hot_gpus) filter (where hot_gpus is not null)), ' '), '') as hot_gpus, {sums} from flags group by all"""


def _joined_masks(df):
    return df.withColumn("hot_gpus", F.array_join("hot_gpus", " "))


@query("thermal_bands_cluster", check_sql(bands_sql("timestamp"), fx.NODES_SQL, flags_sql("nodes", "timestamp", 0, 150)))
def thermal_bands_cluster(spark, sf):
    return _joined_masks(thermal.thermal_bands(fx.nodes(spark, sf, _TEMPS), ["timestamp"]))


@query(
    "thermal_bands_job",
    check_sql(
        bands_sql("timestamp, allocation_id"),
        fx.NODES_SQL,
        fx.PERNODE_SQL,
        TICKS_SQL,
        TICKED_SQL,
        flags_sql("ticked", "timestamp, allocation_id", None, None),
    ),
)
def thermal_bands_job(spark, sf):
    pernode = fx.pernode_jobs(spark, sf)
    joined = intervals.join_jobs_by_time(fx.nodes(spark, sf, _TEMPS), pernode, fx.HOUR, "6 hours", ends="nearest")
    bands = thermal.thermal_bands(joined, ["timestamp", "allocation_id"], value_range=sensors.JOB_BAND_RANGE)
    return _joined_masks(bands)


def long_sql(table: str, keys: str) -> str:
    parts = [f"select {keys}, '{kind}' as comptype, {c} as temp from {table}" for kind, cols in fx.COMPTYPES.items() for c in cols]
    return "long as (" + " union all ".join(parts) + ")"


def comptype_sql(keys: str) -> str:
    make = {
        "mean": "avg(temp)", "std": "stddev_samp(temp)", "min": "min(temp)", "max": "max(temp)",
        "q25": "quantile_cont(temp, 0.25)", "q50": "quantile_cont(temp, 0.5)", "q75": "quantile_cont(temp, 0.75)",
        "size": "count(*)", "count": "count(temp)",
    }
    cols = ", ".join(
        f"{expr} filter (where comptype = '{kind}') as {kind}_{k}" for kind in fx.COMPTYPES for k, expr in make.items()
    )
    return f"select {keys}, {cols} from long group by all"


COMPTYPE_DOUBLES = [f"{kind}_{k}" for kind in fx.COMPTYPES for k in thermal.COMPTYPE_KINDS if k not in ("size", "count")]
COMPTYPE_SENSORS = [c.removesuffix("_mean") for cols in fx.COMPTYPES.values() for c in cols]


@query(
    "comptype_cluster",
    check_sql(comptype_sql("timestamp"), fx.NODES_SQL, long_sql("nodes", "timestamp"), doubles=COMPTYPE_DOUBLES),
)
def comptype_cluster(spark, sf):
    return tidy(thermal.comptype_stats(fx.nodes(spark, sf, COMPTYPE_SENSORS), ["timestamp"], fx.COMPTYPES))


JOB_COMPTYPE_CTES = (fx.NODES_SQL, fx.PERNODE_SQL, TICKS_SQL, TICKED_SQL, long_sql("ticked", "timestamp, allocation_id"))


def job_comptypes(spark, sf):
    """Component statistics of jobs."""
    nodes, pernode = fx.nodes(spark, sf, COMPTYPE_SENSORS), fx.pernode_jobs(spark, sf)
    # Read by the join and by the statistics.
    nodes = settle(intervals.with_tick(nodes, fx.HOUR).select("timestamp", "hostname", intervals.TICK, *[c for cols in fx.COMPTYPES.values() for c in cols]))
    joined = intervals.join_jobs_by_time(nodes.select("timestamp", "hostname", intervals.TICK), pernode, fx.HOUR, "6 hours", ends="nearest")
    return thermal.comptype_stats(nodes, ["timestamp", "allocation_id"], fx.COMPTYPES, members=joined)


@query("comptype_job", check_sql(comptype_sql("timestamp, allocation_id"), *JOB_COMPTYPE_CTES, doubles=COMPTYPE_DOUBLES))
def comptype_job(spark, sf):
    return tidy(job_comptypes(spark, sf))


# ---- cooling plant and meters

_PLANT = ["k100_total_power", "k100_pue", "mtwst"]


def interpolated_sql(name: str, step: int) -> str:
    us = step * 1_000_000
    return f"""pairs as (select epoch_us(timestamp) as t, lead(epoch_us(timestamp)) over w as t1,
    {", ".join(f"v{i}, lead(v{i}) over w as w{i}" for i in range(len(_PLANT)))}
    from (select timestamp, {", ".join(f"avg({c}) as v{i}" for i, c in enumerate(_PLANT))} from cooling group by timestamp) s
    window w as (order by timestamp)),
  {name} as (select make_timestamp(g) as timestamp,
    {", ".join(f"case when g = t then v{i} else v{i} + (w{i} - v{i}) * ((g - t) / (t1 - t)) end as {c}" for i, c in enumerate(_PLANT))}
    from (select *, unnest(generate_series(cast(ceil(t / {us}) as bigint) * {us}, coalesce(t1 - 1, t), {us})) as g from pairs) x)"""


@query(
    "cep_interpolated",
    check_sql(f"select * from plant", fx.COOLING_SQL, interpolated_sql("plant", 600), doubles=_PLANT, digits=5),
)
def cep_interpolated(spark, sf):
    return tidy(facility.interpolate_to_grid(fx.cooling(spark, sf), "10 minutes", _PLANT), 5)


@query(
    "cep_join",
    check_sql(
        f"select b.*, {', '.join(f'p.{c}' for c in _PLANT)} from ({bands_sql('timestamp')}) b left join plant p on p.timestamp = b.timestamp",
        fx.NODES_SQL,
        flags_sql("nodes", "timestamp", 0, 150),
        fx.COOLING_SQL,
        interpolated_sql("plant", 3600),
        doubles=_PLANT,
        digits=5,
    ),
)
def cep_join(spark, sf):
    bands = thermal.thermal_bands(fx.nodes(spark, sf, _TEMPS), ["timestamp"])
    plant = facility.interpolate_to_grid(fx.cooling(spark, sf), fx.HOUR, _PLANT)
    return tidy(_joined_masks(intervals.with_facility(bands, plant)), 5)


# ---- whole jobs, from node aggregates to stored results


def _plant(spark, sf):
    return facility.interpolate_to_grid(fx.cooling(spark, sf), fx.HOUR, _PLANT)


def _with_plant(select: str) -> str:
    return f"select b.*, {', '.join(f'p.{c}' for c in _PLANT)} from ({select}) b left join plant p on p.timestamp = b.timestamp"


_PLANT_CTES = (fx.COOLING_SQL, interpolated_sql("plant", 3600))


@query("whole_job_power", check_sql("select * from job_summary", *JOB_POWER_CTES, SUMMARY_SQL, doubles=_SUMMARY_DOUBLES))
def whole_job_power(spark, sf):
    nodes = fx.nodes(spark, sf, ["input_power", "total_power"])
    return tidy(whole.job_power(nodes, fx.pernode_jobs(spark, sf), fx.HOUR)[1])


@query(
    "whole_job_components",
    check_sql(
        "select * from component_summary",
        *COMPONENT_SUMMARY_CTES,
        doubles=[f"{k}_{p}_pwr" for k in ("mean_mean", "max_mean", "min_mean", "max_max") for p in ("cpu", "gpu")],
        digits=8,
    ),
)
def whole_job_components(spark, sf):
    nodes = fx.nodes(spark, sf, COMPONENT_SENSORS)
    return tidy(whole.job_components(nodes, fx.pernode_jobs(spark, sf), fx.HOUR)[1], 8)


@query(
    "whole_job_thermal",
    check_sql(
        _with_plant(bands_sql("timestamp, allocation_id")),
        fx.NODES_SQL,
        fx.PERNODE_SQL,
        TICKS_SQL,
        TICKED_SQL,
        flags_sql("ticked", "timestamp, allocation_id", None, None),
        *_PLANT_CTES,
        doubles=_PLANT,
        digits=5,
    ),
)
def whole_job_thermal(spark, sf):
    out = whole.job_thermal(fx.nodes(spark, sf, _TEMPS), fx.pernode_jobs(spark, sf), _plant(spark, sf), fx.HOUR)
    return tidy(_joined_masks(out), 5)


@query(
    "whole_cluster_thermal",
    check_sql(_with_plant(bands_sql("timestamp")), fx.NODES_SQL, flags_sql("nodes", "timestamp", 0, 150), *_PLANT_CTES, doubles=_PLANT, digits=5),
)
def whole_cluster_thermal(spark, sf):
    return tidy(_joined_masks(whole.cluster_thermal(fx.nodes(spark, sf, _TEMPS), _plant(spark, sf))), 5)


@query(
    "whole_cluster_comptypes",
    check_sql(
        _with_plant(comptype_sql("timestamp")), fx.NODES_SQL, long_sql("nodes", "timestamp"), *_PLANT_CTES,
        doubles=[*COMPTYPE_DOUBLES, *_PLANT], digits=5,
    ),
)
def whole_cluster_comptypes(spark, sf):
    return tidy(whole.cluster_comptypes(fx.nodes(spark, sf, COMPTYPE_SENSORS), _plant(spark, sf), fx.COMPTYPES), 5)


@query(
    "whole_job_comptypes",
    check_sql(
        _with_plant(comptype_sql("timestamp, allocation_id")), *JOB_COMPTYPE_CTES, *_PLANT_CTES, doubles=[*COMPTYPE_DOUBLES, *_PLANT], digits=5
    ),
)
def whole_job_comptypes(spark, sf):
    nodes = fx.nodes(spark, sf, COMPTYPE_SENSORS)
    return tidy(whole.job_comptypes(nodes, fx.pernode_jobs(spark, sf), _plant(spark, sf), fx.HOUR, fx.COMPTYPES), 5)


def resampled_sql(name: str, table: str, bucket: str, cols: list[str], keys: str = "") -> str:
    key_list = f"{keys}, " if keys else ""
    grid = f"""(select {key_list}unnest(generate_series(min({bucket}), max({bucket}), interval '{name[1]}')) as timestamp from {table} {'group by ' + keys if keys else ''})"""
    on = "m.timestamp = g.timestamp" + (f" and m.{keys} = g.{keys}" if keys else "")
    return f"""{name[0]} as (select g.*, {", ".join(f"m.{c}" for c in cols)} from {grid} g left join (
    select {key_list}{bucket} as timestamp, {", ".join(f"avg({c}) as {c}" for c in cols)} from {table} group by all) m on {on})"""


_MINUTES = "time_bucket(interval '30 minutes', timestamp, timestamp '1970-01-01')"


@query(
    "resample_grid",
    check_sql(
        "select * from grid",
        fx.METER_SQL,
        resampled_sql(("grid", "30 minutes"), "meter", _MINUTES, ["kw"], "msb"),
        doubles=["kw"],
    ),
)
def resample_grid(spark, sf):
    df = facility.resample_mean(fx.meter(spark, sf), "30 minutes", ["kw"], ["msb"])
    return tidy(df.select("timestamp", "msb", "kw"))


MSB_SQL = """board as (select n.timestamp, d.msb, count(n.hostname) as hosts, coalesce(sum(total_power_mean), 0) as total_power,
  coalesce(sum(input_power_mean), 0) as input_power from nodes n join node_dim d on d.hostname = n.hostname group by all)"""


def board_power(spark, sf):
    nodes = fx.nodes(spark, sf, ["input_power", "total_power"])
    return facility.msb_power(nodes, fx.node_dim(spark, sf))


@query("msb_power", check_sql("select * from board", fx.NODES_SQL, MSB_SQL, doubles=["total_power", "input_power"]))
def msb_power(spark, sf):
    return tidy(board_power(spark, sf))


# The cabinets of each board once more, as SQL, to check the floor map against.
FLOOR_SQL = """floor as (select hostname, case
    when r = 'g' or (r = 'h' and c between 9 and 36) then 'msb16'
    when r = 'f' or (r = 'e' and (c between 1 and 13 or c between 25 and 36)) or (r = 'd' and c between 1 and 3) then 'msb17'
    when (r = 'd' and (c between 4 and 17 or c between 19 and 32 or c between 34 and 36))
      or (r = 'c' and (c between 1 and 13 or c between 25 and 36)) or (r = 'b' and c between 1 and 8) then 'msb19'
    when r = 'a' or (r = 'b' and c between 9 and 36) then 'msb20' end as msb
  from (select distinct hostname, hostname[1] as r, cast(hostname[2:3] as int) as c, cast(hostname[5:6] as int) as n from node_dim) d
  where n between 1 and 18)"""


@query(
    "msb_power_on_floor",
    check_sql(
        """select timestamp, f.msb, count(n.hostname) as hosts, coalesce(sum(total_power_mean), 0) as total_power,
        coalesce(sum(input_power_mean), 0) as input_power from nodes n join floor f on f.hostname = n.hostname and f.msb is not null group by all""",
        fx.NODES_SQL,
        FLOOR_SQL,
        doubles=["total_power", "input_power"],
    ),
)
def msb_power_on_floor(spark, sf):
    """Board power with the boards of the real floor map; hosts that no board feeds are left out."""
    nodes = fx.nodes(spark, sf, ["input_power", "total_power"])
    return tidy(facility.msb_power(nodes, places.floor_map(spark)))


_SIX = "time_bucket(interval '6 hours', timestamp, timestamp '1970-01-01')"


@query(
    "msb_loss",
    check_sql(
        "select * from loss", fx.NODES_SQL, MSB_SQL, resampled_sql(("loss", "6 hours"), "board", _SIX, ["hosts"], "msb"), doubles=["hosts"]
    ),
)
def msb_loss(spark, sf):
    return tidy(facility.hosts_seen(board_power(spark, sf), "6 hours").select("timestamp", "msb", "hosts"))


_HOURS = "date_trunc('hour', timestamp)"
METER_DIFF_CTES = (
    fx.NODES_SQL,
    MSB_SQL,
    fx.METER_SQL,
    resampled_sql(("metered", "1 hour"), "meter", _HOURS, ["kw"], "msb"),
    resampled_sql(("summed", "1 hour"), "board", _HOURS, ["input_power"], "msb"),
    """comparison as (select s.timestamp, s.msb, s.input_power / 1000 as summation, m.kw as meter, m.kw - s.input_power / 1000 as diff
    from summed s left join metered m on m.timestamp = s.timestamp and m.msb = s.msb)""",
)


def comparison(spark, sf):
    return facility.meter_vs_summation(fx.meter(spark, sf), board_power(spark, sf), fx.HOUR)


@query("meter_diff", check_sql("select * from comparison", *METER_DIFF_CTES, doubles=["summation", "meter", "diff"], digits=11))
def meter_diff(spark, sf):
    return tidy(comparison(spark, sf), 11)


@query(
    "meter_method_long",
    check_sql(
        "select timestamp, msb, 'meter' as method, meter as kw from comparison union all select timestamp, msb, 'summation', summation from comparison",
        *METER_DIFF_CTES,
        doubles=["kw"],
        digits=8,
    ),
)
def meter_method_long(spark, sf):
    return tidy(facility.method_long(comparison(spark, sf)), 8)


@query(
    "meter_diff_summary",
    check_sql(
        "select msb, count(diff) as n, avg(diff) as diff_mean, -exp(avg(case when diff < 0 then ln(-diff) end)) as negative_diff_gmean from comparison group by msb",
        *METER_DIFF_CTES,
        doubles=["diff_mean", "negative_diff_gmean"],
        digits=5,
    ),
)
def meter_diff_summary(spark, sf):
    return tidy(facility.meter_diff_summary(comparison(spark, sf), ["msb"]), 5)


@query(
    "weekly_extrema",
    check_sql(
        """select cast(week(timestamp) as int) as week, max(k100_total_power) * 0.001 as max_power,
        case when min(k100_total_power) > 0 then min(k100_total_power) else 0 end * 0.001 as min_power from cooling group by 1""",
        fx.COOLING_SQL,
        doubles=["max_power", "min_power"],
    ),
)
def weekly_extrema(spark, sf):
    return tidy(facility.weekly_extrema(fx.cooling(spark, sf)))


@query(
    "pue_summary",
    check_sql(
        """select avg(k100_pue) as pue_year, avg(k100_pue) filter (where timestamp >= '2024-01-10' and timestamp < '2024-01-20') as pue_summer,
        count(k100_pue) as n from cooling""",
        fx.COOLING_SQL,
        doubles=["pue_year", "pue_summer"],
    ),
)
def pue_summary(spark, sf):
    plant = fx.cooling(spark, sf)
    summer = (F.col("timestamp") >= "2024-01-10") & (F.col("timestamp") < "2024-01-20")
    return tidy(facility.pue_summary(plant, summer))
