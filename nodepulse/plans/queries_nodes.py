"""Checked queries: node aggregates, cluster series, row expressions, time grid."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import derive, places, sensors, timegrid
from ..functions.bands import band, band_counts, hot_mask
from ..functions.missing import any_null
from ..operators import cluster, hier_agg, reshape, segments
from ..sources import schemas
from . import fixtures as fx
from .registry import check_sql, query, tidy

_X = ["input_power", "gpu0_core_temp", "total_power"]
_GROUPS = ["timestamp", "hostname"]


def _moments(table: str, bin_sql: str, groups: str, cols: list[str]) -> str:
    parts = ", ".join(
        f"count({c}) as {c}_count, sum({c}) as {c}_sum, "
        f"case when count({c}) = 1 then 0.0 else var_samp({c}) * (count({c}) - 1) end as {c}_tot_sq_dev, "
        f"min({c}) as {c}_min, max({c}) as {c}_max"
        for c in cols
    )
    return f"select {bin_sql} as timestamp, {groups}, {parts} from {table} group by all"


_MOMENT_DOUBLES = [f"{c}_{k}" for c in _X for k in ("sum", "tot_sq_dev", "min", "max")]
_SIX_HOURS = "time_bucket(interval '6 hours', timestamp, timestamp '1970-01-01')"
_M2 = {f"{c}_tot_sq_dev": 4 for c in _X}


@query(
    "hier_init",
    check_sql(_moments("readings", _SIX_HOURS, "hostname", _X), fx.TELEMETRY_SQL, doubles=_MOMENT_DOUBLES, **_M2),
)
def hier_init(spark, sf):
    return tidy(hier_agg.init_agg(fx.readings(spark, sf), "6 hours", values=_X), **_M2)


@query(
    "hier_coarsen",
    check_sql(
        _moments("readings", "date_trunc('day', timestamp)", "hostname", _X), fx.TELEMETRY_SQL, doubles=_MOMENT_DOUBLES, **_M2
    ),
)
def hier_coarsen(spark, sf):
    fine = hier_agg.init_agg(fx.readings(spark, sf), "6 hours", values=_X)
    return tidy(hier_agg.coarsen_agg(fine, "1 day"), **_M2)


def _final(table: str, bin_sql: str, groups: str, cols: list[str]) -> str:
    parts = ", ".join(
        f"avg({c}) as {c}_mean, stddev_samp({c}) as {c}_std, min({c}) as {c}_min, max({c}) as {c}_max" for c in cols
    )
    return f"select {bin_sql} as timestamp, {groups}, {parts} from {table} group by all"


_FINAL_DOUBLES = [f"{c}_{k}" for c in _X for k in ("mean", "std", "min", "max")]


@query(
    "hier_finalize",
    check_sql(_final("readings", "date_trunc('day', timestamp)", "hostname", _X), fx.TELEMETRY_SQL, doubles=_FINAL_DOUBLES),
)
def hier_finalize(spark, sf):
    fine = hier_agg.init_agg(fx.readings(spark, sf), "6 hours", values=_X)
    return tidy(hier_agg.finalize_agg(hier_agg.coarsen_agg(fine, "1 day"), _GROUPS))


_SHIP = ["quantity", "price", "discount"]
_SHIP_SQL = {"quantity": "l_quantity", "price": "floor(l_extendedprice)", "discount": "floor(l_discount * 100 + 0.5)"}


@query(
    "hier_lineitem_weekly",
    check_sql(
        _final("ship", "date_trunc('week', l_shipdate)", "l_returnflag", _SHIP),
        f"ship as (select l_returnflag, l_shipdate, {', '.join(f'{v} as {k}' for k, v in _SHIP_SQL.items())} from lineitem)",
        doubles=[f"{c}_{k}" for c in _SHIP for k in ("mean", "std", "min", "max")],
    ),
)
def hier_lineitem_weekly(spark, sf):
    """A denser chain: days, merged into weeks, by return flag."""
    rows = fx.table(spark, sf, "lineitem").select(
        "l_returnflag", F.col("l_shipdate").alias("timestamp"), *[F.expr(v).cast("double").alias(k) for k, v in _SHIP_SQL.items()]
    )
    keys = {"before": ["l_returnflag"], "after": []}
    daily = hier_agg.init_agg(rows, "1 day", values=_SHIP, **keys)
    weekly = hier_agg.coarsen_agg(daily, "1 week", **keys)
    return tidy(hier_agg.finalize_agg(weekly, ["l_returnflag", "timestamp"]))


_WIDE = [*fx.RULES, *[c for c in sensors.NODE_SUMS], *sensors.NODE_MAXIMA]


@query(
    "node_aggregates_all_sensors",
    check_sql(
        _final("readings", "date_trunc('day', timestamp)", "hostname", _WIDE),
        fx.TELEMETRY_SQL,
        doubles=[f"{c}_{k}" for c in _WIDE for k in ("mean", "std", "min", "max")],
    ),
)
def node_aggregates_all_sensors(spark, sf):
    """All sensors at once, twenty at a time."""
    return tidy(fx.node_aggregates(fx.readings(spark, sf).drop("node_id", "event_id"), "1 day", _WIDE))


def _stored(sensor: str) -> str:
    """Type that means and deviations are stored in."""
    return "double" if sensor in sensors.FLOAT_SENSORS else "real"


# A float has seven digits.
_WIDE_M2 = {f"{c}_tot_sq_dev": -2 for c in _WIDE}


@query(
    "lossless_all_sensors",
    check_sql(
        f"""select timestamp, hostname, {", ".join(
            f"{c}_count, cast({c}_sum as double) as {c}_sum, cast(cast({c}_tot_sq_dev as {_stored(c)}) as double) as {c}_tot_sq_dev, "
            f"cast({c}_min as double) as {c}_min, cast({c}_max as double) as {c}_max" for c in _WIDE
        )} from ({_moments("readings", _SIX_HOURS, "hostname", _WIDE)}) m""",
        fx.TELEMETRY_SQL,
        doubles=[f"{c}_{k}" for c in _WIDE for k in ("sum", "tot_sq_dev", "min", "max")],
        digits=1,
        **_WIDE_M2,
    ),
)
def lossless_all_sensors(spark, sf):
    """The mergeable aggregates of all 117 sensors, with the types they are stored in."""
    rows = fx.readings(spark, sf).drop("node_id", "event_id")
    stored = schemas.apply_schema(hier_agg.init_agg(rows, "6 hours", values=_WIDE), schemas.lossless_schema(schemas.loaded_schema()))
    return tidy(_as_doubles(stored), 1, **_WIDE_M2)


@query(
    "final_all_sensors",
    check_sql(
        f"""select timestamp, hostname, {", ".join(
            f"count({c}) as {c}_count, cast(cast(avg({c}) as {_stored(c)}) as double) as {c}_mean, "
            f"cast(cast(stddev_samp({c}) as {_stored(c)}) as double) as {c}_std, "
            f"cast(min({c}) as double) as {c}_min, cast(max({c}) as double) as {c}_max" for c in _WIDE
        )} from (select * replace (date_trunc('day', timestamp) as timestamp) from readings) r group by 1, 2""",
        fx.TELEMETRY_SQL,
        doubles=[f"{c}_{k}" for c in _WIDE for k in ("mean", "std", "min", "max")],
    ),
)
def final_all_sensors(spark, sf):
    """Six-hour bins merged into days and brought into their final form, with counts and stored types."""
    rows = fx.readings(spark, sf).drop("node_id", "event_id")
    days = hier_agg.coarsen_agg(hier_agg.init_agg(rows, "6 hours", values=_WIDE), "1 day")
    final = hier_agg.finalize_agg(days, _GROUPS, keep_count=True)
    stored = schemas.final_schema(schemas.loaded_schema())
    counts = [T.StructField(f"{c}_count", T.LongType()) for c in _WIDE]
    return tidy(_as_doubles(schemas.apply_schema(final, T.StructType([*stored, *counts]))))


def _as_doubles(df):
    """Narrow numbers as doubles, for comparing them."""
    narrow = (T.ByteType, T.ShortType, T.FloatType)
    return df.select(
        *[F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, narrow) or f.name.endswith("_sum") else f.name for f in df.schema]
    )


# ---- cluster series


def stats_sql(col: str, name: str, kinds) -> str:
    make = {
        "count": f"count({col})",
        "size": "count(*)",
        "sum": f"coalesce(sum({col}), 0)",
        "mean": f"avg({col})",
        "std": f"stddev_samp({col})",
        "min": f"min({col})",
        "max": f"max({col})",
        "q25": f"quantile_cont({col}, 0.25)",
        "q50": f"quantile_cont({col}, 0.5)",
        "q75": f"quantile_cont({col}, 0.75)",
    }
    return ", ".join(f"{make[k]} as {k}_{name}" for k in kinds)


def stats_doubles(names, kinds) -> list[str]:
    return [f"{k}_{n}" for n in names for k in kinds if k not in ("count", "size")]


_POWER_SENSORS = ["input_power", "total_power", "ps0_input_power", "ps1_input_power"]
_SUPPLY = "ps0_input_power_mean + ps1_input_power_mean"
CLUSTER_SQL = f"""cluster as (
  select timestamp, {", ".join(stats_sql(_SUPPLY if n == "ps_1_2" else c, n, cluster.POWER_KINDS) for n, c in cluster.SERIES.items())}
  from nodes group by timestamp)"""


def cluster_series(spark, sf):
    return cluster.cluster_power_ts(fx.nodes(spark, sf, _POWER_SENSORS))


@query(
    "cluster_power_ts",
    check_sql(
        "select * from cluster", fx.NODES_SQL, CLUSTER_SQL, doubles=stats_doubles(cluster.SERIES, cluster.POWER_KINDS)
    ),
)
def cluster_power_ts(spark, sf):
    return tidy(cluster_series(spark, sf))


def component_sql(cols: list[str]) -> str:
    total = " + ".join(f"coalesce({c}, 0)" for c in cols)
    return f"case when coalesce({', '.join(cols)}) is not null then {total} end"


def nan_sql(cols: list[str]) -> str:
    return " + ".join(f"cast({c} is null as int)" for c in cols)


_CPU, _GPU = sensors.mean_of(sensors.CPU_POWERS), sensors.mean_of(sensors.GPU_POWERS)
COMPONENT_SQL = f"""component as (
  select timestamp, hostname, {component_sql(_CPU)} as cpu_power, {nan_sql(_CPU)} as cpu_nan,
         {component_sql(_GPU)} as gpu_power, {nan_sql(_GPU)} as gpu_nan from nodes)"""
COMPONENT_STATS_SQL = ", ".join(
    f"{stats_sql(f'{p}_power', f'{p}_power', cluster.COMPONENT_KINDS)}, cast(sum({p}_nan) as bigint) as {p}_nans" for p in ("cpu", "gpu")
)
COMPONENT_DOUBLES = stats_doubles(["cpu_power", "gpu_power"], cluster.COMPONENT_KINDS)
COMPONENT_SENSORS = sensors.CPU_POWERS + sensors.GPU_POWERS


@query(
    "cluster_component_ts",
    check_sql(
        f"select timestamp, {COMPONENT_STATS_SQL} from component group by timestamp",
        fx.NODES_SQL,
        COMPONENT_SQL,
        doubles=COMPONENT_DOUBLES,
    ),
)
def cluster_component_ts(spark, sf):
    return tidy(cluster.cluster_component_ts(fx.nodes(spark, sf, COMPONENT_SENSORS)))


# ---- row expressions

_SUM_NAMES = list(sensors.NODE_SUMS)


@query(
    "node_sums",
    check_sql(f"select event_id, {', '.join(_SUM_NAMES)} from readings", fx.TELEMETRY_SQL, doubles=_SUM_NAMES),
)
def node_sums(spark, sf):
    return tidy(derive.add_node_sums(fx.telemetry(spark, sf)).select("event_id", *_SUM_NAMES))


_MAX_NAMES = list(sensors.NODE_MAXIMA)


@query(
    "node_maxima",
    check_sql(f"select event_id, {', '.join(_MAX_NAMES)} from readings", fx.TELEMETRY_SQL, doubles=_MAX_NAMES),
)
def node_maxima(spark, sf):
    return tidy(derive.add_node_maxima(fx.telemetry(spark, sf)).select("event_id", *_MAX_NAMES))


@query(
    "component_power",
    check_sql(
        f"""select event_id, {component_sql(sensors.CPU_POWERS)} as cpu_power, {nan_sql(sensors.CPU_POWERS)} as cpu_nan,
        {component_sql(sensors.GPU_POWERS)} as gpu_power, {nan_sql(sensors.GPU_POWERS)} as gpu_nan from telemetry""",
        fx.TELEMETRY_SQL,
        doubles=["cpu_power", "gpu_power"],
    ),
)
def component_power(spark, sf):
    df = derive.add_component_power(fx.telemetry(spark, sf), suffix="")
    return tidy(df.select("event_id", "cpu_power", "cpu_nan", "gpu_power", "gpu_nan"))


@query(
    "supply_sum",
    check_sql(
        """select event_id, try_cast(ps0 as double) + try_cast(ps1 as double) as ps_1_2_input_power from (
        select event_id, case when event_id % 9 = 0 then 'n/a' else cast(ps0_input_power as varchar) end as ps0,
               cast(ps1_input_power as varchar) as ps1 from telemetry) t""",
        fx.TELEMETRY_SQL,
        doubles=["ps_1_2_input_power"],
    ),
)
def supply_sum(spark, sf):
    text = fx.telemetry(spark, sf).select(
        "event_id",
        F.when(F.col("event_id") % 9 == 0, "n/a").otherwise(F.col("ps0_input_power").cast("string")).alias("ps0_input_power"),
        F.col("ps1_input_power").cast("string").alias("ps1_input_power"),
    )
    return tidy(derive.add_supply_sum(text, suffix="").select("event_id", "ps_1_2_input_power"))


_FROM, _TO = "2024-01-10 00:00:00", "2024-01-20 12:00:00"


@query("between_times", f"select event_id, ts from events where ts between timestamp '{_FROM}' and timestamp '{_TO}'")
def between_times(spark, sf):
    df = fx.events(spark, sf)
    return df.filter(timegrid.between_times("ts", _FROM, _TO)).select("event_id", "ts")


@query(
    "compute_nodes_only",
    check_sql("select event_id, hostname, xid from failures", fx.NODE_SQL, fx.FAILURES_SQL),
)
def compute_nodes_only(spark, sf):
    return derive.compute_nodes_only(fx.gpu_failures(spark, sf)).select("event_id", "hostname", "xid")


@query(
    "valid_intervals",
    check_sql(
        """select allocation_id, begin_time, end_time from (
        select allocation_id, begin_time, case when allocation_id % 4 = 0 then begin_time - interval 1 minute
          when allocation_id % 7 = 0 then null else end_time end as end_time from jobs) j where begin_time <= end_time""",
        fx.JOBS_SQL,
    ),
)
def valid_intervals(spark, sf):
    early = F.timestamp_micros(F.unix_micros("begin_time") - 60_000_000)
    end = F.when(F.col("allocation_id") % 4 == 0, early).when(F.col("allocation_id") % 7 != 0, F.col("end_time"))
    jobs = fx.jobs(spark, sf).withColumn("end_time", end)
    return derive.valid_intervals(jobs).select("allocation_id", "begin_time", "end_time")


def class_sql(col: str, labels) -> str:
    quote = lambda v: f"'{v}'" if isinstance(v, str) else str(v)
    whens = " ".join(f"when {col} <= {cut} then {quote(v)}" for cut, v in zip(fx.CUTS, labels))
    return f"case {whens} else {quote(labels[-1])} end"


@query(
    "node_class",
    check_sql(
        f"""select allocation_id, num_nodes, {class_sql("num_nodes", (5, 4, 3, 2, 1))} as class,
        {class_sql("num_nodes", sensors.NODE_CLASS_NAMES)} as node_cat, {class_sql("num_nodes", sensors.JOB_TYPES)} as job_type
        from jobs""",
        fx.JOBS_SQL,
    ),
)
def node_class(spark, sf):
    return fx.jobs(spark, sf).select(
        "allocation_id",
        "num_nodes",
        derive.node_class("num_nodes", fx.CUTS).alias("class"),
        derive.node_class("num_nodes", fx.CUTS, sensors.NODE_CLASS_NAMES).alias("node_cat"),
        derive.node_class("num_nodes", fx.CUTS, sensors.JOB_TYPES).alias("job_type"),
    )


@query(
    "log_positive",
    check_sql(
        """select event_id, log10(total_power + 1) as log_power, ln(total_power + 1) as ln_power from telemetry
        where total_power >= 0 and log10(total_power + 1) > 0""",
        fx.TELEMETRY_SQL,
        doubles=["log_power", "ln_power"],
    ),
)
def log_positive(spark, sf):
    df = derive.log_positive(fx.telemetry(spark, sf), "total_power", "log_power")
    df = derive.log_positive(df, "total_power", "ln_power", base=None)
    return tidy(df.select("event_id", "log_power", "ln_power"))


@query(
    "unit_conversion",
    check_sql(
        """select c.event_id, floor(value * 100) * 0.001 as power_mw, value / 3600 as hours from events c""",
        doubles=["power_mw", "hours"],
    ),
)
def unit_conversion(spark, sf):
    df = fx.events(spark, sf)
    return tidy(
        df.select(
            "event_id",
            derive.to_unit(F.floor(F.col("value") * 100), 0.001).alias("power_mw"),
            derive.to_unit("value", 1 / 3600).alias("hours"),
        )
    )


_CORES = sensors.GPU_CORE_TEMPS
_MEMS = sensors.GPU_MEM_TEMPS


def band_sql(c: str, low, high) -> str:
    inside = " and ".join([f"{c} is not null"] + ([f"{c} >= {low}"] if low is not None else []) + ([f"{c} < {high}"] if high is not None else []))
    return f"case when {inside} then " + " + ".join(f"cast({c} >= {cut} as int)" for cut in sensors.BAND_CUTS) + " end"


def band_count_sql(cols, prefix, low, high) -> str:
    return ", ".join(
        " + ".join(f"cast(coalesce(({band_sql(c, low, high)}) = {k}, false) as int)" for c in cols) + f" as {prefix}_band{k}"
        for k in range(5)
    )


def mask_sql(cols, low, high) -> str:
    limits = ("" if low is None else " and {c} >= " + str(low)) + ("" if high is None else " and {c} < " + str(high))
    bits = " || ".join("case when {c} >= 83{l} then '1' else '0' end".format(c=c, l=limits.format(c=c)) for c in cols)
    return f"case when contains({bits}, '1') then hostname || ':' || {bits} end"


@query(
    "temp_bands",
    check_sql(
        f"select event_id, cast({band_sql('t', 0, 150)} as double) as cluster_band, cast({band_sql('t', None, None)} as double) as job_band from "
        "(select event_id, case when event_id % 41 = 0 then gpu0_core_temp + 100 else gpu0_core_temp end as t from telemetry) x",
        fx.TELEMETRY_SQL,
        doubles=["cluster_band", "job_band"],
    ),
)
def temp_bands(spark, sf):
    t = F.when(F.col("event_id") % 41 == 0, F.col("gpu0_core_temp") + 100).otherwise(F.col("gpu0_core_temp"))
    df = fx.telemetry(spark, sf).select("event_id", t.alias("t"))
    low, high = sensors.CLUSTER_BAND_RANGE
    in_cluster, in_job = band("t", low=low, high=high), band("t")
    return tidy(df.select("event_id", in_cluster.cast("double").alias("cluster_band"), in_job.cast("double").alias("job_band")))


@query(
    "band_counts",
    check_sql(
        f"select event_id, {band_count_sql(_CORES, 'n_cores', 0, 150)}, {band_count_sql(_MEMS, 'n_mems', 0, 150)} from telemetry",
        fx.TELEMETRY_SQL,
    ),
)
def band_counts_query(spark, sf):
    counts = {**band_counts(_CORES, "n_cores", low=0, high=150), **band_counts(_MEMS, "n_mems", low=0, high=150)}
    return fx.telemetry(spark, sf).select("event_id", *[c.alias(n) for n, c in counts.items()])


@query(
    "any_missing",
    check_sql(
        f"select event_id, ({' or '.join(f'{c} is null' for c in _CORES + _MEMS)}) as any_nan from telemetry", fx.TELEMETRY_SQL
    ),
)
def any_missing(spark, sf):
    return fx.telemetry(spark, sf).select("event_id", any_null(_CORES + _MEMS).alias("any_nan"))


@query(
    "hot_mask",
    check_sql(f"select event_id, {mask_sql(_CORES + _MEMS, 0, 150)} as hot_gpus from telemetry", fx.TELEMETRY_SQL),
)
def hot_mask_query(spark, sf):
    return fx.telemetry(spark, sf).select("event_id", hot_mask("hostname", _CORES + _MEMS).alias("hot_gpus"))


@query(
    "node_location",
    check_sql(
        """select node_id, hostname, ascii(substr(hostname, 1, 1)) - ascii('a') + 1 as row,
        cast(substr(hostname, 2, 2) as int) as rack, cast(substr(hostname, 5) as int) as height from node_dim""",
        fx.NODE_SQL,
    ),
)
def node_location(spark, sf):
    place = places.node_location("hostname")
    return fx.node_dim(spark, sf).select("node_id", "hostname", *[c.alias(n) for n, c in place.items()])


@query(
    "pci_and_link",
    check_sql(
        "select event_id, substr(message, 17, 10) as pci, regexp_extract(message, 'link ([0-9])', 1) as link from gpu_failures",
        fx.NODE_SQL,
        fx.FAILURES_SQL,
    ),
)
def pci_and_link(spark, sf):
    return fx.gpu_failures(spark, sf).select(
        "event_id", places.pci_address("message").alias("pci"), places.nvlink_id("message").alias("link")
    )


@query(
    "domain_lookup",
    check_sql(
        """select j.allocation_id, substr(account, 1, 3) as domain, coalesce(d.description, substr(account, 1, 3)) as job_group
        from jobs j left join domains d on d.domain = substr(account, 1, 3)""",
        fx.JOBS_SQL,
        fx.DOMAINS_SQL,
    ),
)
def domain_lookup(spark, sf):
    jobs = fx.jobs(spark, sf).select("allocation_id", derive.account_domain("account").alias("domain"))
    named = derive.lookup(jobs, fx.domains(spark, sf), "domain", "description", "job_group")
    return named.select("allocation_id", "domain", "job_group")


@query(
    "calendar_parts",
    """select event_id, cast(year(ts) as int) as year, cast(month(ts) as int) as month, cast(week(ts) as int) as week,
    cast(day(ts) as int) as day from events""",
)
def calendar_parts(spark, sf):
    return fx.events(spark, sf).select("event_id", *[c.alias(n) for n, c in timegrid.calendar_parts("ts").items()])


@query(
    "local_to_utc",
    "select event_id, ts + interval 5 hour as utc from events",
)
def local_to_utc(spark, sf):
    """January has no change of clocks: Eastern time is five hours behind."""
    return fx.events(spark, sf).select("event_id", timegrid.local_to_utc("ts").alias("utc"))


@query(
    "pick_by_index",
    check_sql(
        f"select event_id, case cast(event_id % 7 as int) {' '.join(f'when {k} then {c}' for k, c in enumerate(_CORES))} end as temp from telemetry",
        fx.TELEMETRY_SQL,
        doubles=["temp"],
    ),
)
def pick_by_index(spark, sf):
    picked = derive.pick_by_index(_CORES, (F.col("event_id") % 7).cast("int"))
    return tidy(fx.telemetry(spark, sf).select("event_id", picked.alias("temp")))


@query(
    "account_domain",
    check_sql("select substr(account, 1, 3) as domain, count(*) as jobs from jobs group by 1", fx.JOBS_SQL),
)
def account_domain(spark, sf):
    return fx.jobs(spark, sf).groupBy(derive.account_domain("account").alias("domain")).agg(F.count(F.lit(1)).alias("jobs"))


# ---- time grid


@query(
    "time_grid",
    """select event_id, time_bucket(interval '10 seconds', ts, timestamp '1970-01-01') as floored,
    case when ts = time_bucket(interval '10 seconds', ts, timestamp '1970-01-01') then ts
         else time_bucket(interval '10 seconds', ts, timestamp '1970-01-01') + interval 10 second end as ceiled,
    make_timestamp(cast(round_even(cast(epoch_us(ts) as double) / 10000000, 0) as bigint) * 10000000) as rounded
    from events""",
)
def time_grid(spark, sf):
    return fx.events(spark, sf).select(
        "event_id",
        timegrid.floor_to("ts", "10 seconds").alias("floored"),
        timegrid.ceil_to("ts", "10 seconds").alias("ceiled"),
        timegrid.round_to("ts", "10 seconds").alias("rounded"),
    )


@query(
    "lag_diff",
    check_sql(
        """select timestamp, sum_inp - lag(sum_inp, 4) over w as diff_back, lead(sum_inp, 1) over w - sum_inp as diff_next
        from cluster window w as (partition by cast(timestamp as date) order by timestamp)""",
        fx.NODES_SQL,
        CLUSTER_SQL,
        doubles=["diff_back", "diff_next"],
    ),
)
def lag_diff(spark, sf):
    series = cluster_series(spark, sf).select("timestamp", "sum_inp", F.to_date("timestamp").alias("date"))
    return tidy(
        series.select(
            "timestamp",
            segments.lag_diff("sum_inp", 4, ["date"], "timestamp").alias("diff_back"),
            segments.lag_diff("sum_inp", -1, ["date"], "timestamp").alias("diff_next"),
        )
    )


_INSTANTS = ["2024-01-05 03:00:00", "2024-01-05 04:00:00", "2024-01-17 12:00:00"]


@query(
    "time_slices",
    check_sql(
        f"select timestamp, hostname, input_power_mean from nodes where timestamp in ({', '.join(f'timestamp {t!r}' for t in _INSTANTS)})",
        fx.NODES_SQL,
        doubles=["input_power_mean"],
    ),
)
def time_slices(spark, sf):
    df = fx.nodes(spark, sf, ["input_power"])
    return tidy(df.filter(timegrid.at_times("timestamp", _INSTANTS)).select("timestamp", "hostname", "input_power_mean"))


# ---- long, wide, counts


@query(
    "melt_temps",
    check_sql(
        f"""select event_id, variable, value from (unpivot (select event_id, {', '.join(_CORES)} from telemetry)
        on {', '.join(_CORES)} into name variable value value)
        union all select event_id, 'gpu0_core_temp', null from telemetry where gpu0_core_temp is null""",
        fx.TELEMETRY_SQL,
        doubles=["value"],
    ),
)
def melt_temps(spark, sf):
    return tidy(reshape.melt(fx.telemetry(spark, sf), ["event_id"], _CORES))


_PRESENT = ["ps0_input_power", "p0_power", "p1_power", "gpu0_core_temp", "gpu0_mem_temp", "total_power"]


@query(
    "non_null_counts",
    check_sql(
        f"select count(*) as rows, {', '.join(f'count({c}) as count_{c}' for c in _PRESENT)} from telemetry", fx.TELEMETRY_SQL
    ),
)
def non_null_counts(spark, sf):
    return reshape.non_null_counts(fx.telemetry(spark, sf), _PRESENT)
