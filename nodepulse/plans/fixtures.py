"""The machine-room tables, derived from the given event tables.

``events`` stands in for sensor readings: a user is a node, an event a reading.
Readings are whole numbers, as the real sensors send them, so sums of them do
not depend on row order.  The same rules, as SQL text, feed the checks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import sensors
from ..functions.timegrid import as_timestamp
from ..operators.intervals import by_job
from ..session import configure
from .jobs import load_readings, node_aggregates

def _rules(names: list[str], value: str, gaps: dict[int, int]) -> dict[str, tuple[int | None, str]]:
    """One rule for each of ``names``; ``value`` may use its place k, ``gaps`` says how often which are missing."""
    return {name: (gaps.get(k), value.format(k=k)) for k, name in enumerate(names)}


#: All sensors of a node: (every how many readings one is missing, value).
RULES: dict[str, tuple[int | None, str]] = {
    "ps0_input_power": (11, "floor(value * 20)"),
    "ps1_input_power": (13, "floor(value * 20) + event_id % 7"),
    "total_power": (None, "floor(value * 38) + event_id % 5"),
    "p0_power": (17, "floor(value * 3)"),
    "p1_power": (34, "floor(value * 2)"),
    **_rules(sensors.IO_POWERS, "10 + event_id % (9 - {k})", {1: 21}),
    **_rules(sensors.MEM_POWERS, "20 + event_id % (11 + {k})", {1: 15}),
    **_rules(["io_power", "fan_disk_power"], "60 + event_id % (15 + {k})", {1: 41}),
    **_rules(sensors.GPU_POWERS, "floor(value) + {k}", {k: 38 if k % 2 else 19 for k in range(6)}),
    **_rules(sensors.GPU_CORE_TEMPS, "60 + (event_id * 7 + 13 * {k}) % 40", {0: 23}),
    **_rules(sensors.GPU_MEM_TEMPS, "55 + (event_id * 11 + 9 * {k}) % 40", {0: 29}),
    **_rules(sensors.DIMM_TEMPS, "30 + (event_id * 5 + 7 * {k}) % 30", {1: 31, 9: 43}),
    **_rules(sensors.CPU_CORE_TEMPS, "40 + (event_id * 3 + 11 * {k}) % 50", {k: 37 for k in range(23, 46, 2)}),
    **_rules(sensors.REGULATOR_TEMPS, "35 + (event_id * 13 + 3 * {k}) % 25", {4: 47}),
    **_rules(sensors.OTHER_TEMPS, "18 + (event_id + 5 * {k}) % 12", {0: 53}),
    **_rules(sensors.SUPPLY_FLOATS, "floor(value * 8) / 8 + {k}", {5: 59}),
}

#: Component types with the sensors that the stand-in has.
COMPTYPES = {
    kind: sensors.mean_of([c for c in cols if c in RULES]) for kind, cols in sensors.COMPONENT_TYPES.items()
}

#: Parameters scaled to the stand-in's size.
CUTS = (4, 8, 12, 18)
MACHINE = 24
WATTS = 5000.0
HOUR = "1 hour"


def rule_sql(name: str) -> str:
    every, value = RULES[name]
    value = f"cast({value} as double)"
    return value if every is None else f"case when event_id % {every} = 0 then null else {value} end"


HOST_SQL = (
    "concat(chr(cast(97 + {id} % 8 as int)), "
    "lpad(cast(cast(1 + floor({id} / 8) % 36 as int) as {text}), 2, '0'), 'n', "
    "lpad(cast(cast(1 + floor({id} / 288) % 18 as int) as {text}), 2, '0'))"
)
MSB_SQL = "concat('msb', cast(16 + {id} % 4 as {text}))"
XID_SQL = (
    "case cast(event_id % 8 as int) when 0 then 48 when 1 then 63 when 2 then 74 when 3 then 79 "
    "when 4 then 62 when 5 then 64 when 6 then 31 else 13 end"
)
MESSAGE_SQL = (
    "concat('NVRM: Xid (PCI: ', case cast(event_id % 3 as int) when 0 then '0004:04:00' when 1 then '0004:05:00' "
    "else '0035:03:00' end, '): link ', cast(event_id % 6 as {text}))"
)
PLANT_RULES = {
    "k100_total_power": "floor(value * 100)",
    "k100_pue": "1 + floor(value) / 1024",
    "mtwst": "60 + floor(value) / 64",
    "mtwrt": "70 + floor(value) / 32",
    "cep_mtw_tons": "floor(value * 7)",
    "cep_chilled_water_tons": "floor(value * 2)",
    "cep_outside_air_wet_bulb_temp": "20 + floor(value) / 8",
}


def host_expr(id_col: str) -> Column:
    return F.expr(HOST_SQL.format(id=id_col, text="string"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").withColumn("ts", as_timestamp("ts"))


def msb_expr(id_col: str) -> Column:
    return F.expr(MSB_SQL.format(id=id_col, text="string"))


def node_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per node.  A host's name and board follow from its number."""
    ids = table(spark, sf_dir, "events").select(F.col("user_id").alias("node_id")).distinct()
    return ids.select("node_id", host_expr("node_id").alias("hostname"), msb_expr("node_id").alias("msb"))


def as_telemetry(rows: DataFrame) -> DataFrame:
    """Events, from a table or a stream, as sensor readings; no join, the host is computed in place."""
    return rows.selectExpr(
        "cast(ts as timestamp) as timestamp",
        f"{HOST_SQL.format(id='user_id', text='string')} as hostname",
        "user_id as node_id",
        f"{MSB_SQL.format(id='user_id', text='string')} as msb",
        "event_id",
        *[f"{rule_sql(name)} as {name}" for name in RULES],
    )


def telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sensor readings, one row per event."""
    return as_telemetry(events(spark, sf_dir))


def jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    seconds = F.expr("cast(60 * (30 + floor(value * 10)) as bigint)")
    return (
        events(spark, sf_dir)
        .filter(F.col("event_type") == "signup")
        .select(
            F.col("event_id").alias("allocation_id"),
            "user_id",
            F.col("ts").alias("begin_time"),
            F.timestamp_micros(F.unix_micros("ts") + seconds * 1_000_000).alias("end_time"),
            F.expr("cast(1 + event_id % 24 as int)").alias("num_nodes"),
            F.expr("concat(chr(cast(97 + event_id % 6 as int)), 'sc', lpad(cast(event_id % 40 as string), 3, '0'))").alias("account"),
        )
    )


def pernode_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each job on each of its nodes.

    Rows go to their job's partition before equal ones are dropped: hardly any are, so
    a task that read many jobs would hold them all.  What is made of a job afterwards needs no further shuffle.
    """
    ev = table(spark, sf_dir, "events")
    nodes = node_dim(spark, sf_dir)
    machine = ev.agg((F.max("user_id") + 1).alias("n")).scalar()
    spread = (
        jobs(spark, sf_dir)
        .withColumn("i", F.explode(F.sequence(F.lit(0), F.col("num_nodes") - 1)))
        .withColumn("node_id", (F.col("user_id") + F.col("i")) % machine)
    )
    rows = (
        spread.join(nodes.select("node_id", "hostname"), "node_id")
        .select(
            "allocation_id",
            (F.col("allocation_id") % 1000).alias("primary_job_id"),
            F.col("hostname").alias("node_name"),
            "num_nodes",
            (F.col("num_nodes") * 6).alias("num_gpus"),
            "begin_time",
            "end_time",
            "account",
            (F.col("num_nodes") * 1000 + F.col("node_id")).cast("double").alias("energy"),
            (F.col("num_nodes") * 600 + F.col("node_id")).cast("double").alias("gpu_energy"),
        )
    )
    return by_job(rows).distinct()


def gpu_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    login = F.col("event_id") % 50 == 0
    return (
        events(spark, sf_dir)
        .filter(F.col("event_type") == "error")
        .select(
            "event_id",
            F.col("ts").alias("exact"),
            F.when(login, F.lit("login1")).otherwise(host_expr("user_id")).alias("hostname"),
            F.expr(XID_SQL).alias("xid"),
            (F.col("event_id") % 3).cast("int").alias("gpu"),
            F.expr(MESSAGE_SQL.format(text="string")).alias("message"),
            F.expr("concat(chr(cast(97 + event_id % 6 as int)), 'sc', lpad(cast(event_id % 40 as string), 3, '0'))").alias("account"),
        )
    )


def cooling(spark: SparkSession, sf_dir: str) -> DataFrame:
    views = events(spark, sf_dir).filter(F.col("event_type") == "view")
    return views.selectExpr("ts as timestamp", *[f"cast({v} as double) as {c}" for c, v in PLANT_RULES.items()])


def meter(spark: SparkSession, sf_dir: str) -> DataFrame:
    clicks = events(spark, sf_dir).filter(F.col("event_type") == "click")
    return clicks.select(F.col("ts").alias("timestamp"), msb_expr("user_id").alias("msb"), F.expr("floor(value * 4) / 64").alias("kw"))


def domains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Domain codes and their descriptions, from the region table."""
    return table(spark, sf_dir, "region").select(
        F.expr("concat(chr(cast(97 + r_regionkey as int)), 'sc')").alias("domain"), F.col("r_name").alias("description")
    )


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Telemetry with the per-node sums and maxima."""
    return load_readings(telemetry(spark, sf_dir))


def nodes(spark: SparkSession, sf_dir: str, values: list[str], resolution: str = HOUR) -> DataFrame:
    """Node aggregates of the given sensors: one row per hour and host."""
    df = readings(spark, sf_dir).select("timestamp", "hostname", *values)
    return node_aggregates(df, resolution, values)


# ---------------------------------------------------------------- SQL for the checks


NODE_SQL = f"""node_dim as (
  select node_id, {HOST_SQL.format(id="node_id", text="varchar")} as hostname,
         concat('msb', cast(16 + node_id % 4 as varchar)) as msb
  from (select distinct user_id as node_id from events) u)"""

_SUMS = ", ".join(
    f"{' + '.join(parts)} as {name}" for name, parts in sensors.NODE_SUMS.items() if all(p in RULES for p in parts)
)
_MAXIMA = ", ".join(
    f"greatest({', '.join(c for c in parts if c in RULES)}) as {name}" for name, parts in sensors.NODE_MAXIMA.items()
)
TELEMETRY_SQL = f"""{NODE_SQL},
telemetry as (
  select e.ts as timestamp, n.hostname, n.node_id, n.msb, e.event_id,
         {", ".join(f"{rule_sql(name)} as {name}" for name in RULES)}
  from events e join node_dim n on n.node_id = e.user_id),
readings as (select *, {_SUMS}, {_MAXIMA} from telemetry)"""

_ALL_SENSORS = [*RULES, *sensors.NODE_SUMS, *sensors.NODE_MAXIMA]
NODES_SQL = f"""{TELEMETRY_SQL},
nodes as (
  select date_trunc('hour', timestamp) as timestamp, hostname,
         {", ".join(f"avg({c}) as {c}_mean, max({c}) as {c}_max" for c in _ALL_SENSORS)}
  from readings group by 1, 2)"""

JOBS_SQL = """jobs as (
  select event_id as allocation_id, user_id, ts as begin_time,
         ts + interval '1' second * cast(60 * (30 + floor(value * 10)) as int) as end_time,
         cast(1 + event_id % 24 as int) as num_nodes,
         concat(chr(cast(97 + event_id % 6 as int)), 'sc', lpad(cast(event_id % 40 as varchar), 3, '0')) as account
  from events where event_type = 'signup')"""

PERNODE_SQL = f"""{JOBS_SQL},
pernode as (
  select distinct j.allocation_id, j.allocation_id % 1000 as primary_job_id, n.hostname as node_name, j.num_nodes,
         j.num_nodes * 6 as num_gpus, j.begin_time, j.end_time, j.account,
         cast(j.num_nodes * 1000 + n.node_id as double) as energy,
         cast(j.num_nodes * 600 + n.node_id as double) as gpu_energy
  from jobs j join range(24) g(i) on g.i < j.num_nodes
  join node_dim n on n.node_id = (j.user_id + g.i) % (select max(user_id) + 1 from events))"""

FAILURES_SQL = f"""gpu_failures as (
  select e.event_id, e.ts as exact, case when e.event_id % 50 = 0 then 'login1' else n.hostname end as hostname,
         {XID_SQL} as xid, cast(e.event_id % 3 as int) as gpu, {MESSAGE_SQL.format(text="varchar")} as message,
         concat(chr(cast(97 + event_id % 6 as int)), 'sc', lpad(cast(event_id % 40 as varchar), 3, '0')) as account
  from events e join node_dim n on n.node_id = e.user_id where e.event_type = 'error'),
failures as (select * from gpu_failures where hostname not like 'login%' and hostname not like 'batch%')"""

COOLING_SQL = f"""cooling as (
  select ts as timestamp, {", ".join(f"cast({v} as double) as {c}" for c, v in PLANT_RULES.items())}
  from events where event_type = 'view')"""

METER_SQL = """meter as (
  select ts as timestamp, concat('msb', cast(16 + user_id % 4 as varchar)) as msb, floor(value * 4) / 64 as kw
  from events where event_type = 'click')"""

DOMAINS_SQL = """domains as (
  select concat(chr(cast(97 + r_regionkey as int)), 'sc') as domain, r_name as description from region)"""
