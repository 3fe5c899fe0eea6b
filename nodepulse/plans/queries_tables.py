"""Checked queries: reading, writing, compacting, and the streaming jobs.

They write the given tables below the shared folder and read them back.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import cluster, hier_agg, reshape, thermal
from ..session import scratch_path
from ..sources import readers, schemas, writers
from ..streaming import node_stream
from . import fixtures as fx
from .fixtures import HOST_SQL, rule_sql
from .queries_jobs import bands_sql, flags_sql
from .queries_nodes import _moments, stats_doubles, stats_sql
from .registry import check_sql, query, tidy


def stored_readings(spark, sf, label):
    """Readings written by day."""
    path = scratch_path(spark, label)
    df = fx.telemetry(spark, sf).select("timestamp", "hostname", "event_id", "total_power", "ps0_input_power")
    writers.write_partitioned(df, path)
    return path


@query("read_day", "select event_id, floor(value * 38) + event_id % 5 as total_power from events where cast(ts as date) = date '2024-01-15'")
def read_day(spark, sf):
    path = stored_readings(spark, sf, "read-day")
    return tidy(readers.read_day(spark, path, "2024-01-15", ["event_id", "total_power"]))


@query("day_window", "select event_id, cast(cast(ts as date) as varchar) as date from events where cast(ts as date) between date '2024-01-09' and date '2024-01-12'")
def day_window(spark, sf):
    table = readers.read_table(spark, stored_readings(spark, sf, "day-window"), ["event_id", "date"])
    return readers.day_window(table, "2024-01-10", 1, 2).select("event_id", F.col("date").cast("string"))


@query(
    "available_days",
    """select cast(d as varchar) as date from (select distinct cast(ts as date) as d from events) x
    where d not in (date '2024-01-03', date '2024-01-20') order by d limit 25""",
)
def available_days(spark, sf):
    table = readers.day_files(spark, stored_readings(spark, sf, "days"))
    skip = F.col("date").isin("2024-01-03", "2024-01-20")
    return readers.available_days(table, skip, 25).select(F.col("date").cast("string"))


_ARRIVED = "ts + to_seconds(event_id % 301 - 150)"


@query(
    "day_with_margin",
    f"""select event_id, ts as timestamp from (select event_id, ts, {_ARRIVED} as arrived from events) a
    where arrived >= timestamp '2024-01-10' - interval 60 second and arrived < timestamp '2024-01-11' + interval 60 second
    and ts >= timestamp '2024-01-10' and ts < timestamp '2024-01-11'""",
)
def day_with_margin(spark, sf):
    """Rows arrive up to two and a half minutes off; a minute of it is waited for."""
    path = scratch_path(spark, "arrivals")
    late = F.timestamp_micros(F.unix_micros("ts") + (F.col("event_id") % 301 - 150) * 1_000_000)
    rows = fx.events(spark, sf).select("event_id", F.col("ts").alias("timestamp"), late.alias("arrived"))
    writers.write_partitioned(rows.withColumn("date", F.to_date("arrived")), path)
    table = readers.read_table(spark, path)
    return readers.read_day_with_spill(table, "2024-01-10", "1 minute").select("event_id", "timestamp")


@query(
    "compact_roundtrip",
    "select cast(cast(ts as date) as varchar) as date, count(*) as rows, cast(sum(event_id) as bigint) as ids from events group by 1",
)
def compact_roundtrip(spark, sf):
    """Many small files a day become few; no row is lost."""
    small, merged = scratch_path(spark, "small"), scratch_path(spark, "merged")
    rows = fx.events(spark, sf).select("event_id", F.col("ts").alias("timestamp"))
    writers.with_date(rows.repartition(8)).write.partitionBy("date").parquet(small)
    writers.compact(spark, small, merged)
    days = readers.read_table(spark, merged).groupBy(F.col("date").cast("string").alias("date"))
    return days.agg(F.count(F.lit(1)).alias("rows"), F.sum("event_id").alias("ids"))


@query(
    "minutes_stay_whole",
    "select date_trunc('minute', ts) as minute, count(*) as rows, cast(1 as bigint) as partitions from events group by 1",
)
def minutes_stay_whole(spark, sf):
    """After the range partitioning every minute lies in one partition."""
    rows = fx.events(spark, sf).select("event_id", F.col("ts").alias("timestamp"))
    placed = writers.repartition_by_time(rows, "1 minute", partitions=16).withColumn("part", F.spark_partition_id())
    per_part = placed.groupBy(F.date_trunc("minute", "timestamp").alias("minute"), "part").agg(F.count(F.lit(1)).alias("rows"))
    return per_part.groupBy("minute").agg(F.sum("rows").alias("rows"), F.count(F.lit(1)).alias("partitions"))


@query("csv_roundtrip", "select event_id, user_id, ts as timestamp, value from events")
def csv_roundtrip(spark, sf):
    """CSV by day, read back through a glob with a declared schema."""
    path = scratch_path(spark, "csv")
    rows = fx.events(spark, sf).select("event_id", "user_id", F.col("ts").alias("timestamp"), "value")
    writers.write_daily_csv(rows, path)
    schema = "event_id bigint, user_id bigint, timestamp timestamp, value double"
    return readers.read_many(spark, f"{path}/date=*/*.csv", schema)


@query("thermal_csv", check_sql(bands_sql("timestamp"), fx.NODES_SQL, flags_sql("nodes", "timestamp", 0, 150)))
def thermal_csv(spark, sf):
    """Band counts through CSV: the list of hot masks is written as text."""
    path = scratch_path(spark, "bands")
    temps = [c.removesuffix("_mean") for k in ("gpu_core", "gpu_mem") for c in fx.COMPTYPES[k]]
    bands = thermal.thermal_bands(fx.nodes(spark, sf, temps), ["timestamp"])
    writers.write_daily_csv(bands, path)
    kinds = {"timestamp": "timestamp", "hot_gpus": "string"}
    schema = ", ".join(f"{c} {kinds.get(c, 'bigint')}" for c in bands.columns)
    return readers.read_csv_typed(spark, path, schema).fillna("", ["hot_gpus"])


_TYPED = ["total_power", "gpu0_core_temp", "ps0_input_power"]


@query(
    "typed_aggregates",
    check_sql(
        f"select timestamp, hostname, {', '.join(f'{c}_{k}' for c in _TYPED for k in ('count', 'sum', 'min', 'max'))} from ("
        + _moments("telemetry", "time_bucket(interval '6 hours', timestamp, timestamp '1970-01-01')", "hostname", _TYPED) + ") m",
        fx.TELEMETRY_SQL,
        doubles=[f"{c}_{k}" for c in _TYPED for k in ("sum", "min", "max")],
    ),
)
def typed_aggregates(spark, sf):
    """Mergeable aggregates written with the derived narrow types, and read back."""
    path = scratch_path(spark, "typed")
    rows = fx.telemetry(spark, sf).select("timestamp", "hostname", *_TYPED)
    base = schemas.loaded_schema()
    base = type(base)([f for f in base if f.name in ("timestamp", "hostname", *_TYPED)])
    writers.write_partitioned(hier_agg.init_agg(rows, "6 hours"), path, schemas.lossless_schema(base))
    counts = [F.col(f"{c}_count").cast("bigint").alias(f"{c}_count") for c in _TYPED]
    others = [F.col(f"{c}_{k}").cast("double").alias(f"{c}_{k}") for c in _TYPED for k in ("sum", "min", "max")]
    return tidy(readers.read_table(spark, path).select("timestamp", "hostname", *counts, *others))


@query(
    "corrupt_files_skipped",
    check_sql(
        "select date_trunc('hour', timestamp) as hour, count(*) as n, cast(sum(event_id) as bigint) as ids from telemetry group by 1",
        fx.TELEMETRY_SQL,
    ),
)
def corrupt_files_skipped(spark, sf):
    """A stored table with damaged files among its own: those are passed over, the rest is whole."""
    path = scratch_path(spark, "damaged")
    rows = fx.telemetry(spark, sf).select("timestamp", "event_id")
    rows.write.parquet(path)
    # Text where parquet is expected, one file for each kind of event.
    fx.events(spark, sf).select("event_type").distinct().write.mode("append").text(path)
    table = readers.read_table(spark, path, schema=rows.schema, ignore_corrupt=True)
    return table.groupBy(F.date_trunc("hour", "timestamp").alias("hour")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("ids")
    )


@query(
    "pending_days",
    "select cast(d as varchar) as date from (select distinct cast(ts as date) as d from events) x where d >= date '2024-01-19'",
)
def pending_days(spark, sf):
    """Days whose output is not there yet."""
    source, target = stored_readings(spark, sf, "source"), scratch_path(spark, "target")
    rows = readers.read_table(spark, source, ["timestamp", "event_id", "date"])
    writers.write_finished(rows.filter("date < date'2024-01-19'"), target)
    return writers.pending_days(readers.day_files(spark, source), writers.finished_days(spark, target)).select(F.col("date").cast("string"))


@query(
    "half_written_days_pending",
    """select cast(d as varchar) as date, count(*) as rows from (select cast(ts as date) as d from events) x
    where d >= date '2024-01-25' or d in (date '2024-01-05', date '2024-01-10') group by 1""",
)
def half_written_days_pending(spark, sf):
    """A day without a mark and one that was written to after its mark are to do again, and then are done but for the last week."""
    source, target = stored_readings(spark, sf, "source"), scratch_path(spark, "target")
    rows = readers.read_table(spark, source, ["timestamp", "event_id", "date"])
    writers.write_finished(rows.filter("date < date'2024-01-25' and date <> date'2024-01-05'"), target)
    broken = rows.filter("event_id % 2 = 0 and date in (date'2024-01-05', date'2024-01-10')")
    broken.write.mode("append").partitionBy("date").parquet(target)
    left = writers.pending_days(readers.day_files(spark, source), writers.finished_days(spark, target))
    todo = rows.join(left, "date")
    writers.write_finished(todo.filter("date < date'2024-01-25'"), target)
    after = writers.pending_days(readers.day_files(spark, source), writers.finished_days(spark, target))
    again = readers.read_table(spark, target, ["date"]).filter("date in (date'2024-01-05', date'2024-01-10')")
    days = again.unionByName(rows.join(after, "date").select("date"))
    return days.groupBy(F.col("date").cast("string").alias("date")).agg(F.count(F.lit(1)).alias("rows"))


@query(
    "corrupt_files",
    "select event_type as kind, cast(2 as bigint) as files, cast(sum(octet_length(encode(cast(event_id as varchar))) + 1) as bigint) as bytes from events group by 1",
)
def corrupt_files(spark, sf):
    """Two damaged files beside one sound one for each kind of event: which ones are passed over, and their bytes."""
    path = scratch_path(spark, "damaged")
    rows = fx.events(spark, sf).select("event_type", "event_id", F.col("ts").alias("timestamp"))
    rows.repartition(1, "event_type").write.partitionBy("event_type").parquet(path)
    for half in (0, 1):
        text = rows.filter(f"event_id % 2 = {half}").select("event_type", F.col("event_id").cast("string"))
        text.repartition(1).write.mode("append").partitionBy("event_type").text(path)
    schema = T.StructType.fromDDL("event_id bigint, timestamp timestamp, event_type string")
    found = readers.corrupt_files(spark, path, schema)
    kind = F.regexp_extract("path", "event_type=([a-z]+)", 1).alias("kind")
    return found.groupBy(kind).agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"))


@query(
    "days_without_rows",
    """select cast(d as varchar) as date from (select cast(unnest(generate_series(date '2023-12-30', date '2024-02-03', interval 1 day)) as date) as d) x
    where d not in (select cast(ts as date) from events)""",
)
def days_without_rows(spark, sf):
    """The calendar against the days that have readings."""
    calendar = readers.date_range(spark, "2023-12-30", "2024-02-03")
    have = fx.events(spark, sf).select(F.to_date("ts").alias("date")).distinct()
    return reshape.drop_members(calendar, have, ["date"]).select(F.col("date").cast("string"))


@query(
    "union_missing_columns",
    """select event_id, value, cast(null as double) as page from events where event_type = 'click'
    union all select event_id, value, cast(event_id % 7 as double) from events where event_type = 'view'""",
)
def union_missing_columns(spark, sf):
    ev = fx.events(spark, sf)
    clicks = ev.filter("event_type = 'click'").select("event_id", "value")
    views = ev.filter("event_type = 'view'").select("event_id", "value", (F.col("event_id") % 7).alias("page"))
    return reshape.union_tolerant(clicks, None, views).withColumn("page", F.col("page").cast("double"))


# ---- streaming

_LIVE = ["ps0_input_power", "ps1_input_power", "total_power"]
_DONE = "(select max(ts) from events) - interval 1 minute"
_HOURLY = _moments("telemetry", "date_trunc('hour', timestamp)", "hostname", _LIVE)
_LIVE_DOUBLES = [f"{c}_{k}" for c in _LIVE for k in ("sum", "tot_sq_dev", "min", "max")]
_LIVE_DIGITS = {f"{c}_tot_sq_dev": 4 for c in _LIVE}


def live_aggregates(spark, sf, path):
    schema = fx.table(spark, sf, "events").schema

    def build():
        arriving = node_stream.read_stream(spark, sf, schema, file_glob="events.parquet")
        rows = fx.as_telemetry(arriving).select("timestamp", "hostname", *_LIVE)
        return node_stream.stream_init_agg(rows, fx.HOUR, _LIVE)

    return node_stream.run_to_table(spark, build, path, scratch_path(spark, "live-state"))


@query(
    "stream_init_agg",
    check_sql(
        f"select * from ({_HOURLY}) h where timestamp + interval 1 hour <= {_DONE}",
        fx.TELEMETRY_SQL,
        doubles=_LIVE_DOUBLES,
        **_LIVE_DIGITS,
    ),
)
def stream_init_agg(spark, sf):
    """Bins that the watermark has closed; the last one is still open."""
    return tidy(live_aggregates(spark, sf, scratch_path(spark, "live")).drop("date"), **_LIVE_DIGITS)


_LIVE_SERIES = {"ps0": "ps0_input_power_mean", "ps1": "ps1_input_power_mean", "top": "total_power_mean"}


@query(
    "stream_cluster_power",
    check_sql(
        f"""select timestamp, {", ".join(stats_sql(c, n, cluster.POWER_KINDS) for n, c in _LIVE_SERIES.items())} from closed
        where timestamp + interval 1 hour <= (select max(timestamp) from closed) - interval 1 minute group by timestamp""",
        fx.NODES_SQL,
        f"closed as (select * from nodes where timestamp + interval 1 hour <= {_DONE})",
        doubles=stats_doubles(_LIVE_SERIES, cluster.POWER_KINDS),
    ),
)
def stream_cluster_power(spark, sf):
    """A second stream over the table that the first one writes."""
    path = scratch_path(spark, "live")
    written = live_aggregates(spark, sf, path)

    def second():
        arriving = node_stream.read_stream(spark, path, written.schema)
        means = hier_agg.finalize_agg(arriving, ["timestamp", "hostname"])
        return node_stream.stream_cluster_power(means, fx.HOUR, _LIVE_SERIES)

    series = node_stream.run_to_table(spark, second, scratch_path(spark, "power"), scratch_path(spark, "power-state"))
    return tidy(series.drop("date"))


# ---- rows that come late
#
# The month runs 3600 times as fast: a second of readings for each hour of events.  One row in eleven comes 30 seconds
# late, one in thirteen five minutes; two minutes of arrivals are a file, and a file is a micro-batch.

_FAST_SQL = f"""fast as (
  select *, cast(floor(epoch(ts) / 3600) as bigint) - 473352 as second,
         case when event_id % 11 = 3 then 30 when event_id % 13 = 5 then 300 else 0 end as delay
  from events),
arrived as (
  select timestamp '2024-01-01' + interval 1 second * second as timestamp, (second + delay) // 120 as file,
         {HOST_SQL.format(id="user_id", text="varchar")} as hostname, {rule_sql("ps0_input_power")} as ps0_input_power,
         {rule_sql("total_power")} as total_power
  from fast),
binned as (
  select *, time_bucket(interval 10 seconds, timestamp, timestamp '1970-01-01') as bin, dense_rank() over (order by file) as batch from arrived),
marks as (
  select batch, max(latest) over (order by batch rows between unbounded preceding and 2 preceding) - interval 1 minute as closed
  from (select batch, max(timestamp) as latest from binned group by batch)),
in_time as (
  select binned.* from binned join marks using (batch) where closed is null or bin + interval 10 seconds > closed),
done as (select max(timestamp) - interval 1 minute as done from binned)"""


def arrivals(spark, sf) -> str:
    """A folder of parquet files, one for each two minutes of arrivals, in the order in which they came."""
    path = scratch_path(spark, "arrivals")
    rows = fx.events(spark, sf).selectExpr(
        "cast(floor(unix_seconds(ts) / 3600) as bigint) - 473352 as second",
        "case when event_id % 11 = 3 then 30 when event_id % 13 = 5 then 300 else 0 end as delay",
        f"{HOST_SQL.format(id='user_id', text='string')} as hostname",
        f"{rule_sql('ps0_input_power')} as ps0_input_power",
        f"{rule_sql('total_power')} as total_power",
    )
    rows = rows.selectExpr("*", "timestamp_seconds(1704067200 + second) as timestamp", "(second + delay) div 120 as file").drop("second", "delay")
    files = [r["file"] for r in rows.select("file").distinct().orderBy("file").collect()]  # the fast month has eight
    for file in files:
        rows.where(F.col("file") == file).drop("file").coalesce(1).write.mode("append").parquet(path)
    return path


def arriving(spark, path):
    schema = "hostname string, ps0_input_power double, total_power double, timestamp timestamp"
    return node_stream.read_stream(spark, path, T.StructType.fromDDL(schema), files_per_trigger=1)


@query(
    "stream_late_rows",
    check_sql(
        """select bin as timestamp, hostname, count(total_power) as came,
            count(total_power) filter (in_time) as counted, count(total_power) filter (not in_time) as left_out
        from (select binned.*, i.batch is not null as in_time
              from binned left join (select distinct batch, bin from in_time) i using (batch, bin)), done
        where bin + interval 10 seconds <= done group by 1, 2""",
        _FAST_SQL,
    ),
)
def stream_late_rows(spark, sf):
    """Which rows of eight micro-batches are in, and how many came after their bin was closed."""
    path = arrivals(spark, sf)

    def build():
        return node_stream.stream_init_agg(arriving(spark, path), "10 seconds", ["total_power"])

    written = node_stream.run_to_table(spark, build, scratch_path(spark, "late"), scratch_path(spark, "late-state"))
    return node_stream.left_out(spark.read.parquet(path), written, "10 seconds", "total_power")


_FAST_SERIES = {"ps0": "ps0_input_power", "top": "total_power"}


@query(
    "stream_power_of_readings",
    check_sql(
        f"""select timestamp, {", ".join(stats_sql(c, n, cluster.POWER_KINDS) for n, c in _FAST_SERIES.items())}
        from nodes, done where timestamp + interval 10 seconds <= done group by timestamp""",
        _FAST_SQL,
        "nodes as (select bin as timestamp, hostname, avg(ps0_input_power) as ps0_input_power, avg(total_power) as total_power from in_time group by 1, 2)",
        doubles=stats_doubles(_FAST_SERIES, cluster.POWER_KINDS),
    ),
)
def stream_power_of_readings(spark, sf):
    """Both aggregates in one streaming query, over eight micro-batches with late rows."""
    path = arrivals(spark, sf)

    def build():
        return node_stream.stream_power_of_readings(arriving(spark, path), "10 seconds", _FAST_SERIES)

    series = node_stream.run_to_table(spark, build, scratch_path(spark, "fast"), scratch_path(spark, "fast-state"))
    return tidy(series.drop("date"))
