"""Checked queries: power edges, segments, spectra."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import edges as ed
from ..operators import segments as sg
from . import fixtures as fx
from . import jobs as whole
from .queries_jobs import JOB_POWER_CTES, job_power_series
from .queries_nodes import CLUSTER_SQL, class_sql, cluster_series
from .registry import check_sql, query, tidy

_FRONT, _REAR = 2, 6
_PARAMS = {"front": _FRONT, "rear": _REAR, "band": fx.WATTS, "min_nodes": 1}

NUMBERED_SQL = f"""series as (select *, cast(timestamp as date) as date from cluster),
numbered as (select *, cast(row_number() over w - 1 as int) as rn, count(*) over (partition by date) as day_rows,
  sum_inp - lag(sum_inp, 4) over w as diff,
  min(count_inp) over (partition by date order by timestamp rows between {_FRONT} preceding and {_REAR - 1} following) as fewest
  from series window w as (partition by date order by timestamp)),
edges as (select date, case when diff > 0 then 'rise' else 'fall' end as type, rn as edge_index, timestamp as edge_timestamp,
  cast(trunc(sum_inp / {fx.WATTS}) as int) as start_class, diff as amplitude, cast(floor(abs(diff) / {fx.WATTS}) as int) as amplitude_class
  from numbered where rn >= {_FRONT} and rn < day_rows - {_REAR} and fewest >= 1 and floor(abs(diff) / {fx.WATTS}) between 1 and 13)"""
# An edge is kept unless a kept edge that comes before it in the order (class,
# then position) lies in its stretch; the recursion visits edges in that order.
KEPT_SQL = f"""ordered as (select *, row_number() over (partition by date, type order by amplitude_class desc, edge_index) as k from edges),
visit(date, type, k, kept) as (
  select distinct date, type, cast(0 as bigint), cast([] as integer[]) from edges
  union all
  select o.date, o.type, o.k, case when len(list_filter(v.kept, lambda x: x >= o.edge_index - {_FRONT} and x < o.edge_index + {_REAR})) = 0
    then list_append(v.kept, o.edge_index) else v.kept end
  from visit v join ordered o on o.date = v.date and o.type = v.type and o.k = v.k + 1),
kept as (select o.* exclude (k) from ordered o join (select date, type, arg_max(kept, k) as kept from visit group by all) f
  on f.date = o.date and f.type = o.type where list_contains(f.kept, o.edge_index)),
segments as (select k.*, cast(n.rn - k.edge_index + {_FRONT} as int) as "offset", n.timestamp, n.sum_inp, n.mean_top from kept k
  join numbered n on n.date = k.date and n.rn between k.edge_index - {_FRONT} and k.edge_index + {_REAR - 1})"""
_EDGE_CTES = (fx.NODES_SQL, CLUSTER_SQL, NUMBERED_SQL)


def _check_recursive(body: str, doubles, **kw) -> str:
    return check_sql(body, *_EDGE_CTES, KEPT_SQL, doubles=doubles, **kw).replace("with ", "with recursive ", 1)


def numbered(spark, sf):
    series = cluster_series(spark, sf).select("timestamp", "sum_inp", "count_inp", "mean_top")
    return sg.number_rows(series, front=_FRONT, rear=_REAR)


def found(spark, sf):
    return sg.find_edges(numbered(spark, sf), **_PARAMS)


def _dated(df):
    return df.withColumn("date", F.col("date").cast("string"))


_DATE_TEXT = "* replace (cast(date as varchar) as date)"


@query("power_edges", check_sql(f"select {_DATE_TEXT} from edges", *_EDGE_CTES, doubles=["amplitude"]))
def power_edges(spark, sf):
    return tidy(_dated(found(spark, sf)))


@query("edges_without_overlap", _check_recursive(f"select {_DATE_TEXT} from kept", ["amplitude"]))
def edges_without_overlap(spark, sf):
    return tidy(_dated(sg.suppress_overlaps(found(spark, sf), _FRONT, _REAR)))


_METRICS = ["sum_inp", "mean_top"]


def carved(spark, sf):
    series = cluster_series(spark, sf).select("timestamp", "sum_inp", "count_inp", "mean_top")
    return sg.power_segments(series, _METRICS, **_PARAMS)


@query("power_segments", _check_recursive(f"select {_DATE_TEXT} from segments", ["amplitude", *_METRICS]))
def power_segments(spark, sf):
    return tidy(_dated(carved(spark, sf)))


_PROFILE_SQL = _check_recursive(
    'select type, amplitude_class, "offset", count(*) as n, '
    + ", ".join(
        f"avg({m}) as {m}_mean, avg({m}) - 1.96 * stddev_samp({m}) / sqrt(count({m})) as {m}_low, "
        f"avg({m}) + 1.96 * stddev_samp({m}) / sqrt(count({m})) as {m}_high"
        for m in _METRICS
    )
    + " from segments group by all",
    [f"{m}_{k}" for m in _METRICS for k in ("mean", "low", "high")],
    digits=5,
)


@query("segment_profile", _PROFILE_SQL)
def segment_profile(spark, sf):
    return tidy(sg.segment_profile(carved(spark, sf), _METRICS), 5)


@query("whole_power_dynamics", _PROFILE_SQL)
def whole_power_dynamics(spark, sf):
    """The whole job, with the series given as two tables."""
    series = cluster_series(spark, sf)
    power, other = series.select("timestamp", "sum_inp", "count_inp"), series.select("timestamp", "mean_top")
    return tidy(whole.power_dynamics(power, other, _METRICS, **_PARAMS), 5)


@query(
    "segment_counts",
    _check_recursive(
        'select type, amplitude_class, count(*) filter (where "offset" = 0) as segments, count(*) as rows from segments group by all', []
    ),
)
def segment_counts(spark, sf):
    return sg.segment_counts(carved(spark, sf))


# ---- jobs

_JOB = {"watts": fx.WATTS, "full_size": fx.MACHINE, "cuts": fx.CUTS}
JOB_TICKS_SQL = f"""ticked_jobs as (select *, {class_sql("nodes", (5, 4, 3, 2, 1))} as class from (
  select allocation_id, timestamp, sum_inp as power, cast(row_number() over w - 1 as int) as idx, count(*) over p as rows,
    lead(sum_inp) over w - sum_inp as diff, first_value(count_inp) over w as nodes,
    max(cast(count_inp <> size_inp as int)) over p as has_gap
  from job_power window w as (partition by allocation_id order by timestamp), p as (partition by allocation_id)) t),
clean as (select * from ticked_jobs where has_gap = 0 and rows > 1),
marked as (select *, direction <> 0 and coalesce(lag(direction) over (partition by allocation_id order by idx), 0) <> direction as starts from (
  select *, case when diff > {fx.WATTS} * nodes / {fx.MACHINE} then 1 when diff < -{fx.WATTS} * nodes / {fx.MACHINE} then -1 else 0 end as direction
  from clean) m)"""
_JOB_CTES = (*JOB_POWER_CTES, JOB_TICKS_SQL)


@query(
    "clean_jobs",
    check_sql("select allocation_id, idx, power, rows, nodes, class from clean", *_JOB_CTES, doubles=["power"]),
)
def clean_jobs(spark, sf):
    df = ed.clean_jobs(ed.number_ticks(job_power_series(spark, sf), cuts=fx.CUTS))
    return tidy(df.select("allocation_id", "idx", "power", "rows", "nodes", "class"))


_EDGE_COLS = "allocation_id, class, idx, direction, starts, diff, power"


@query("job_edges", check_sql(f"select {_EDGE_COLS} from marked where direction <> 0", *_JOB_CTES, doubles=["diff", "power"]))
def job_edges(spark, sf):
    return tidy(ed.job_edges(job_power_series(spark, sf), **_JOB))


@query(
    "distinct_job_edges",
    check_sql(f"select {_EDGE_COLS} from marked where starts", *_JOB_CTES, doubles=["diff", "power"]),
)
def distinct_job_edges(spark, sf):
    return tidy(ed.distinct_edges(ed.job_edges(job_power_series(spark, sf), **_JOB)))


@query(
    "edges_per_job",
    check_sql(
        """select allocation_id, class, t.type, cast(sum(cast(direction = t.d as int)) as bigint) as n_edges,
        cast(sum(cast(direction = t.d and starts as int)) as bigint) as n_distinct_edges
        from marked join (values ('Rising', 1), ('Falling', -1)) t(type, d) on 1 = 1 group by all""",
        *_JOB_CTES,
    ),
)
def edges_per_job(spark, sf):
    return ed.edges_per_job(job_power_series(spark, sf), **_JOB)


DURATION_SQL = """starts_only as (select * from marked where starts),
later as (select e.allocation_id, e.class, e.idx, e.direction, e.rows, l.idx - e.idx - 1 as k, sign(l.power - 0.8 * e.power) as s
  from starts_only e left join marked l on l.allocation_id = e.allocation_id and l.idx > e.idx and l.idx < e.rows - 1),
durations as (select allocation_id, class, idx, case when direction > 0 then 'Rising' else 'Falling' end as type,
  coalesce(min(case when s <> s0 then k end), 1 + rows - 2 - idx) as duration
  from (select *, first_value(s) over (partition by allocation_id, idx order by k) as s0 from later) x
  group by allocation_id, class, idx, direction, rows)"""
DURATION_CTES = (*_JOB_CTES, DURATION_SQL)


def durations(spark, sf):
    return ed.edge_durations(job_power_series(spark, sf), **_JOB)


@query(
    "edge_durations",
    check_sql("select *, duration / 6 as minutes from durations", *DURATION_CTES, doubles=["minutes"]),
)
def edge_durations(spark, sf):
    return tidy(durations(spark, sf))


_REACH, _LARGE, _STEP = 2, 2, 400.0
SNAPSHOT_SQL = f"""large as (select * from (select allocation_id, timestamp, cast(row_number() over w - 1 as int) as idx, count(*) over p as rows,
    lead(sum_inp) over w - sum_inp as diff, max(cast(count_inp <> size_inp as int)) over p as has_gap
  from job_power where count_inp > {_LARGE} window w as (partition by allocation_id order by timestamp), p as (partition by allocation_id)) t
  where has_gap = 0 and rows > 1),
turned as (select *, case when idx >= {_REACH} and idx + {_REACH + 1} < rows - 1 then
  case when diff > {_STEP} then 1 when diff < -{_STEP} then -1 else 0 end else 0 end as direction from large),
first_of_run as (select * from (select *, lag(direction, 1, 0) over (partition by allocation_id order by idx) as before from turned) t
  where direction <> 0 and before <> direction),
snapshots as (select s.allocation_id, case when s.direction > 0 then 'Rising' else 'Falling' end as type, s.idx as edge_index,
  s.diff as edge_diff, l.idx - s.idx as "offset", l.diff from first_of_run s join large l on l.allocation_id = s.allocation_id
  and l.idx between s.idx - {_REACH} and s.idx + {_REACH + 1})"""
_SNAPSHOT_CTES = (*JOB_POWER_CTES, SNAPSHOT_SQL)


def snapshots(spark, sf):
    return ed.edge_snapshots(job_power_series(spark, sf), _REACH, _STEP, _LARGE)


@query("edge_snapshots", check_sql("select * from snapshots", *_SNAPSHOT_CTES, doubles=["edge_diff", "diff"]))
def edge_snapshots(spark, sf):
    return tidy(snapshots(spark, sf))


@query(
    "edge_reintegrated",
    check_sql(
        """select *, coalesce(sum(diff) over (partition by allocation_id, type, edge_index order by "offset" rows between unbounded preceding and 1 preceding), 0) as relative_power from snapshots""",
        *_SNAPSHOT_CTES,
        doubles=["edge_diff", "diff", "relative_power"],
    ),
)
def edge_reintegrated(spark, sf):
    return tidy(ed.reintegrate(snapshots(spark, sf)))


@query(
    "edge_extremes",
    check_sql(
        "select max(diff) as steepest_rise, min(diff) as steepest_fall from marked where direction <> 0",
        *_JOB_CTES,
        doubles=["steepest_rise", "steepest_fall"],
    ),
)
def edge_extremes(spark, sf):
    return tidy(ed.edge_extremes(ed.job_edges(job_power_series(spark, sf), **_JOB)))


_SPECTRUM = {"watts": 500.0, "full_size": fx.MACHINE, "cuts": fx.CUTS}


def spectrum_sql(top_n: int) -> str:
    """Every frequency of every job by its definition: quadratic, for the check only."""
    return f"""changes as (select * from (select *, max(abs(diff)) over (partition by allocation_id) as largest from clean) c
  where largest >= 500.0 * nodes / {fx.MACHINE} and diff is not null and rows - 1 > {2 * top_n}),
waves as (select allocation_id, class, rows, k, sum(diff * cos(2 * pi() * k * idx / (rows - 1))) as re, sum(diff * sin(2 * pi() * k * idx / (rows - 1))) as im
  from (select *, unnest(generate_series(0, (rows - 1) // 2)) as k from changes) x group by all),
strengths as (select *, re * re + im * im as amp, max(re * re + im * im) over (partition by allocation_id) as top from waves),
spectrum as (select allocation_id, class, rows as ticks, k / ((rows - 1) * 10.0) as freq, amp from (
  select *, row_number() over (partition by allocation_id order by round(amp / top, 9) desc, k) as place from strengths where top > 0) s where place <= {top_n} and amp > 0)"""


SPECTRUM_CTES = (*_JOB_CTES, spectrum_sql(1))


def spectrum(spark, sf, top_n: int = 1):
    return ed.job_spectrum(job_power_series(spark, sf), top_n, **_SPECTRUM)


# Amplitudes span many powers of ten: their logarithms are compared.
_LOGGED = "allocation_id, class, ticks, freq, log10(amp) as amp_log10"


@query(
    "job_fft",
    check_sql(f"select {_LOGGED} from spectrum", *SPECTRUM_CTES, doubles=["freq", "amp_log10"], digits=8),
)
def job_fft(spark, sf):
    return tidy(spectrum(spark, sf).selectExpr(*_LOGGED.split(", ")), 8)


@query(
    "job_fft_top3",
    check_sql(f"select {_LOGGED} from spectrum", *_JOB_CTES, spectrum_sql(3), doubles=["freq", "amp_log10"], digits=6),
)
def job_fft_top3(spark, sf):
    """The three strongest frequencies of each job."""
    return tidy(spectrum(spark, sf, 3).selectExpr(*_LOGGED.split(", ")), 6)


@query(
    "job_fft_features",
    check_sql(
        "select *, log10(sqrt(amp)) as amp_log, ticks / 6 as minutes from spectrum where amp <> 0",
        *SPECTRUM_CTES,
        doubles=["freq", "amp", "amp_log", "minutes"],
        digits=8,
        amp=-5,
    ),
)
def job_fft_features(spark, sf):
    return tidy(ed.spectrum_features(spectrum(spark, sf)), 8, amp=-5)


@query(
    "job_fft_tallies",
    check_sql(
        f"""select class, count(*) as jobs, cast(sum(cast(gap as int)) as bigint) as sensor_errors,
        cast(sum(cast(not gap and rows <= 1 as int)) as bigint) as short,
        cast(sum(cast(not gap and rows > 1 and quiet as int)) as bigint) as below_threshold,
        cast(sum(cast(not gap and rows > 1 and not quiet and rows - 1 <= 2 as int)) as bigint) as too_short
        from (select allocation_id, class, rows, has_gap = 1 as gap, coalesce(max(abs(diff)) < 500.0 * nodes / {fx.MACHINE}, false) as quiet
              from ticked_jobs group by allocation_id, class, nodes, rows, has_gap) j group by class""",
        *_JOB_CTES,
    ),
)
def job_fft_tallies(spark, sf):
    return ed.job_tallies(job_power_series(spark, sf), **_SPECTRUM)


@query(
    "leadership_jobs",
    check_sql(
        """select allocation_id, timestamp, (row_number() over (partition by allocation_id order by timestamp) - 1) / 6 as minute, sum_inp
        from job_power where job_sch_node_num > 18""",
        *JOB_POWER_CTES,
        doubles=["minute", "sum_inp"],
    ),
)
def leadership_jobs(spark, sf):
    return tidy(ed.leadership_jobs(job_power_series(spark, sf), 18))
