"""Checked queries: GPU failures."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import sensors
from ..functions.derive import compute_nodes_only
from ..operators import distributions as dist
from ..operators import failures as fl
from ..operators import reshape
from ..session import few
from . import fixtures as fx
from .queries_jobs import JOB_COMPTYPE_CTES, comptype_sql
from .registry import check_sql, query, tidy

_BASE = (fx.NODE_SQL, fx.FAILURES_SQL)


def names_sql(col: str) -> str:
    return f"case {col} " + " ".join(f"when {x} then '{n}'" for x, n in sensors.XID_NAMES.items()) + " end"


def failures(spark, sf):
    return compute_nodes_only(fx.gpu_failures(spark, sf))


@query("failure_counts", check_sql(f"select {names_sql('xid')} as name, xid, count(*) as freq from failures group by all", *_BASE))
def failure_counts(spark, sf):
    df = failures(spark, sf).withColumn("name", fl.failure_name("xid"))
    return fl.failure_counts(df, ["name", "xid"])


@query("failure_counts_per_node", check_sql("select xid, hostname, count(*) as freq from failures group by all", *_BASE))
def failure_counts_per_node(spark, sf):
    return fl.failure_counts(failures(spark, sf), ["xid", "hostname"])


@query(
    "failure_node_max",
    check_sql(
        """select xid, cast(sum(freq) as bigint) as total, max(freq) as max_per_node, count(*) as nodes from (
        select xid, hostname, count(*) as freq from failures group by all) f group by xid""",
        *_BASE,
    ),
)
def failure_node_max(spark, sf):
    return fl.failure_node_max(failures(spark, sf))


@query(
    "failure_value_counts",
    check_sql(
        """select row_number() over (order by n desc, xid, gpu) as place, xid, gpu, n
        from (select xid, gpu, count(*) as n from failures group by all) c""",
        *_BASE,
    ),
)
def failure_value_counts(spark, sf):
    """Errors and slots, the most frequent first: the place of each in that order."""
    counts = few(reshape.value_counts(failures(spark, sf), ["xid", "gpu"]))  # a row for each code and slot
    place = F.row_number().over(Window.orderBy(F.desc("n"), "xid", "gpu")).cast("long")
    return counts.select(place.alias("place"), "xid", "gpu", "n")


_OFTEN = 230


@query(
    "frequent_xids",
    check_sql(f"select xid, count(*) as freq from failures group by xid having count(*) >= {_OFTEN}", *_BASE),
)
def frequent_xids(spark, sf):
    return fl.frequent_xids(failures(spark, sf), _OFTEN)


FREQUENT_SQL = f"frequent as (select xid from failures group by xid having count(*) >= {_OFTEN})"


@query(
    "failures_of_frequent_xids",
    check_sql("select event_id, xid from failures where xid in (select xid from frequent)", *_BASE, FREQUENT_SQL),
)
def failures_of_frequent_xids(spark, sf):
    return fl.of_frequent_xids(failures(spark, sf), _OFTEN).select("event_id", "xid")


PCI_SQL = """pcis as (select hostname, string_agg(substr(pci, 3, 5), ' ' order by pci) as pcis from (
  select distinct hostname, substr(message, 17, 10) as pci from failures) d group by hostname),
modal as (select pcis, count(*) as nodes from pcis group by pcis order by nodes desc, pcis limit 1)"""


@query("modal_pci", check_sql("select * from modal", *_BASE, PCI_SQL))
def modal_pci(spark, sf):
    return fl.modal_pci(failures(spark, sf))


@query("node_pci_sets", check_sql("select * from pcis", *_BASE, PCI_SQL))
def node_pci_sets(spark, sf):
    return fl.node_pci_sets(failures(spark, sf))


GOOD_SQL = "good as (select * from failures where hostname in (select hostname from pcis where pcis in (select pcis from modal)))"
_SLOT_SQL = "case substr(message, 17, 10) " + " ".join(
    f"when '{a}' then {slot}" for slot, a in enumerate(sensors.GPU_PCI_ADDRESSES)
) + " end"


def good(spark, sf):
    return fl.on_good_nodes(failures(spark, sf))


@query(
    "failures_by_slot",
    check_sql(
        f"select xid, {_SLOT_SQL} as gpu_slot, count(*) as n from good where hostname <> 'f26n07' group by all", *_BASE, PCI_SQL, GOOD_SQL
    ),
)
def failures_by_slot(spark, sf):
    return fl.failures_by_slot(good(spark, sf))


@query(
    "nvlink_links",
    check_sql(
        f"""select {_SLOT_SQL} as gpu_slot, regexp_extract(message, 'link ([0-9])', 1) as link, count(*) as n from good
        where hostname <> 'f26n07' and xid = 74 group by all""",
        *_BASE,
        PCI_SQL,
        GOOD_SQL,
    ),
)
def nvlink_links(spark, sf):
    return fl.nvlink_breakdown(good(spark, sf))


_PLACES_SQL = {
    "row": "ascii(substr(hostname, 1, 1)) - ascii('a') + 1",
    "rack": "cast(substr(hostname, 2, 2) as int)",
    "height": "cast(substr(hostname, 5) as int)",
}


@query(
    "failures_by_location",
    check_sql(
        " union all ".join(f"select '{v}' as along, xid, {e} as place, count(*) as n from failures group by all" for v, e in _PLACES_SQL.items()),
        *_BASE,
    ),
)
def failures_by_location(spark, sf):
    df = failures(spark, sf)
    parts = [
        fl.failures_by_location(df, v).select(F.lit(v).alias("along"), "xid", F.col(v).alias("place"), "n") for v in _PLACES_SQL
    ]
    return reshape.union_tolerant(*parts)


RATES_SQL = """hours as (select account, sum((epoch_us(end_time) - epoch_us(begin_time)) / 1000000 / 3600 * size) as node_hours from (
  select j.*, c.size from jobs j join (select allocation_id, count(*) as size from pernode group by 1) c on c.allocation_id = j.allocation_id) s
  where begin_time <= end_time group by account),
rates as (select *, sum(freq) over (partition by account) as total_freq from (
  select c.account, c.xid, c.n, h.node_hours, c.n / h.node_hours as freq from (
    select account, xid, count(*) as n from failures {where} group by all) c join hours h on h.account = c.account) r)"""
_RATES_CTES = (fx.NODE_SQL, fx.PERNODE_SQL, fx.FAILURES_SQL)
_RATE_DOUBLES = ["node_hours", "freq", "total_freq"]
_HARDWARE_SQL = f"where xid in {sensors.HARDWARE_XIDS}"


def rates(spark, sf, xids=None):
    return fl.failures_per_project(failures(spark, sf), fx.jobs(spark, sf), fx.pernode_jobs(spark, sf), xids)


@query(
    "failures_per_project",
    check_sql("select * from rates", *_RATES_CTES, RATES_SQL.format(where=""), doubles=_RATE_DOUBLES, freq=9, total_freq=9),
)
def failures_per_project(spark, sf):
    return tidy(rates(spark, sf), freq=9, total_freq=9)


@query(
    "hardware_failures_top_projects",
    check_sql(
        """select * from rates where account in (select account from (select distinct account, round(total_freq, 12) as t from rates)
        order by t desc, account limit 15)""",
        *_RATES_CTES,
        RATES_SQL.format(where=_HARDWARE_SQL),
        doubles=_RATE_DOUBLES,
        freq=9,
        total_freq=9,
    ),
)
def hardware_failures_top_projects(spark, sf):
    return tidy(fl.top_projects(rates(spark, sf, sensors.HARDWARE_XIDS)), freq=9, total_freq=9)


LABELS_SQL = """labels as (select account, coalesce(description, d) || ' ' || chr(cast(64 + dense_rank() over (partition by d order by account) as int)) as label
  from (select distinct account, substr(account, 1, 3) as d from jobs) a left join domains on domain = d)"""


def labels(spark, sf):
    return fl.project_labels(fx.jobs(spark, sf), fx.domains(spark, sf))


@query("project_labels", check_sql("select * from labels", fx.JOBS_SQL, fx.DOMAINS_SQL, LABELS_SQL))
def project_labels(spark, sf):
    return labels(spark, sf)


@query(
    "stacked_bars",
    check_sql(
        "select label, xid, sum(freq) as height from rates r join labels l on l.account = r.account group by all",
        *_RATES_CTES,
        fx.DOMAINS_SQL,
        RATES_SQL.format(where=""),
        LABELS_SQL,
        doubles=["height"],
        digits=9,
    ),
)
def stacked_bars(spark, sf):
    return tidy(dist.stacked_bars(rates(spark, sf), labels(spark, sf)), 9)


_PICK_SQL = "case gpu " + " ".join(f"when {k} then gpu{k}_core_temp_mean" for k in range(6)) + " end"
ZSCORE_SQL = f"""stats as ({comptype_sql("timestamp, allocation_id")}),
at_hour as (select *, make_timestamp(cast(round_even(cast(epoch_us(exact) as double) / 3600000000, 0) as bigint) * 3600000000) as timestamp from failures),
temps as (select f.event_id, {_PICK_SQL} as temp from at_hour f join nodes n on n.timestamp = f.timestamp and n.hostname = f.hostname),
matched as (select f.event_id, min(p.allocation_id) as allocation_id from at_hour f join temps t on t.event_id = f.event_id and t.temp is not null
  join pernode p on p.node_name = f.hostname and f.exact > p.begin_time and f.exact <= p.end_time
  group by f.event_id having count(*) = 1)"""


@query(
    "failure_zscores",
    check_sql(
        """select f.event_id, f.xid, t.temp, cast(m.allocation_id as double) as allocation_id, s.gpu_core_mean as mean, s.gpu_core_std as std,
        case when 1 - s.gpu_core_count / s.gpu_core_size <= 0.2 then (t.temp - s.gpu_core_mean) / nullif(s.gpu_core_std, 0) end as z
        from at_hour f left join temps t on t.event_id = f.event_id left join matched m on m.event_id = f.event_id
        left join stats s on s.allocation_id = m.allocation_id and s.timestamp = f.timestamp""",
        *JOB_COMPTYPE_CTES,
        fx.FAILURES_SQL,
        ZSCORE_SQL,
        doubles=["temp", "allocation_id", "mean", "std", "z"],
    ),
)
def failure_zscores(spark, sf):
    nodes = fx.nodes(spark, sf, sensors.GPU_CORE_TEMPS)
    df = fl.failure_zscores(failures(spark, sf), nodes, fx.pernode_jobs(spark, sf), fx.HOUR)
    return tidy(df.select("event_id", "xid", "temp", F.col("allocation_id").cast("double"), "mean", "std", "z"))


@query(
    "failure_pivot",
    check_sql(
        "select hostname, "
        + ", ".join(f"coalesce(max(freq) filter (where xid = {x}), 0) as x{x}" for x in sensors.HARDWARE_XIDS)
        + " from (select hostname, xid, count(*) as freq from failures group by all) f group by hostname",
        *_BASE,
    ),
)
def failure_pivot(spark, sf):
    counts = fl.failure_counts(failures(spark, sf), ["hostname", "xid"])
    wide = reshape.pivot_fixed(counts, ["hostname"], "xid", "freq", list(sensors.HARDWARE_XIDS), fill=0)
    return wide.withColumnsRenamed({str(x): f"x{x}" for x in sensors.HARDWARE_XIDS})


CORR_SQL = """counts as (select hostname, xid, count(*) as freq from failures where xid in (select xid from frequent) group by all),
kinds as (select distinct xid, name from (select xid, {name} as name from counts) k),
grid as (select n.hostname, k.name, coalesce(c.freq, 0) as freq from (select distinct hostname from counts) n join kinds k on 1 = 1
  left join counts c on c.hostname = n.hostname and c.xid = k.xid),
corrs as (select a.name as kind_a, b.name as kind_b, corr(cast(a.freq as double), cast(b.freq as double)) as corr, count(*) as n
  from grid a join grid b on b.hostname = a.hostname where {order} group by all)"""
_KINDS = sorted(sensors.XID_NAMES.values())


def corr(spark, sf):
    df = fl.of_frequent_xids(failures(spark, sf), _OFTEN).withColumn("name", fl.failure_name("xid"))
    counts = fl.failure_counts(df, ["hostname", "name"])
    return dist.corr_matrix(counts, "hostname", "name", "freq", _KINDS)


_CORR_CTES = (*_BASE, FREQUENT_SQL, CORR_SQL.format(name=names_sql("xid"), order="a.name < b.name"))
_VALID = "where corr is not null and not isnan(corr)"


@query("failure_corr", check_sql(f"select * from corrs {_VALID}", *_CORR_CTES, doubles=["corr"]))
def failure_corr(spark, sf):
    return tidy(corr(spark, sf))


@query(
    "failure_corr_t",
    check_sql(f"select *, corr * sqrt((n - 2) / (1 - corr * corr)) as t from corrs {_VALID} and abs(corr) < 1", *_CORR_CTES, doubles=["corr", "t"]),
)
def failure_corr_t(spark, sf):
    df = dist.corr_significance(corr(spark, sf)).filter("t is not null")
    return tidy(df.select("kind_a", "kind_b", "corr", "n", "t"))


# Two-sided p-value by Simpson's rule: with t = sqrt(v) tan(s) the density of
# Student's t is a power of the cosine on a finite range.
_PANELS = 20000
P_VALUE_SQL = f"""tests as (select *, n - 2 as v, case when abs(corr) < 1 then corr * sqrt((n - 2) / (1 - corr * corr)) end as t from corrs {_VALID}),
angles as (select *, atan(abs(t) / sqrt(v)) as a from tests),
tails as (select kind_a, kind_b, corr, n, t,
    2 * exp(lgamma((max(v) + 1) / 2) - lgamma(max(v) / 2)) / sqrt(pi()) * max((pi() / 2 - a) / {_PANELS}) / 3
    * sum(case when i = 0 or i = {_PANELS} then 1 when i % 2 = 1 then 4 else 2 end * pow(cos(a + i * (pi() / 2 - a) / {_PANELS}), v - 1)) as p
  from angles join range({_PANELS + 1}) g(i) on 1 = 1 group by kind_a, kind_b, corr, n, t)"""


@query(
    "failure_corr_p",
    check_sql(
        "select kind_a, kind_b, corr, n, t, coalesce(p, 0) as p_value, coalesce(p, 0) < 0.05 / 13 / 14 as significant from tails",
        *_CORR_CTES,
        P_VALUE_SQL,
        doubles=["corr", "t", "p_value"],
    ),
)
def failure_corr_p(spark, sf):
    return tidy(dist.corr_significance(corr(spark, sf)))
