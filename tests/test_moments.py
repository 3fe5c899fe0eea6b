"""Matrices of mergeable aggregates, and counted temperatures."""

import math
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from nodepulse.functions import sensors
from nodepulse.operators import hier_agg, intervals, jobs, moments, thermal
from nodepulse.plans import queries_jobs
from nodepulse.plans.registry import tidy
from nodepulse.session import configure
from nodepulse.sources import schemas


def state_of(rows):
    keys = pa.array([k for k, _ in rows])
    return moments.State.of_values([keys], np.array([v for _, v in rows], float).reshape(len(rows), -1))


def test_merged_states_equal_the_whole():
    rng = np.random.default_rng(1)
    rows = [(f"h{rng.integers(5)}", np.where(rng.random(3) < 0.2, np.nan, 1e9 + rng.integers(-40, 40, 3))) for _ in range(500)]
    rows.append(("h5", [np.nan, np.nan, 4.0]))
    whole = state_of(rows).reduced()
    parts = [state_of(rows[a:b]).reduced() for a, b in ((0, 3), (3, 200), (200, 501))]
    merged = moments.State.joined(parts).reduced()
    assert merged.keys[0].to_pylist() == whole.keys[0].to_pylist()
    for a, b in zip(merged.parts, whole.parts, strict=True):
        assert a == pytest.approx(b, rel=1e-9, nan_ok=True)
    for k, host in enumerate(whole.keys[0].to_pylist()):
        own = np.array([v for h, v in rows if h == host], float)
        for v in range(3):
            there = own[:, v][~np.isnan(own[:, v])]
            count, total, dev, low, high = (p[k, v] for p in whole.parts)
            assert count == len(there)
            if len(there):
                assert (total, low, high) == (there.sum(), there.min(), there.max())
                assert dev == pytest.approx(((there - there.mean()) ** 2).sum(), rel=1e-9, abs=1e-6)
            else:
                assert np.isnan([total, dev, low, high]).all()


@pytest.mark.parametrize("cells", [1, 40, 1 << 21])
def test_wide_frames_equal_narrow_ones(spark, monkeypatch, cells):
    monkeypatch.setattr(moments, "CELLS", cells)
    cols = [f"if(id % {i + 3} = 0, null, cast(id * {i} % 17 as double)) as s{i}" for i in range(1, 21)]
    df = spark.range(400).selectExpr("timestamp_seconds(id * 7) as timestamp", "if(id % 50 = 1, null, concat('h', id % 3)) as hostname", *cols)
    wide = hier_agg.init_agg(df, "5 minutes")
    for part in ([f"s{i}" for i in range(1, 11)], [f"s{i}" for i in range(11, 21)]):
        narrow = hier_agg.init_agg(df, "5 minutes", values=part)
        got = sorted(map(tuple, wide.select(*narrow.columns).collect()))
        assert len(got) == narrow.count()
        for a, b in zip(got, sorted(map(tuple, narrow.collect())), strict=True):
            assert a[:2] == b[:2]
            assert [math.nan if x is None else x for x in a[2:]] == pytest.approx([math.nan if x is None else x for x in b[2:]], nan_ok=True)
    hours = hier_agg.coarsen_agg(wide, "1 hour")
    assert hours.columns == wide.columns
    assert {r.hostname: r.s4_count for r in hours.collect()} == {
        r.hostname: r.n for r in df.where("hostname is not null").groupBy("hostname").agg({"s4": "count"}).toDF("hostname", "n").collect()
    }


def test_merging_has_one_shuffle_and_no_window(spark):
    df = spark.range(100).selectExpr("timestamp_seconds(id * 7) as timestamp", "concat('h', id % 3) as hostname", "cast(id as double) as x")
    plan = hier_agg.coarsen_agg(hier_agg.init_agg(df, "1 minute"), "1 hour")._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and plan.count("RepartitionByExpression") == 1


def test_no_rows(spark):
    df = spark.createDataFrame([], "timestamp timestamp, hostname string, " + ", ".join(f"s{i} double" for i in range(20)))
    init = hier_agg.init_agg(df, "1 hour")
    assert init.count() == 0 and len(init.columns) == 102
    assert hier_agg.coarsen_agg(init, "1 day").count() == 0


def test_stored_types_of_all_sensors():
    base = schemas.loaded_schema()
    assert len([f for f in base if f.name not in ("timestamp", "hostname", "node_state")]) == 117
    assert len(schemas.lossless_schema(base)) == 2 + 5 * 117
    assert len(schemas.final_schema(base)) == 2 + 4 * 117


def test_counted_temperatures_merge(spark):
    groups = {"dimm": sensors.mean_of(sensors.DIMM_TEMPS), "cpu_core": sensors.mean_of(sensors.CPU_CORE_TEMPS)}
    cols = [
        f"if((id + {k}) % 11 = 0, null, {20 + k % 9} + (id * {k + 3}) % 37 / 4D) as {c}" for k, c in enumerate(c for own in groups.values() for c in own)
    ]
    df = spark.range(300).selectExpr("id", "timestamp_seconds(id div 60) as timestamp", "if(id % 7 = 0, null, id % 4) as job", *cols)
    keys = ["timestamp", "job"]
    halves = [thermal.counted_values(df.where(f"id % 2 = {k}"), keys, groups) for k in (0, 1)]
    merged = thermal.stats_of_counts(halves[0].unionByName(halves[1]), keys, list(groups))
    whole = thermal.comptype_stats(df, keys, groups)
    assert sorted(map(str, merged.collect())) == sorted(map(str, whole.collect()))
    pdf = df.toPandas()
    pdf["job"] = pdf["job"].fillna(-1)
    got = {(r.timestamp, -1 if r.job is None else r.job): r for r in whole.collect()}
    assert len(got) == len(pdf.groupby(["timestamp", "job"]))
    for (t, j), own in pdf.groupby(["timestamp", "job"]):
        r = got[t.to_pydatetime(), j]
        for kind, names in groups.items():
            flat = own[names].to_numpy().ravel()
            there = flat[~np.isnan(flat)]
            assert (r[f"{kind}_size"], r[f"{kind}_count"]) == (len(flat), len(there))
            assert [r[f"{kind}_{k}"] for k in ("mean", "std", "min", "max")] == pytest.approx(
                [there.mean(), there.std(ddof=1), there.min(), there.max()]
            )
            assert [r[f"{kind}_{k}"] for k in ("q25", "q50", "q75")] == pytest.approx(np.quantile(there, [0.25, 0.5, 0.75]).tolist())


def test_counted_temperatures_of_nothing(spark):
    df = spark.createDataFrame([("a", None, None)], "k string, x double, y double")
    r = thermal.comptype_stats(df, ["k"], {"t": ["x", "y"]}).first()
    assert (r.t_size, r.t_count, r.t_mean, r.t_std, r.t_q50) == (2, 0, None, None, None)
    one = spark.createDataFrame([("a", 61.5, None)], "k string, x double, y double")
    r = thermal.comptype_stats(one, ["k"], {"t": ["x", "y"]}).first()
    assert (r.t_size, r.t_count, r.t_mean, r.t_std, r.t_q50) == (2, 1, 61.5, None, 61.5)
    assert thermal.comptype_stats(df.limit(0), ["k"], {"t": ["x", "y"]}).count() == 0


def test_single_readings_are_shuffled_once(spark):
    """A partial row of one reading carries that reading alone."""
    df = spark.range(50).selectExpr("id div 2 as k", *[f"if(id % {i + 2} = 0, null, cast(id * {i} as double)) as s{i}" for i in range(3)])
    names = ["s0", "s1", "s2"]
    for rows, singles in ((df.where("k * 2 = id"), 25), (df.coalesce(1), 0)):
        seen = []
        keep, moments._shuffled = moments._shuffled, lambda partial, *a: seen.append(partial) or keep(partial, *a)
        try:
            got = moments.reduced(rows, ["k"], names, merge=False).collect()
        finally:
            moments._shuffled = keep
        assert seen[0].where("min is null").count() == seen[0].where("size(sum) = 3 and tot_sq_dev is null").count() >= singles
        want = {r.k: r for r in rows.groupBy("k").agg(*[c for v in names for c in hier_agg.moments(v)]).collect()}
        assert {r.k: r.asDict() for r in got} == {k: r.asDict() for k, r in want.items()}


def test_members_of_a_tick(spark):
    """Statistics of groups that share readings equal those of the readings written out for each group."""
    nodes = spark.range(60).selectExpr(
        "timestamp_seconds(id div 20 * 10) as timestamp", "if(id % 20 = 19, null, concat('h', id % 10)) as hostname",
        "if(id % 7 = 0, null, cast(id % 13 as double)) as x", "if(id % 5 = 0, null, id % 11 / 4D) as y",
    )
    pernode = spark.sql(
        "select explode(array(1L, 2L, null)) as allocation_id, 3 as num_nodes, timestamp_seconds(0) as begin_time, timestamp_seconds(10) as end_time"
    ).crossJoin(spark.range(7).selectExpr("if(id = 6, null, concat('h', id)) as node_name")).where("allocation_id is null or (node_name < concat('h', allocation_id * 2))")
    keys, groups = ["timestamp", "allocation_id"], {"a": ["x", "y"], "b": ["y"]}
    nodes = intervals.with_tick(nodes, "10 seconds")
    joined = intervals.join_jobs_by_time(nodes, pernode, "10 seconds")
    want = thermal.comptype_stats(joined, keys, groups)
    for cells in (1, 1 << 20):
        thermal.CELLS, before = cells, thermal.CELLS
        try:
            got = thermal.comptype_stats(nodes, keys, groups, members=joined)
            assert got.columns == want.columns and got.dtypes == want.dtypes
            assert sorted(map(repr, tidy(got, 9).collect())) == sorted(map(repr, tidy(want, 9).collect()))
        finally:
            thermal.CELLS = before
    assert want.count() == 6
    assert thermal.comptype_stats(nodes, keys, groups, members=joined.limit(0)).count() == 0
    assert thermal.comptype_stats(nodes.limit(0), keys, groups, members=joined).count() == 0


def test_matches_of_jobs_are_not_shuffled(spark):
    """Readings and job ticks are laid out by tick; the statistics of (tick, job) are made where the matches lie."""
    configure(spark)
    nodes = spark.range(10).selectExpr("timestamp_seconds(id) as timestamp", "'h' as hostname", "1D as input_power_mean", "2D as total_power_mean")
    pernode = spark.range(2).selectExpr("id as allocation_id", "'h' as node_name", "1 as num_nodes", "timestamp_seconds(0) as begin_time", "timestamp_seconds(5) as end_time")
    plan = jobs.job_power_ts(nodes, pernode, "1 second")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan[: plan.index("SortMergeJoin")]
    assert plan.count("Exchange hashpartitioning(__tick") == 2


def test_wide_batches_are_reduced_in_pieces(spark, monkeypatch):
    """Reducing takes many times the bytes of the rows, so tasks hold few rows of a batch at once and hand on few."""
    names = [f"s{i}" for i in range(117)]
    df = spark.createDataFrame([], "k long, " + ", ".join(f"{v} double" for v in names))
    made, keep = [], type(df).mapInArrow
    monkeypatch.setattr(type(df), "mapInArrow", lambda self, task, schema: made.append(task) or keep(self, task, schema))
    moments.reduced(moments.reduced(df, ["k"], names, merge=False), ["k"], names, merge=True)
    rng = np.random.default_rng(2)
    values = np.where(rng.random((10_000, 117)) < 0.1, np.nan, rng.integers(0, 90, (10_000, 117)))
    batch = pa.record_batch([pa.array(np.arange(10_000) * 2 // 3), *[pa.array(v, from_pandas=True) for v in values.T]], names=["k", *names])
    for k, task in enumerate(made):
        out, rows = [], 0
        tracemalloc.start()
        try:
            for part in task(iter([batch])):
                assert part.nbytes < 30e6
                rows += part.num_rows
                # Copies in Arrow's own memory, which is not counted.
                out.append(pa.ipc.read_record_batch(part.serialize(), part.schema))
                del part
            most = tracemalloc.get_traced_memory()[1]
        finally:
            tracemalloc.stop()
        assert most < 100e6, f"task {k}: {most / 1e6:.0f} MB"
        table = pa.Table.from_batches(out).combine_chunks()
        # Merging wants the counts of all variables, then their sums, and so on.
        batch = (table.select(["k", *[f"{v}_{x}" for x in moments.KINDS for v in names]]) if k == 1 else table).to_batches()[0]
    assert len(made) == 4 and batch.num_rows == 6667
    own = [values[np.arange(10_000) * 2 // 3 == k, 0] for k in range(6667)]
    assert batch.column("s0_count").to_pylist() == [int((~np.isnan(v)).sum()) for v in own]
    assert batch.column("s0_max").to_pylist() == [None if np.isnan(v).all() else np.nanmax(v) for v in own]


def test_statistics_of_many_groups_take_little_memory():
    """Sums come from the readings' own; temperatures are ranked for some groups at a time, in groups of any sizes."""
    rng = np.random.default_rng(4)
    temps = np.where(rng.random((500, 46)) < 0.1, np.nan, rng.integers(0, 200, (500, 46)) / 4)
    temps[7] = np.nan
    size = np.r_[1, rng.integers(1, 25, 8000), 300]
    rows = np.r_[7, rng.integers(0, 500, size.sum() - 1)]
    starts = np.cumsum(size) - size
    ranked = thermal.Ranked(temps)
    tracemalloc.start()
    try:
        got = dict(zip(thermal.COMPTYPE_KINDS, ranked.stats(rows, starts), strict=True))
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert most < 50e6, f"{most / 1e6:.0f} MB"
    assert [got[k][0] for k in ("size", "count")] == [46, 0] and np.isnan([got[k][0] for k in ("mean", "std", "min", "max", "q25", "q50", "q75")]).all()
    for k in (1, 2, 500, 8000, 8001):
        own = temps[rows[starts[k] : starts[k] + size[k]]].ravel()
        there = own[~np.isnan(own)]
        want = [there.mean(), there.std(ddof=1), there.min(), there.max(), *np.quantile(there, [0.25, 0.5, 0.75]), len(own), len(there)]
        assert [got[kind][k] for kind in thermal.COMPTYPE_KINDS] == pytest.approx(want, rel=1e-12)


def test_nodes_of_comptype_job_are_computed_once(spark, tmp_path):
    """The join and the statistics read one table of nodes."""
    events = spark.range(200).selectExpr(
        "id as event_id", "timestamp_seconds(id * 100) as ts", "id % 9 as user_id", "if(id % 5 = 0, 'signup', 'view') as event_type", "id / 3D as value"
    )
    events.write.parquet(f"{tmp_path}/events.parquet")
    made = queries_jobs.job_comptypes(spark, str(tmp_path))
    assert "MapInArrow" not in made._jdf.queryExecution().optimizedPlan().toString()
    assert made.count() > 0
