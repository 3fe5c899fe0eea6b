import time

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from nodepulse.operators import edges, segments


def job_series(spark, jobs):
    data = [(a, i, float(p), c, s, c) for a, (power, c, s) in jobs.items() for i, p in enumerate(power)]
    df = spark.createDataFrame(data, "allocation_id bigint, i int, sum_inp double, count_inp bigint, size_inp bigint, job_sch_node_num bigint")
    return df.selectExpr("*", "timestamp_seconds(1577836800 + i * 10) as timestamp")


SIZE = {"watts": 4.0, "full_size": 1}


def test_jobs_with_gaps_and_single_ticks_are_left_out(spark):
    series = job_series(spark, {1: ([1, 2, 3], 1, 1), 2: ([1], 1, 1), 3: ([1, 2], 1, 2)})
    clean = edges.clean_jobs(edges.number_ticks(series))
    assert {r.allocation_id for r in clean.select("allocation_id").distinct().collect()} == {1}


def test_runs_count_once_as_distinct_edges(spark):
    power = [0, 10, 20, 20, 5, 5, 15]
    got = edges.edges_per_job(job_series(spark, {1: (power, 1, 1), 2: ([1, 1, 1], 1, 1)}), **SIZE)
    table = {(r.allocation_id, r.type): (r.n_edges, r.n_distinct_edges) for r in got.collect()}
    assert table == {(1, "Rising"): (3, 2), (1, "Falling"): (1, 1), (2, "Rising"): (0, 0), (2, "Falling"): (0, 0)}


def brute_duration(power, e, share=0.8):
    begin = np.array(power[:-1], float)
    rem = begin[e + 1 :] - share * begin[e]
    change = np.where(np.diff(np.sign(rem)))[0]
    return 1 + (change[0] if len(change) else len(rem))


@pytest.mark.parametrize("power", [[0, 0, 10, 10, 1, 1], [5, 20, 20, 20, 3, 3, 30, 2, 2], [10, 1, 1, 8, 1, 20, 20], [1, 9], [8, 1, 6.4, 1, 9, 9]])
def test_durations(spark, power):
    got = edges.edge_durations(job_series(spark, {1: (power, 1, 1)}), **SIZE).collect()
    diff = np.diff(power)
    starts = [i for i, d in enumerate(diff) if abs(d) > 4 and not (i and np.sign(diff[i - 1]) == np.sign(d) and abs(diff[i - 1]) > 4)]
    assert {r.idx: r.duration for r in got} == {e: brute_duration(power, e) for e in starts}


def test_long_search_crosses_chunks(spark):
    power = [10, 100] + [100] * 700 + [1, 1, 1]
    got = {r.idx: r.duration for r in edges.edge_durations(job_series(spark, {1: (power, 1, 1)}), **SIZE).collect()}
    assert got[0] == brute_duration(power, 0)


def test_frequency_of_a_period_of_four_ticks(spark):
    power = [100 + 50 * np.sin(2 * np.pi * i / 4) for i in range(65)]
    row = edges.job_spectrum(job_series(spark, {1: (power, 1, 1), 2: ([1, 1, 1, 1], 1, 1)}), watts=1.0, full_size=1).collect()
    assert len(row) == 1 and row[0].freq == pytest.approx(0.025) and row[0].ticks == 65


def test_spectrum_ties_take_the_lowest_frequency(spark):
    row = edges.job_spectrum(job_series(spark, {1: ([0, 9, 9, 9, 9, 9, 9], 1, 1)}), watts=1.0, full_size=1).first()
    assert row.freq == 0.0


def test_tallies(spark):
    jobs = {1: ([1, 2, 3], 1, 2), 2: ([1], 1, 1), 3: ([1, 1, 1, 1], 1, 1), 4: ([0, 50, 0], 1, 1), 5: ([0, 50, 0, 50], 1, 1)}
    row = edges.job_tallies(job_series(spark, jobs), watts=1.0, full_size=1).first()
    assert (row.jobs, row.sensor_errors, row.short, row.below_threshold, row.too_short) == (5, 1, 1, 1, 1)


def test_snapshots_need_their_whole_stretch(spark):
    power = [0, 0, 0, 0, 20, 20, 20, 20, 20, 0]
    got = edges.edge_snapshots(job_series(spark, {1: (power, 9, 9)}), reach=2, watts=10, min_nodes=5)
    assert {r.edge_index for r in got.collect()} == {3} and got.count() == 6
    moved = [r.relative_power for r in edges.reintegrate(got).orderBy("offset").collect()]
    assert moved == [0, 0, 0, 20, 20, 20]


def brute_keep(items, front, rear):
    kept = []
    for cls, idx in sorted(items, key=lambda t: (-t[0], t[1])):
        if not [x for x in kept if idx - front <= x < idx + rear]:
            kept.append(idx)
    return sorted(kept)


@pytest.mark.parametrize("items", [[(1, 10), (3, 15), (2, 100)], [(1, 0), (1, 63), (1, 64), (1, 128)], [(2, 50), (2, 61), (1, 49), (3, 200), (3, 137)]])
def test_overlaps_are_suppressed_by_class(spark, items):
    df = spark.createDataFrame([("2020-01-01", "rise", c, i) for c, i in items], "d string, type string, amplitude_class int, edge_index int")
    df = df.selectExpr("cast(d as date) as date", "type", "amplitude_class", "edge_index")
    got = segments.suppress_overlaps(df, 12, 64)
    assert sorted(r.edge_index for r in got.collect()) == brute_keep(items, 12, 64)
    if items[0] == (1, 10):
        assert sorted(r.edge_index for r in got.collect()) == [15, 100]


def test_segments_of_a_day(spark):
    rng = np.random.default_rng(5)
    power = np.cumsum(rng.normal(0, 3000, 400)) + 60000
    nodes = np.where(np.arange(400) == 200, 1, 10)
    data = [(i, float(p), int(n)) for i, (p, n) in enumerate(zip(power, nodes))]
    series = spark.createDataFrame(data, "i int, sum_inp double, count_inp int").selectExpr("*", "timestamp_seconds(1577836800 + i * 10) as timestamp")
    got = segments.power_segments(series, ["sum_inp"], front=3, rear=7, band=5000.0, min_nodes=5)
    want = {}
    for kind, sign in (("rise", 1), ("fall", -1)):
        found = []
        for i in range(4, 400):
            size = int(sign * (power[i] - power[i - 4]) // 5000)
            if 1 <= size <= 13 and 3 <= i < 400 - 7 and nodes[i - 3 : i + 7].min() >= 5:
                found.append((size, i))
        want[kind] = brute_keep(found, 3, 7)
    collected = got.collect()
    for kind in want:
        assert sorted({r.edge_index for r in collected if r.type == kind}) == want[kind]
    assert len(collected) == 10 * sum(map(len, want.values()))
    assert all(r.sum_inp == power[r.edge_index - 3 + r.offset] for r in collected)


def scanned_lengths(power, edges_at, share):
    """Durations by looking at all later values."""
    begin, out = power[:-1], []
    for i in edges_at:
        later = begin[i + 1 :]
        sides = [0 if len(later) == 0 else None]
        if len(later):
            sides = np.sign(later - share * begin[i])
            other = [k for k in range(1, len(later)) if not sides[k] == sides[0]]
        ticks = 0 if not len(later) else (other[0] if other else len(later))
        out.append(ticks + 1 if ticks == len(later) else ticks)
    return out


@given(st.integers(0, 2**32 - 1), st.integers(2, 90))
@settings(max_examples=200, deadline=None)
def test_range_table_equals_the_scan(seed, n):
    rng = np.random.default_rng(seed)
    power = rng.integers(0, 12, n).astype(float) * rng.choice([1.0, 0.8, 10.0])
    if seed % 5 == 0:
        power[rng.integers(0, n, 3)] = np.nan
    edges_at = np.sort(rng.choice(n - 1, rng.integers(0, n), replace=True))
    share = float(rng.choice([0.8, 1.0, 0.5]))
    assert edges._lengths(power, edges_at, share) == scanned_lengths(power, edges_at, share)


def test_long_job_with_many_edges():
    rng = np.random.default_rng(1)
    power = 1e6 + np.cumsum(rng.normal(0, 10, 1_000_000))
    edges_at = np.sort(rng.choice(999_990, 50_000, replace=False))
    start = time.perf_counter()
    got = edges._lengths(power, edges_at, 0.9999)
    assert time.perf_counter() - start < 5
    some = rng.choice(50_000, 20)
    assert [got[k] for k in some] == [scanned_lengths_fast(power, edges_at[k], 0.9999) for k in some]


def scanned_lengths_fast(power, i, share):
    later = power[i + 1 : -1]
    side = np.sign(later - share * power[i])
    other = np.flatnonzero(side[1:] != side[0])
    return int(other[0]) + 1 if len(other) else len(later) + 1
