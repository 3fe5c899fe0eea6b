import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from nodepulse.operators import hier_agg
from nodepulse.plans.jobs import node_aggregates

KEYS = {"before": [], "after": []}


@pytest.fixture
def hourly(spark):
    values = [-1.0, 1.0, None, None, 1.0, None]
    data = [(f"2020-02-02 0{h}:00:00", v) for h, v in enumerate(values)]
    return spark.createDataFrame(data, "t string, x double").selectExpr("cast(t as timestamp) as timestamp", "x")


def test_six_hours_through_all_three_steps(hourly, rows):
    two = hier_agg.init_agg(hourly, "2 hours", **KEYS)
    kinds = [f"x_{k}" for k in hier_agg.KINDS]
    got = [tuple(r) for r in two.orderBy("timestamp").select(*kinds).collect()]
    assert got == [(2, 0, 2, -1, 1), (0, None, None, None, None), (1, 1, 0, 1, 1)]
    four = hier_agg.coarsen_agg(two, "4 hours", **KEYS)
    got = [tuple(r) for r in four.orderBy("timestamp").select(*kinds).collect()]
    assert got == [(2, 0, 2, -1, 1), (1, 1, 0, 1, 1)]
    final = hier_agg.finalize_agg(four, ["timestamp"])
    got = [tuple(r) for r in final.orderBy("timestamp").drop("timestamp").collect()]
    assert got[0] == (0, pytest.approx(math.sqrt(2)), -1, 1)
    assert got[1] == (1, None, 1, 1)


def test_empty_coarse_group_stays_missing(spark):
    data = [("2020-02-02 00:00:00", None), ("2020-02-02 01:00:00", None)]
    df = spark.createDataFrame(data, "t string, x double").selectExpr("cast(t as timestamp) as timestamp", "x")
    coarse = hier_agg.coarsen_agg(hier_agg.init_agg(df, "1 hour", **KEYS), "2 hours", **KEYS)
    row = hier_agg.finalize_agg(coarse, ["timestamp"]).first()
    assert (row.x_mean, row.x_std) == (None, None)


def test_large_mean_does_not_cancel(spark):
    data = [(f"2020-02-02 00:0{m}:00", 1e9 + m % 2) for m in range(8)]
    df = spark.createDataFrame(data, "t string, x double").selectExpr("cast(t as timestamp) as timestamp", "x")
    fine = hier_agg.init_agg(df, "1 minute", **KEYS)
    coarse = hier_agg.coarsen_agg(fine, "1 hour", **KEYS).first()
    assert coarse.x_tot_sq_dev == pytest.approx(2.0, rel=1e-9)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 7199), st.one_of(st.none(), st.integers(-50, 50))), min_size=1, max_size=40))
def test_coarsening_equals_direct_aggregation(spark, readings):
    data = [("h", s, None if v is None else float(v)) for s, v in readings]
    df = spark.createDataFrame(data, "hostname string, s int, x double")
    df = df.selectExpr("hostname", "timestamp_seconds(1580601600 + s) as timestamp", "x")
    direct = hier_agg.init_agg(df, "1 hour").orderBy("timestamp").collect()
    merged = hier_agg.coarsen_agg(hier_agg.init_agg(df, "10 minutes"), "1 hour").orderBy("timestamp").collect()
    assert len(direct) == len(merged)
    for a, b in zip(direct, merged):
        assert a.x_count == b.x_count and a.x_min == b.x_min and a.x_max == b.x_max and a.x_sum == b.x_sum
        if a.x_count:
            assert a.x_tot_sq_dev == pytest.approx(b.x_tot_sq_dev, abs=1e-6)


def test_all_sensors_are_one_aggregate(spark):
    cols = [f"cast(id * {i} % 17 as double) as s{i}" for i in range(1, 118)]
    df = spark.range(60).selectExpr("timestamp_seconds(id * 7) as timestamp", "concat('h', id % 3) as hostname", *cols)
    whole = node_aggregates(df, "1 minute")
    assert len(whole.columns) == 2 + 4 * 117
    assert whole.count() == 21
    assert whole._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1


def test_rows_without_host_belong_to_no_bin(spark):
    df = spark.createDataFrame([("a", 1.0), (None, 2.0)], "hostname string, x double").selectExpr("timestamp'2020-01-01' as timestamp", "*")
    assert [r.x_sum for r in hier_agg.init_agg(df, "1 hour").collect()] == [1.0]
