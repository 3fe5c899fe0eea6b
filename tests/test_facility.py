import pytest
from pyspark.sql import functions as F

from nodepulse.operators import facility, failures, thermal


def test_interpolation_across_gaps_and_midnight(spark):
    data = [("2020-01-01 23:59:50", 0.0, 1.0), ("2020-01-02 00:00:05", 15.0, None), ("2020-01-02 00:00:05", 15.0, None), ("2020-01-04 00:00:00", 45.0, 3.0)]
    df = spark.createDataFrame(data, "t string, a double, b double").selectExpr("cast(t as timestamp) as timestamp", "a", "b")
    grid = facility.interpolate_to_grid(df, "10 seconds", ["a", "b"]).orderBy("timestamp").collect()
    assert [str(r.timestamp)[5:] for r in grid[:3]] == ["01-01 23:59:50", "01-02 00:00:00", "01-02 00:00:10"]
    assert [r.a for r in grid[:2]] == [0.0, 10.0]
    assert grid[-1].a == 45.0 and grid[-1].b == 3.0
    assert len(grid) == 1 + 2 * 8640 + 1 and None not in [r.b for r in grid]


def test_resampling_keeps_empty_bins(spark):
    data = [("00:00:01", 1.0), ("00:00:02", 3.0), ("00:00:31", 5.0)]
    df = spark.createDataFrame(data, "t string, x double").selectExpr("cast('2020-01-01 ' || t as timestamp) as timestamp", "x")
    got = [r.x for r in facility.resample_mean(df, "10 seconds", ["x"]).orderBy("timestamp").collect()]
    assert got == [2.0, None, None, 5.0]


def test_geometric_mean_of_negative_differences(spark):
    df = spark.createDataFrame([(-2.0,), (-8.0,), (3.0,), (None,)], "diff double")
    row = facility.meter_diff_summary(df).first()
    assert row.negative_diff_gmean == pytest.approx(-4.0) and row.diff_mean == pytest.approx(-7 / 3) and row.n == 3


def test_weekly_minimum_not_above_zero_is_zero(spark):
    df = spark.createDataFrame([("2024-01-01", -5.0), ("2024-01-02", 9.0), ("2024-01-08", 2.0)], "t string, k100_total_power double")
    df = df.selectExpr("cast(t as timestamp) as timestamp", "k100_total_power")
    got = {r.week: (r.max_power, r.min_power) for r in facility.weekly_extrema(df, factor=1.0).collect()}
    assert got == {1: (9.0, 0.0), 2: (2.0, 2.0)}


def test_component_types_ignore_missing_readings(spark):
    df = spark.createDataFrame([("t", 1.0, None, 4.0), ("t", 3.0, 5.0, None)], "k string, a double, b double, c double")
    row = thermal.comptype_stats(df, ["k"], {"x": ["a", "b"], "y": ["c"]}).first()
    assert (row.x_size, row.x_count, row.x_mean, row.x_q50) == (4, 3, 3.0, 3.0)
    assert (row.y_size, row.y_count, row.y_std) == (2, 1, None)


def test_zscore_rules(spark, monkeypatch):
    base = "timestamp'2020-01-01 00:00:10' as exact"
    fails = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (4, "d")], "event_id bigint, hostname string").selectExpr("*", "0 as gpu", base)
    silent = [(f"s{k}", None) for k in range(3)]
    temps = [("a", 70.0), ("x", 60.0), ("y", 50.0), ("b", 70.0), ("c", None), ("f", 99.0), *silent, *[(f"t{k}", 60.0) for k in range(6)]]
    nodes = spark.createDataFrame(temps, "hostname string, t0 double").selectExpr("*", "timestamp'2020-01-01 00:00:10' as timestamp")
    later = nodes.withColumn("timestamp", nodes.timestamp + F.expr("interval 10 seconds"))
    nodes = nodes.unionByName(later)
    members = [(1, "a"), (1, "x"), (1, "y"), (1, "y"), (2, "b"), (3, "f"), *[(2, h) for h, _ in temps if h[0] in "st"]]
    pernode = spark.createDataFrame(members, "allocation_id bigint, node_name string").selectExpr(
        "*", "timestamp'2020-01-01 00:00:00' as begin_time", "timestamp'2020-01-01 00:00:10' as end_time"
    )
    # This node's part of the job ended before the failure's tick.
    pernode = pernode.unionByName(spark.sql("select 1L as allocation_id, 'f' as node_name, timestamp'2019-12-31' as begin_time, timestamp'2020-01-01' as end_time"))
    groups = []
    whole = failures.comptype_stats

    def watched(rows, keys, kinds):
        groups.extend(tuple(r) for r in rows.select("allocation_id", "hostname").collect())
        return whole(rows, keys, kinds)

    monkeypatch.setattr(failures, "comptype_stats", watched)
    got = {r.event_id: (r.temp, r.allocation_id, r.z) for r in failures.failure_zscores(fails, nodes, pernode, temps=["t0"]).collect()}
    assert got == {1: (70.0, 1, 1.0), 2: (70.0, 2, None), 3: (None, None, None), 4: (None, None, None)}
    assert sorted(groups) == sorted({(j, h) for j, h in members if j != 3})


def test_modal_set_breaks_ties_by_order(spark):
    data = [("a", "0004:05:00"), ("a", "0004:04:00"), ("a", "0004:04:00"), ("b", "0035:03:00")]
    df = spark.createDataFrame([(h, f"NVRM: Xid (PCI: {p}): x") for h, p in data], "hostname string, message string")
    row = failures.modal_pci(df).first()
    assert (row.pcis, row.nodes) == ("04:04 04:05", 1)
    assert failures.on_good_nodes(df).select("hostname").distinct().first()[0] == "a"


def test_labels_follow_account_order(spark):
    accounts = spark.createDataFrame([("phy2",), ("phy1",), ("bio9",), ("phy1",)], "account string")
    domains = spark.createDataFrame([("phy", "Physics")], "domain string, description string")
    got = {r.account: r.label for r in failures.project_labels(accounts, domains).collect()}
    assert got == {"phy1": "Physics A", "phy2": "Physics B", "bio9": "bio A"}
