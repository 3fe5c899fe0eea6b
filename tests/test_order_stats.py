import numpy as np
import pytest

from nodepulse.operators import densities, cluster, distributions, jobs, order_stats, thermal


@pytest.fixture(scope="module")
def skewed():
    """Two thirds of all rows in one group, many equal values, an outlier."""
    rng = np.random.default_rng(3)
    hot = np.round(rng.lognormal(3, 1, 4000), 1)
    return [("hot", float(v)) for v in hot] + [("hot", 1e9)] + [("cold", float(v)) for v in rng.normal(0, 1, 900)] + [("one", 5.0)] + [("flat", 2.0)] * 1000 + [("none", None)]


@pytest.fixture(scope="module")
def frame(spark, skewed):
    return spark.createDataFrame(skewed, "k string, v double").repartition(7).cache()


def groups(data):
    out = {}
    for k, v in data:
        if v is not None:
            out.setdefault(k, []).append(v)
    return out


def test_quantiles_equal_numpy(frame, skewed):
    probs = {"a": 0.0, "b": 0.25, "c": 0.5, "d": 0.999, "e": 1.0}
    got = {r.k: tuple(r)[1:] for r in order_stats.exact_quantiles(frame, ["k"], "v", probs).collect()}
    want = groups(skewed)
    assert set(got) == set(want)
    for k, values in want.items():
        assert got[k] == pytest.approx(tuple(np.quantile(values, list(probs.values()))))


def test_ranks_cover_each_group_without_gaps(frame, skewed):
    ranks = order_stats.value_ranks(frame, ["k"], "v").orderBy("k", "value").collect()
    for k, values in groups(skewed).items():
        mine = [r for r in ranks if r.k == k]
        assert [r.value for r in mine] == sorted(set(values))
        at = 0
        for r in mine:
            assert r.before == at and r.total == len(values)
            at += r.n
        assert at == len(values)


def test_value_at_share(frame, skewed):
    got = {r.k: r.value_at for r in distributions.ecdf_mark(frame, ["k"], "v", 0.8).collect()}
    assert got == {k: sorted(v)[int((len(v) - 1) * 0.8)] for k, v in groups(skewed).items()}


def test_grouped_statistics(frame, skewed):
    got = {r.k: r for r in order_stats.grouped_stats(frame, ["k"], [("v", "v", cluster.POWER_KINDS)]).collect()}
    for k, values in groups(skewed).items():
        assert got[k].q50_v == pytest.approx(np.quantile(values, 0.5))
        assert got[k].sum_v == pytest.approx(sum(values))


def test_building_series_runs_nothing(spark):
    """No Spark job runs while the plan of a series is built."""
    nodes = spark.range(10).selectExpr(
        "timestamp_seconds(id) as timestamp", "'h' as hostname", *[f"double(id) as {c}" for c in ("input_power_mean", "total_power_mean", "ps0_input_power_mean", "ps1_input_power_mean")]
    )
    pernode = spark.range(2).selectExpr("id as allocation_id", "'h' as node_name", "1 as num_nodes", "timestamp_seconds(0) as begin_time", "timestamp_seconds(5) as end_time")
    tracker, group = spark.sparkContext.statusTracker(), "series"
    spark.sparkContext.setJobGroup(group, group)
    try:
        cluster.cluster_power_ts(nodes)
        jobs.job_power_ts(nodes, pernode)
        thermal.comptype_stats(nodes, ["timestamp"], {"x": ["input_power_mean", "total_power_mean"]})
        assert tracker.getJobIdsForGroup(group) == []
    finally:
        spark.sparkContext._jsc.clearJobGroup()


def test_two_nodes_have_no_p_value(spark):
    counts = [("a", "x", 1), ("b", "x", 2), ("a", "y", 3), ("b", "y", 1)]
    corr = distributions.corr_matrix(spark.createDataFrame(counts, "h string, kind string, n bigint"), "h", "kind", "n", ["x", "y"])
    assert {r.p_value for r in distributions.corr_significance(corr).collect()} == {None}


def test_box_whiskers(frame, skewed):
    box = {r.k: r for r in distributions.box_summary(frame, ["k"], "v").collect()}
    values = np.array(groups(skewed)["hot"])
    q1, q3 = np.quantile(values, [0.25, 0.75])
    inside = values[(values >= q1 - 1.5 * (q3 - q1)) & (values <= q3 + 1.5 * (q3 - q1))]
    assert (box["hot"].whisker_low, box["hot"].whisker_high) == (inside.min(), inside.max())
    assert box["hot"].highest == 1e9 and box["hot"].n == len(values)


def test_correlation_and_p_values(spark):
    counts = [("a", "x", 1), ("b", "x", 2), ("c", "x", 3), ("a", "y", 1), ("b", "y", 2), ("c", "y", 3), ("a", "z", 5), ("c", "z", 1)]
    df = spark.createDataFrame(counts, "h string, kind string, n bigint")
    corr = distributions.corr_matrix(df, "h", "kind", "n", ["x", "y", "z", "never"])
    got = {(r.kind_a, r.kind_b): r for r in distributions.corr_significance(corr).collect()}
    assert got["x", "y"].corr == pytest.approx(1.0) and got["x", "y"].p_value == pytest.approx(0.0, abs=1e-6)
    want = np.corrcoef([1, 2, 3], [5, 0, 1])[0, 1]
    assert got["x", "z"].corr == pytest.approx(want)
    # With one degree of freedom Student's t is the Cauchy distribution.
    t = want * np.sqrt(1 / (1 - want**2))
    assert got["x", "z"].p_value == pytest.approx(1 - 2 / np.pi * np.arctan(abs(t)))
    assert not any("never" in pair for pair in got)


@pytest.mark.parametrize("t, freedom, p", [(2.228, 10, 0.05), (2.576, 1e6, 0.01), (0.0, 5, 1.0), (12.706, 1, 0.05), (-2.228, 10, 0.05)])
def test_student_tail_against_printed_tables(t, freedom, p):
    got = distributions._upper_tail(np.array([t]), np.array([float(freedom)]))[0]
    assert got == pytest.approx(p, abs=2e-4)


def test_density_integrates_to_one(spark):
    df = spark.range(500).selectExpr("id % 2 as k", "pow(id % 37, 1.3) as x")
    grid = densities.kde_1d(df, "k", "x", points=400).toPandas().sort_values("x")
    for _, part in grid.groupby("k"):
        assert np.trapezoid(part["density"], part["x"]) == pytest.approx(1.0, abs=5e-3)


def test_densities_are_the_exact_sums(spark):
    rng = np.random.default_rng(6)
    x = np.r_[rng.normal(0, 1, 300), rng.pareto(1.5, 300) * 3, [1e4]]
    y = 0.9 * x + rng.normal(0, 1, len(x))
    rows = [(int(k % 3), float(a), float(b)) for k, (a, b) in enumerate(zip(x, y, strict=True))]
    rows += [(7, 5.0, 5.0)] * 4 + [(8, 1.0, None), (9, None, None), (None, 1.0, 2.0)]
    df = spark.createDataFrame(rows, "k int, x double, y double")
    line = densities.kde_1d(df, "k", "x", points=50).toPandas()
    plane = densities.kde_2d(df, "k", "x", "y", (-3.0, 30.0, 7), (-4.0, 20.0, 6)).toPandas()
    assert set(line["k"]) == set(plane["k"]) == {0, 1, 2}
    for k in range(3):
        own = np.array([(a, b) for c, a, b in rows if c == k])
        n, h = len(own), own[:, 0].std(ddof=1) * len(own) ** -0.2
        at = line[line["k"] == k].sort_values("i")
        assert at["x"].to_numpy() == pytest.approx(np.linspace(own[:, 0].min() - 3 * h, own[:, 0].max() + 3 * h, 50))
        want = np.exp(-0.5 * ((at["x"].to_numpy()[:, None] - own[:, 0]) / h) ** 2).sum(1) / (n * h * np.sqrt(2 * np.pi))
        assert np.abs(at["density"] - want).max() < 3e-12 / (h * np.sqrt(2 * np.pi))
        cov = np.cov(own.T) * n ** (-1 / 3)
        grid = plane[plane["k"] == k]
        off = grid[["x", "y"]].to_numpy()[:, None] - own[None]
        want = np.exp(-0.5 * np.einsum("gni,ij,gnj->gn", off, np.linalg.inv(cov), off)).sum(1) / (n * 2 * np.pi * np.sqrt(np.linalg.det(cov)))
        assert len(grid) == 42
        assert np.abs(grid["density"] - want).max() < 2e-9 / (2 * np.pi * np.sqrt(np.linalg.det(cov)))


def test_densities_do_not_multiply_rows(spark):
    df = spark.range(2000).selectExpr("id % 3 as k", "cast(id % 997 as double) as x", "cast(id * id % 1009 as double) as y")
    for made in (densities.kde_1d(df, "k", "x"), densities.kde_2d(df, "k", "x", "y", (0.0, 999.0, 9), (0.0, 999.0, 9))):
        assert "Generate" not in made._jdf.queryExecution().optimizedPlan().toString()
