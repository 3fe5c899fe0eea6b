import pytest
from pyspark.sql import functions as F

from nodepulse.operators import edges, intervals, jobs
from nodepulse.plans import fixtures


@pytest.fixture
def pernode(spark):
    data = [(1, "a", 2, "00:00:10", "00:00:20"), (1, "b", 2, "00:00:10", "00:00:20"), (2, "a", 1, "00:00:19", "00:00:40")]
    df = spark.createDataFrame(data, "allocation_id bigint, node_name string, num_nodes int, b string, e string")
    return df.selectExpr(
        "allocation_id", "node_name", "num_nodes", "cast('2020-01-01 ' || b as timestamp) as begin_time", "cast('2020-01-01 ' || e as timestamp) as end_time"
    )


def ticks(spark, *texts, host="a"):
    return spark.createDataFrame([(t, host) for t in texts], "t string, hostname string").selectExpr(
        "cast('2020-01-01 ' || t as timestamp) as timestamp", "hostname", "10.0D as input_power_mean", "20.0D as total_power_mean"
    )


def test_both_ends_belong_to_a_job(spark, pernode, rows):
    df = ticks(spark, "00:00:00", "00:00:10", "00:00:20", "00:00:30")
    got = rows(intervals.join_jobs_by_time(df, pernode, "10 seconds").selectExpr("date_format(timestamp, 'ss') as s", "allocation_id"))
    assert got == [("10", 1), ("10", 2), ("20", 1), ("20", 2), ("30", 2)]


def test_repeated_job_rows_count_once(spark, pernode, rows):
    df = ticks(spark, "00:00:10")
    joined = intervals.join_jobs_by_time(df, pernode.union(pernode), "10 seconds")
    assert joined.count() == 2


def test_an_interval_over_many_buckets_matches_once(spark, rows):
    job = spark.createDataFrame([(7, "a", 1)], "allocation_id bigint, node_name string, num_nodes int").selectExpr(
        "*", "timestamp'2020-01-01 00:30:00' as begin_time", "timestamp'2020-01-03 00:30:00' as end_time"
    )
    grid = spark.range(0, 4 * 24 * 6).selectExpr("timestamp_seconds(1577836800 + id * 600) as timestamp", "'a' as hostname")
    joined = intervals.join_jobs_by_time(grid, job, "10 minutes", "1 hour")
    assert joined.count() == joined.select("timestamp").distinct().count() == 48 * 6 + 1


def test_reversed_interval_matches_nothing(spark):
    job = spark.createDataFrame([(7, "a", 1)], "allocation_id bigint, node_name string, num_nodes int").selectExpr(
        "*", "timestamp'2020-01-01 00:30:00' as begin_time", "timestamp'2020-01-01 00:10:00' as end_time"
    )
    assert intervals.join_jobs_by_time(ticks(spark, "00:20:00"), job, "10 seconds").count() == 0
    assert intervals.expand_job_ticks(job, "10 seconds").count() == 0


def test_ticks_round_their_ends(pernode, rows):
    got = rows(intervals.expand_job_ticks(pernode, "10 seconds").selectExpr("allocation_id", "hostname", "date_format(timestamp, 'ss')"))
    assert [g for g in got if g[0] == 2] == [(2, "a", "20"), (2, "a", "30"), (2, "a", "40")]


def test_an_event_at_the_begin_is_outside_and_at_the_end_inside(spark, pernode, rows):
    events = spark.createDataFrame([(1, "00:00:10"), (2, "00:00:20"), (3, "00:00:41")], "event_id bigint, t string").selectExpr(
        "event_id", "'a' as hostname", "cast('2020-01-01 ' || t as timestamp) as exact"
    )
    matches = intervals.jobs_at(events, pernode, "exact").select("event_id", "allocation_id")
    assert rows(matches) == [(2, 1), (2, 2)]
    assert intervals.exactly_one(matches, ["event_id"]).count() == 0


def test_job_series_and_summary(spark, pernode, rows):
    nodes = ticks(spark, "00:00:10", "00:00:20").union(ticks(spark, "00:00:10", host="b"))
    series = jobs.job_power_ts(nodes, pernode, "10 seconds")
    first = series.filter("allocation_id = 1").orderBy("timestamp").first()
    assert (first.count_hostname, first.job_sch_node_num, first.sum_inp, first.q50_inp, first.std_inp) == (2, 2, 20.0, 10.0, 0.0)
    summary = jobs.job_power_summary(series).filter("allocation_id = 1").first()
    assert (summary.max_sum_inp, summary.mean_sum_inp, summary.max_hosts_size) == (20.0, 15.0, 2)


def test_days_of_long_jobs(spark, rows):
    df = spark.createDataFrame([(1, d) for d in (1, 2, 3, 5)] + [(2, 3)], "allocation_id bigint, d int").selectExpr(
        "allocation_id", "cast('2020-01-0' || d as timestamp) as timestamp"
    )
    assert jobs.first_day_jobs(df).count() == 5
    assert jobs.first_day_jobs(df, 1).count() == 3
    day = "cast(day(timestamp) as int)"
    assert rows(jobs.continued_jobs(df).selectExpr("allocation_id", day)) == [(1, 2), (1, 3)]
    assert rows(jobs.new_jobs(df).selectExpr("allocation_id", day)) == [(1, 1), (1, 5), (2, 3)]


def test_repeated_node_and_job_count_once_over_all_their_time(spark):
    rows = [(1, "h", 0, 10), (1, "h", 20, 30), (2, "h", 100, 110)]
    for order in (rows, rows[::-1]):
        pernode = spark.createDataFrame(order, "allocation_id long, node_name string, b long, e long").selectExpr(
            "*", "timestamp_seconds(b) as begin_time", "timestamp_seconds(e) as end_time"
        )
        events = spark.range(40).selectExpr("id as event_id", "'h' as hostname", "timestamp_seconds(id) as exact")
        got = intervals.jobs_at(events, pernode, "exact").select("event_id", "allocation_id").collect()
        assert sorted((r.event_id, r.allocation_id) for r in got) == [(k, 1) for k in range(1, 31)]


def test_job_ends_outward_and_nearest(spark):
    pernode = spark.sql("select 1L as allocation_id, 'h' as node_name, 1 as num_nodes, timestamp_seconds(14) as begin_time, timestamp_seconds(36) as end_time")
    points = spark.range(0, 80, 10).selectExpr("timestamp_seconds(id) as timestamp", "'h' as hostname", "id")
    for ends, want in (("outward", [10, 20, 30, 40]), ("nearest", [10, 20, 30, 40])):
        assert sorted(r.id for r in intervals.join_jobs_by_time(points, pernode, "10 seconds", ends=ends).collect()) == want
    pernode = spark.sql("select 1L as allocation_id, 'h' as node_name, 1 as num_nodes, timestamp_seconds(16) as begin_time, timestamp_seconds(34) as end_time")
    for ends, want in (("outward", [10, 20, 30, 40]), ("nearest", [20, 30])):
        assert sorted(r.id for r in intervals.join_jobs_by_time(points, pernode, "10 seconds", ends=ends).collect()) == want
    ticks = intervals.expand_job_ticks(pernode, "10 seconds")
    assert intervals.join_ticks(points, ticks).count() == 2


def test_job_rows_are_made_distinct_in_their_jobs_partition(spark, tables):
    """No task holds the rows of all jobs it read, and the join's lists of nodes need no further shuffle."""
    pernode = fixtures.pernode_jobs(spark, tables)
    plan = pernode._jdf.queryExecution().executedPlan().toString()
    assert plan.index("HashAggregate") < plan.index("Exchange hashpartitioning(allocation_id")
    assert plan.count("partial_") <= 2 and plan.index("Exchange") == plan.index("Exchange hashpartitioning(allocation_id")
    assert pernode.count() == pernode.distinct().count() == pernode.select("allocation_id", "node_name").distinct().count() > 0
    joined = intervals.join_jobs_by_time(ticks(spark, "00:00:00"), pernode, "10 seconds")
    assert joined._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning(allocation_id") == 1


def test_jobs_stay_in_as_many_partitions_as_the_session_has(spark, tables):
    """Adaptive execution joins small partitions; those that hold the rows of many jobs are not to be joined."""
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    series = spark.range(40).selectExpr("id % 9 as allocation_id", "timestamp_seconds(id) as timestamp", "1D as sum_inp", "1L as count_inp", "1L as size_inp")
    for df in (fixtures.pernode_jobs(spark, tables), edges.number_ticks(series)):
        assert df.rdd.getNumPartitions() == parts
        used = df.select("allocation_id", F.spark_partition_id().alias("part")).distinct().collect()
        assert len({r.part for r in used}) > 1 and len(used) == len({r.allocation_id for r in used})
