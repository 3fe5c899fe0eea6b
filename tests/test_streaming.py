"""Late rows over several micro-batches, and state that outlives a run."""

from datetime import datetime, timedelta

import pytest

from nodepulse.streaming import node_stream

START = datetime(2024, 1, 1)
SCHEMA = "timestamp timestamp, hostname string, x double"
#: Micro-batches of (second, host, value).
FILES = [
    [(0, "a", 1.0), (5, "a", 2.0), (100, "a", 3.0), (3, "b", 4.0)],
    [(130, "a", 5.0), (70, "a", 6.0), (99, "b", 7.0)],  # 60 and 31 seconds behind the latest row so far
    [(400, "b", 8.0), (2, "a", 9.0), (32, "c", 10.0), (71, "a", 11.0)],  # the watermark was at 40: two rows are too late
    [(405, "a", 12.0), (75, "a", 13.0), (395, "a", 14.0)],  # it was at 70, which closes no bin that ends later
    [(900, "b", 15.0), (330, "b", 16.0), (390, "c", 17.0)],  # it was at 340
]


def write(spark, path, rows):
    data = [(START + timedelta(seconds=s), h, v) for s, h, v in rows]
    spark.createDataFrame(data, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def arriving(spark, path):
    return node_stream.read_stream(spark, path, spark.createDataFrame([], SCHEMA).schema, files_per_trigger=1)


def seconds(ts):
    return int((ts - START).total_seconds())


def model(files):
    """Rows that count, by the rule: a bin is shut for rows once the batch before has closed it."""
    kept, latest = [], []
    for n, rows in enumerate(files):
        shut = max(latest[: n - 1], default=-1e9) - 60
        kept += [(s // 10 * 10, h, v) for s, h, v in rows if s // 10 * 10 + 10 > shut]
        latest.append(max(s for s, _, _ in rows))
    done = max(latest) - 60
    return [r for r in kept if r[0] + 10 <= done], done


@pytest.mark.parametrize("runs", [[5], [2, 2, 1], [1, 1, 1, 1, 1]])
def test_late_rows(spark, tmp_path, runs):
    source, sink, state = (str(tmp_path / x) for x in ("in", "out", "state"))
    todo = list(FILES)
    for n in runs:
        for rows in todo[:n]:
            write(spark, source, rows)
        todo = todo[n:]
        written = node_stream.run_to_table(
            spark, lambda: node_stream.stream_init_agg(arriving(spark, source), "10 seconds", ["x"]), sink, state
        )
    got = {(seconds(r.timestamp), r.hostname): (r.x_count, r.x_sum) for r in written.collect()}
    assert len(got) == written.count()
    if runs == [5]:
        kept, done = model(FILES)
        assert {(s, h): (n, v) for (s, h), (n, v) in got.items()} == {
            (s, h): (sum(r[:2] == (s, h) for r in kept), sum(r[2] for r in kept if r[:2] == (s, h))) for s, h, _ in kept
        }
        out = {(seconds(r.timestamp), r.hostname): (r.came, r.left_out) for r in node_stream.left_out(spark.read.parquet(source), written, "10 seconds", "x").collect()}
        flat = [(s // 10 * 10, h) for rows in FILES for s, h, _ in rows]
        assert out == {k: (flat.count(k), flat.count(k) - got.get(k, (0, 0))[0]) for k in flat if k[0] <= max(s for s, _ in got)}
        assert out[30, "c"] == (1, 1) and out[0, "a"] == (3, 1) and out[390, "c"] == (1, 0)
    # What the first run left open is finished by the later ones.
    assert got[100, "a"] == (1, 3.0) and got[400, "b"] == (1, 8.0)


def test_two_states_in_one_query(spark, tmp_path):
    source, sink, state = (str(tmp_path / x) for x in ("in", "out", "state"))
    for rows in FILES:
        write(spark, source, rows)
    series = node_stream.run_to_table(
        spark, lambda: node_stream.stream_power_of_readings(arriving(spark, source), "10 seconds", {"x": "x"}), sink, state
    ).collect()
    kept, _ = model(FILES)
    for r in series:
        own = [k for k in kept if k[0] == seconds(r.timestamp)]
        means = [sum(v for _, h, v in own if h == host) / sum(h == host for _, h, _ in own) for host in {h for _, h, _ in own}]
        assert (r.size_x, r.max_x) == (len(means), max(means))
    assert {seconds(r.timestamp) for r in series} == {k[0] for k in kept}
