import os
import subprocess
import sys

from pyspark.sql import functions as F
from pyspark.sql import types as T

from nodepulse.functions import sensors
from nodepulse.operators.hier_agg import init_agg
from nodepulse.plans.jobs import load_readings
from nodepulse.sources import readers, schemas, writers
from nodepulse.streaming import node_stream


def minutes(spark, n=3000):
    return spark.range(n).selectExpr(
        "timestamp_seconds(1577836800 + id * 60) as timestamp", "concat('h', id % 3) as hostname", "cast(id % 11 as double) as x"
    )


def test_write_replaces_only_its_days(spark, tmp_path):
    path = str(tmp_path / "t")
    df = minutes(spark)
    writers.write_partitioned(df, path)
    one_day = df.filter("date(timestamp) = '2020-01-02'").withColumn("x", F.lit(-1.0))
    writers.write_partitioned(one_day, path)
    back = readers.read_table(spark, path)
    assert back.count() == 3000
    assert back.filter("x = -1").select("date").distinct().count() == 1
    assert readers.read_day(spark, path, "2020-01-02", ["x"]).columns == ["x"]


def test_date_filter_prunes_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    writers.write_partitioned(minutes(spark), path)
    day = readers.read_day(spark, path, "2020-01-02", ["x"])
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan and "ReadSchema: struct<x:double>" in plan


def test_corrupt_files_are_passed_over_on_request(spark, tmp_path):
    path = str(tmp_path / "t")
    minutes(spark).repartition(3).write.parquet(path)
    with open(os.path.join(path, "part-broken.parquet"), "wb") as f:
        f.write(b"not parquet at all")
    schema = minutes(spark).schema
    assert readers.read_table(spark, path, schema=schema, ignore_corrupt=True).count() == 3000


def test_compaction_keeps_every_row_in_fewer_files(spark, tmp_path):
    small, merged = str(tmp_path / "small"), str(tmp_path / "merged")
    writers.with_date(minutes(spark).repartition(9)).write.partitionBy("date").parquet(small)
    writers.compact(spark, small, merged)
    count = lambda p: sum(f.endswith(".parquet") for _, _, fs in os.walk(p) for f in fs)
    assert spark.read.parquet(merged).count() == 3000 and count(merged) < count(small)


def test_pending_days(spark):
    df = writers.with_date(minutes(spark))
    done = df.filter("date <> '2020-01-02'")
    assert [str(r.date) for r in writers.pending_days(df, done).collect()] == ["2020-01-02"]
    assert writers.pending_days(df, None).count() == 3


def test_date_range_includes_both_ends(spark):
    assert readers.date_range(spark, "2019-12-27", "2021-01-31").count() == 402
    assert readers.date_range(spark, "2020-01-02", "2020-01-01").count() == 0


def test_schemas_widen(spark):
    raw, loaded = schemas.raw_schema(), schemas.loaded_schema()
    assert len(raw) == 4 + 107 and len(loaded) == 3 + 117
    lossless, final = schemas.lossless_schema(loaded), schemas.final_schema(loaded)
    assert len(lossless) == 2 + 117 * 5 and len(final) == 2 + 117 * 4
    assert lossless["gpu0_core_temp_sum"].dataType == T.LongType()
    assert lossless["p0_power_sum"].dataType == lossless["p0_power_count"].dataType == T.LongType()
    assert lossless["ps0_input_voltage_sum"].dataType == T.DoubleType()
    assert lossless["ps0_input_voltage_min"].dataType == T.FloatType()
    assert final["p0_power_mean"].dataType == T.FloatType()


def test_long_bins_fit_their_types(spark):
    """400 readings of 90 degrees in one bin."""
    rows = spark.range(400).selectExpr("timestamp_seconds(id) as timestamp", "'h' as hostname", "cast(90 as tinyint) as gpu0_core_temp")
    base = schemas.loaded_schema()
    base = T.StructType([f for f in base if f.name in rows.columns])
    got = schemas.apply_schema(init_agg(rows, "1 hour"), schemas.lossless_schema(base)).first()
    assert (got.gpu0_core_temp_sum, got.gpu0_core_temp_count) == (36_000, 400)


def test_full_width_readings_load(spark):
    fields = schemas.raw_schema()
    row = tuple(
        {"timestamp": None, "string": "a01n01", "smallint": 7, "tinyint": 40, "float": 1.5}[f.dataType.simpleString()] for f in fields
    )
    df = load_readings(spark.createDataFrame([row], fields))
    got = df.first()
    assert got.gpu_total_power == 42 and got.dimm_max_temp == 40 and got.input_power == 14
    assert schemas.apply_schema(df, schemas.loaded_schema()).schema == schemas.loaded_schema()
    assert set(sensors.NODE_SUMS) | set(sensors.NODE_MAXIMA) <= set(df.columns)


def test_stream_equals_batch_for_closed_bins(spark, tmp_path):
    source = str(tmp_path / "in")
    df = minutes(spark, 600)
    for part in range(3):
        df.filter(f"pmod(unix_seconds(timestamp), 36000) between {part * 12000} and {part * 12000 + 11999}").coalesce(1).write.mode("append").parquet(source)

    def build():
        return node_stream.stream_init_agg(node_stream.read_stream(spark, source, df.schema), "10 minutes", ["x"])

    out = node_stream.run_to_table(spark, build, str(tmp_path / "out"), str(tmp_path / "state")).drop("date")
    last = df.agg(F.max("timestamp")).first()[0]
    batch = init_agg(df, "10 minutes").filter(F.expr("timestamp + interval 10 minutes") <= F.lit(last) - F.expr("interval 1 minute"))
    key = ["timestamp", "hostname"]
    assert out.select(batch.columns).orderBy(*key).collect() == batch.orderBy(*key).collect()
    again = node_stream.run_to_table(spark, build, str(tmp_path / "out"), str(tmp_path / "state"))
    assert again.count() == out.count()


def plant_days(spark, path):
    df = writers.with_date(minutes(spark))
    writers.write_finished(df.filter("date <> '2020-01-03'"), path)
    return df


def test_day_lists_open_no_file(spark, tmp_path):
    path = str(tmp_path / "t")
    plant_days(spark, path)
    for day in ("2020-01-01", "2020-01-02"):
        for name in os.listdir(os.path.join(path, f"date={day}")):
            if name.endswith(".parquet"):
                size = os.path.getsize(os.path.join(path, f"date={day}", name))
                os.remove(os.path.join(path, f"date={day}", f".{name}.crc"))
                with open(os.path.join(path, f"date={day}", name), "wb") as f:
                    f.write(b"x" * size)  # no reader of parquet can open it now
    days = readers.day_files(spark, path)
    assert "ReadSchema: struct<length:bigint>" in days._jdf.queryExecution().executedPlan().toString()
    assert [str(r.date) for r in readers.available_days(days).collect()] == ["2020-01-01", "2020-01-02"]
    assert sorted(str(r.date) for r in writers.finished_days(spark, path).collect()) == ["2020-01-01", "2020-01-02"]


def test_only_marked_days_are_finished(spark, tmp_path):
    path = str(tmp_path / "t")
    assert writers.finished_days(spark, path).count() == 0
    df = plant_days(spark, path)
    finished = lambda: sorted(str(r.date) for r in writers.finished_days(spark, path).collect())
    df.filter("date = '2020-01-03'").limit(5).write.mode("append").partitionBy("date").parquet(path)
    assert finished() == ["2020-01-01", "2020-01-02"]
    df.filter("date = '2020-01-02'").limit(5).write.mode("append").partitionBy("date").parquet(path)
    assert finished() == ["2020-01-01"]
    writers.write_finished(df.filter("date > '2020-01-01'"), path)
    assert finished() == ["2020-01-01", "2020-01-02", "2020-01-03"]
    assert spark.read.parquet(path).count() == 3000
    writers.write_finished(df.limit(0), path)
    assert len(finished()) == 3


def test_corrupt_files_are_named(spark, tmp_path):
    path = str(tmp_path / "t with space+plus")
    df = minutes(spark)
    df.repartition(3).write.parquet(path)
    df.limit(0).coalesce(1).write.mode("append").parquet(path)
    assert readers.corrupt_files(spark, path, df.schema).count() == 0
    for name, content in (("a b.parquet", b"not parquet"), ("c.parquet", b""), ("d.parquet", b"PAR1" + b"x" * (2 << 20))):
        with open(os.path.join(path, name), "wb") as f:
            f.write(content)
    got = {os.path.basename(r.path).replace("%20", " "): r.length for r in readers.corrupt_files(spark, path, df.schema).collect()}
    assert got == {"a b.parquet": 11, "d.parquet": (2 << 20) + 4}


def test_scratch_of_an_application_is_cleared(tmp_path):
    """In a session of its own settings: the folder of the others stays."""
    folder = str(tmp_path / "shared")
    code = f"""
import os
from pyspark.sql import SparkSession
from nodepulse.session import clear_scratch, scratch_path
conf = {{"spark.master": "local[1]", "spark.ui.enabled": "false", "spark.checkpoint.dir": {folder!r}}}
spark = SparkSession.builder.config(map=conf).getOrCreate()
os.makedirs({folder!r} + "/other")
path = scratch_path(spark, "x")
spark.range(3).write.parquet(path)
assert spark.read.parquet(path).count() == 3
clear_scratch(spark)
assert os.path.isdir({folder!r} + "/other") and not os.path.exists(os.path.dirname(path))
clear_scratch(spark)
"""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    done = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]
