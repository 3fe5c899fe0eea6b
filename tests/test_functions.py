import pytest
from pyspark.sql import functions as F

from nodepulse.functions import bands, derive, missing, places, sensors, timegrid
from nodepulse.operators import failures


def one(df, col):
    return df.select(col.alias("v")).first().v


def times(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "t string").selectExpr("cast(t as timestamp) as t")


def seconds(df, col):
    return [r.v for r in df.select(F.date_format(col, "mm:ss").alias("v")).collect()]


def test_half_way_goes_to_the_even_tick(spark):
    df = times(spark, "2020-01-01 00:00:05", "2020-01-01 00:00:15", "2020-01-01 00:00:25", "2020-01-01 00:00:15.000001")
    assert seconds(df, timegrid.round_to("t", "10 seconds")) == ["00:00", "00:20", "00:20", "00:20"]


def test_floor_and_ceil(spark):
    df = times(spark, "2020-01-01 00:00:10", "2020-01-01 00:00:11", "1969-12-31 23:59:59")
    assert seconds(df, timegrid.floor_to("t", "10 seconds")) == ["00:10", "00:10", "59:50"]
    assert seconds(df, timegrid.ceil_to("t", "10 seconds")) == ["00:10", "00:20", "00:00"]


def test_weeks_start_on_monday(spark):
    df = times(spark, "2024-01-07 23:00:00", "2024-01-08 00:00:00")
    got = [str(r.v)[:10] for r in df.select(timegrid.floor_to("t", "1 week").alias("v")).collect()]
    assert got == ["2024-01-01", "2024-01-08"]


def test_grid_of_a_reversed_range_is_empty(spark):
    df = times(spark, "2020-01-01 00:00:15")
    assert one(df, timegrid.grid_between(F.col("t"), F.col("t"), "10 seconds")) == []


def test_nan_is_missing(spark):
    df = missing.nan_to_null(spark.createDataFrame([(float("nan"),), (2.0,)], "x double"))
    assert df.agg(F.sum("x")).first()[0] == 2.0


def test_sums_and_maxima_with_missing_parts(spark):
    df = spark.createDataFrame([(1.0, None), (None, None), (1.0, 2.0)], "a double, b double")
    got = df.select(
        missing.sum_strict(["a", "b"]), missing.sum_present(["a", "b"]), missing.max_present(["a", "b"]), missing.null_count(["a", "b"])
    )
    assert [tuple(r) for r in got.collect()] == [(None, 1.0, 1.0, 1), (None, None, None, 2), (3.0, 3.0, 2.0, 0)]


def test_unreadable_text_is_missing(spark):
    df = spark.createDataFrame([("12",), ("n/a",), ("NaN",), (None,)], "x string")
    assert [r[0] for r in df.select(missing.number_or_null("x")).collect()] == [12.0, None, None, None]


@pytest.mark.parametrize(
    "t, closed, open_",
    [(79.99, 0, 0), (80, 1, 1), (83, 2, 2), (87, 3, 3), (90, 4, 4), (149, 4, 4), (150, None, 4), (-1, None, 0), (None, None, None)],
)
def test_bands_are_closed_on_the_left(spark, t, closed, open_):
    df = spark.createDataFrame([(None if t is None else float(t),)], "t double")
    low, high = sensors.CLUSTER_BAND_RANGE
    assert one(df, bands.band("t", low=low, high=high)) == closed
    assert one(df, bands.band("t")) == open_


def test_band_counts_follow_the_bands(spark):
    temps = [79.99, 80.0, 83.0, 87.0, 90.0, 149.0, 150.0, -1.0, None]
    cols = [f"c{i}" for i in range(len(temps))]
    df = spark.createDataFrame([tuple(temps)], ", ".join(f"{c} double" for c in cols))
    counts = bands.band_counts(cols, "n", low=0, high=150)
    assert tuple(df.select(*counts.values()).first()) == (1, 1, 1, 1, 2)
    counts = bands.band_counts(cols, "n")
    assert tuple(df.select(*counts.values()).first()) == (2, 1, 1, 1, 3)


def test_hot_mask(spark):
    df = spark.createDataFrame([("h", 83.0, None, 82.9), ("h", 60.0, None, 70.0), ("h", 150.0, None, 70.0)], "host string, a double, b double, c double")
    got = [r[0] for r in df.select(bands.hot_mask("host", ["a", "b", "c"])).collect()]
    assert got == ["h:100", None, None]
    got = [r[0] for r in df.select(bands.hot_mask("host", ["a", "b", "c"], low=None, high=None)).collect()]
    assert got == ["h:100", None, "h:100"]


def test_size_classes(spark):
    df = spark.createDataFrame([(n,) for n in (1, 45, 46, 91, 92, 921, 922, 2764, 2765)], "n int")
    assert [r[0] for r in df.select(derive.node_class("n")).collect()] == [5, 5, 4, 4, 3, 3, 2, 2, 1]
    named = df.select(derive.node_class("n", labels=sensors.NODE_CLASS_NAMES))
    assert [r[0] for r in named.collect()][-1] == "E-4608"


def test_place_and_device(spark):
    df = spark.createDataFrame([("c07n11", "NVRM: Xid (PCI:0004:05:00): link 3")], "h string, m string")
    place = places.node_location("h")
    assert tuple(df.select(place["row"], place["rack"], place["height"]).first()) == (3, 7, 11)
    message = "NVRM: Xid (PCI: 0004:05:00): link 3"
    df = spark.createDataFrame([(message,), ("nothing",)], "m string")
    assert [tuple(r) for r in df.select(places.pci_address("m"), places.nvlink_id("m")).collect()] == [("0004:05:00", "3"), ("", None)]


def test_floor_map_has_each_node_once(spark):
    floor = places.floor_map(spark)
    per_board = {r.msb: r["count"] for r in floor.groupBy("msb").count().collect()}
    assert floor.select("hostname").distinct().count() == sum(per_board.values())
    assert per_board == {"msb16": 64 * 18, "msb17": 64 * 18, "msb19": 64 * 18, "msb20": 64 * 18}


def test_dotted_names(spark):
    df = spark.createDataFrame([(1.0, 2.0)], "input_power_mean double, gpu0_core_temp_tot_sq_dev double")
    assert derive.with_dotted_names(df).columns == ["input_power.mean", "gpu0_core_temp.tot_sq_dev"]


def test_core_13_is_absent():
    assert len(sensors.CPU_CORE_TEMPS) == 46 and "p0_core13_temp" not in sensors.CPU_CORE_TEMPS


def test_labels_go_on_after_z(spark):
    df = spark.range(1, 20_000).select("id", failures.sheet_letters(F.col("id")).alias("s"))
    got = {r.id: r.s for r in df.collect()}
    assert [got[k] for k in (1, 26, 27, 52, 53, 702, 703, 704, 18_278, 18_279)] == ["A", "Z", "AA", "AZ", "BA", "ZZ", "AAA", "AAB", "ZZZ", "AAAA"]
    assert len(set(got.values())) == len(got)


def test_lookup_takes_one_description(spark):
    dim = spark.createDataFrame([("a", "second"), ("a", "first"), ("b", None)], "k string, v string")
    df = spark.createDataFrame([("a",), ("b",), ("c",)], "k string")
    assert sorted((r.k, r.o) for r in derive.lookup(df, dim, "k", "v", "o").collect()) == [("a", "first"), ("b", "b"), ("c", "c")]


def test_local_time_over_a_clock_change(spark):
    df = spark.sql("select explode(array(timestamp'2020-03-08 01:30:00', timestamp'2020-03-08 03:30:00', timestamp'2020-11-01 00:30:00', timestamp'2020-11-01 02:30:00')) as t")
    got = [str(r[0]) for r in df.select(timegrid.local_to_utc("t", "America/New_York").alias("u").cast("string")).collect()]
    assert got == ["2020-03-08 06:30:00", "2020-03-08 07:30:00", "2020-11-01 04:30:00", "2020-11-01 07:30:00"]
