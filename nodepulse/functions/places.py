"""Where a node stands, and what an error message says about the device."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Cabinets fed by each main switch board, as row letter and first
# and last cabinet number; 18 nodes per cabinet.
BOARD_CABINETS = {
    "msb16": [("h", 9, 36), ("g", 1, 36)],
    "msb17": [("f", 1, 36), ("e", 1, 13), ("e", 25, 36), ("d", 1, 3)],
    "msb19": [("d", 4, 17), ("d", 19, 32), ("d", 34, 36), ("c", 1, 13), ("c", 25, 36), ("b", 1, 8)],
    "msb20": [("b", 9, 36), ("a", 1, 36)],
}
NODES_PER_CABINET = 18


def node_location(host: Column | str) -> dict[str, Column]:
    """Row (letter, counted from 1), rack number and height from ``a01n01``."""
    return {
        "row": F.ascii(F.substring(host, 1, 1)) - F.ascii(F.lit("a")) + 1,
        "rack": F.substring(host, 2, 2).try_cast("int"),
        "height": F.substring(host, 5, 10).try_cast("int"),
    }


def pci_address(message: Column | str) -> Column:
    """The ten characters of the bus address in the log message."""
    return F.substring(message, 17, 10)


def nvlink_id(message: Column | str) -> Column:
    """The link number in the log message, NULL when there is none."""
    return F.nullif(F.regexp_extract(message, r"link (\d)", 1), F.lit(""))


def floor_map(spark: SparkSession) -> DataFrame:
    """One row per node: hostname, cabinet and main switch board."""
    spans = [(board, row, first, last) for board, parts in BOARD_CABINETS.items() for row, first, last in parts]
    return (
        spark.createDataFrame(spans, "msb string, row string, first int, last int")
        .withColumn("number", F.explode(F.sequence("first", "last")))
        .withColumn("cabinet", F.concat("row", F.lpad(F.col("number").cast("string"), 2, "0")))
        .withColumn("node", F.explode(F.sequence(F.lit(1), F.lit(NODES_PER_CABINET))))
        .select(
            F.concat("cabinet", F.lit("n"), F.lpad(F.col("node").cast("string"), 2, "0")).alias("hostname"),
            "cabinet",
            "msb",
        )
    )
