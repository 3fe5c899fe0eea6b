"""Every registered query against its SQL twin.

The whole catalog takes minutes; NODEPULSE_ALL=1 runs it, else one query of each
kind runs.
"""

import os

import numpy as np
import pandas as pd
import pytest

import __spark_entry__ as entry_points
from nodepulse.plans.catalog import REGISTRY

SAMPLE = [
    "hier_finalize",
    "cluster_power_ts",
    "cluster_component_ts",
    "job_power_ts",
    "job_component_summary",
    "job_energy",
    "thermal_bands_job",
    "comptype_cluster",
    "cep_join",
    "meter_diff_summary",
    "failures_per_project",
    "failure_zscores",
    "failure_corr_t",
    "power_segments",
    "edge_durations",
    "job_fft",
    "ecdf",
    "kde_2d",
    "compact_roundtrip",
    "corrupt_files",
    "half_written_days_pending",
    "final_all_sensors",
    "stream_late_rows",
    "stream_power_of_readings",
    "stream_cluster_power",
]
NAMES = list(REGISTRY) if os.environ.get("NODEPULSE_ALL") else SAMPLE


def comparable(df: pd.DataFrame) -> list[tuple]:
    def text(v):
        if isinstance(v, (list, np.ndarray)):
            return str(list(v))
        if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, float) and np.isnan(v)):
            return "-"
        if isinstance(v, (bool, np.bool_)):
            return str(bool(v))
        return repr(float(v)) if isinstance(v, (int, float, np.number)) else str(v)

    return sorted(tuple(text(v) for v in row) for row in df[sorted(df.columns)].itertuples(index=False))


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, duck, tables, name):
    q = REGISTRY[name]
    got = q.run(spark, tables).toPandas()
    if q.sql is None:
        return
    want = duck.execute(q.sql).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert comparable(got) == comparable(want)


def test_entry_has_rows(spark):
    assert entry_points.entry(spark).count() > 0


def test_sql_keys_are_queries():
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())
