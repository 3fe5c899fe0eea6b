import glob
import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from nodepulse.session import local_session  # noqa: E402

TABLES = os.environ.get("NODEPULSE_TABLES", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = local_session(cores=4, partitions=4, app="nodepulse-tests")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def tables():
    return TABLES


@pytest.fixture(scope="session")
def duck(tables):
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for path in glob.glob(f"{tables}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"create view {name} as select * from '{path}'")
    return con


@pytest.fixture
def rows(spark):
    """Rows of a frame as tuples, sorted."""

    def collect(df, *cols):
        df = df.select(*cols) if cols else df
        return sorted((tuple(r) for r in df.collect()), key=lambda t: tuple((v is None, str(v)) for v in t))

    return collect
