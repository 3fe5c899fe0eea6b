"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Settings every job relies on.  Sizes stay with the cluster's own defaults.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Tables that are laid out by tick are joined and grouped by finer keys where they lie.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Rows of job arrays differ in size by far: bound the batch by bytes.
    "spark.sql.execution.arrow.maxBytesPerBatch": "67108864",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply :data:`SETTINGS` to a running session and return it."""
    for key, value in SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def local_session(cores: str | int = "*", partitions: int = 8, app: str = "nodepulse") -> SparkSession:
    """A local session for tests and the bench."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("NODEPULSE_DRIVER_MEMORY", "12g"))
        .config("spark.sql.shuffle.partitions", str(partitions))
        # Call sites in error messages cost a millisecond per column expression.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


_own_folder: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see, from ``spark.checkpoint.dir``.

    Only a local master may run without that setting; it then gets a folder of
    its own under the temporary directory, which is removed when Python ends.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    if context.applicationId not in _own_folder:
        own = _own_folder[context.applicationId] = tempfile.mkdtemp(prefix="nodepulse-")
        atexit.register(shutil.rmtree, own, ignore_errors=True)
    return _own_folder[context.applicationId]


def _own_scratch(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below :func:`shared_folder`, among those of this application."""
    return f"{_own_scratch(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def clear_scratch(spark: SparkSession) -> None:
    """Remove all that this application has written to its scratch paths.

    For the end of a job, once its results are written elsewhere: tables that
    were kept between steps, and token files, are gone then.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(_own_scratch(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def settle(df: DataFrame) -> DataFrame:
    """Compute ``df`` once and keep it in the shared folder.

    For a table that several steps read, where computing it is costly or must
    give the same rows each time.  It survives the loss of executors.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)


def few(df: DataFrame, limit: int = 100_000) -> DataFrame:
    """``df``, computed once, for joins by its key; sent to all executors if it has at most ``limit`` rows.

    For tables of a row for each class, domain or error code.
    """
    df = settle(df)
    return F.broadcast(df) if df.count() <= limit else df
