"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A hot key is split even where the split costs another shuffle behind the join.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # The JVM does not compile methods above 8,000 bytes: longer stages then run operator by operator instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Lets a write that splits by verdict keep both files open instead of sorting every task's rows.
    "spark.sql.maxConcurrentOutputFileWriters": "4",
    # Shuffle files go when their query ends, not when the driver happens to collect its garbage.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Python workers hold one batch at a time, of whole texts too.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": "16m",
}


# Only a new session can take these. Call sites in error messages cost several calls into the JVM per expression,
# which adds up in plans of many columns.
START_SETTINGS = {"spark.python.sql.dataFrameDebugging.enabled": "false"}


def get_session(app_name: str = "wardhouse", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings this package expects; `conf` keys use `__` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **START_SETTINGS}.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return configure(builder.getOrCreate())


def configure(spark: SparkSession) -> SparkSession:
    """The same settings on a session that somebody else made.

    Local Python workers also get this package's folder; on a cluster ship it with `--py-files`.
    """
    home = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if home not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([home, *filter(None, paths)])
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder named by `spark.checkpoint.dir`.

    A local master (tests, bench) may leave it unset and then gets a temporary folder. On a cluster
    executors do not see the driver's disk, so there the setting is required.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="wardhouse-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder
