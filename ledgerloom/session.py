"""Spark session set-up and run-wide constants.

The pipeline is wall-clock free: every place the reference reads the current
date takes ``as_of`` instead (pinned in tests and in the oracle).
"""

from __future__ import annotations

import datetime as _dt
import os
import tempfile

from pyspark import SparkConf
from pyspark.sql import SparkSession

# The pinned "today" used by tests and the DuckDB oracle.
DEFAULT_AS_OF = _dt.date(2002, 1, 1)


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app_name: str = "ledgerloom") -> SparkSession:
    """Session with AQE, UTC and the UI off.

    On a cluster the master, memory and checkpoint dir come from the
    submitter; here we only fill in what is unset.
    """
    wanted = {
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        # Small stages keep some parallelism (CPU-heavy projections such as
        # the regex/md5 of the fact); large shuffles are unaffected.
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "256k",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.driver.memory": os.environ.get("LEDGERLOOM_DRIVER_MEMORY", "16g"),
    }
    # Under spark-submit the JVM runs already and its configuration is known.
    submitted = SparkConf() if "PYSPARK_GATEWAY_PORT" in os.environ else None
    builder = SparkSession.builder.appName(app_name)
    for key, value in wanted.items():
        if submitted is None or not submitted.contains(key):
            builder = builder.config(key, value)
    if master:
        builder = builder.master(master)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster names it (a shared file system path); only when it is unset, as
    in local tests, do we pick a scratch folder of our own.
    """
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    if conf_dir:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(conf_dir)
        return conf_dir
    current = sc.getCheckpointDir()
    if current:
        return current
    if not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    local = tempfile.mkdtemp(prefix="ledgerloom-ckpt-")
    spark.conf.set("spark.checkpoint.dir", local)
    sc.setCheckpointDir(local)
    return local
