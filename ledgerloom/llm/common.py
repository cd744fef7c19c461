"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

#: White space of the word rules: space and the controls 9 to 13.
BLANK = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give this package to the executors, once per application, unless their PYTHONPATH has it."""
    root, app = Path(__file__).resolve().parents[2], spark.sparkContext.applicationId
    if app in _SHIPPED or str(root) in os.environ.get("PYTHONPATH", "").split(os.pathsep):
        return
    handle, name = tempfile.mkstemp(prefix="package-", suffix=".zip")  # the driver's copy; Spark sends it on
    os.close(handle)
    atexit.register(os.unlink, name)
    with zipfile.ZipFile(name, "w") as z:
        for p in sorted(Path(__file__).resolve().parents[1].rglob("*.py")):
            z.write(p, p.relative_to(root))
    spark.sparkContext.addPyFile(name)
    _SHIPPED.add(app)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder below the shared folder that ``spark.checkpoint.dir`` names."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"


def store(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    This cuts the lineage: a lost executor costs a reread, not a recompute,
    and the planner sees the real size of the table.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._stored = path
    return out


def discard(df: DataFrame) -> None:
    """Remove a table that ``store`` wrote and nothing will read again."""
    path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df._stored)
    path.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def store_once(df: DataFrame, name: str) -> DataFrame:
    """``store`` that also lets Spark remove the shuffle files of the write as soon as the table is there."""
    conf, key = df.sparkSession.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = conf.get(key, None)
    conf.set(key, "true")
    try:
        return store(df, name)
    finally:
        conf.unset(key) if before is None else conf.set(key, before)


def seeded_hash(seed: int, *cols: Column) -> Column:
    """Hash that depends on the seed in every bit."""
    return F.xxhash64(F.lit(seed), *cols)
