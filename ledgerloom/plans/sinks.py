"""Model sinks (A16): materialise a model as a Parquet table, or expose it
as a view.

Tables go under the shared folder the cluster names in
``spark.checkpoint.dir`` (never a machine-local temp dir on a cluster), one
sub-folder per run so concurrent runs do not collide. Writing a model that
several others read cuts the lineage: a lost executor re-reads the table
instead of recomputing the chain from bronze.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from ..session import ensure_checkpoint_dir


def run_folder(spark: SparkSession) -> str:
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/ledgerloom-tables/{uuid.uuid4().hex}"


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    w = df.write.mode("overwrite").option("compression", "zstd")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def materialize(df: DataFrame, path: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` as a table and return a fresh scan of it."""
    write_table(df, path, partition_by)
    return df.sparkSession.read.parquet(path)


def is_written(spark: SparkSession, path: str) -> bool:
    """Whether a write to ``path`` has finished."""
    done = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return done.getFileSystem(spark._jsc.hadoopConfiguration()).exists(done)
