"""Readers for the driver-generated Parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

DRIVER_TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


SPREAD_MAX_BYTES = 1 << 30

_SCANS: dict[tuple, DataFrame] = {}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table; callers select the columns they need so the scan
    prunes (ReadSchema) and filters push down (PushedFilters).

    The (lazy) scan is memoised per session and path: resolving a Parquet
    schema costs a footer read on the driver each time.

    A table of at most SPREAD_MAX_BYTES with fewer splits than the cluster has
    cores (a small file with one row group) is spread round-robin so the work
    stacked on it does not run in one task; the shuffle that this adds is thus
    bounded on any cluster, and a larger table is read as it is split. Filters
    and column pruning still reach the scan through the repartition."""
    if name not in DRIVER_TABLES:
        raise ValueError(f"unknown driver table {name!r}")
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = (spark.sparkContext.applicationId, id(spark), path)
    if key not in _SCANS:
        df = spark.read.parquet(path)
        target = spark.sparkContext.defaultParallelism
        size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
        if size <= SPREAD_MAX_BYTES and df.rdd.getNumPartitions() < target:
            df = df.repartition(target)
        _SCANS[key] = df
    return _SCANS[key]
