"""Duplicate numbering (``row_number`` over identical rows) that survives
huge groups of copies.

``row_number() over (partition by K order by O)`` puts a whole group into one
task. When the rows of a group are identical in every column we keep, the
numbers can be produced from counts instead: pre-aggregate ``(K, O) ->
n`` (map-side partial aggregation collapses the copies before the shuffle),
take a running sum of ``n`` over the much smaller per-``(K, O)`` frame, and
regenerate the rows with ``explode(sequence(offset+1, offset+n))``. The
result equals ``row_number`` as a multiset; rows tied on ``(K, O)`` are
indistinguishable, so the order among them does not matter.

Copies beyond ``BLOCK`` are not regenerated where they were counted: such a
row is cut into blocks of numbers, the blocks (one short row each) are dealt
over all tasks, and each task regenerates its own, so what follows (ids,
regexes, joins) is spread too. Rows with fewer copies are not shuffled again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


BLOCK = 1000  # copies regenerated from one row


def number_copies(df: DataFrame, partition_cols: Sequence[str], order_cols: Sequence[str],
                  out_col: str = "dup_seq", rewrite: dict[str, Column] | None = None,
                  times: Column | None = None) -> DataFrame:
    """Return ``df``'s columns in ``partition_cols + order_cols`` plus
    ``out_col`` = 1-based row number within ``partition_cols`` ordered by
    ``order_cols``. Every other column is dropped (callers keep all the
    columns they need in the two lists). ``rewrite``: columns that are counted
    as they come and ordered by and returned as the given one-to-one images.
    ``times``: how many copies a row stands for, by default one."""
    keys = list(partition_cols) + list(order_cols)
    counted = df.groupBy(*keys).agg(F.sum(F.lit(1) if times is None else times).alias("_n"))
    if rewrite:
        # Dealt over the tasks as they came: the images are made behind the shuffle.
        counted = counted.repartition(*partition_cols).withColumns(rewrite)
    w = (Window.partitionBy(*partition_cols)
         .orderBy(*[F.col(c).asc_nulls_last() for c in order_cols])  # DuckDB default order
         .rowsBetween(Window.unboundedPreceding, -1))
    offset = F.coalesce(F.sum("_n").over(w), F.lit(0))
    with_offset = counted.select(*keys, "_n", offset.alias("_off"))

    def numbers(first: Column, last: Column) -> Column:
        return F.explode(F.sequence(first, last)).alias(out_col)

    few = (with_offset.filter(F.col("_n") <= BLOCK)
           .select(*keys, numbers(F.col("_off") + 1, F.col("_off") + F.col("_n"))))
    blocks = (with_offset.filter(F.col("_n") > BLOCK)
              .select(*keys, (F.col("_off") + F.col("_n")).alias("_last"),
                      F.explode(F.sequence(F.col("_off") + 1, F.col("_off") + F.col("_n"), F.lit(BLOCK).cast("bigint")))
                      .alias("_first")))
    # A stated number of partitions, as AQE would put these short rows into one task.
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    many = (blocks.repartition(tasks, *keys, "_first")
            .select(*keys, numbers(F.col("_first"), F.least(F.col("_first") + (BLOCK - 1), F.col("_last")))))
    return few.unionByName(many)
