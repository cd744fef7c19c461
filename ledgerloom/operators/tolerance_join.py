"""Band join |a - b| <= tol AND |d1 - d2| <= gap as an equi-join.

Spark plans a theta join like this as a BroadcastNestedLoopJoin (or a
Cartesian product), which does not scale. So values are put into buckets, one
side goes into each bucket that it reaches along one dimension, the other side
along the other, and both meet by an equi-join on the pair of buckets. Every
qualifying pair meets in exactly one (amount, day) cell, so there are no
duplicates; the full predicate stays as a residual filter. The narrower the
buckets, the more copies of a row; the wider, the more pairs that the filter drops.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def bucket(value: Column, width: int) -> Column:
    """floor(value / width) for integer values (exact for negatives too)."""
    return F.floor(value / F.lit(width)).cast("bigint")


def reached(value: Column, width: int, reach: int) -> Column:
    """Every bucket that holds a value within ``reach`` of ``value``. With
    buckets wider than twice the reach that is one, or two near a border."""
    return F.explode(F.sequence(bucket(value - F.lit(reach), width), bucket(value + F.lit(reach), width)))
