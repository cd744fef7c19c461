"""Which rows may have a partner in another table, told without moving them.

The keys of the other table set bits in ``BITS`` bits, which are broadcast:
``BITS / 8`` bytes at most, whatever the size of either table. A row whose bit
is not set has no partner; the few others go through the join itself, so the
result is exact and only they are shuffled. The fuller the bits, the more rows
take the join: the worst case is the plain join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import with_once

BITS = 1 << 26


def _spot(key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(BITS))


def may_match(rows: DataFrame, key: Column, keys: DataFrame, name: str = "_may") -> DataFrame:
    """``rows`` with a boolean ``name``: false only where ``key`` equals none of the one column of ``keys``. ``key`` is
    worked out once a row, as it may be an id or a long hash."""
    member = F.col(keys.columns[0])
    spots = keys.filter(member.isNotNull()).select(_spot(member).alias("_spot"))
    bits = spots.groupBy(F.bitmap_bucket_number("_spot").alias("_bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("_spot")).alias("_bits"))
    at = F.bitmap_bit_position("_spot").cast("int")
    byte = F.conv(F.hex(F.substring(F.col("_bits"), F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return (with_once(rows, _spot(key), "_spot").join(F.broadcast(bits), F.bitmap_bucket_number("_spot") == F.col("_bucket"), "left")
                .select(*rows.columns, F.coalesce(F.getbit(byte, F.pmod(at, F.lit(8))) == 1, F.lit(False)).alias(name)))
