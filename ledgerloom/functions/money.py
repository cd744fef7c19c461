"""Money as exact decimals.

The reference keeps amounts as DOUBLE; we keep DECIMAL(18,2) so that the
0.05 transfer tolerance, sums and the md5 id text are exact and engine
independent.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"


def cents(x: Column) -> Column:
    """Whole cents of a double amount: bigint(round(x * 100))."""
    return F.round(x * 100).cast("bigint")


def money(c: Column) -> Column:
    """Decimal amount from integer cents, exact in every engine."""
    return (c.cast("decimal(16,0)") * F.lit(0.01).cast("decimal(3,2)")).cast(MONEY)


def money_text(x: Column) -> Column:
    """Plain decimal text (``-12.50``) of a money column."""
    return x.cast(MONEY).cast("string")
