"""Column-level building blocks (built-in Spark expressions only)."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_once(df: DataFrame, expr: Column, name: str) -> DataFrame:
    """Add ``expr`` as column ``name``, evaluated exactly once per row.

    The value comes out of a generator (``inline`` of a one-element array).
    The optimizer does not push later filters below a generator nor fold
    the expression into each of its uses, which it otherwise may do with a
    plain projection — re-running an expensive expression (a CSV parse, a
    chain of regexes) once per use."""
    return df.select("*", F.inline(F.array(F.struct(expr.alias(name)))))
