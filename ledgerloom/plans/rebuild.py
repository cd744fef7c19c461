"""Rebuild of the four statement tables from everything received.

Received documents are the parser's records as JSON text. A document that
cannot be read, or lacks what its tables need, goes to the failures with its
reason; the others go on. The first copy of each file is chosen on slim keys,
so no payload is moved for it, and the documents are stored once. All tables and the failures are
committed together as one version of a ``TableSet``: readers keep the old
version until the new one is whole, and a rebuild that dies changes nothing.

Defined results: records that are no finance document are left out and are no
failure; a null body of a finance document is unreadable; repeated rows count
once; no received document gives empty tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.membership import may_match
from ..sources.statements import MULTI_NO_ACCOUNTS
from . import ingest, sinks
from .table_sets import TableSet

FAILURES = "failures"
UNREADABLE, NO_HASH, NO_KIND, NO_PERIOD, NO_AMOUNT = (
    "unreadable record", "no hash", "unknown kind", "header without period_end", "detail without amount")
_BROKEN = "_broken"
_KINDS = ("bank", "multi", "cc")


def _failure(kind: Column, accounts: Column, card: Column) -> Column:
    """Why a document cannot be loaded, null if it can."""
    banked, carded = kind.isin("bank", "multi"), kind == "cc"
    count = F.coalesce(F.size(accounts), F.lit(0))
    bare = F.exists(accounts, lambda a: a["header"]["period_end"].isNull())
    no_amount = F.exists(accounts, lambda a: F.exists(a["details"], lambda d: d["amount"].isNull()))
    return (F.when(F.col(_BROKEN).isNotNull() | F.col("_doc").isNull(), F.lit(UNREADABLE))
             .when(F.col("sha256").isNull(), F.lit(NO_HASH))
             .when(~kind.isin(*_KINDS), F.lit(NO_KIND))
             .when((kind == "multi") & (count == 0), F.lit(MULTI_NO_ACCOUNTS))
             .when((banked & (bare | (count == 0))) | (carded & card["header"]["period_end"].isNull()), F.lit(NO_PERIOD))
             .when((banked & no_amount) | (carded & F.exists(card["details"], lambda d: d["amount"].isNull())), F.lit(NO_AMOUNT)))


def read_documents(received: DataFrame, record: T.StructType) -> DataFrame:
    """The records of ``received`` (sha256, source_type, source_id, source_order, finance, body) with a ``reason``
    where one cannot be loaded. ``record`` is the type of the JSON text: kind, accounts, card, issues."""
    schema = T.StructType([*record.fields, T.StructField(_BROKEN, T.StringType())])
    parsed = received.where("finance").withColumn("_doc", F.from_json("body", schema, {"columnNameOfCorruptRecord": _BROKEN}))
    flat = parsed.select("sha256", "source_type", "source_id", "source_order", "_doc", F.col(f"_doc.{_BROKEN}").alias(_BROKEN),
                         *[F.col(f"_doc.{f.name}").alias(f.name) for f in record.fields])
    return flat.withColumn("reason", F.coalesce(
        _failure(F.col("kind"), F.col("accounts"), F.col("card")), F.when(F.col("kind").isNull(), F.lit(NO_KIND)))).withColumn(
        "issues", F.coalesce("issues", F.array().cast("array<string>"))).drop("_doc", _BROKEN)


def later_copies(documents: DataFrame) -> DataFrame:
    """(sha256, row) of every copy but the first of each file by (source_order, source_id, row). Only files that may have come
    more than once are shuffled, and of them no payload; a file that came once is its own first copy."""
    slim = documents.select("sha256", "source_order", "source_id", "row")
    key = F.xxhash64("sha256")
    again = slim.groupBy(key.alias("_file")).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("_file")
    copies = may_match(slim, key, again).where("_may").drop("_may")
    firsts = copies.groupBy("sha256").agg(
        F.min(F.struct("source_order", "source_id", "row")).alias("first")).select(F.col("first.row").alias("row"))
    return copies.join(firsts, "row", "left_anti").select("sha256", "row")


def without_rows(documents: DataFrame, dropped: DataFrame,
                 table: Callable[[str, DataFrame], DataFrame] = lambda name, df: df) -> DataFrame:
    """``documents`` but those whose (sha256, row) is in ``dropped``; only those that may be are shuffled for it.
    ``table`` writes what stays of these few, so that who reads the result often does not look for them each time."""
    key, d = F.xxhash64("sha256", "row"), dropped.select(F.col("sha256").alias("d_sha"), F.col("row").alias("d_row"))
    marked = may_match(documents, key, dropped.select(key.alias("_key")))
    asked = marked.where("_may").drop("_may").join(
        d, (F.col("row") == F.col("d_row")) & F.col("sha256").eqNullSafe(F.col("d_sha")), "left_anti")
    return marked.where("not _may").drop("_may").unionByName(table("asked", asked))


def first_received(documents: DataFrame) -> DataFrame:
    """The first copy of each file."""
    return without_rows(documents, later_copies(documents))


def rebuild_bronze(tables: TableSet, received: DataFrame, record: T.StructType) -> int:
    """Build the four tables and the failures from all of ``received`` and commit them; returns the version."""
    folder, expected = sinks.run_folder(tables.spark), tables.version()
    staged = sinks.materialize(read_documents(received, record).withColumn("row", F.monotonically_increasing_id()), f"{folder}/read")
    whole = staged.where("reason is null")
    # The documents are stored once: what is kept of them is told by the rows that go.
    later = sinks.materialize(later_copies(whole), f"{folder}/later")
    good = without_rows(whole, later, lambda name, df: sinks.materialize(df, f"{folder}/{name}")).drop("row", "reason")
    failures = staged.where("reason is not null").select("source_id", "sha256", "reason").distinct()
    return tables.replace({**{name: rows(good) for name, rows in ingest.BRONZE_TABLES.items()}, FAILURES: failures}, expected)
