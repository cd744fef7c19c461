"""The enrichment run: new merchants and review items appended as one commit.

Both tables live in one ``TableSet``. A run reads them at one version, works
out what the open descriptions add, and commits both appends together. The
merchant dimension is keyed by canonical name: names it holds are left out, so
a second run over the same input adds nothing. A run that meets another
writer's commit starts again from that version.

Vectors come from a table (canonical_name, vec), where the reference calls an
embedding service; names without one are listed by ``waiting`` and are looked
at again in the next run.

Defined results: null, empty and fully stripped descriptions add nothing; a
name that several descriptions share is added once, but every one of these
descriptions is queued for review; of several vectors of a name the smallest
counts; empty tables give an empty commit.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import sinks
from .enrich import merchant_clean_names, merchant_new, merchant_review_queue, nearest_merchant, rule_categories, triage, unresolved_descriptions
from .table_sets import Conflict, TableSet

MERCHANTS, QUEUE = "dim_merchants", "merchant_review_queue"
MERCHANT_COLUMNS = ["merchant_id", "canonical_name", "category_id", "embedding", "created_at", "updated_at"]
QUEUE_COLUMNS = ["queue_id", "raw_description", "candidate_merchant_id", "distance", "created_at"]


@dataclass(frozen=True)
class Additions:
    merchants: DataFrame
    queue: DataFrame
    waiting: DataFrame


def additions(descriptions: DataFrame, merchants: DataFrame, queue: DataFrame, vectors: DataFrame,
              category_rules: DataFrame, created_at: str, folder: str) -> Additions:
    """What the open descriptions add to the merchants and to the queue, and the names that wait for a vector."""
    when = F.lit(created_at).cast("timestamp_ntz")
    named = merchants.select(F.col("canonical_name").alias("known")).where("known is not null").distinct()
    cleaned = merchant_clean_names(unresolved_descriptions(descriptions.select("raw_description").distinct(), queue))
    cleaned = cleaned.where("canonical_name <> ''")
    # read by every step below
    fresh = sinks.materialize(cleaned.join(named, F.col("canonical_name") == F.col("known"), "left_anti"), f"{folder}/open")
    ruled = sinks.materialize(rule_categories(fresh.select("canonical_name").distinct(), category_rules), f"{folder}/ruled")
    rest = fresh.join(ruled.select("canonical_name"), "canonical_name", "left_anti")

    vector = vectors.where("canonical_name is not null and vec is not null").groupBy("canonical_name").agg(F.min("vec").alias("vec"))
    names = sinks.materialize(rest.select("canonical_name").distinct().join(vector, "canonical_name", "left"), f"{folder}/names")
    asked = names.where("vec is not null").select(F.col("canonical_name").alias("query_id"), "canonical_name", "vec")
    near = nearest_merchant(asked.select("query_id", "vec"), merchants.where("embedding is not null").select(
        "merchant_id", F.col("embedding").cast("array<double>").alias("vec")))
    decided = sinks.materialize(triage(asked.withColumn("raw_description", F.lit(None).cast("string")), near)
                                .drop("raw_description"), f"{folder}/decided")

    by_rule = ruled.select(F.md5("canonical_name").alias("merchant_id"), "canonical_name", "category_id",
                           F.lit(None).cast("array<float>").alias("embedding"), when.alias("created_at"), when.alias("updated_at"))
    by_vector = merchant_new(decided).withColumns({"created_at": when, "updated_at": when})
    review = rest.join(decided.where("decision = 'review'").drop("decision"), "canonical_name").withColumn("decision", F.lit("review"))
    return Additions(by_rule.unionByName(by_vector).select(*MERCHANT_COLUMNS),
                     merchant_review_queue(review).withColumn("created_at", when).select(*QUEUE_COLUMNS),
                     names.where("vec is null").select("canonical_name"))


def run_enrichment(tables: TableSet, descriptions: DataFrame, vectors: DataFrame, category_rules: DataFrame,
                   created_at: str, attempts: int = 5) -> DataFrame:
    """One run against the set's newest version; returns the names that wait for a vector."""
    for attempt in range(attempts):
        version = tables.version()
        found = additions(descriptions, tables.read(MERCHANTS, version), tables.read(QUEUE, version), vectors,
                          category_rules, created_at, sinks.run_folder(tables.spark))
        try:
            tables.append({MERCHANTS: found.merchants, QUEUE: found.queue}, expected=version)
            return found.waiting
        except Conflict:
            if attempt == attempts - 1:
                raise
    raise ValueError("attempts must be positive")
