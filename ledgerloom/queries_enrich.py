"""Registered merchant-enrichment queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from .oracle import enrich_sql  # noqa: F401
from .plans.enrichment_run import MERCHANTS, QUEUE
from .registry import from_model, register

from_model("merchant_clean", columns=["raw_description", "canonical_name"])
from_model("merchant_rule_match", columns=["canonical_name", "category_id"])
from_model("unresolved_descriptions", columns=["raw_description"])
from_model("rule_merchants", columns=["merchant_id", "canonical_name", "category_id"])

# Distances are rounded to 6 decimals on both sides (float summation order).
register("nearest_merchant", ["query_id", "merchant_id", "distance"],
         "SELECT query_id, merchant_id, round(distance, 6) AS distance FROM nearest_merchant",
         ("nearest_merchant",))(
    lambda lake: lake.nearest_merchant.withColumn("distance", F.round("distance", 6)))

register("merchant_triage", ["query_id", "merchant_id", "distance", "decision"],
         "SELECT query_id, merchant_id, round(distance, 6) AS distance, decision FROM merchant_triage",
         ("merchant_triage",))(
    lambda lake: lake.merchant_triage.withColumn("distance", F.round("distance", 6)))

register("merchant_new", ["merchant_id", "canonical_name", "category_id"],
         """SELECT md5(canonical_name) AS merchant_id, canonical_name, 'uncategorised' AS category_id
            FROM (SELECT DISTINCT 'shop ' || translate(query_id, '0123456789', 'abcdefghij') AS canonical_name
                  FROM merchant_triage WHERE decision = 'new') n""",
         ("merchant_triage",))(lambda lake: lake.merchant_new)

register("merchant_review_queue", ["queue_id", "raw_description", "candidate_merchant_id", "distance"],
         """SELECT md5(concat_ws('|', raw_description, merchant_id)) AS queue_id, raw_description,
                   merchant_id AS candidate_merchant_id, round(distance, 6) AS distance
            FROM merchant_triage WHERE decision = 'review'""",
         ("merchant_triage",))(
    lambda lake: lake.merchant_review_queue.withColumn("distance", F.round("distance", 6)))

# The run with its two appends: both tables after the commit, what still waits, and the fact over the new dimension.
register("enriched_merchants", ["merchant_id", "canonical_name", "category_id", "has_vector"],
         "SELECT merchant_id, canonical_name, category_id, has_vector FROM enriched_merchants", ("enriched_merchants",))(
    lambda lake: lake.enriched[0].read(MERCHANTS).withColumn("has_vector", F.col("embedding").isNotNull()))

register("enriched_review_queue", ["queue_id", "raw_description", "candidate_merchant_id", "distance"],
         """SELECT queue_id, raw_description, candidate_merchant_id, round(distance, 6) AS distance
            FROM enriched_review_queue""", ("enriched_review_queue",))(
    lambda lake: lake.enriched[0].read(QUEUE).withColumn("distance", F.round("distance", 6)))

register("enrichment_waiting", ["canonical_name"], "SELECT canonical_name FROM enrichment_waiting",
         ("enrichment_waiting",))(lambda lake: lake.enriched[1])

_FACT = ["transaction_id", "clean_description", "merchant_id", "category_id", "category_source"]
from_model("fact_enriched", columns=_FACT)
