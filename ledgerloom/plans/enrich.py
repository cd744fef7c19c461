"""Merchant enrichment (D1–D8): clean raw descriptions, resolve them by
rule, else by the nearest merchant vector, and triage the rest.

Snapshot semantics: every description is compared with the merchants that
exist at the start of the batch (the reference inserts one by one, so later
items may see earlier inserts in an undefined order).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import with_once
from ..functions.text import merchant_clean
from ..operators.nearest import nearest_merchant as _nearest
from ..operators.rules import first_rule
from ..sources.fixtures import FIXTURE_PARSED_AT

# Cosine-distance thresholds of the triage.
AUTO_MATCH_MAX = 0.22
NEW_MERCHANT_MIN = 0.35


def distinct_descriptions(bank_transactions: DataFrame, cc_transactions: DataFrame) -> DataFrame:
    return (bank_transactions.select("raw_description")
            .unionByName(cc_transactions.select("raw_description"))
            .distinct())


def merchant_clean_names(descriptions: DataFrame) -> DataFrame:
    """D1 over distinct raw descriptions; the ten-regex chain runs once per
    description (``with_once``) however often the name is used later."""
    return with_once(descriptions.select("raw_description"), merchant_clean(F.col("raw_description")),
                     "canonical_name")


def rule_categories(names: DataFrame, category_rules: DataFrame) -> DataFrame:
    """(canonical_name, category_id) of the names that a rule holds: the first rule by (priority, file order)
    whose lower-cased pattern is a substring; transfer rules included."""
    rules = category_rules.filter(F.col("priority").isNotNull()).select(
        F.lower("pattern").alias("pattern"), F.col("priority").cast("int").alias("priority"), "line", "category_id")
    found = first_rule(names.select(F.col("canonical_name").alias("text")), rules, ["priority", "line"], "category_id")
    return found.filter(F.col("category_id").isNotNull()).select(F.col("text").alias("canonical_name"), "category_id")


def merchant_rule_match(cleaned: DataFrame, category_rules: DataFrame) -> DataFrame:
    return rule_categories(cleaned.select("canonical_name").filter(F.col("canonical_name") != ""), category_rules)


def unresolved_descriptions(descriptions: DataFrame, review_queue: DataFrame) -> DataFrame:
    """D3: distinct raw descriptions not already queued; empty/NULL dropped.
    NOT IN semantics: one NULL in the queue empties the result."""
    queued = review_queue.select(F.col("raw_description").alias("q_raw"))
    kept = (descriptions.filter(F.col("raw_description").isNotNull() & (F.col("raw_description") != ""))
            .join(queued.filter(F.col("q_raw").isNotNull()).distinct(),
                  F.col("raw_description") == F.col("q_raw"), "left_anti"))
    # A NULL in the queue makes every NOT IN test unknown: keep nothing. An
    # uncorrelated EXISTS subquery, evaluated once.
    return kept.filter(~queued.filter(F.col("q_raw").isNull()).exists())


def rule_merchants(unresolved: DataFrame, merchants: DataFrame, category_rules: DataFrame) -> DataFrame:
    """One new merchant per cleaned name that a rule resolves, unless the
    name already exists."""
    cleaned = merchant_clean_names(unresolved).filter(F.col("canonical_name") != "")
    existing = merchants.select(F.col("canonical_name").alias("e_name")).filter(F.col("e_name").isNotNull())
    fresh = cleaned.select("canonical_name").distinct().join(
        existing.distinct(), F.col("canonical_name") == F.col("e_name"), "left_anti")
    ts = F.lit(FIXTURE_PARSED_AT).cast("timestamp_ntz")
    return (rule_categories(fresh, category_rules)
                 .select(F.md5("canonical_name").alias("merchant_id"), "canonical_name", "category_id",
                         ts.alias("created_at"), ts.alias("updated_at")))


def nearest_merchant(queries: DataFrame, merchants: DataFrame) -> DataFrame:
    """(query_id, merchant_id, distance) — exact, see operators.nearest."""
    return _nearest(queries, merchants)


def triage(queries: DataFrame, nearest: DataFrame) -> DataFrame:
    """Auto (<= 0.22), new (>= 0.35 or no merchant), else review."""
    j = queries.select(F.col("query_id").cast("string").alias("query_id"), "raw_description",
                       "canonical_name", "vec").join(nearest, "query_id", "left")
    d = F.col("distance")
    decision = (F.when(F.col("merchant_id").isNotNull() & (d <= AUTO_MATCH_MAX), F.lit("auto"))
                 .when(F.col("merchant_id").isNull() | d.isNull() | (d >= NEW_MERCHANT_MIN), F.lit("new"))
                 .otherwise(F.lit("review")))
    return j.withColumn("decision", decision)


def merchant_new(triaged: DataFrame) -> DataFrame:
    """New uncategorised merchants with their vector, one per name."""
    ts = F.lit(FIXTURE_PARSED_AT).cast("timestamp_ntz")
    new = triaged.filter(F.col("decision") == "new")
    per_name = new.groupBy("canonical_name").agg(F.min(F.struct("query_id", "vec")).alias("w"))
    return per_name.select(F.md5("canonical_name").alias("merchant_id"), "canonical_name",
                           F.lit("uncategorised").alias("category_id"),
                           F.col("w.vec").cast("array<float>").alias("embedding"),
                           ts.alias("created_at"), ts.alias("updated_at"))


def merchant_review_queue(triaged: DataFrame) -> DataFrame:
    """Borderline items queued with their candidate and distance."""
    ts = F.lit(FIXTURE_PARSED_AT).cast("timestamp_ntz")
    return (triaged.filter(F.col("decision") == "review")
                   .select(F.md5(F.concat_ws("|", "raw_description", "merchant_id")).alias("queue_id"),
                           "raw_description", F.col("merchant_id").alias("candidate_merchant_id"),
                           "distance", ts.alias("created_at")))


# --- ordered mode: earlier inserts are visible to later descriptions ---------------------

def ordered_triage(queries: DataFrame, merchants: DataFrame) -> DataFrame:
    """D6–D8 with the reference's sequential visibility, order = (canonical
    name, query id).

    A description becomes a new merchant iff its nearest distance over the
    batch-start merchants *and the new merchants before it* is >= 0.35 (or
    there is none). The new merchants are therefore the lexicographically
    first maximal independent set of the graph whose nodes are the items
    that are new against the snapshot and whose edges join items closer
    than 0.35. It is found in rounds, all on executors: an undecided item
    with an earlier leader neighbour is absorbed; one whose earlier
    neighbours are all absorbed becomes a leader. Each round decides at
    least the earliest undecided item, so the loop ends; every round's
    status is checkpointed (reliable, under spark.checkpoint.dir) to cut
    the lineage. Finally every item is triaged against the snapshot plus
    the leaders that precede it.

    Returns (query_id, raw_description, canonical_name, merchant_id,
    distance, decision, rounds).
    """
    from ..operators.nearest import nearest_earlier, neighbours_before
    from ..session import ensure_checkpoint_dir

    spark = queries.sparkSession
    ensure_checkpoint_dir(spark)
    q = queries.select(F.col("query_id").cast("string").alias("query_id"), "raw_description", "canonical_name",
                       "vec", F.concat_ws("\u0001", "canonical_name", F.col("query_id").cast("string")).alias("ord_key"))
    snap = _nearest(q.select("query_id", "vec"), merchants).select(
        "query_id", F.col("merchant_id").alias("s_merchant"), F.col("distance").alias("s_dist"))
    qs = q.join(snap, "query_id", "left").checkpoint()
    cand = qs.filter(F.col("s_merchant").isNull() | (F.col("s_dist") >= NEW_MERCHANT_MIN))
    edges = neighbours_before(cand.select(F.col("query_id").alias("item_id"), "ord_key", "vec"),
                              NEW_MERCHANT_MIN).select("item_id", "other_id").checkpoint()
    status = cand.select(F.col("query_id").alias("item_id"), F.lit("U").alias("status")).checkpoint()
    rounds = 0
    while True:
        rounds += 1
        # only undecided items need their earlier neighbours looked at, so
        # the edge set shrinks round by round
        open_items = status.filter(F.col("status") == "U").select("item_id")
        edges = edges.join(open_items, "item_id", "left_semi").checkpoint()
        earlier = edges.join(status.select(F.col("item_id").alias("other_id"), F.col("status").alias("y")),
                             "other_id")
        agg = earlier.groupBy("item_id").agg(F.max(F.col("y") == "L").alias("any_leader"),
                                             F.min(F.col("y") == "N").alias("all_absorbed"))
        new = (status.join(agg, "item_id", "left")
               .select("item_id",
                       F.when(F.col("status") != "U", F.col("status"))
                        .when(F.coalesce(F.col("any_leader"), F.lit(False)), F.lit("N"))
                        .when(F.coalesce(F.col("all_absorbed"), F.lit(True)), F.lit("L"))
                        .otherwise(F.lit("U")).alias("status"))
               .checkpoint())
        status = new
        if status.filter(F.col("status") == "U").limit(1).count() == 0:
            break
    leaders = (qs.join(status.filter(F.col("status") == "L").select(F.col("item_id").alias("query_id")), "query_id")
                 .select(F.md5("ord_key").alias("merchant_id"), "ord_key", "vec", "query_id"))
    near_l = nearest_earlier(q.select("query_id", "ord_key", "vec"), leaders.select("merchant_id", "ord_key", "vec"))
    near_l = near_l.select("query_id", F.col("merchant_id").alias("l_merchant"), F.col("distance").alias("l_dist"))
    is_leader = leaders.select("query_id", F.lit(True).alias("is_leader"))
    j = qs.join(near_l, "query_id", "left").join(is_leader, "query_id", "left")
    use_l = F.col("l_dist").isNotNull() & (F.col("s_dist").isNull() | (F.col("l_dist") < F.col("s_dist")))
    best_m = F.when(use_l, F.col("l_merchant")).otherwise(F.col("s_merchant"))
    best_d = F.when(use_l, F.col("l_dist")).otherwise(F.col("s_dist"))
    decision = (F.when(F.coalesce(F.col("is_leader"), F.lit(False)), F.lit("new"))
                 .when(best_d <= AUTO_MATCH_MAX, F.lit("auto"))
                 .otherwise(F.lit("review")))
    return j.select("query_id", "raw_description", "canonical_name",
                    F.when(decision == "new", F.lit(None).cast("string")).otherwise(best_m).alias("merchant_id"),
                    F.when(decision == "new", F.lit(None).cast("double")).otherwise(best_d).alias("distance"),
                    decision.alias("decision"), F.lit(rounds).alias("rounds"))
