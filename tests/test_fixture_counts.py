"""Counts at sf0.01 over the whole tables (all line items, customers, months and
parts), derived with DuckDB; FIXTURES.md §2.5 has those of the earlier, smaller fixture."""

import pytest
from pyspark.sql import functions as F

MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def lake(spark):
    from ledgerloom.plans.context import Lake
    return Lake(spark, MID)


def test_bronze_counts(lake):
    assert lake.bank_statements.count() == 14060
    assert lake.bank_transactions.count() == 15639
    assert lake.cc_statements.count() == 46925
    assert lake.cc_transactions.count() == 60855


def test_fact_counts(lake):
    f = lake.fact_table
    assert f.count() == 76494 == f.select("transaction_id").distinct().count()
    assert f.filter(F.col("amount").isNull()).count() == 2815
    assert f.select("stable_id").distinct().count() == 76339
    src = {r.category_source: r["count"] for r in f.groupBy("category_source").count().collect()}
    assert src == {"default": 16334, "merchant": 47706, "override": 274, "rule": 7546, "transfer-detect": 4634}


def test_transfer_and_gold_counts(lake):
    assert lake.transfer_candidates.count() == 1051
    assert lake.transfer_matches.count() == 1021
    assert lake.one_way_transfers.count() == 1198
    assert lake.fact_transfers.count() == 3240
    assert lake.spending_by_category.count() == 853
    assert lake.cash_flow_monthly.count() == 83 == lake.disposable_income.count()
    assert lake.transfer_review_queue.count() == 4077
    dc = lake.data_completeness
    assert dc.count() == 127130 and dc.filter(F.col("status") == "PRESENT").count() == 26289
    assert lake.duplicate_alerts.count() == 310 and lake.outlier_alerts.count() == 4254
    assert lake.reconciliation_gaps.count() == 150
    assert lake.review_unmapped_holders.count() == 302
    assert lake.net_worth_daily.count() == 2528


def test_triage_counts(lake):
    d = {r.decision: r["count"] for r in lake.merchant_triage.groupBy("decision").count().collect()}
    assert d == {"auto": 214, "review": 87, "new": 99}
