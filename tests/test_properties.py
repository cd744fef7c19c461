"""Properties of the silver/gold models on the smallest fixture."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from testpaths import SMALL


@pytest.fixture(scope="module")
def lake(spark):
    from ledgerloom.plans.context import Lake
    return Lake(spark, SMALL)


def test_fact_transfers_symmetric_and_once_per_side(lake):
    ft = lake.fact_transfers.collect()
    pairs = {(r.transaction_id, r.matched_transaction_id) for r in ft if r.matched_transaction_id}
    assert pairs and all((b, a) in pairs for a, b in pairs)
    ids = [r.transaction_id for r in ft]
    assert len(ids) == len(set(ids))
    amounts = {r.transaction_id: r.amount for r in lake.fact_table.collect()}
    for a, b in pairs:
        assert amounts[a] * amounts[b] < 0 and abs(amounts[a] + amounts[b]) <= Decimal("0.05")


def test_category_source_agrees_with_category(lake):
    f = lake.fact_table
    rules = {r.category_id for r in lake.dim_category_rules.collect()}
    rows = f.select("category_id", "category_source", "is_transfer").distinct().collect()
    for r in rows:
        if r.category_source == "transfer-detect":
            assert r.category_id == "transfer" and r.is_transfer
        elif r.category_source == "default":
            assert r.category_id == "uncategorised"
        elif r.category_source == "rule":
            assert r.category_id in rules and r.category_id != "transfer"
        elif r.category_source == "override":
            assert r.category_id in {"travel", "transfer"}
    assert {r.category_source for r in rows} == {"override", "transfer-detect", "merchant", "rule", "default"}


def test_spending_totals_equal_fact(lake):
    f = lake.fact_table
    want = f.filter((F.col("amount") < 0) & ~F.col("is_transfer")).agg(F.sum(-F.col("amount"))).first()[0]
    got = lake.spending_by_category.agg(F.sum("spend")).first()[0]
    assert got == want


def test_net_worth_one_row_per_day(lake):
    nw = lake.net_worth_daily
    assert nw.count() == nw.select("as_of_date").distinct().count() > 0
    assert nw.filter(F.col("net_worth").isNull()).count() == 0
