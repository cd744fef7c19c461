"""Plan guards: no registered query may plan a nested-loop or cartesian join
or a row-at-a-time Python UDF; Arrow-batched Python appears only in the
vector operators."""

import pytest

from ledgerloom import registry
from ledgerloom.plans.context import Lake
from plan_review import plan_text, summary
from testpaths import SMALL

VECTOR_KEYS = {"nearest_merchant", "merchant_triage", "merchant_new", "merchant_review_queue"}
SKIP = {"csv_inbox_incremental"}  # streams to a sink; its batch twin is checked


@pytest.mark.parametrize("name", sorted(set(registry.queries()) - SKIP))
def test_plan_has_no_pair_explosion(spark, name):
    text = plan_text(registry.queries()[name](spark, SMALL))
    s = summary(text)
    assert s["nested_loop"] == 0 and s["cartesian"] == 0, name
    assert "BatchEvalPython" not in text, name
    if name not in VECTOR_KEYS:
        assert s["python"] == 0, name


@pytest.mark.parametrize("name", ["transfer_candidates", "transfer_matches", "fact_transfers"])
def test_lazy_transfer_plans_have_no_pair_explosion(spark, name):
    """The registered keys read written tables; here the joins themselves are in the plan."""
    s = summary(plan_text(getattr(Lake(spark, SMALL, materialize=False), name)))
    assert s["exchanges"] > 0
    assert s["nested_loop"] == 0 and s["cartesian"] == 0
