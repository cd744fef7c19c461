"""Registered silver (B) and gold (C) queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from .registry import from_model, register

# --- B ----------------------------------------------------------------------------------
from_model("dim_accounts", columns=[
    "account_id", "holder", "source_system", "account_subtype", "account_kind", "friendly_name",
    "inversion_factor", "is_active", "expected_frequency", "start_date"])

from_model("dim_merchants", columns=[
    "merchant_id", "canonical_name", "category_id", "created_at", "updated_at"])

_BANK_NUM = ["holder", "account_number", "txn_date", "amount", "raw_description", "running_balance",
             "statement_sha256", "dup_seq"]
register("txn_bank_numbered", _BANK_NUM, f"SELECT {', '.join(_BANK_NUM)} FROM bank_numbered",
         ("bank_numbered",))(lambda lake: lake.txn_bank_numbered)

_CC_NUM = ["holder", "card_number", "txn_date", "amount", "raw_description", "posting_date",
           "statement_sha256", "dup_seq"]
register("txn_cc_numbered", _CC_NUM, f"SELECT {', '.join(_CC_NUM)} FROM cc_numbered",
         ("cc_numbered",))(lambda lake: lake.txn_cc_numbered)

register("txn_ids", ["transaction_id", "stable_id", "source_system"],
         "SELECT transaction_id, stable_id, source_system FROM unified", ("unified",))(
    lambda lake: lake.txn_unified)

_UNI = ["transaction_id", "stable_id", "holder", "account_id", "txn_date", "amount", "raw_description",
        "source_system", "statement_sha256"]
register("txn_unified", _UNI, f"SELECT {', '.join(_UNI)} FROM unified", ("unified",))(
    lambda lake: lake.txn_unified)

register("clean_description", ["transaction_id", "raw_description", "clean_description"],
         "SELECT transaction_id, raw_description, clean_description FROM staged", ("staged",))(
    lambda lake: lake.txn_staged)

register("transfer_detect", ["transaction_id", "clean_description", "detected_transfer"],
         "SELECT transaction_id, clean_description, detected_transfer FROM staged", ("staged",))(
    lambda lake: lake.txn_staged)

register("rule_match", ["transaction_id", "rule_category"],
         "SELECT transaction_id, rule_category FROM rule_matches", ("rule_matches",))(
    lambda lake: lake.txn_staged.filter(F.col("rule_category").isNotNull()))

_FACT = ["transaction_id", "stable_id", "holder", "account_id", "account_name", "account_kind", "txn_date",
         "amount", "raw_description", "clean_description", "merchant_id", "source_system", "day_of_week_name",
         "is_weekend", "category_id", "category_source", "is_transfer", "statement_sha256"]
from_model("fact_transactions", columns=_FACT)
from_model("transfer_candidates", columns=["debit_txn_id", "credit_txn_id", "amount", "day_gap", "amount_gap"])
from_model("transfer_matches", columns=["debit_txn_id", "credit_txn_id", "amount"])
from_model("one_way_transfers", columns=["debit_txn_id", "credit_txn_id", "amount"])
from_model("fact_transfers", columns=["transaction_id", "transfer_type", "matched_transaction_id"])
from_model("review_unmapped_holders", columns=["holder_raw", "source", "variant_appearances"])
from_model("investment_theses", columns=[
    "thesis_id", "ticker", "status", "opened", "closed", "price_at_open", "buy_threshold", "sell_threshold",
    "stop_loss", "confidence", "horizon_months", "expected_return_pct", "days_open", "horizon_days",
    "horizon_reached", "is_active", "dependencies", "invalidation_conditions", "decisions", "outcome",
    "source_file", "ingested_at"])
from_model("reconciliation_gaps", columns=["account_hint", "month", "csv_row_count", "gap_reason"])

# --- C ------------------------------------------------------------------------------------
from_model("semantic_transactions", columns=[
    "transaction_id", "transaction_date", "day_of_week_name", "is_weekend", "amount", "raw_description",
    "clean_description", "merchant_name", "category_name", "parent_category_name", "account_name",
    "account_kind", "is_transfer", "source_system"])
from_model("spending_by_category", columns=["month", "category_id", "spend", "txn_count"])
from_model("cash_flow_monthly", columns=["month", "total_income", "total_spending", "net_savings", "savings_rate"])
from_model("disposable_income", columns=["month", "total_income", "essential_spending", "disposable_income"])
from_model("data_completeness", columns=["month", "friendly_name", "account_kind", "txn_count",
                                         "statement_count", "status"])
_ALERT = ["alert_type", "txn_date", "amount", "account_name", "raw_description", "alert_message"]
from_model("duplicate_alerts", columns=_ALERT)
from_model("outlier_alerts", columns=_ALERT)
from_model("quality_alerts", columns=_ALERT)
from_model("transfer_review_queue", columns=["transaction_date", "amount", "account_name", "merchant_name",
                                             "raw_description", "category_name", "source_system"])
from_model("net_worth_daily", columns=["as_of_date", "total_assets", "total_liabilities", "net_worth",
                                       "n_accounts_contributing"])
