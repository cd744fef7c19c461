"""Ingest keys (A1–A15) as DuckDB SQL over the flat fixture tables."""

from __future__ import annotations

from ..sources.fixtures import FIXTURE_LANDED_AT, FIXTURE_PARSED_AT
from ..sources.statements import PRIOR_CUTOFF
from . import models_sql  # noqa: F401
from .sqlkit import cte, money, with_name

_EMPTY = "CAST([] AS VARCHAR[])"

cte("prior_shas", f"""
SELECT sha256 FROM bank_statements WHERE period_start < DATE '{PRIOR_CUTOFF}'
UNION SELECT sha256 FROM cc_statements WHERE period_start < DATE '{PRIOR_CUTOFF}'
""", ("bank_statements", "cc_statements"))

cte("bank_docs", f"""
SELECT s.*,
       CASE WHEN k % 41 = 0 OR k % 30 = 0 THEN 'multi' ELSE 'bank' END AS kind,
       CASE WHEN k % 41 = 0 THEN 0 ELSE 1 END AS n_acc,
       CASE WHEN k % 37 = 0 THEN ['balance_mismatch'] ELSE {_EMPTY} END AS issues,
       CASE WHEN k % 23 = 0 THEN '' ELSE account_number END AS h_account_number
FROM (SELECT *, CAST(regexp_extract(account_number, '(\\d+)', 1) AS BIGINT) AS k FROM bank_statements) s
""", ("bank_statements",))

cte("cc_docs", f"""
SELECT s.*, 'cc' AS kind, 1 AS n_acc,
       CASE WHEN k % 37 = 0 THEN ['balance_mismatch'] ELSE {_EMPTY} END AS issues
FROM (SELECT *, CAST(regexp_extract(card_number_last4, '(\\d+)', 1) AS BIGINT) AS k FROM cc_statements) s
""", ("cc_statements",))

cte("received_docs", f"""
SELECT sha256, source_id, 0 AS source_order, kind, n_acc, issues, holder, bank, product,
       h_account_number AS acct, period_start, period_end FROM bank_docs
UNION ALL
SELECT sha256, source_id || '#2', 1, kind, n_acc, issues, holder, bank, product, h_account_number,
       period_start, period_end FROM bank_docs WHERE k % 19 = 0
UNION ALL
SELECT sha256, source_id, 0, kind, n_acc, issues, holder, bank, product, card_number_last4,
       period_start, period_end FROM cc_docs
UNION ALL
SELECT sha256, source_id || '#2', 1, kind, n_acc, issues, holder, bank, product, card_number_last4,
       period_start, period_end FROM cc_docs WHERE k % 19 = 0
UNION ALL
SELECT sha256(html), 'page-' || CAST(page_id AS VARCHAR), 0, NULL, NULL, {_EMPTY}, NULL, NULL, NULL, NULL,
       NULL, NULL FROM pages
""", ("bank_docs", "cc_docs"))

cte("ingest_flags", """
SELECT r.*,
       r.sha256 IN (SELECT sha256 FROM prior_shas) AS in_prior,
       r.kind = 'multi' AND r.n_acc = 0 AND r.sha256 NOT IN (SELECT sha256 FROM prior_shas) AS empty_multi,
       r.kind IS NOT NULL AND r.source_order = 0 AND r.sha256 NOT IN (SELECT sha256 FROM prior_shas)
         AND NOT (r.kind = 'multi' AND r.n_acc = 0) AS is_new
FROM received_docs r
""", ("received_docs", "prior_shas"))

cte("new_shas", """
SELECT sha256 FROM ingest_flags WHERE is_new
""", ("ingest_flags",))

cte("statement_ingest_result", """
SELECT source_id,
       kind IS NOT NULL AND NOT coalesce(empty_multi, false) AS was_finance_doc,
       coalesce(is_new, false) AS was_new_row,
       CASE WHEN is_new THEN bank END AS bank,
       CASE WHEN is_new THEN concat_ws('_', bank, product) END AS bank_product,
       CASE WHEN is_new THEN holder END AS holder,
       CASE WHEN is_new THEN (CASE WHEN length(regexp_replace(acct, '[^0-9]', '', 'g')) >= 4
                                   THEN right(regexp_replace(acct, '[^0-9]', '', 'g'), 4) ELSE '' END) END AS last4,
       CASE WHEN is_new THEN period_start END AS period_start,
       CASE WHEN is_new THEN period_end END AS period_end,
       CASE WHEN kind IS NOT NULL THEN sha256 END AS sha256,
       CASE WHEN empty_multi THEN list_append(issues, 'multi_account_no_accounts')
            WHEN is_new THEN issues ELSE CAST([] AS VARCHAR[]) END AS validation_issues
FROM ingest_flags
""", ("ingest_flags",))

cte("statement_new_batch", """
SELECT sha256, 'local' AS source_type, source_id, kind, n_acc AS n_accounts FROM ingest_flags WHERE is_new
""", ("ingest_flags",))

cte("bronze_bank_statements_new", f"""
SELECT sha256, source_type, source_id, holder, bank, product, account_type, h_account_number AS account_number,
       branch_name, transit_number, plan_name, period_start, period_end, opening_balance, total_deducted,
       total_added, closing_balance, issues AS validation_issues, TIMESTAMP '{FIXTURE_PARSED_AT}' AS parsed_at
FROM bank_docs WHERE sha256 IN (SELECT sha256 FROM new_shas)
""", ("bank_docs", "new_shas"))

cte("bronze_bank_transactions_new", """
SELECT statement_sha256, account_number, txn_date, amount, raw_description, running_balance
FROM bank_transactions WHERE statement_sha256 IN (SELECT sha256 FROM new_shas)
""", ("bank_transactions", "new_shas"))

cte("bronze_cc_statements_new", f"""
SELECT sha256, source_type, source_id, holder, bank, product, card_number_last4, statement_date, period_start,
       period_end, payment_due_date, previous_balance, payments_and_credits, purchases_and_other_charges,
       new_installments, cash_advances, total_interest_charges, fees, total_balance, minimum_payment_due,
       credit_limit, available_credit, issues AS validation_issues,
       TIMESTAMP '{FIXTURE_PARSED_AT}' AS parsed_at, n_details
FROM cc_docs WHERE sha256 IN (SELECT sha256 FROM new_shas)
""", ("cc_docs", "new_shas"))

cte("bronze_cc_transactions_new", """
SELECT statement_sha256, card_number, txn_date, posting_date, amount, raw_description, original_currency,
       original_amount, exchange_rate
FROM cc_transactions WHERE statement_sha256 IN (SELECT sha256 FROM new_shas)
""", ("cc_transactions", "new_shas"))

cte("account_last4", """
SELECT account_id,
       CASE WHEN length(regexp_replace(account_id, '[^0-9]', '', 'g')) >= 4
            THEN right(regexp_replace(account_id, '[^0-9]', '', 'g'), 4) ELSE '' END AS last4
FROM (SELECT account_number AS account_id FROM bank_statements
      UNION SELECT card_number_last4 FROM cc_statements
      UNION SELECT card_number FROM cc_transactions) a
WHERE account_id IS NOT NULL
""", ("bank_statements", "cc_statements", "cc_transactions"))

cte("statement_owner_metadata", """
SELECT r.source_id,
       concat_ws(' ', coalesce(r.bank_product, 'statement'), strftime(r.period_end, '%Y-%m-%d')) AS title,
       coalesce(nullif(h.owner, ''), '_unowned') AS owner,
       coalesce(r.last4, '') AS last4
FROM statement_ingest_result r
LEFT JOIN (SELECT holder_raw, min(owner) AS owner FROM dim_holders WHERE holder_raw IS NOT NULL GROUP BY 1) h
  ON coalesce(r.holder, '') = h.holder_raw
WHERE r.was_finance_doc
""", ("statement_ingest_result", "dim_holders"))

cte("bronze_rebuild", """
SELECT status, count(*) AS documents FROM (
  SELECT CASE WHEN NOT was_finance_doc AND len(validation_issues) > 0 THEN 'failed_validation'
              WHEN NOT was_finance_doc THEN 'not_finance'
              WHEN NOT was_new_row THEN 'already_ingested'
              WHEN len(validation_issues) > 0 THEN 'ingested_with_issues'
              ELSE 'ingested' END AS status
  FROM statement_ingest_result) s
GROUP BY status
""", ("statement_ingest_result",))

cte("bronze_provenance", f"""
SELECT 'web/pages' AS source, TIMESTAMP '{FIXTURE_LANDED_AT}' AS ingested_at,
       CAST(NULL AS TIMESTAMP) AS source_timestamp, 'page_' || CAST(page_id AS VARCHAR) || '.html' AS filename,
       CAST(strlen(html) AS BIGINT) AS size_bytes, sha256(html) AS sha256, url
FROM pages
""")

cte("csv_expected", f"""
SELECT acct || '.csv' AS source_file, TIMESTAMP '{FIXTURE_LANDED_AT}' AS landed_at, d AS row_date,
       CASE WHEN o_orderkey % 20 = 6 THEN ltrim(concat(descr, ',', chr(10), '"ref" 6'))
            WHEN trim(coalesce(descr, '')) = '' THEN NULL ELSE trim(descr) END AS description,
       CAST({money('tc')} AS DECIMAL(12,2)) AS amount, acct AS account_hint
FROM bank_src
WHERE o_custkey % 4 <> 3 AND o_orderkey % 20 NOT IN (2, 3, 4, 5)
""", ("bank_src",))

cte("seed_tables", """
SELECT 'dim_account_normalization' AS seed, count(*) AS n_rows FROM dim_account_normalization
UNION ALL SELECT 'dim_holders', count(*) FROM dim_holders
UNION ALL SELECT 'dim_category_overrides', count(*) FROM dim_category_overrides
UNION ALL SELECT 'dim_category_rules', count(*) FROM dim_category_rules
UNION ALL SELECT 'dim_transfer_rules', count(*) FROM dim_transfer_rules
UNION ALL SELECT 'dim_categories', count(*) FROM dim_categories
""", ("dim_account_normalization", "dim_holders", "dim_category_overrides", "dim_category_rules",
      "dim_transfer_rules", "dim_categories"))

cte("seed_rejects", """
SELECT 'dim_account_normalization' AS seed, w.col0 AS field, w.col1 AS value, w.col2 AS reason
FROM customer, (VALUES ('inversion_factor', 'minus one', 'not int'), ('start_date', '1995-13-40', 'not date')) w
WHERE c_custkey % 13 = 0
""")

cte("rebuilt_failures", """
SELECT source_id, sha256, CASE WHEN sha256 LIKE 'a%' AND sha256 < 'a4' THEN 'unreadable record'
                               WHEN n_acc = 0 THEN 'multi_account_no_accounts' ELSE 'header without period_end' END AS reason
FROM received_docs
WHERE kind IS NOT NULL AND (n_acc = 0 OR sha256 >= 'a0' AND sha256 < 'a4' OR sha256 >= 'b0' AND sha256 < 'b4')
""", ("received_docs",))

cte("rebuilt_shas", """
SELECT DISTINCT sha256 FROM received_docs
WHERE kind IS NOT NULL AND source_id NOT IN (SELECT source_id FROM rebuilt_failures)
""", ("received_docs", "rebuilt_failures"))

for _table in ("bank_statements", "bank_transactions", "cc_statements", "cc_transactions"):
    with_name(f"rebuilt_{_table}", f"bronze_{_table}_new", "new_shas", "rebuilt_shas")
