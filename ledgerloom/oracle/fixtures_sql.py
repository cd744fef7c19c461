"""The fixture derivation of ``sources.fixtures`` written again in DuckDB SQL.

Importing this module registers the CTEs. The seed values are shared with
the Spark side (they are data, not logic); every rule is re-stated in SQL.
"""

from __future__ import annotations

from ..sources.fixtures import (CARD_PAYMENT_TEXT, CATEGORIES, CATEGORY_RULES, DESCRIPTION_TEMPLATES,
                                EXTRA_MERCHANTS, FIXTURE_LANDED_AT, FIXTURE_PARSED_AT,
                                MERCHANT_CATEGORY_BY_LENGTH, QUERY_WEIGHTS, REVERSAL_TEXT, THESIS_STATUSES,
                                TRANSFER_RULES)
from .sqlkit import cents, cte, money, mon, sql_list, sql_values

NULL_MONEY = "CAST(NULL AS DECIMAL(18,2))"

cte("bank_src", f"""
SELECT o.o_orderkey, o.o_custkey, c.c_mktsegment,
       CAST(o.o_orderdate AS DATE) AS d,
       {mon('o.o_orderdate')} AS mon,
       {cents('o.o_totalprice')} AS tc,
       CASE WHEN o.o_orderstatus = 'O' THEN {cents('o.o_totalprice')}
            ELSE -(({cents('o.o_totalprice')} // 100)
                   * (CASE WHEN o.o_orderkey % 503 = 7 THEN 60 ELSE 1 END)) END AS cents,
       'A' || CAST(o.o_custkey AS VARCHAR) AS acct,
       md5('bank|' || CAST(o.o_custkey AS VARCHAR) || '|' || strftime({mon('o.o_orderdate')}, '%Y-%m-%d')) AS sha,
       CASE WHEN o.o_orderkey % 16 = 15 THEN p.p_name
            ELSE {sql_list(DESCRIPTION_TEMPLATES)}[CAST(o.o_orderkey % 16 + 1 AS INTEGER)] END AS descr,
       CASE WHEN c.c_custkey % 50 = 49 THEN NULL ELSE c.c_name END AS holder
FROM orders o
JOIN customer c ON o.o_custkey = c.c_custkey
LEFT JOIN part p ON p.p_partkey = o.o_orderkey % (SELECT max(p_partkey) + 1 FROM part)
""")

cte("bank_statements", f"""
SELECT sha AS sha256, 'local' AS source_type, sha AS source_id, max(holder) AS holder,
       max(c_mktsegment) AS bank, 'chequing' AS product, 'chequing' AS account_type,
       acct AS account_number, CAST(NULL AS VARCHAR) AS branch_name,
       CAST(NULL AS VARCHAR) AS transit_number, CAST(NULL AS VARCHAR) AS plan_name,
       mon AS period_start, last_day(mon) AS period_end,
       {NULL_MONEY} AS opening_balance, {NULL_MONEY} AS total_deducted, {NULL_MONEY} AS total_added,
       CASE WHEN o_custkey % 40 = 39 THEN {NULL_MONEY} ELSE {money('sum(tc)')} END AS closing_balance,
       CAST([] AS VARCHAR[]) AS validation_issues,
       TIMESTAMP '{FIXTURE_PARSED_AT}' AS parsed_at
FROM bank_src
GROUP BY sha, acct, mon, o_custkey
""", ("bank_src",))

_BANK_LINE = f"sha AS statement_sha256, acct AS account_number, d AS txn_date, {money('cents')} AS amount, descr AS raw_description, {money('tc')} AS running_balance"
cte("bank_transactions", f"""
SELECT {_BANK_LINE} FROM bank_src
UNION ALL
SELECT {_BANK_LINE} FROM bank_src WHERE o_orderkey % 97 = 0
UNION ALL
SELECT sha, acct, d + CAST(o_orderkey % 10 AS INTEGER), {money('-cents')}, '{REVERSAL_TEXT}', {money('0')}
FROM bank_src WHERE o_orderkey % 31 = 2
""", ("bank_src",))

cte("cc_src", f"""
SELECT u.*, 'V' || CAST(custkey AS VARCHAR) AS card,
       md5('cc|' || CAST(custkey AS VARCHAR) || '|' || strftime(mon, '%Y-%m-%d')) AS sha
FROM (
  SELECT o.o_custkey AS custkey, CAST(l.l_shipdate AS DATE) AS txn_date,
         CAST(l.l_shipdate AS DATE) + 2 AS posting_date,
         {money(cents('l.l_extendedprice') + ' // 100')} AS amount,
         p.p_name AS raw_description, {mon('l.l_shipdate')} AS mon
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN part p ON l.l_partkey = p.p_partkey
  UNION ALL
  SELECT o_custkey, d + CAST(o_orderkey % 13 AS INTEGER), d + CAST(o_orderkey % 13 AS INTEGER),
         {money('-(-cents + (o_orderkey % 9 - 4) * 2)')}, '{CARD_PAYMENT_TEXT}', mon
  FROM bank_src
  WHERE o_orderkey % 12 = 1 AND cents < 0
) u
""", ("bank_src",))

cte("cc_transactions", f"""
SELECT sha AS statement_sha256, card AS card_number, txn_date, posting_date, amount, raw_description,
       CAST(NULL AS VARCHAR) AS original_currency, {NULL_MONEY} AS original_amount,
       CAST(NULL AS DOUBLE) AS exchange_rate
FROM cc_src
""", ("cc_src",))

cte("cc_statements", f"""
SELECT sha AS sha256, 'local' AS source_type, sha AS source_id,
       max(CASE WHEN custkey % 50 = 48 THEN NULL
                ELSE 'Customer#' || lpad(CAST(custkey AS VARCHAR), 9, '0') END) AS holder,
       'cardbank' AS bank, 'visa' AS product,
       max(CASE WHEN custkey % 22 = 0 THEN card || 'X' ELSE card END) AS card_number_last4,
       last_day(max(mon)) AS statement_date, max(mon) AS period_start, last_day(max(mon)) AS period_end,
       last_day(max(mon)) + 21 AS payment_due_date,
       {NULL_MONEY} AS previous_balance, {NULL_MONEY} AS payments_and_credits,
       {NULL_MONEY} AS purchases_and_other_charges, {NULL_MONEY} AS new_installments,
       {NULL_MONEY} AS cash_advances, {NULL_MONEY} AS total_interest_charges, {NULL_MONEY} AS fees,
       CAST(sum(amount) AS DECIMAL(18,2)) AS total_balance,
       {NULL_MONEY} AS minimum_payment_due, {NULL_MONEY} AS credit_limit, {NULL_MONEY} AS available_credit,
       CAST([] AS VARCHAR[]) AS validation_issues, TIMESTAMP '{FIXTURE_PARSED_AT}' AS parsed_at,
       CAST(count(*) AS INTEGER) AS n_details
FROM cc_src
GROUP BY sha
""", ("cc_src",))

cte("banking_csv_raw", f"""
SELECT account_hint || '.csv' AS source_file, TIMESTAMP '{FIXTURE_LANDED_AT}' AS landed_at,
       row_date, description, amount, account_hint
FROM (
  SELECT acct AS account_hint, d AS row_date, descr AS description,
         CAST({money('tc')} AS DECIMAL(12,2)) AS amount
  FROM bank_src
  UNION ALL
  SELECT 'A' || CAST(user_id AS VARCHAR), CAST(ts AS DATE), event_type,
         CAST({money(cents('value'))} AS DECIMAL(12,2))
  FROM events
) u
""", ("bank_src",))

cte("questrade_positions", """
SELECT 'Q' || CAST(l_suppkey AS VARCHAR) AS account_number,
       strftime(l_shipdate, '%Y-%m-%d') AS snapshot_date,
       'SYM' || CAST(l_partkey AS VARCHAR) AS symbol, l_partkey AS symbol_id,
       'lot ' || CAST(l_orderkey AS VARCHAR) AS description, 'CAD' AS currency,
       l_quantity AS quantity, l_extendedprice / l_quantity * (1 + l_tax) AS current_price,
       l_extendedprice / l_quantity AS average_entry_price,
       l_extendedprice * (1 + l_tax) AS current_market_value,
       l_extendedprice AS book_cost, l_extendedprice * l_tax AS open_pnl,
       l_shipdate AS fetched_at
FROM lineitem
""")

cte("questrade_snapshots", """
SELECT account_number, CAST(snapshot_date AS DATE) AS snapshot_date, symbol, symbol_id, description,
       currency, quantity, current_price, average_entry_price, current_market_value AS market_value,
       book_cost, open_pnl, fetched_at
FROM questrade_positions
""", ("questrade_positions",))

# --- seeds ---------------------------------------------------------------------
cte("dim_category_rules", f"""
SELECT rule_id, category_id, pattern, CAST(priority AS INTEGER) AS priority
FROM (VALUES {sql_values(CATEGORY_RULES)}) t(rule_id, category_id, pattern, priority)
""")

cte("dim_transfer_rules", f"""
SELECT * FROM (VALUES {sql_values(TRANSFER_RULES)}) t(rule_id, pattern, direction, notes)
""")

cte("dim_categories", f"""
SELECT category_id, category_name, CAST(parent_category_id AS VARCHAR) AS parent_category_id
FROM (VALUES {sql_values(CATEGORIES)}) t(category_id, category_name, parent_category_id)
""")

cte("dim_account_normalization", """
SELECT 'A' || CAST(c_custkey AS VARCHAR) AS account_id, 'Chequing ' || CAST(c_custkey AS VARCHAR) AS friendly_name,
       1 AS inversion_factor, c_custkey % 11 <> 0 AS is_active, 'monthly' AS expected_frequency,
       DATE '1995-01-01' + CAST(c_custkey % 1000 AS INTEGER) AS start_date
FROM customer WHERE c_custkey % 5 <> 4
UNION ALL
SELECT 'V' || CAST(c_custkey AS VARCHAR), 'Card ' || CAST(c_custkey AS VARCHAR),
       -1, c_custkey % 11 <> 0, 'monthly', DATE '1995-01-01' + CAST(c_custkey % 1000 AS INTEGER)
FROM customer WHERE c_custkey % 2 = 0
""")

cte("dim_holders", """
SELECT c_name AS holder_raw, 'own' || CAST(c_custkey % 3 AS VARCHAR) AS owner
FROM customer WHERE c_custkey % 10 <> 7
""")

cte("dim_merchants", f"""
SELECT md5(canonical_name) AS merchant_id, canonical_name, category_id,
       CAST(NULL AS FLOAT[]) AS embedding,
       TIMESTAMP '{FIXTURE_PARSED_AT}' AS created_at, TIMESTAMP '{FIXTURE_PARSED_AT}' AS updated_at
FROM (
  SELECT DISTINCT lower(p_name) AS canonical_name,
         {sql_list(MERCHANT_CATEGORY_BY_LENGTH)}[CAST(length(p_name) % 4 + 1 AS INTEGER)] AS category_id
  FROM part
  UNION ALL
  SELECT * FROM (VALUES {sql_values(EXTRA_MERCHANTS)}) e(canonical_name, category_id)
) m
""")

cte("thesis_records", f"""
SELECT CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE 'T' || CAST(p_partkey AS VARCHAR) END AS thesis_id_fm,
       CASE WHEN p_partkey % 17 = 0 THEN NULL ELSE p_brand END AS ticker,
       CASE WHEN p_partkey % 5 = 4 THEN NULL
            ELSE {sql_list(THESIS_STATUSES)}[CAST(p_partkey % 5 + 1 AS INTEGER)] END AS status,
       DATE '1998-01-01' + CAST(p_partkey % 1000 AS INTEGER) AS opened,
       CAST(NULL AS DATE) AS closed,
       CAST(CAST(p_retailprice AS DECIMAL(12,4)) + CASE WHEN rep = 1 THEN 1 ELSE 0 END AS DECIMAL(12,4)) AS price_at_open,
       CAST(p_size AS INTEGER) AS horizon_months,
       'Investment Theses/T' || CAST(p_partkey AS VARCHAR) || '.md' AS source_file,
       p_partkey,
       CASE WHEN rep = 1 THEN TIMESTAMP '2001-12-15 00:00:00' ELSE TIMESTAMP '2001-12-01 00:00:00' END AS ingested_at
FROM part, (SELECT 0 AS rep UNION ALL SELECT 1) r
WHERE rep = 0 OR p_partkey % 7 = 0
""")

# --- vectors and the prior review queue -------------------------------------------

cte("merchant_vectors", f"""
SELECT 'M' || CAST(vec_id AS VARCHAR) AS merchant_id,
       'shop ' || translate(CAST(vec_id AS VARCHAR), '0123456789', 'abcdefghij') AS canonical_name,
       'uncategorised' AS category_id, CAST(embedding AS DOUBLE[]) AS vec
FROM embeddings WHERE vec_id % 5 = 0
""")

_W = "CASE e.vec_id % 5 " + " ".join(f"WHEN {k} THEN {v}" for k, v in QUERY_WEIGHTS.items()) + " END"
cte("query_vectors", f"""
SELECT CAST(e.vec_id AS VARCHAR) AS query_id,
       'shop ' || translate(CAST(e.vec_id AS VARCHAR), '0123456789', 'abcdefghij') AS raw_description,
       list_transform(range(1, len(b.embedding) + 1),
                      lambda i: CAST(b.embedding[i] AS DOUBLE) + ({_W}) * CAST(e.embedding[i] AS DOUBLE)) AS vec
FROM embeddings e JOIN embeddings b ON b.vec_id = e.vec_id - e.vec_id % 5
WHERE e.vec_id % 5 <> 0
""")

cte("prior_review_queue", """
SELECT DISTINCT raw_description FROM cc_transactions WHERE length(raw_description) % 7 = 0
""", ("cc_transactions",))
