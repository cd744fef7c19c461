"""Silver models: account dimension, categorised transaction fact, holders,
theses, reconciliation. Each is DataFrame(s) -> DataFrame."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import with_once
from ..functions.ids import bar_md5, packed, unpacked
from ..functions.money import MONEY
from ..functions.text import clean_description
from ..operators.membership import may_match
from ..operators.numbering import number_copies
from ..operators.rules import categorised, transfer_words

# --- B1 ----------------------------------------------------------------------

def dim_accounts(questrade_snapshots: DataFrame, bank_statements: DataFrame,
                 cc_statements: DataFrame, normalization: DataFrame) -> DataFrame:
    null_s = F.lit(None).cast("string")
    q = questrade_snapshots.select(F.col("account_number").alias("account_id"),
                                   null_s.alias("holder"),
                                   F.lit("questrade").alias("source_system"),
                                   F.lit("investment").alias("account_kind"))
    b = bank_statements.select(F.col("account_number").alias("account_id"), "holder",
                               F.lit("bank").alias("source_system"),
                               F.lit("bank").alias("account_kind"))
    c = cc_statements.select(F.col("card_number_last4").alias("account_id"), "holder",
                             F.lit("credit_card").alias("source_system"),
                             F.lit("credit_card").alias("account_kind"))
    # One row per (account, source); holder = a non-null value (max is the
    # deterministic stand-in for any_value). DISTINCT first: it hashes, while
    # a maximum of texts sorts all the rows that it is given.
    deduped = (q.unionByName(b).unionByName(c).distinct()
                .groupBy("account_id", "source_system")
                .agg(F.max("holder").alias("holder"),
                     F.max("account_kind").alias("account_kind")))
    # The normalisation seed is joined without a hint: Spark's size estimate
    # (and AQE's runtime one) turns it into a broadcast when it is small.
    n = normalization.select(
        F.col("account_id").alias("n_account_id"), "friendly_name", "inversion_factor",
        "is_active", "expected_frequency", "start_date")
    j = deduped.join(n, deduped.account_id == n.n_account_id, "left")
    return j.select(
        "account_id", "holder", "source_system",
        null_s.alias("account_subtype"),
        "account_kind",
        F.coalesce("friendly_name", "account_id").alias("friendly_name"),
        F.coalesce(F.col("inversion_factor"), F.lit(1)).cast("int").alias("inversion_factor"),
        F.coalesce(F.col("is_active"), F.lit(True)).alias("is_active"),
        F.coalesce(F.col("expected_frequency"), F.lit("monthly")).alias("expected_frequency"),
        F.col("start_date"),
    )


# --- B3 / B4 / B5 / B6 ---------------------------------------------------------

# Hashes travel packed between the shuffles, and ids are worked out behind the
# last one: both are long texts that do not compress.

def _numbered(lines: DataFrame, headers: DataFrame, header_keys: dict[str, str], partition_cols: list[str],
              order_cols: list[str], account: str, overrides: DataFrame | None = None) -> DataFrame:
    """Lines with their header's holder and copy number.

    Copies have equal columns of their own, whatever their header. So only lines whose hash of these comes again are
    shuffled for their number; any other line is the only one of its group, once per copy of its header. With
    ``overrides`` the lines also get their ``OVERRIDE_COLUMNS``; the lines that may have one go with those that come
    again, so that the lines meet their headers once and not once more for each side of a split behind that."""
    sha = F.col("statement_sha256")
    h = headers.select(packed(F.col("sha256")).alias("h_sha"), *[F.col(c).alias("h_" + c) for c in header_keys], "holder")
    on = sha == F.col("h_sha")
    for header, line in header_keys.items():
        on &= F.col(line) == F.col("h_" + header)
    # Copies of a header are counted where the join deals them.
    at = [c for c in h.columns if c != "holder"]
    h = h.repartition(*at).groupBy(*h.columns).agg(F.count(F.lit(1)).alias("h_times"))

    key = F.xxhash64(*[c for c in partition_cols if c != "holder"])
    again = lines.groupBy(key.alias("_key")).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1).select("_key")
    marked = may_match(lines, key, again)
    apart = F.col("_may")
    if overrides is not None:
        marked = may_match(marked, bar_md5(sha, F.col(account), F.col("txn_date"), F.col("amount")), overrides.select("stable_id"), "_may_o")
        apart |= F.col("_may_o")
    times = F.coalesce("h_times", F.lit(1).cast("bigint"))

    def with_header(rows: DataFrame) -> DataFrame:
        return rows.withColumn("statement_sha256", packed(sha)).join(h, on, "left")

    # Counted packed, as the join has dealt the rows by that column.
    several = number_copies(with_header(marked.filter(apart)), partition_cols, order_cols,
                            rewrite={"statement_sha256": unpacked(sha)}, times=times)
    single = with_header(marked.filter(~apart)).withColumn("statement_sha256", unpacked(sha)).select(
        *partition_cols, *order_cols, F.explode(F.sequence(F.lit(1).cast("bigint"), times)).alias("dup_seq"))
    if overrides is not None:
        several = _overridden(several, bar_md5(sha, F.col(account), F.col("txn_date"), F.col("amount")), overrides)
        single = single.withColumns(_no_override())
    return single.unionByName(several)


def txn_bank_numbered(bank_transactions: DataFrame, bank_statements: DataFrame, overrides: DataFrame | None = None) -> DataFrame:
    return _numbered(bank_transactions, bank_statements, {"account_number": "account_number"},
                     ["holder", "account_number", "txn_date", "amount", "raw_description", "running_balance"],
                     ["statement_sha256"], "account_number", overrides)


def txn_cc_numbered(cc_transactions: DataFrame, cc_statements: DataFrame, overrides: DataFrame | None = None) -> DataFrame:
    return _numbered(cc_transactions, cc_statements, {},
                     ["holder", "card_number", "txn_date", "amount", "raw_description"],
                     ["posting_date", "statement_sha256"], "card_number", overrides)


#: The category that a line's override names, and whether it has an override (which may name none).
OVERRIDE_COLUMNS = ["o_category", "overridden"]


def _no_override() -> dict[str, Column]:
    return {"o_category": F.lit(None).cast("string"), "overridden": F.lit(False)}


def _overridden(lines: DataFrame, stable_id: Column, overrides: DataFrame) -> DataFrame:
    """``lines`` with their ``OVERRIDE_COLUMNS``; a line with several overrides comes once for each."""
    o = overrides.select(F.col("stable_id").alias("o_stable_id"), F.col("category_id").alias("o_category"))
    return lines.join(o, stable_id == F.col("o_stable_id"), "left").withColumn(
        "overridden", F.col("o_stable_id").isNotNull()).drop("o_stable_id")


LINE_COLUMNS = ["holder", "account_id", "txn_date", "amount", "raw_description", "running_balance", "dup_seq",
                "source_system", "statement_sha256"]


def txn_lines(bank_numbered: DataFrame, cc_numbered: DataFrame) -> DataFrame:
    """All numbered lines (``LINE_COLUMNS``, the hash packed, and their override if they have it), from which ids and
    dimensions follow."""
    bank = bank_numbered.withColumnRenamed("account_number", "account_id").withColumn("source_system", F.lit("bank"))
    card = cc_numbered.withColumnRenamed("card_number", "account_id").withColumns(
        {"source_system": F.lit("credit_card"), "running_balance": F.lit(None)})
    columns = [*LINE_COLUMNS, *[c for c in OVERRIDE_COLUMNS if c in bank.columns]]
    both = bank.select(*columns).unionByName(card.select(*columns))
    return both.withColumn("statement_sha256", packed(F.col("statement_sha256")))


def _transaction_id(amount: str = "amount") -> Column:
    # A card line has no running balance, and null parts are left out.
    return bar_md5(F.col("holder"), F.col("account_id"), F.col("txn_date"), F.col(amount), F.col("raw_description"),
                   F.col("running_balance"), F.col("dup_seq"))


def _stable_id() -> Column:
    return bar_md5(unpacked(F.col("statement_sha256")), F.col("account_id"), F.col("txn_date"), F.col("amount"))


def txn_unified(lines: DataFrame) -> DataFrame:
    """The ids of the lines; columns beyond the lines' own are kept."""
    more = [c for c in lines.columns if c not in LINE_COLUMNS]
    return lines.select(
        _transaction_id().alias("transaction_id"), _stable_id().alias("stable_id"),
        "holder", "account_id", "txn_date", "amount", "raw_description", "source_system",
        unpacked(F.col("statement_sha256")).alias("statement_sha256"), *more)


# --- B7 / B8 / B9 / B10 ----------------------------------------------------------

def description_texts(descriptions: DataFrame) -> DataFrame:
    """The distinct clean texts (``text``) of ``descriptions`` (raw_description). Texts are cleaned once per
    description: a plain projection between two distincts would be moved down to every line."""
    cleaned = with_once(descriptions.select("raw_description"), clean_description(F.col("raw_description")), "text")
    return cleaned.select("text").distinct()


def text_rules(texts: DataFrame, transfer_rules: DataFrame, category_rules: DataFrame) -> DataFrame:
    """What the rules and the catch-all transfer words say of each distinct text (``text``, transfer_rule,
    first_category); texts of which they say nothing are left out."""
    worded = texts.select("text").distinct().filter(transfer_words(F.col("text"))).select(
        "text", F.lit(True).alias("transfer_rule"), F.lit(None).cast("string").alias("first_category"))
    return categorised(texts, transfer_rules, category_rules).unionByName(worded).groupBy("text").agg(
        F.max("transfer_rule").alias("transfer_rule"), F.max("first_category").alias("first_category"))


def description_rules(descriptions: DataFrame, transfer_rules: DataFrame, category_rules: DataFrame) -> DataFrame:
    """``text_rules`` of the clean texts of ``descriptions``."""
    return text_rules(description_texts(descriptions), transfer_rules, category_rules)


def with_categorisation_inputs(lines: DataFrame, found: DataFrame) -> DataFrame:
    """clean_description (B7), detected_transfer (B8) and rule_category.

    Rules and transfer words are matched once per distinct description
    (``found``, the ``description_rules`` of the lines) and come back by an
    equi-join; a null description has no rule and no verdict on transfers."""
    staged = lines.select("*", clean_description(F.col("raw_description")).alias("clean_description"))
    cd = F.col("clean_description")
    out = staged.join(found, cd == F.col("text"), "left")
    detected = F.when(cd.isNull(), F.lit(None).cast("boolean")).otherwise(
        F.coalesce(F.col("transfer_rule"), F.lit(False)))
    out = out.select(*[F.col(c) for c in staged.columns], detected.alias("detected_transfer"), "first_category")
    return out.select(*staged.columns, "detected_transfer", F.when(~F.col("detected_transfer"), F.col("first_category")).alias("rule_category"))


def with_accounts_and_overrides(lines: DataFrame, accounts: DataFrame, overrides: DataFrame) -> DataFrame:
    """The lines with their override's category and their account's columns. Only lines that may have an override
    are shuffled for it."""
    marked = may_match(lines, _stable_id(), overrides.select("stable_id"))
    asked = _overridden(marked.filter(F.col("_may")), _stable_id(), overrides)
    rest = marked.filter(~F.col("_may")).withColumns(_no_override())
    return with_accounts(asked.unionByName(rest).drop("_may"), accounts)


def with_accounts(lines: DataFrame, accounts: DataFrame) -> DataFrame:
    """The lines with their account's columns."""
    a = accounts.select(F.col("account_id").alias("a_account_id"), "friendly_name",
                        "account_kind", "inversion_factor")
    return lines.join(a, F.col("account_id") == F.col("a_account_id"), "left").drop("a_account_id")


FACT_ROW_COLUMNS = [*LINE_COLUMNS, "friendly_name", "account_kind", "inversion_factor", *OVERRIDE_COLUMNS, "detected_transfer",
                    "rule_category", "m_merchant_id", "m_category"]


def fact_rows(staged: DataFrame, merchants: DataFrame) -> DataFrame:
    """The rows of the fact with what it cannot be worked out of without a join (``FACT_ROW_COLUMNS``).
    ``staged``: lines with overrides, accounts and the inputs of their category."""
    m = merchants.select(F.col("merchant_id").alias("m_merchant_id"),
                         F.col("canonical_name").alias("m_name"),
                         F.col("category_id").alias("m_category"))
    return staged.join(m, staged.clean_description == m.m_name, "left").select(*FACT_ROW_COLUMNS)


def _signed_amount() -> Column:
    # A factor of one or minus one, as all seeds have, needs no decimal product.
    amount, factor = F.col("amount"), F.col("inversion_factor")
    return (F.when(factor == 1, amount.cast(MONEY)).when(factor == -1, (-amount).cast(MONEY))
             .otherwise((amount * factor).cast(MONEY)))


def with_ids(rows: DataFrame) -> DataFrame:
    """The ``fact_rows`` with their ``transaction_id``, worked out once a row however often it is asked for."""
    return with_once(rows, _transaction_id(), "transaction_id")


def fact_measures(rows: DataFrame) -> tuple[DataFrame, Column]:
    """(account_id, txn_date, amount, clean_description) of each of the ``fact_rows`` with what its id is made of, and
    the id: who needs few ids can drop the other rows before they are worked out."""
    parts = ["holder", "raw_description", "running_balance", "dup_seq"]
    return rows.select("account_id", "txn_date", _signed_amount().alias("amount"), F.col("amount").alias("line_amount"),
                       clean_description(F.col("raw_description")).alias("clean_description"), *parts), _transaction_id("line_amount")


def fact_transactions(rows: DataFrame, *more: str) -> DataFrame:
    """The fact of its ``fact_rows``, which may have their ids already; columns of the rows named in ``more`` are kept."""
    merchant_cat = F.nullif(F.col("m_category"), F.lit("uncategorised"))
    category = (F.when(F.col("o_category").isNotNull(), F.col("o_category"))
                 .when(F.col("detected_transfer"), F.lit("transfer"))
                 .when(merchant_cat.isNotNull(), F.col("m_category"))
                 .when(F.col("rule_category").isNotNull(), F.col("rule_category"))
                 .otherwise(F.lit("uncategorised")))
    source = (F.when(F.col("o_category").isNotNull(), F.lit("override"))
               .when(F.col("detected_transfer"), F.lit("transfer-detect"))
               .when(merchant_cat.isNotNull(), F.lit("merchant"))
               .when(F.col("rule_category").isNotNull(), F.lit("rule"))
               .otherwise(F.lit("default")))
    is_transfer = (F.coalesce(F.col("o_category") == "transfer", F.lit(False))
                   | F.coalesce(F.col("detected_transfer"), F.lit(False)))
    return rows.select(
        F.col("transaction_id") if "transaction_id" in rows.columns else _transaction_id().alias("transaction_id"),
        _stable_id().alias("stable_id"), "holder", "account_id",
        F.col("friendly_name").alias("account_name"),
        "account_kind", "txn_date",
        _signed_amount().alias("amount"),
        "raw_description", clean_description(F.col("raw_description")).alias("clean_description"),
        F.col("m_merchant_id").alias("merchant_id"),
        "source_system",
        F.date_format("txn_date", "EEEE").alias("day_of_week_name"),
        F.coalesce(F.dayofweek("txn_date").isin(1, 7), F.lit(False)).alias("is_weekend"),
        category.alias("category_id"),
        source.alias("category_source"),
        is_transfer.alias("is_transfer"),
        unpacked(F.col("statement_sha256")).alias("statement_sha256"),
        *more,
    )


# --- B15 / B16 / B17 -------------------------------------------------------------

def review_unmapped_holders(bank_statements: DataFrame, cc_statements: DataFrame,
                            holders: DataFrame) -> DataFrame:
    all_holders = (bank_statements.select("holder", F.lit("bank").alias("source"))
                   .union(cc_statements.select("holder", F.lit("cc").alias("source")))
                   .distinct())
    known = holders.select(F.col("holder_raw")).filter(F.col("holder_raw").isNotNull()).distinct()
    # left join + IS NULL: a NULL holder never equals a seed row, so it stays.
    unmapped = all_holders.join(known, all_holders.holder == known.holder_raw, "left_anti")
    # Each holder has at most two rows here (bank, cc), so the per-holder
    # window is tiny whatever the data size.
    return unmapped.select(
        F.col("holder").alias("holder_raw"),
        "source",
        F.count(F.lit(1)).over(Window.partitionBy("holder")).alias("variant_appearances"),
    )


def investment_theses(theses: DataFrame, as_of: _dt.date) -> DataFrame:
    today = F.lit(as_of.isoformat()).cast("date")
    horizon_days = F.col("horizon_months") * 30
    return theses.select(
        "thesis_id", "ticker", "status", "opened", "closed", "price_at_open", "buy_threshold",
        "sell_threshold", "stop_loss", "confidence", "horizon_months", "expected_return_pct",
        F.datediff(today, F.col("opened")).cast("bigint").alias("days_open"),
        horizon_days.alias("horizon_days"),
        (today >= F.date_add(F.col("opened"), horizon_days)).alias("horizon_reached"),
        (~F.col("status").isin("exited", "invalidated")).alias("is_active"),
        "dependencies", "invalidation_conditions", "decisions", "outcome",
        "source_file", "ingested_at",
    )


def reconciliation_gaps(csv_raw: DataFrame, fact: DataFrame) -> DataFrame:
    csv_months = (csv_raw.groupBy("account_hint", F.trunc("row_date", "month").alias("month"))
                  .agg(F.count(F.lit(1)).alias("csv_row_count")))
    pdf_months = (fact.filter(F.col("source_system").isin("bank", "credit_card"))
                  .select(F.col("account_id").alias("p_account"),
                          F.trunc("txn_date", "month").alias("p_month"))
                  .filter(F.col("p_account").isNotNull() & F.col("p_month").isNotNull())
                  .distinct())
    gaps = csv_months.join(pdf_months, (csv_months.account_hint == pdf_months.p_account)
                           & (csv_months.month == pdf_months.p_month), "left_anti")
    return gaps.select("account_hint", "month", "csv_row_count",
                       F.lit("missing_pdf").alias("gap_reason"))
