"""Gold models."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.ids import packed, unpacked
from ..functions.money import MONEY
from ..operators.membership import may_match

# Display names of the essential spending categories.
ESSENTIAL_CATEGORY_NAMES = ["Groceries", "Rent / Mortgage", "Utilities"]
UNCATEGORISED_NAME = "Uncategorised"
REVIEW_MIN_ABS_AMOUNT = 5000
OUTLIER_MIN_ABS_AMOUNT = 100
OUTLIER_SIGMAS = 3


def _month(c: str):
    return F.trunc(F.col(c), "month")


# --- C1 ------------------------------------------------------------------------

def _named_categories(categories: DataFrame) -> DataFrame:
    """category_id -> (name, parent's name) — a self join of a small seed."""
    c = categories.select("category_id", "category_name", "parent_category_id")
    p = categories.select(F.col("category_id").alias("p_id"), F.col("category_name").alias("parent_name"))
    return (c.join(p, c.parent_category_id == p.p_id, "left")
             .select("category_id", "category_name", "parent_name"))


MARKS = ("_may_f", "_may_o")


def semantic_transactions(fact: DataFrame, merchants: DataFrame, categories: DataFrame,
                          transfers: DataFrame, overrides: DataFrame,
                          table: Callable[[str, DataFrame], DataFrame] = lambda name, df: df,
                          overridden: str | None = None,
                          derived: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> DataFrame:
    """Only rows that may be a transfer or have an override are shuffled for these. ``table`` writes what the fact
    meets: of a written table Spark knows the size, and where it is small the fact is not shuffled for it.
    ``overridden``: the column of ``fact`` that tells which rows have an override, if it has one. ``derived`` gives the
    fact's other columns to rows of ``fact`` and keeps ``MARKS``, where it holds but what they follow from and the id."""
    cats = _named_categories(categories)
    # Resolve category names on the (small) dimension side before touching
    # the fact, so the fact meets three joins instead of seven.
    m = (merchants.select(F.col("canonical_name").alias("m_name"), F.col("category_id").alias("m_cat"))
         .join(cats.select(F.col("category_id").alias("m_cat"), F.col("category_name").alias("m_cat_name"),
                           F.col("parent_name").alias("m_parent_name")), "m_cat", "left")
         .drop("m_cat"))
    m = table("semantic_merchants", m)
    o = (overrides.select(F.col("stable_id").alias("o_stable_id"), F.col("category_id").alias("o_cat"))
         .join(cats.select(F.col("category_id").alias("o_cat"), F.col("category_name").alias("o_cat_name"),
                           F.col("parent_name").alias("o_parent_name")), "o_cat", "left")
         .drop("o_cat"))
    o = table("semantic_overrides", o)
    f = table("semantic_transfers", transfers.select(packed(F.col("transaction_id")).alias("f_id"))
              .filter(F.col("f_id").isNotNull()).distinct())
    f_id, none = packed(F.col("transaction_id")), F.lit(None).cast("string")
    marked = may_match(fact, F.col("transaction_id"), f.select(unpacked(F.col("f_id")).alias("id")), "_may_f")
    if overridden is None:
        marked = may_match(marked, F.col("stable_id"), o.select("o_stable_id"), "_may_o")
    else:
        marked = marked.withColumn("_may_o", F.col(overridden))
    may = F.col("_may_f") | F.col("_may_o")
    asked = (derived(marked.filter(may)).join(f, f_id == f.f_id, "left").join(o, F.col("stable_id") == F.col("o_stable_id"), "left")
             .withColumn("_moved", F.col("f_id").isNotNull()).drop("f_id", "o_stable_id"))
    rest = derived(marked.filter(~may)).withColumns({"o_cat_name": none, "o_parent_name": none, "_moved": F.lit(False)})
    j = asked.unionByName(rest).join(m, F.col("clean_description") == F.col("m_name"), "left")
    return j.select(
        "transaction_id",
        F.col("txn_date").alias("transaction_date"),
        "day_of_week_name", "is_weekend", "amount", "raw_description", "clean_description",
        F.coalesce("m_name", "clean_description").alias("merchant_name"),
        F.coalesce("o_cat_name", "m_cat_name", F.lit(UNCATEGORISED_NAME)).alias("category_name"),
        F.coalesce("o_parent_name", "m_parent_name", F.lit(UNCATEGORISED_NAME)).alias("parent_category_name"),
        "account_name", "account_kind",
        F.col("_moved").alias("is_transfer"),
        "source_system",
    )


# --- C2 / C3 / C4 -------------------------------------------------------------------

def spending_by_category(fact: DataFrame) -> DataFrame:
    return (fact.filter((F.col("amount") < 0) & ~F.col("is_transfer"))
                .groupBy(_month("txn_date").alias("month"), "category_id")
                .agg(F.sum(-F.col("amount")).cast(MONEY).alias("spend"),
                     F.count(F.lit(1)).alias("txn_count")))


def _income(c):
    return F.sum(F.when(c > 0, c).otherwise(F.lit(0))).cast(MONEY)


def _spend(c, cond=None):
    test = (c < 0) if cond is None else ((c < 0) & cond)
    return F.sum(F.when(test, -c).otherwise(F.lit(0))).cast(MONEY)


def cash_flow_monthly(semantic: DataFrame) -> DataFrame:
    a = F.col("amount")
    g = (semantic.filter(~F.col("is_transfer"))
                 .groupBy(_month("transaction_date").alias("month"))
                 .agg(_income(a).alias("total_income"), _spend(a).alias("total_spending"),
                      F.sum(a).cast(MONEY).alias("net_savings")))
    # a plain DOUBLE division, as in the reference
    rate = F.when(F.col("total_income") > 0,
                  F.col("net_savings").cast("double") / F.col("total_income").cast("double"))
    return g.select("month", "total_income", "total_spending", "net_savings",
                    rate.cast("double").alias("savings_rate"))


def disposable_income(semantic: DataFrame) -> DataFrame:
    a = F.col("amount")
    g = (semantic.filter(~F.col("is_transfer"))
                 .groupBy(_month("transaction_date").alias("month"))
                 .agg(_income(a).alias("total_income"),
                      _spend(a, F.col("category_name").isin(*ESSENTIAL_CATEGORY_NAMES)).alias("essential_spending")))
    return g.select("month", "total_income", "essential_spending",
                    (F.col("total_income") - F.col("essential_spending")).cast(MONEY).alias("disposable_income"))


# --- C5 ---------------------------------------------------------------------------------

def data_completeness(accounts: DataFrame, fact: DataFrame, as_of: _dt.date) -> DataFrame:
    """Per active account, one row per month from its start month to the
    as-of month, with the month's transaction and statement counts.

    The month spine is generated per account (``explode(sequence)``), not by
    a months x accounts cross join."""
    max_month = F.trunc(F.lit(as_of.isoformat()).cast("date"), "month")
    start = F.trunc("start_date", "month")
    active = accounts.filter(F.col("is_active") & F.col("start_date").isNotNull())
    # The month list runs from the earliest start month to the as-of month,
    # and always holds the earliest start month itself (even when that lies
    # after the as-of month). The earliest start month is an uncorrelated
    # scalar subquery: evaluated once, no driver round trip, no cross join.
    first_month = active.select(F.min(start)).scalar()
    last_month = F.greatest(max_month, first_month)
    expected = active.select("account_id", "friendly_name", "account_kind",
                             F.explode(F.when(start <= last_month,
                                              F.sequence(start, last_month, F.expr("interval 1 month")))
                                       .otherwise(F.array().cast("array<date>"))).alias("month"))
    actual = (fact.groupBy(_month("txn_date").alias("a_month"), F.col("account_id").alias("a_account"))
                  .agg(F.count(F.lit(1)).alias("txn_count"),
                       F.countDistinct("statement_sha256").alias("statement_count")))
    j = expected.join(actual, (expected.month == actual.a_month) & (expected.account_id == actual.a_account), "left")
    return j.select(
        "month", "friendly_name", "account_kind",
        F.coalesce("txn_count", F.lit(0)).cast("bigint").alias("txn_count"),
        F.coalesce("statement_count", F.lit(0)).cast("bigint").alias("statement_count"),
        F.when(F.col("txn_count").isNull() | (F.col("txn_count") == 0), F.lit("MISSING"))
         .otherwise(F.lit("PRESENT")).alias("status"),
    )


# --- C6 / C7 / C8 ------------------------------------------------------------------------

DUPLICATE_KEYS = ["txn_date", "amount", "account_id", "clean_description"]


def duplicate_alerts(fact: DataFrame) -> DataFrame:
    """Groups of identical (date, amount, account, clean text), every member
    flagged. Counting is a partial aggregate (a hot group collapses map-side);
    the join back is an equi-join on the four keys that AQE can split when
    one group is huge. NULL keys never join, as in the reference."""
    keyed = fact.filter(F.col("txn_date").isNotNull() & F.col("amount").isNotNull()
                        & F.col("account_id").isNotNull() & F.col("clean_description").isNotNull())
    # Only rows whose keys may come again are shuffled whole; all others only as a hash.
    key = F.xxhash64(*DUPLICATE_KEYS)
    again = keyed.groupBy(key.alias("_key")).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1).select("_key")
    keyed = may_match(keyed, key, again).filter(F.col("_may")).drop("_may")
    groups = (keyed.groupBy(*DUPLICATE_KEYS).agg(F.count(F.lit(1)).alias("occurrence_count"))
                   .filter(F.col("occurrence_count") > 1))
    j = keyed.join(groups, DUPLICATE_KEYS)
    return j.select(
        F.lit("POTENTIAL_DUPLICATE").alias("alert_type"), "txn_date", "amount", "account_name",
        "raw_description",
        F.concat(F.lit("Found "), F.col("occurrence_count").cast("string"),
                 F.lit(" identical transactions")).alias("alert_message"),
    )


def outlier_alerts(fact: DataFrame) -> DataFrame:
    """Spend outliers per category: |amount| > avg + 3 sd and > 100.

    Stats come from one partial aggregation per category (a few rows per
    category reach the final stage) and go back by an equi-join, which Spark
    broadcasts when the stats turn out small. The ratio in the message is
    computed exactly in integer cents and rounded half-up to one decimal."""
    abs_cents = (F.abs(F.col("amount")) * 100).cast("decimal(38,0)")
    stats = (fact.filter((F.col("amount") < 0) & ~F.col("is_transfer"))
                 .groupBy(F.col("category_id").alias("s_cat"))
                 .agg(F.count(F.lit(1)).cast("decimal(38,0)").alias("s_n"),
                      F.sum(abs_cents).cast("decimal(38,0)").alias("s_sum"),
                      F.stddev_samp(F.abs(F.col("amount")).cast("double")).alias("s_sd")))
    j = fact.filter(~F.col("is_transfer")).join(stats, F.col("category_id") == F.col("s_cat"))
    avg = F.col("s_sum").cast("double") / F.col("s_n").cast("double") / 100.0
    absd = F.abs(F.col("amount")).cast("double")
    flagged = j.filter((absd > avg + OUTLIER_SIGMAS * F.col("s_sd")) & (absd > OUTLIER_MIN_ABS_AMOUNT))
    # round(|x| / avg, 1) = (20 * |x|c * n + S) div (2 * S) tenths, S = sum of |x|c
    tenths = F.expr("cast((20 * cast(abs(amount) * 100 as decimal(38,0)) * s_n + s_sum) div (2 * s_sum) as bigint)")
    ratio_text = F.concat((tenths / 10).cast("bigint").cast("string"), F.lit("."), (tenths % 10).cast("string"))
    return flagged.select(
        F.lit("SPENDING_OUTLIER").alias("alert_type"), "txn_date", "amount", "account_name", "raw_description",
        F.concat(F.lit("Amount is "), ratio_text, F.lit("x higher than "), F.col("category_id"),
                 F.lit(" average")).alias("alert_message"),
    )


def quality_alerts(fact: DataFrame) -> DataFrame:
    return duplicate_alerts(fact).unionByName(outlier_alerts(fact))


# --- C9 ---------------------------------------------------------------------------------------

def transfer_review_queue(semantic: DataFrame) -> DataFrame:
    return (semantic.filter(~F.col("is_transfer") & (F.col("category_name") == UNCATEGORISED_NAME)
                            & (F.abs("amount") >= REVIEW_MIN_ABS_AMOUNT))
                    .select("transaction_date", "amount", "account_name", "merchant_name", "raw_description",
                            "category_name", "source_system")
                    .orderBy(F.abs("amount").desc()))


# --- C10 -------------------------------------------------------------------------------------

def net_worth_daily(bank_statements: DataFrame, as_of: _dt.date) -> DataFrame:
    """Daily sum of forward-filled closing balances.

    Each statement holds its balance on [period_end, next period_end of the
    same holder+account), the last one until as_of (inclusive). Of statements
    of one account and day the one with the largest (sha256, balance) holds.
    They are reduced to it before the shuffle, so an account, however many
    statements it has, brings at most one row per calendar day to its window.
    Instead of a
    days x windows range join, every window emits +balance at its start and
    -balance at its end; the deltas are summed per day (a partial aggregate
    whose result is bounded by the calendar, not by the data), a running sum
    over those few thousand days gives each day's totals, and each change
    day is expanded to the days until the next change.
    """
    end_cap = F.date_add(F.lit(as_of.isoformat()).cast("date"), 1)
    sb = (bank_statements.filter(F.col("closing_balance").isNotNull())
          .filter(F.col("period_end").isNotNull())
          .groupBy("holder", "account_number", F.col("period_end").alias("as_of_date"))
          .agg(F.max(F.struct(*[c for c in ("sha256", "closing_balance") if c in bank_statements.columns])).alias("last"))
          .select("holder", "account_number", "as_of_date", "last.closing_balance"))
    w = Window.partitionBy("holder", "account_number").orderBy("as_of_date")
    windows = sb.select(
        "holder", "account_number", "closing_balance",
        F.col("as_of_date").alias("ws"),
        F.least(F.coalesce(F.lead("as_of_date").over(w), end_cap), end_cap).alias("we"),
    ).filter(F.col("ws") < F.col("we"))
    named = (F.col("holder").isNotNull() & F.col("account_number").isNotNull()).cast("int")
    deltas = windows.select(
        F.explode(F.array(
            F.struct(F.col("ws").alias("day"), F.col("closing_balance").alias("dv"),
                     named.alias("dn"), F.lit(1).alias("da")),
            F.struct(F.col("we").alias("day"), (-F.col("closing_balance")).alias("dv"),
                     (-named).alias("dn"), F.lit(-1).alias("da")),
        )).alias("e")).select("e.*")
    per_day = deltas.groupBy("day").agg(F.sum("dv").alias("dv"), F.sum("dn").alias("dn"),
                                        F.sum("da").alias("da"))
    # Single-partition window on purpose: one row per change day.
    run = Window.orderBy("day").rowsBetween(Window.unboundedPreceding, 0)
    totals = per_day.select(
        "day",
        F.sum("dv").over(run).alias("assets"),
        F.sum("dn").over(run).alias("n_named"),
        F.sum("da").over(run).alias("n_all"),
        F.lead("day").over(Window.orderBy("day")).alias("next_day"),
    ).filter((F.col("n_all") > 0) & F.col("next_day").isNotNull())
    days = totals.select(
        F.explode(F.sequence("day", F.date_sub("next_day", 1))).alias("as_of_date"), "assets", "n_named")
    return days.select(
        "as_of_date",
        F.col("assets").cast(MONEY).alias("total_assets"),
        F.lit(0.0).cast("double").alias("total_liabilities"),
        F.col("assets").cast(MONEY).alias("net_worth"),
        F.col("n_named").cast("bigint").alias("n_accounts_contributing"),
    )
