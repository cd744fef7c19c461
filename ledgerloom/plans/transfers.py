"""Transfer matching.

Candidates: a debit (amount < 0) and a credit (amount > 0) whose amounts
cancel within 0.05 and whose dates are within 3 days (different accounts,
|debit| < 500), 10 days (different accounts, |debit| >= 500) or 7 days (same
account). Matches are mutual-best pairs; one-way transfers are debits whose
clean text matches an outbound rule by LIKE and that are not matched.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import with_once
from ..functions.ids import packed, packed_id, unpacked
from ..operators.membership import may_match
from ..operators.rules import rule_hits
from ..operators.tolerance_join import bucket, reached

TOLERANCE_CENTS = 5          # 0.05
SMALL_GAP_DAYS = 3
LARGE_GAP_DAYS = 10
SAME_ACCOUNT_GAP_DAYS = 7
LARGE_AMOUNT = 500
MAX_GAP_DAYS = max(SMALL_GAP_DAYS, LARGE_GAP_DAYS, SAME_ACCOUNT_GAP_DAYS)
AMOUNT_WIDTH, DAY_WIDTH = 40, 40   # buckets of the band joins, in cents and days


def _abs_cents(amount_col: str = "amount"):
    return (F.abs(F.col(amount_col)) * 100).cast("bigint")


def _money(cents: Column) -> Column:
    return (cents.cast("decimal(20,0)") / F.lit(100).cast("decimal(3,0)")).cast("decimal(18,2)")


def _day_number(date_col: str = "txn_date"):
    return F.datediff(F.col(date_col), F.lit("1970-01-01").cast("date"))


def _meeting(rows: DataFrame, cents: str, day: str, spread: str, gap: int) -> DataFrame:
    """``rows`` with their amount and day buckets (``_ab``, ``_db``): by ``spread`` all that they reach along 'amount' or
    'day', and their own along the other."""
    ab, db = bucket(F.col(cents), AMOUNT_WIDTH), bucket(F.col(day), DAY_WIDTH)
    if spread == "amount":
        ab = reached(F.col(cents), AMOUNT_WIDTH, TOLERANCE_CENTS)
    else:
        db = reached(F.col(day), DAY_WIDTH, gap)
    return rows.select("*", ab.alias("_ab"), db.alias("_db"))


def transfer_candidates(fact: DataFrame) -> DataFrame:
    """B11 as a bucketed equi-join (no nested loop). Ids are packed and amounts are cents while they are shuffled."""
    def side(rows: DataFrame, p: str, name: str) -> DataFrame:
        return rows.select(packed(F.col("transaction_id")).alias(name), F.col("account_id").alias(f"{p}_acct"),
                           _abs_cents().alias(f"{p}_c"), _day_number().alias(f"{p}_day"))

    d = _meeting(side(fact.filter(F.col("amount") < 0), "d", "debit_txn_id"), "d_c", "d_day", "day", MAX_GAP_DAYS)
    c = _meeting(side(fact.filter(F.col("amount") > 0), "c", "credit_txn_id"), "c_c", "c_day", "amount", MAX_GAP_DAYS)
    c = c.withColumnRenamed("_ab", "c_ab").withColumnRenamed("_db", "c_db")
    j = d.join(c, (d._ab == c.c_ab) & (d._db == c.c_db))
    day_gap = F.abs(F.col("d_day") - F.col("c_day")).cast("bigint")
    amount_gap = F.abs(F.col("d_c") - F.col("c_c"))
    cross_account = F.col("d_acct") != F.col("c_acct")
    ok = (
        (amount_gap <= TOLERANCE_CENTS)
        & (
            (cross_account & (
                ((F.col("d_c") < LARGE_AMOUNT * 100) & (day_gap <= SMALL_GAP_DAYS))
                | ((F.col("d_c") >= LARGE_AMOUNT * 100) & (day_gap <= LARGE_GAP_DAYS))))
            | ((F.col("d_acct") == F.col("c_acct")) & (day_gap <= SAME_ACCOUNT_GAP_DAYS))
        )
    )
    return j.filter(ok).select(
        unpacked(F.col("debit_txn_id")).alias("debit_txn_id"), unpacked(F.col("credit_txn_id")).alias("credit_txn_id"),
        _money(-F.col("d_c")).alias("amount"),
        day_gap.alias("day_gap"),
        _money(amount_gap).alias("amount_gap"),
    )


def transfer_matches(candidates: DataFrame) -> DataFrame:
    """B12 mutual best without windows: the best partner of each debit and of
    each credit are min(struct) aggregates (partial aggregation, no sort of a
    whole group); a pair is kept when each side is the other's best."""
    best_credit = (candidates.groupBy("debit_txn_id")
                   .agg(F.min(F.struct("day_gap", "amount_gap", "credit_txn_id")).alias("b"))
                   .select("debit_txn_id", F.col("b.credit_txn_id").alias("bc")))
    best_debit = (candidates.groupBy("credit_txn_id")
                  .agg(F.min(F.struct("day_gap", "amount_gap", "debit_txn_id")).alias("b"))
                  .select(F.col("credit_txn_id").alias("cc"), F.col("b.debit_txn_id").alias("bd")))
    mutual = best_credit.join(best_debit, (best_credit.debit_txn_id == best_debit.bd)
                              & (best_credit.bc == best_debit.cc))
    amounts = candidates.select(F.col("debit_txn_id").alias("a_d"), F.col("credit_txn_id").alias("a_c"),
                                "amount")
    # The (debit, credit) pair is unique among candidates, so this join adds
    # the debit amount back without fan-out.
    return (mutual.join(amounts, (mutual.debit_txn_id == amounts.a_d) & (mutual.bc == amounts.a_c))
                  .select("debit_txn_id", F.col("bc").alias("credit_txn_id"), "amount"))


def _spots(side: DataFrame) -> DataFrame:
    """The distinct (cents, day) of the rows of ``side`` that can have a partner."""
    return (side.filter(F.col("account_id").isNotNull() & F.col("txn_date").isNotNull())
            .select(_abs_cents().alias("cents"), _day_number().alias("day")).distinct())


def _live_spots(debits: DataFrame, credits: DataFrame) -> DataFrame:
    """(is_debit, cents, day): where a row has any row of the other side near enough, whatever their accounts. Only two
    numbers a spot are shuffled; no row of another spot has a partner, nor is anyone's."""
    def side(rows: DataFrame, p: str, spread: str) -> DataFrame:
        r = _spots(rows).select(F.col("cents").alias(f"{p}_cents"), F.col("day").alias(f"{p}_day"))
        return _meeting(r, f"{p}_cents", f"{p}_day", spread, MAX_GAP_DAYS).withColumnsRenamed({"_ab": f"{p}_ab", "_db": f"{p}_db"})

    d, c = side(debits, "d", "day"), side(credits, "c", "amount")
    limit = F.when(F.col("d_cents") < LARGE_AMOUNT * 100, max(SMALL_GAP_DAYS, SAME_ACCOUNT_GAP_DAYS)).otherwise(MAX_GAP_DAYS)
    return (d.join(c, (F.col("d_ab") == F.col("c_ab")) & (F.col("d_db") == F.col("c_db")))
            .filter((F.abs(F.col("d_day") - F.col("c_day")) <= limit) & (F.abs(F.col("d_cents") - F.col("c_cents")) <= TOLERANCE_CENTS))
            .select(F.explode(F.array(*[F.struct(F.lit(p == "d").alias("is_debit"), F.col(f"{p}_cents").alias("cents"),
                                                 F.col(f"{p}_day").alias("day")) for p in "dc"])).alias("spot"))
            .select("spot.*").distinct())


def _at(side: DataFrame, spots: DataFrame) -> DataFrame:
    """The rows of ``side`` but those that are at none of ``spots``; a few of these may stay, which changes no match."""
    return (may_match(side, F.xxhash64(_abs_cents(), _day_number()), spots.select(F.xxhash64("cents", "day").alias("spot")))
            .filter("_may").drop("_may"))


def _cells(side: DataFrame, transaction_id: Column | None = None) -> DataFrame:
    """One row per (cents, day, account): its smallest id, packed until the pairs are found. Only that id can be
    anyone's best partner, as all rows of a cell have the same gaps. ``transaction_id``: how it follows from the rows."""
    transaction_id = F.col("transaction_id") if transaction_id is None else transaction_id
    return (side.filter(F.col("account_id").isNotNull() & F.col("txn_date").isNotNull())
            .groupBy(_abs_cents().alias("cents"), _day_number().alias("day"), F.col("account_id").alias("acct"))
            .agg(F.min(packed_id(transaction_id)).alias("id")))


def _same_account(debits: DataFrame, credits: DataFrame) -> DataFrame:
    """The best partner of each cell within its account, (q_debit, q_id, q_cents, rank): both directions of one join,
    reduced before they are shuffled. Only cells that may have one of the other side in their account and buckets meet."""
    def side(rows: DataFrame, p: str, spread: str) -> DataFrame:
        r = rows.select(*[F.col(c).alias(f"{p}_{c}") for c in ("id", "cents", "day", "acct")])
        r = _meeting(r, f"{p}_cents", f"{p}_day", spread, SAME_ACCOUNT_GAP_DAYS)
        return r.withColumnsRenamed({"_ab": f"{p}_ab", "_db": f"{p}_db"})

    d, c = side(debits, "d", "day"), side(credits, "c", "amount")
    d_key, c_key = (F.xxhash64(f"{p}_acct", f"{p}_ab", f"{p}_db") for p in "dc")
    d, c = (may_match(rows, key, others.select(other.alias("key"))).filter("_may").drop("_may")
            for rows, key, others, other in ((d, d_key, c, c_key), (c, c_key, d, d_key)))
    day_gap, amount_gap = F.abs(F.col("d_day") - F.col("c_day")), F.abs(F.col("d_cents") - F.col("c_cents"))
    return (d.join(c, (F.col("d_acct") == F.col("c_acct")) & (F.col("d_ab") == F.col("c_ab")) & (F.col("d_db") == F.col("c_db")))
            .filter((day_gap <= SAME_ACCOUNT_GAP_DAYS) & (amount_gap <= TOLERANCE_CENTS))
            .select(F.explode(F.array(*[F.struct(
                F.lit(q == "d").alias("q_debit"), F.col(f"{q}_id").alias("q_id"), F.col(f"{q}_cents").alias("q_cents"),
                F.struct(day_gap.alias("day_gap"), amount_gap.alias("amount_gap"), F.col(f"{t}_id").alias("id")).alias("rank"))
                for q, t in (("d", "c"), ("c", "d"))])).alias("pair")).select("pair.*")
            .groupBy("q_debit", "q_id", "q_cents").agg(F.min("rank").alias("rank")))


def _near(spots: DataFrame, targets: DataFrame, debit_cents: str) -> DataFrame:
    """``spots`` (q_cents, q_day) with the cells of ``targets`` (t_cents,
    t_day, …) that the amount and day bands of different accounts allow, as
    ``rank`` = (day_gap, amount_gap, t_id, t_acct), beside the buckets where they met. Both sides hold a bounded
    number of rows per (cents, day), so a spot meets at most 11 amounts x 21
    days (twice, for the two smallest ids of different accounts)."""
    q = _meeting(spots, "q_cents", "q_day", "day", LARGE_GAP_DAYS)
    t = _meeting(targets, "t_cents", "t_day", "amount", LARGE_GAP_DAYS)
    t = t.withColumnRenamed("_ab", "t_ab").withColumnRenamed("_db", "t_db")
    limit = F.when(F.col(debit_cents) < LARGE_AMOUNT * 100, SMALL_GAP_DAYS).otherwise(LARGE_GAP_DAYS)
    day_gap = F.abs(F.col("q_day") - F.col("t_day"))
    amount_gap = F.abs(F.col("q_cents") - F.col("t_cents"))
    return (q.join(t, (F.col("_ab") == F.col("t_ab")) & (F.col("_db") == F.col("t_db")))
            .filter((day_gap <= limit) & (amount_gap <= TOLERANCE_CENTS))
            .select(*spots.columns, "_ab", "_db",
                    F.struct(day_gap.alias("day_gap"), amount_gap.alias("amount_gap"), F.col("t_id").alias("id"),
                             F.col("t_acct").alias("acct")).alias("rank")))


def _two_best(near: DataFrame) -> DataFrame:
    """Per spot of ``near`` its first ``rank`` and its first one of another account (s_cents, s_day, one, other). Each
    bucket's ranks are cut to these two where they met, so at most two a bucket are shuffled."""
    def two(ranks: Column) -> tuple[Column, Column]:
        return ranks[0], F.get(F.filter(ranks, lambda x: x["acct"] != ranks[0]["acct"]), F.lit(0))

    # At most 462 structs per spot (see _near).
    met = near.groupBy("q_cents", "q_day", "_ab", "_db").agg(F.array_sort(F.collect_list("rank")).alias("r"))
    met = met.select("q_cents", "q_day", F.array_compact(F.array(*two(F.col("r")))).alias("r"))
    both = met.groupBy("q_cents", "q_day").agg(F.array_sort(F.flatten(F.collect_list("r"))).alias("r"))
    one, other = two(F.col("r"))
    return both.select(F.col("q_cents").alias("s_cents"), F.col("q_day").alias("s_day"), one.alias("one"), other.alias("other"))


def _best_partner(queries: DataFrame, targets: DataFrame, same: DataFrame, queries_are_debits: bool) -> DataFrame:
    """(id, cents, partner): the best partner of each cell's smallest id, or
    no row. Work grows with cells, never with pairs of rows. ``same``: the
    best partners within one account (q_id, q_cents, rank)."""
    debit_cents = "q_cents" if queries_are_debits else "t_cents"
    q = queries.select(*[F.col(c).alias("q_" + c) for c in queries.columns])
    t = targets.select(*[F.col(c).alias("t_" + c) for c in targets.columns])
    # Another account: per (cents, day) the two smallest ids are enough, since
    # cells of one (cents, day) have different accounts (limited map-side).
    place = Window.partitionBy("t_cents", "t_day").orderBy("t_id")
    two = t.withColumn("_place", F.row_number().over(place)).filter(F.col("_place") <= 2).drop("_place")
    spots = q.select("q_cents", "q_day").distinct()
    ranked = _two_best(_near(spots, two, debit_cents))
    best = F.when(F.col("one.acct") != F.col("q_acct"), F.col("one")).otherwise(F.col("other"))
    cross = (q.join(ranked, (F.col("q_cents") == F.col("s_cents")) & (F.col("q_day") == F.col("s_day")))
             .select("q_id", "q_cents", best.alias("rank"))
             .filter(F.col("rank").isNotNull())
             .withColumn("rank", F.struct("rank.day_gap", "rank.amount_gap", "rank.id")))
    return (same.unionByName(cross).groupBy("q_id", "q_cents").agg(F.min("rank").alias("rank"))
            .select(F.col("q_id").alias("id"), F.col("q_cents").alias("cents"), F.col("rank.id").alias("partner")))


def mutual_best(fact: DataFrame, table: Callable[[str, DataFrame], DataFrame] = lambda name, df: df,
                transaction_id: Column | None = None) -> DataFrame:
    """B12 straight from the fact: equal to ``transfer_matches`` over all
    candidate pairs, without making them (a day on which one amount is charged
    and reversed in very many accounts stays linear). ``table`` writes the
    live spots, their cells and the best partners within an account, which are read several times.
    ``transaction_id``: the id where ``fact`` holds what it follows from; it is worked out for rows at live spots only."""
    debits, credits = fact.filter(F.col("amount") < 0), fact.filter(F.col("amount") > 0)
    spots = table("transfer_spots", _live_spots(debits, credits))
    debits = table("transfer_debits", _cells(_at(debits, spots.filter("is_debit")), transaction_id))
    credits = table("transfer_credits", _cells(_at(credits, spots.filter("not is_debit")), transaction_id))
    same = table("transfer_same_account", _same_account(debits, credits))
    d = _best_partner(debits, credits, same.filter("q_debit").drop("q_debit"), queries_are_debits=True)
    c = _best_partner(credits, debits, same.filter("not q_debit").drop("q_debit"), queries_are_debits=False).select(
        F.col("id").alias("c_id"), F.col("partner").alias("c_partner"))
    return (d.join(c, (F.col("id") == F.col("c_partner")) & (F.col("partner") == F.col("c_id")))
            .select(unpacked(F.col("id")).alias("debit_txn_id"), unpacked(F.col("partner")).alias("credit_txn_id"),
                    _money(-F.col("cents")).alias("amount")))


def one_way_transfers(fact: DataFrame, transfer_rules: DataFrame, matches: DataFrame,
                      table: Callable[[str, DataFrame], DataFrame] = lambda name, df: df,
                      texts: DataFrame | None = None, transaction_id: Column | None = None) -> DataFrame:
    """Outbound-rule debits (LIKE '%pattern%', so % and _ in a pattern
    are wildcards) not already matched. ``table`` writes the texts that a rule
    matches before the debits meet them: where they are few, Spark then knows
    it and does not shuffle the debits for them. ``texts``: all clean texts of
    the fact (``text``), if they are known. ``transaction_id``: as in ``mutual_best``."""
    # Once a row: the join asks for texts that are not null, which would work them out a second time.
    debits = with_once(fact.filter(F.col("amount") < 0), F.col("clean_description"), "_clean")
    transaction_id = F.col("transaction_id") if transaction_id is None else transaction_id
    texts = table("outbound_texts", rule_hits(
        debits.select(F.col("clean_description").alias("text")) if texts is None else texts,
        transfer_rules.filter(F.col("direction") == "outbound").select("pattern"), like=True).select("text").distinct())
    hits = (debits.join(texts, F.col("_clean") == F.col("text"), "left_semi")
                .select(transaction_id.alias("debit_txn_id"), "amount"))
    matched = matches.select(F.col("debit_txn_id").alias("m_d")).filter(F.col("m_d").isNotNull())
    # transaction_id is never NULL, so NOT IN equals a plain anti join here.
    return (hits.join(matched, hits.debit_txn_id == matched.m_d, "left_anti")
                .filter(F.col("debit_txn_id").isNotNull())
                .distinct().select("debit_txn_id", F.lit(None).cast("string").alias("credit_txn_id"), "amount"))


def fact_transfers(matches: DataFrame, one_way: DataFrame) -> DataFrame:
    """Each pair emitted once per side."""
    combined = matches.select("debit_txn_id", "credit_txn_id").unionByName(
        one_way.select("debit_txn_id", "credit_txn_id"))
    debit_side = combined.filter(F.col("debit_txn_id").isNotNull()).select(
        F.col("debit_txn_id").alias("transaction_id"), F.lit("transfer").alias("transfer_type"),
        F.col("credit_txn_id").alias("matched_transaction_id"))
    credit_side = combined.filter(F.col("credit_txn_id").isNotNull()).select(
        F.col("credit_txn_id").alias("transaction_id"), F.lit("transfer").alias("transfer_type"),
        F.col("debit_txn_id").alias("matched_transaction_id"))
    return debit_side.unionByName(credit_side)
