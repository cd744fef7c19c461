"""Reference-shaped bronze tables and seeds derived from the driver tables.

The reference reads parsed bank/card statements, CSV exports and hand-kept
seed CSVs. The test data are TPC-H-like tables instead, so this module maps
them, deterministically and with DataFrame operations only, onto the bronze
and seed shapes (rules in FIXTURES.md). The DuckDB oracle derives the same
tables in SQL (``ledgerloom.oracle.fixtures_sql``).

Nothing is collected to the driver. What the bronze tables cost a join or an
aggregation for is written once per session under ``spark.checkpoint.dir``
(``Fixtures(land=True)``, the default) and read back. Only columns that cannot
be worked out of their neighbours are stored; keys, hashes and constants are
added on reading, and tables that are projections of stored ones stay lazy, so
a query pays for the columns that it uses. Seeds stay lazy as well.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.money import MONEY, cents, money
from .driver import read_table

# ---------------------------------------------------------------------------
# The fixture's description templates (index = o_orderkey % 16,
# index 15 takes the part name instead).
DESCRIPTION_TEMPLATES = [
    "SAFEWAY 12 TORONTO ON",
    "NETFLIX.COM 866-579-7172",
    "SQ *STARBUCKS TORONTO ON",
    "ONLINEBILLPAYMENT WISE 4821",
    "TRANSFER TO CIBC",
    "TF1234 SAVINGS",
    "E-TRANSFER RECEIVED",
    "INTERAC TRANSFERRED FUNDS",
    "BC HYDRO",
    "CHEQUE NO 12",
    "NSF FEE",
    "PETRO-CANADA 88213",
    "UBER EATS",
    "DIRECTDEPOSIT ACME",
    "SHELL CAFE",
]
REVERSAL_TEXT = "PAYMENT REVERSAL"
CARD_PAYMENT_TEXT = "PAYMENT RECEIVED THANK YOU"
FIXTURE_PARSED_AT = "2002-01-01 00:00:00"
FIXTURE_LANDED_AT = "2002-01-01 06:00:00"

# Seeds (FIXTURES.md §2.3): (rule_id, category_id, pattern, priority).
CATEGORY_RULES = [
    ("r01", "income", "directdeposit", 5),
    ("r02", "rent", "cheque no", 5),
    ("r03", "transfer", "payment received", 10),
    ("r04", "transfer", "e-transfer", 10),
    ("r05", "fees", "nsf", 20),
    ("r06", "groceries", "safeway", 30),
    ("r07", "dining", "starbucks", 40),
    ("r08", "dining", "uber eats", 40),
    ("r09", "transport", "uber", 50),
    ("r10", "fuel", "shell", 50),
    ("r11", "dining", "cafe", 50),
    ("r12", "fuel", "petro-canada", 50),
    ("r13", "subscriptions", "netflix", 60),
    ("r14", "utilities", "hydro", 70),
]
# (rule_id, pattern, direction, notes)
TRANSFER_RULES = [
    ("t01", "onlinebillpayment wise", "outbound", "external transfer service"),
    ("t02", "transfer to cibc", "outbound", "transfer to another bank"),
]
# (category_id, category_name, parent_category_id)
CATEGORIES = [
    ("dining", "Dining", None),
    ("fees", "Fees", None),
    ("fuel", "Fuel", "transport"),
    ("groceries", "Groceries", None),
    ("income", "Income", None),
    ("rent", "Rent / Mortgage", None),
    ("shopping", "Shopping", None),
    ("subscriptions", "Subscriptions", None),
    ("transfer", "Internal Transfer", None),
    ("transport", "Transport", None),
    ("travel", "Travel", "shopping"),
    ("uncategorised", "Uncategorised", None),
    ("utilities", "Utilities", None),
]
MERCHANT_CATEGORY_BY_LENGTH = ["groceries", "shopping", "uncategorised", "utilities"]
EXTRA_MERCHANTS = [("bc hydro", "utilities"), ("cheque no 12", "rent")]
THESIS_STATUSES = ["open", "watching", "exited", "invalidated"]  # index 4 -> NULL
# ---------------------------------------------------------------------------


def month_start(c: Column) -> Column:
    return F.trunc(F.to_date(c), "month")


def _key_text(prefix: str, key: Column) -> Column:
    return F.concat(F.lit(prefix), key.cast("string"))


# --- bank ------------------------------------------------------------------

def bank_lines(orders: DataFrame, customer: DataFrame, part: DataFrame) -> DataFrame:
    """One bank line per order, the stored columns (helper of §2.1)."""
    o = orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    named = F.col("o_orderkey") % 16 == 15  # only these lines take a part's name
    c = customer.select("c_custkey", "c_name", "c_mktsegment")
    p = part.select("p_partkey", "p_name")
    parts = part.agg(F.max("p_partkey") + 1).scalar()
    templates = F.array(*[F.lit(t) for t in DESCRIPTION_TEMPLATES])
    o = o.withColumn("part_ref", F.when(named, F.col("o_orderkey") % parts))
    j = (o.join(c, o.o_custkey == c.c_custkey)
          .join(p, p.p_partkey == F.col("part_ref"), "left"))
    tc = cents(F.col("o_totalprice"))
    mult = F.when(F.col("o_orderkey") % 503 == 7, F.lit(60)).otherwise(F.lit(1))
    return j.select(
        F.col("o_orderkey"),
        F.col("o_custkey"),
        F.col("c_mktsegment"),
        F.to_date("o_orderdate").alias("d"),
        tc.alias("tc"),
        F.when(F.col("o_orderstatus") == "O", tc)
         .otherwise(-(F.expr("(cast(round(o_totalprice * 100) as bigint)) div 100") * mult))
         .alias("cents"),
        F.when(F.col("o_orderkey") % 16 == 15, F.col("p_name"))
         .otherwise(F.element_at(templates, (F.col("o_orderkey") % 16 + 1).cast("int")))
         .alias("descr"),
        F.when(F.col("c_custkey") % 50 == 49, F.lit(None).cast("string"))
         .otherwise(F.col("c_name")).alias("holder"),
    )


def _document_sha(kind: str, custkey: Column, mon: Column) -> Column:
    return F.md5(F.concat(F.lit(f"{kind}|"), custkey.cast("string"), F.lit("|"), mon.cast("string")))


def bank_src(lines: DataFrame) -> DataFrame:
    """The stored bank lines with their account and statement."""
    return lines.withColumn("mon", month_start(F.col("d"))).select(
        "*", _key_text("A", F.col("o_custkey")).alias("acct"),
        _document_sha("bank", F.col("o_custkey"), F.col("mon")).alias("sha"))


def bank_sums(src: DataFrame) -> DataFrame:
    """One row per bank statement, the stored columns; account and hash follow from customer and month."""
    return src.groupBy("o_custkey", "mon").agg(
        F.max("holder").alias("holder"),
        F.max("c_mktsegment").alias("bank"),
        F.sum("tc").alias("sum_tc"),
    )


def bank_statements(sums: DataFrame) -> DataFrame:
    g = sums.select("*", _key_text("A", F.col("o_custkey")).alias("acct"),
                    _document_sha("bank", F.col("o_custkey"), F.col("mon")).alias("sha"))
    null_money = F.lit(None).cast(MONEY)
    return g.select(
        F.col("sha").alias("sha256"),
        F.lit("local").alias("source_type"),
        F.col("sha").alias("source_id"),
        F.col("holder"),
        F.col("bank"),
        F.lit("chequing").alias("product"),
        F.lit("chequing").alias("account_type"),
        F.col("acct").alias("account_number"),
        F.lit(None).cast("string").alias("branch_name"),
        F.lit(None).cast("string").alias("transit_number"),
        F.lit(None).cast("string").alias("plan_name"),
        F.col("mon").alias("period_start"),
        F.last_day("mon").alias("period_end"),
        null_money.alias("opening_balance"),
        null_money.alias("total_deducted"),
        null_money.alias("total_added"),
        F.when(F.col("o_custkey") % 40 == 39, null_money)
         .otherwise(money(F.col("sum_tc"))).alias("closing_balance"),
        F.array().cast("array<string>").alias("validation_issues"),
        F.lit(FIXTURE_PARSED_AT).cast("timestamp_ntz").alias("parsed_at"),
    )


def bank_transactions(src: DataFrame) -> DataFrame:
    k = src
    line = F.struct(
        F.col("d").alias("txn_date"),
        money(F.col("cents")).alias("amount"),
        F.col("descr").alias("raw_description"),
        money(F.col("tc")).alias("running_balance"),
    )
    reversal = F.struct(
        F.date_add("d", (F.col("o_orderkey") % 10).cast("int")).alias("txn_date"),
        money(-F.col("cents")).alias("amount"),
        F.lit(REVERSAL_TEXT).alias("raw_description"),
        money(F.lit(0)).alias("running_balance"),
    )
    # One pass over the source: every order gives its line, a true repeat of
    # it (same line twice in one statement) when o_orderkey % 97 == 0, and a
    # reversal when o_orderkey % 31 == 2.
    variants = F.array(
        line,
        F.when(F.col("o_orderkey") % 97 == 0, line),
        F.when(F.col("o_orderkey") % 31 == 2, reversal),
    )
    rows = k.select(F.col("sha").alias("statement_sha256"), F.col("acct").alias("account_number"),
                    F.explode(F.filter(variants, lambda v: v.isNotNull())).alias("v"))
    return rows.select("statement_sha256", "account_number", "v.*")


# --- card ------------------------------------------------------------------

def cc_lines(lineitem: DataFrame, orders: DataFrame, part: DataFrame, src: DataFrame) -> DataFrame:
    """Card lines, the stored columns: purchases and payments."""
    li = lineitem.select("l_orderkey", "l_partkey", "l_extendedprice", "l_shipdate")
    o = orders.select("o_orderkey", "o_custkey")
    p = part.select("p_partkey", "p_name")
    purchases = (li.join(o, li.l_orderkey == o.o_orderkey)
                   .join(p, li.l_partkey == p.p_partkey)
                   .select(
                       F.col("o_custkey").alias("custkey"),
                       F.to_date("l_shipdate").alias("txn_date"),
                       F.date_add(F.to_date("l_shipdate"), 2).alias("posting_date"),
                       money(F.expr("cast(round(l_extendedprice * 100) as bigint) div 100")).alias("amount"),
                       F.col("p_name").alias("raw_description"),
                       month_start(F.col("l_shipdate")).alias("mon"),
                   ))
    pay_date = F.date_add("d", (F.col("o_orderkey") % 13).cast("int"))
    payments = (src.filter((F.col("o_orderkey") % 12 == 1) & (F.col("cents") < 0))
                   .select(
                       F.col("o_custkey").alias("custkey"),
                       pay_date.alias("txn_date"),
                       pay_date.alias("posting_date"),
                       money(-(-F.col("cents") + (F.col("o_orderkey") % 9 - 4) * 2)).alias("amount"),
                       F.lit(CARD_PAYMENT_TEXT).alias("raw_description"),
                       F.col("mon"),
                   ))
    return purchases.unionByName(payments)


def cc_src(lines: DataFrame) -> DataFrame:
    """The stored card lines with their card and statement."""
    return lines.select(
        "*",
        _key_text("V", F.col("custkey")).alias("card"),
        _document_sha("cc", F.col("custkey"), F.col("mon")).alias("sha"),
    )


def cc_transactions(cc: DataFrame) -> DataFrame:
    return cc.select(
        F.col("sha").alias("statement_sha256"),
        F.col("card").alias("card_number"),
        "txn_date",
        "posting_date",
        "amount",
        "raw_description",
        F.lit(None).cast("string").alias("original_currency"),
        F.lit(None).cast(MONEY).alias("original_amount"),
        F.lit(None).cast("double").alias("exchange_rate"),
    )


def _cc_header(custkey: Column, card: Column) -> tuple[Column, Column]:
    """(holder, card number) as a line's statement prints them."""
    holder = F.when(custkey % 50 == 48, F.lit(None).cast("string")).otherwise(
        F.concat(F.lit("Customer#"), F.lpad(custkey.cast("string"), 9, "0")))
    return holder, F.when(custkey % 22 == 0, F.concat("card", F.lit("X"))).otherwise(card)


def cc_sums(cc: DataFrame) -> DataFrame:
    """One row per card statement, the stored columns. Lines without customer or month have no hash and share one
    statement, whose texts are the largest of its lines; those of the others follow from the customer."""
    whole = F.col("custkey").isNotNull() & F.col("mon").isNotNull()
    counts = [F.count(F.lit(1)).cast("int").alias("n_details"), F.sum("amount").alias("total")]
    holder, number = _cc_header(F.col("custkey"), F.col("card"))
    odd = (cc.filter(~whole).groupBy("sha")
             .agg(F.max(holder).alias("odd_holder"), F.max(number).alias("odd_number"), F.max("mon").alias("mon"), *counts)
             .select(F.lit(None).alias("custkey"), "mon", "n_details", "total", "odd_holder", "odd_number"))
    none = F.lit(None).cast("string")
    return (cc.filter(whole).groupBy("custkey", "mon").agg(*counts)
              .select("custkey", "mon", "n_details", "total",
                      none.alias("odd_holder"), none.alias("odd_number")).unionByName(odd))


def cc_statements(sums: DataFrame) -> DataFrame:
    whole = F.col("custkey").isNotNull()
    g = sums.withColumn("card", _key_text("V", F.col("custkey")))
    holder, number = _cc_header(F.col("custkey"), F.col("card"))
    g = g.select("mon", "n_details", "total",
                 F.when(whole, _document_sha("cc", F.col("custkey"), F.col("mon"))).alias("sha"),
                 F.when(whole, holder).otherwise(F.col("odd_holder")).alias("holder"),
                 F.when(whole, number).otherwise(F.col("odd_number")).alias("card_number_last4"))
    null_money = F.lit(None).cast(MONEY)
    return g.select(
        F.col("sha").alias("sha256"),
        F.lit("local").alias("source_type"),
        F.col("sha").alias("source_id"),
        "holder",
        F.lit("cardbank").alias("bank"),
        F.lit("visa").alias("product"),
        "card_number_last4",
        F.last_day("mon").alias("statement_date"),
        F.col("mon").alias("period_start"),
        F.last_day("mon").alias("period_end"),
        F.date_add(F.last_day("mon"), 21).alias("payment_due_date"),
        null_money.alias("previous_balance"),
        null_money.alias("payments_and_credits"),
        null_money.alias("purchases_and_other_charges"),
        null_money.alias("new_installments"),
        null_money.alias("cash_advances"),
        null_money.alias("total_interest_charges"),
        null_money.alias("fees"),
        F.col("total").cast(MONEY).alias("total_balance"),
        null_money.alias("minimum_payment_due"),
        null_money.alias("credit_limit"),
        null_money.alias("available_credit"),
        F.array().cast("array<string>").alias("validation_issues"),
        F.lit(FIXTURE_PARSED_AT).cast("timestamp_ntz").alias("parsed_at"),
        "n_details",
    )


# --- CSV exports, positions, theses -----------------------------------------

def banking_csv_raw(src: DataFrame, events: DataFrame) -> DataFrame:
    from_orders = src.select(
        F.col("acct").alias("account_hint"),
        F.col("d").alias("row_date"),
        F.col("descr").alias("description"),
        money(F.col("tc")).cast("decimal(12,2)").alias("amount"),
    )
    from_events = events.select(
        _key_text("A", F.col("user_id")).alias("account_hint"),
        F.to_date("ts").alias("row_date"),
        F.col("event_type").alias("description"),
        money(cents(F.col("value"))).cast("decimal(12,2)").alias("amount"),
    )
    both = from_orders.unionByName(from_events)
    return both.select(
        F.concat("account_hint", F.lit(".csv")).alias("source_file"),
        F.lit(FIXTURE_LANDED_AT).cast("timestamp_ntz").alias("landed_at"),
        "row_date", "description", "amount", "account_hint",
    )


def questrade_positions(lineitem: DataFrame) -> DataFrame:
    """Broker position rows in the shape of the source database (before A13):
    one lot per line item, supplier as the account."""
    li = lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_tax",
                         "l_shipdate")
    return li.select(
        _key_text("Q", F.col("l_suppkey")).alias("account_number"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("snapshot_date"),
        _key_text("SYM", F.col("l_partkey")).alias("symbol"),
        F.col("l_partkey").alias("symbol_id"),
        _key_text("lot ", F.col("l_orderkey")).alias("description"),
        F.lit("CAD").alias("currency"),
        F.col("l_quantity").alias("quantity"),
        (F.col("l_extendedprice") / F.col("l_quantity") * (1 + F.col("l_tax"))).alias("current_price"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("average_entry_price"),
        (F.col("l_extendedprice") * (1 + F.col("l_tax"))).alias("current_market_value"),
        F.col("l_extendedprice").alias("book_cost"),
        (F.col("l_extendedprice") * F.col("l_tax")).alias("open_pnl"),
        F.col("l_shipdate").alias("fetched_at"),
    )


# --- seeds -------------------------------------------------------------------

_SEEDS: dict[tuple, DataFrame] = {}


def _seed(spark: SparkSession, rows, schema: str) -> DataFrame:
    """A literal seed frame, memoised per session (seeds never change in a
    run, and the rule arrays built from them are memoised per frame)."""
    key = (spark.sparkContext.applicationId, id(spark), schema, tuple(rows))
    if key not in _SEEDS:
        _SEEDS[key] = spark.createDataFrame(rows, schema=schema)
    return _SEEDS[key]


def dim_category_rules(spark: SparkSession) -> DataFrame:
    """``line`` is the rule's place in its file, which decides between rules of one priority."""
    rows = [(*rule, line) for line, rule in enumerate(CATEGORY_RULES, 1)]
    return _seed(spark, rows, "rule_id string, category_id string, pattern string, priority int, line int")


def dim_transfer_rules(spark: SparkSession) -> DataFrame:
    return _seed(spark, TRANSFER_RULES, "rule_id string, pattern string, direction string, notes string")


def dim_categories(spark: SparkSession) -> DataFrame:
    return _seed(spark, CATEGORIES, "category_id string, category_name string, parent_category_id string")


def dim_account_normalization(customer: DataFrame) -> DataFrame:
    c = customer.select("c_custkey")
    active = F.col("c_custkey") % 11 != 0
    start = F.date_add(F.lit("1995-01-01").cast("date"), (F.col("c_custkey") % 1000).cast("int"))
    bank = c.filter(F.col("c_custkey") % 5 != 4).select(
        _key_text("A", F.col("c_custkey")).alias("account_id"),
        F.concat(F.lit("Chequing "), F.col("c_custkey").cast("string")).alias("friendly_name"),
        F.lit(1).alias("inversion_factor"),
        active.alias("is_active"),
        F.lit("monthly").alias("expected_frequency"),
        start.alias("start_date"),
    )
    card = c.filter(F.col("c_custkey") % 2 == 0).select(
        _key_text("V", F.col("c_custkey")).alias("account_id"),
        F.concat(F.lit("Card "), F.col("c_custkey").cast("string")).alias("friendly_name"),
        F.lit(-1).alias("inversion_factor"),
        active.alias("is_active"),
        F.lit("monthly").alias("expected_frequency"),
        start.alias("start_date"),
    )
    return bank.unionByName(card)


def wrong_normalizations(customer: DataFrame) -> DataFrame:
    """Lines of the account seed whose factor and start date cannot be read."""
    return customer.filter(F.col("c_custkey") % 13 == 0).select(
        _key_text("W", F.col("c_custkey")).alias("account_id"),
        F.concat(F.lit('Wrong "line", '), F.col("c_custkey").cast("string")).alias("friendly_name"),
        F.lit("minus one").alias("inversion_factor"), F.lit("true").alias("is_active"),
        F.lit("monthly").alias("expected_frequency"), F.lit("1995-13-40").alias("start_date"))


def dim_holders(customer: DataFrame) -> DataFrame:
    return customer.filter(F.col("c_custkey") % 10 != 7).select(
        F.col("c_name").alias("holder_raw"),
        F.concat(F.lit("own"), (F.col("c_custkey") % 3).cast("string")).alias("owner"),
    )


def dim_merchants(part: DataFrame) -> DataFrame:
    cats = F.array(*[F.lit(c) for c in MERCHANT_CATEGORY_BY_LENGTH])
    from_parts = part.select(
        F.lower("p_name").alias("canonical_name"),
        F.element_at(cats, (F.length("p_name") % 4 + 1).cast("int")).alias("category_id"),
    ).distinct()
    spark = part.sparkSession
    extra = spark.createDataFrame(EXTRA_MERCHANTS, "canonical_name string, category_id string")
    ts = F.lit(FIXTURE_PARSED_AT).cast("timestamp_ntz")
    return from_parts.unionByName(extra).select(
        F.md5("canonical_name").alias("merchant_id"),
        "canonical_name",
        "category_id",
        F.lit(None).cast(T.ArrayType(T.FloatType())).alias("embedding"),
        ts.alias("created_at"),
        ts.alias("updated_at"),
    )


def dim_category_overrides(stable_ids: DataFrame) -> DataFrame:
    """Overrides keyed by stable ids of the fact itself (those starting a0)."""
    s = stable_ids.select("stable_id").filter(F.col("stable_id").startswith("a0")).distinct()
    return s.select(
        "stable_id",
        F.when(F.substring("stable_id", 3, 1) < "8", F.lit("travel"))
         .otherwise(F.lit("transfer")).alias("category_id"),
        F.lit(None).cast("string").alias("notes"),
    )


def thesis_records(part: DataFrame) -> DataFrame:
    """Parsed note front matter as records (input of A12): one per part, plus a
    later re-ingest of every seventh key."""
    statuses = F.array(*[F.lit(s) for s in THESIS_STATUSES])
    k = F.col("p_partkey")
    base = part.select(
        F.when(k % 3 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("T"), k.cast("string"))).alias("thesis_id_fm"),
        F.when(k % 17 == 0, F.lit(None).cast("string")).otherwise(F.col("p_brand")).alias("ticker"),
        F.when(k % 5 == 4, F.lit(None).cast("string"))
         .otherwise(F.element_at(statuses, (k % 5 + 1).cast("int"))).alias("status"),
        F.date_add(F.lit("1998-01-01").cast("date"), (k % 1000).cast("int")).alias("opened"),
        F.lit(None).cast("date").alias("closed"),
        F.col("p_retailprice").cast("decimal(12,4)").alias("price_at_open"),
        F.col("p_size").cast("int").alias("horizon_months"),
        F.concat(F.lit("Investment Theses/"), F.concat(F.lit("T"), k.cast("string")), F.lit(".md")).alias("source_file"),
        k.alias("p_partkey"),
    )
    first = base.withColumn("ingested_at", F.lit("2001-12-01 00:00:00").cast("timestamp_ntz"))
    again = (base.filter(k % 7 == 0)
                 .withColumn("price_at_open", (F.col("price_at_open") + F.lit(1)).cast("decimal(12,4)"))
                 .withColumn("ingested_at", F.lit("2001-12-15 00:00:00").cast("timestamp_ntz")))
    return first.unionByName(again)


_LANDED: dict[tuple, DataFrame] = {}
_LANDING_LOCK = __import__("threading").RLock()
STORED_TABLES = ("bank_lines", "cc_lines", "bank_sums", "cc_sums")


class Fixtures:
    """Lazy bundle of every derived bronze table and seed for one sf dir.

    With ``land=True`` each of ``STORED_TABLES`` is written once per session
    (as Parquet under the checkpoint dir) the first time it is needed and read
    back from there; bronze tables are projections of them, seeds stay lazy."""

    def __init__(self, spark: SparkSession, sf_dir: str, land: bool = True):
        self.spark = spark
        self.sf_dir = sf_dir
        self.land = land
        self._cache: dict[str, DataFrame] = {}

    def _get(self, name, build):
        if name not in self._cache:
            if self.land and name in STORED_TABLES:
                self._cache[name] = self._landed(name, build)
            else:
                self._cache[name] = build()
        return self._cache[name]

    def _landed(self, name, build):
        app = self.spark.sparkContext.applicationId
        key = (app, id(self.spark), self.sf_dir, name)
        # one writer per table, also under concurrent queries (re-entrant:
        # landing one table may land the helper it is derived from)
        with _LANDING_LOCK:
            return self._land_locked(key, name, build, app)

    def _land_locked(self, key, name, build, app):
        import hashlib

        from ..session import ensure_checkpoint_dir
        if key not in _LANDED:
            base = ensure_checkpoint_dir(self.spark).rstrip("/")
            tag = hashlib.md5(self.sf_dir.encode()).hexdigest()[:12]
            path = f"{base}/ledgerloom-bronze/{app}/{tag}/{name}"
            build().write.mode("overwrite").option("compression", "zstd").parquet(path)
            _LANDED[key] = self.spark.read.parquet(path)
        return _LANDED[key]

    def land_all(self) -> None:
        for name in STORED_TABLES:
            getattr(self, name)

    def t(self, name: str) -> DataFrame:
        return read_table(self.spark, self.sf_dir, name)

    @property
    def bank_lines(self) -> DataFrame:
        return self._get("bank_lines", lambda: bank_lines(self.t("orders"), self.t("customer"), self.t("part")))

    @property
    def bank_src(self) -> DataFrame:
        return self._get("bank_src", lambda: bank_src(self.bank_lines))

    @property
    def bank_sums(self) -> DataFrame:
        return self._get("bank_sums", lambda: bank_sums(self.bank_src))

    @property
    def bank_statements(self) -> DataFrame:
        return self._get("bank_statements", lambda: bank_statements(self.bank_sums))

    @property
    def bank_transactions(self) -> DataFrame:
        return self._get("bank_transactions", lambda: bank_transactions(self.bank_src))

    @property
    def cc_lines(self) -> DataFrame:
        return self._get("cc_lines", lambda: cc_lines(self.t("lineitem"), self.t("orders"), self.t("part"), self.bank_src))

    @property
    def cc_src(self) -> DataFrame:
        return self._get("cc_src", lambda: cc_src(self.cc_lines))

    @property
    def cc_sums(self) -> DataFrame:
        return self._get("cc_sums", lambda: cc_sums(self.cc_src))

    @property
    def cc_transactions(self) -> DataFrame:
        return self._get("cc_transactions", lambda: cc_transactions(self.cc_src))

    @property
    def cc_statements(self) -> DataFrame:
        return self._get("cc_statements", lambda: cc_statements(self.cc_sums))

    @property
    def banking_csv_raw(self) -> DataFrame:
        return self._get("banking_csv_raw", lambda: banking_csv_raw(self.bank_src, self.t("events")))

    @property
    def questrade_positions(self) -> DataFrame:
        return self._get("questrade_positions", lambda: questrade_positions(self.t("lineitem")))

    @property
    def export_lines(self) -> DataFrame:
        """Raw CSV export lines as they sit in the inbox (input of A10/A11)."""
        from .csv_inbox import export_lines
        return self._get("export_lines", lambda: export_lines(self.t("customer"), self.bank_src))

    @property
    def dim_category_rules(self) -> DataFrame:
        return self._get("dim_category_rules", lambda: dim_category_rules(self.spark))

    @property
    def dim_transfer_rules(self) -> DataFrame:
        return self._get("dim_transfer_rules", lambda: dim_transfer_rules(self.spark))

    @property
    def dim_categories(self) -> DataFrame:
        return self._get("dim_categories", lambda: dim_categories(self.spark))

    @property
    def dim_account_normalization(self) -> DataFrame:
        return self._get("dim_account_normalization", lambda: dim_account_normalization(self.t("customer")))

    @property
    def dim_holders(self) -> DataFrame:
        return self._get("dim_holders", lambda: dim_holders(self.t("customer")))

    @property
    def dim_merchants(self) -> DataFrame:
        return self._get("dim_merchants", lambda: dim_merchants(self.t("part")))

    @property
    def thesis_records(self) -> DataFrame:
        return self._get("thesis_records", lambda: thesis_records(self.t("part")))


# --- vectors and the prior review queue (FIXTURES.md §2.4) -------------------

# Query vector = merchant vector + w * own vector, w by vec_id % 5.
QUERY_WEIGHTS = {1: 0.3, 2: 0.7, 3: 0.9, 4: 3.0}


def _letters(id_col: Column) -> Column:
    """Digits of an id spelled as letters, so the merchant cleaner keeps it."""
    return F.translate(id_col.cast("string"), "0123456789", "abcdefghij")


def merchant_vectors(embeddings: DataFrame) -> DataFrame:
    """Merchants that carry a vector: every fifth embedding."""
    e = embeddings.filter(F.col("vec_id") % 5 == 0)
    name = F.concat(F.lit("shop "), _letters(F.col("vec_id")))
    ts = F.lit(FIXTURE_PARSED_AT).cast("timestamp_ntz")
    return e.select(
        F.concat(F.lit("M"), F.col("vec_id").cast("string")).alias("merchant_id"),
        name.alias("canonical_name"),
        F.lit("uncategorised").alias("category_id"),
        F.col("embedding"),
        F.transform("embedding", lambda x: x.cast("double")).alias("vec"),
        ts.alias("created_at"), ts.alias("updated_at"),
    )


def query_vectors(embeddings: DataFrame) -> DataFrame:
    """Descriptions to resolve: near copies of a merchant vector."""
    own = embeddings.filter(F.col("vec_id") % 5 != 0).select("vec_id", F.col("embedding").alias("own"))
    base = embeddings.filter(F.col("vec_id") % 5 == 0).select(F.col("vec_id").alias("b_id"),
                                                              F.col("embedding").alias("base"))
    w = F.element_at(F.array(*[F.lit(QUERY_WEIGHTS[i]) for i in (1, 2, 3, 4)]),
                     (F.col("vec_id") % 5).cast("int"))
    j = own.join(base, own.vec_id - own.vec_id % 5 == base.b_id)
    raw = F.concat(F.lit("shop "), _letters(F.col("vec_id")))
    return j.select(
        F.col("vec_id").cast("string").alias("query_id"),
        raw.alias("raw_description"),
        raw.alias("canonical_name"),
        F.zip_with("base", "own", lambda b, o: b.cast("double") + w * o.cast("double")).alias("vec"),
    )


def prior_review_queue(cc_transactions: DataFrame) -> DataFrame:
    """Descriptions queued by an earlier enrichment run."""
    d = cc_transactions.select("raw_description").filter(F.length("raw_description") % 7 == 0).distinct()
    return d.select(F.md5("raw_description").alias("queue_id"), "raw_description",
                    F.lit(None).cast("string").alias("candidate_merchant_id"),
                    F.lit(None).cast("double").alias("distance"),
                    F.lit(FIXTURE_PARSED_AT).cast("timestamp_ntz").alias("created_at"))
