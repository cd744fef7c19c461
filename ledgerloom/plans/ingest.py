"""Bronze-side record shaping: broker snapshots (A13) and thesis upsert."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import with_once
from ..functions.ids import packed, unpacked
from ..functions.text import account_last4
from ..sources.fixtures import FIXTURE_PARSED_AT
from ..sources.statements import MULTI_NO_ACCOUNTS
from . import sinks


def questrade_snapshots(positions: DataFrame) -> DataFrame:
    """Replace-table copy of broker positions with a DATE snapshot and
    ``current_market_value`` renamed to ``market_value`` (13 columns)."""
    return positions.select(
        "account_number",
        F.to_date("snapshot_date").alias("snapshot_date"),
        "symbol", "symbol_id", "description", "currency", "quantity", "current_price",
        "average_entry_price",
        F.col("current_market_value").alias("market_value"),
        "book_cost", "open_pnl", "fetched_at",
    )


def file_stem(path_col) -> F.Column:
    """Last path component without its last suffix (Python's Path.stem)."""
    name = F.element_at(F.split(path_col, "/"), -1)
    return F.regexp_replace(name, r"(?<=.)\.[^.]*$", "")


THESIS_COLUMNS = [
    "thesis_id", "ticker", "status", "opened", "closed", "price_at_open", "buy_threshold",
    "sell_threshold", "stop_loss", "confidence", "horizon_months", "expected_return_pct",
    "dependencies", "invalidation_conditions", "decisions", "outcome", "source_file", "ingested_at",
]


def investment_theses_upsert(records: DataFrame) -> DataFrame:
    """One row per thesis_id, last write wins.

    ``thesis_id`` defaults to the file stem, records without a ticker are
    skipped, list fields default to ``[]`` and the outcome to ``{}``. The
    upsert is a max-by aggregate over (ingested_at, source_file): partial
    aggregation keeps a thesis with very many re-ingests from landing in one
    task as a whole."""
    def opt(name, ddl):
        return (F.col(name) if name in records.columns else F.lit(None)).cast(ddl).alias(name)

    rows = records.filter(F.col("ticker").isNotNull() & (F.col("ticker") != "")).select(
        F.coalesce(F.nullif(F.col("thesis_id_fm"), F.lit("")), file_stem(F.col("source_file"))).alias("thesis_id"),
        F.col("ticker"),
        opt("status", "string"), opt("opened", "date"), opt("closed", "date"),
        opt("price_at_open", "decimal(12,4)"), opt("buy_threshold", "decimal(12,4)"),
        opt("sell_threshold", "decimal(12,4)"), opt("stop_loss", "decimal(12,4)"),
        opt("confidence", "decimal(5,4)"), opt("horizon_months", "int"),
        opt("expected_return_pct", "decimal(8,2)"),
        F.coalesce(opt("dependencies", "string"), F.lit("[]")).alias("dependencies"),
        F.coalesce(opt("invalidation_conditions", "string"), F.lit("[]")).alias("invalidation_conditions"),
        F.coalesce(opt("decisions", "string"), F.lit("[]")).alias("decisions"),
        F.coalesce(opt("outcome", "string"), F.lit("{}")).alias("outcome"),
        F.col("source_file"),
        F.col("ingested_at"),
    )
    latest = rows.groupBy("thesis_id").agg(
        F.max(F.struct("ingested_at", "source_file", *[c for c in THESIS_COLUMNS
                                                        if c not in ("ingested_at", "source_file", "thesis_id")]))
        .alias("w"))
    return latest.select("thesis_id", *[F.col("w." + c).alias(c) for c in THESIS_COLUMNS if c != "thesis_id"])


# --- A2–A9, A14: parsed statement documents -> bronze ----------------------------------

def first_copies(documents: DataFrame, prior_shas: DataFrame) -> DataFrame:
    """Finance documents whose hash is in neither header table, one per hash
    (the first received). Copies of one file are byte-identical, so the
    content of any copy is the content; only the source reference is picked
    by (source_order, source_id). A partial aggregate per hash: a document
    received a million times still collapses map-side. Hashes are packed once,
    and both steps go by them, so the documents are shuffled once."""
    fin = with_once(documents.filter(F.col("kind").isNotNull()), packed(F.col("sha256")), "_sha")
    prior = with_once(prior_shas, packed(F.col("sha256")), "p_sha").select("p_sha")
    return fin.join(prior, F.col("_sha") == F.col("p_sha"), "left_anti").groupBy("_sha").agg(
        F.min(F.struct("source_order", "source_id", "source_type")).alias("src"),
        F.first("kind").alias("kind"), F.first("accounts").alias("accounts"),
        F.first("card").alias("card"), F.first("issues").alias("issues"),
    ).select(unpacked(F.col("_sha")).alias("sha256"), F.col("src.source_type").alias("source_type"), F.col("src.source_id").alias("source_id"),
             F.col("src.source_order").alias("source_order"), "kind", "accounts", "card", "issues")


def card_headers(documents: DataFrame) -> DataFrame:
    """The documents with the number of a card's details in place of these, which is all that the headers' table asks of
    them: what is shuffled to pick first copies then holds no details. Documents of other kinds stay, as copies are told
    by their hash alone."""
    return documents.withColumn("card", F.when(F.col("card").isNotNull(), F.struct(F.col("card.header").alias("header"), F.size("card.details").alias("n_details"))))


def _ingestable(first: DataFrame) -> F.Column:
    return ~((F.col("kind") == "multi") & (F.coalesce(F.size("accounts"), F.lit(0)) == 0))


def statement_new_batch(first: DataFrame) -> DataFrame:
    """A2: the documents this run inserts."""
    return (first.filter(_ingestable(first))
                 .select("sha256", "source_type", "source_id", "kind",
                         F.coalesce(F.size("accounts"), F.lit(1)).alias("n_accounts")))


def bronze_bank_statements(first: DataFrame) -> DataFrame:
    """A3: one header row per account; document issues repeated on each."""
    b = first.filter(F.col("kind").isin("bank", "multi") & _ingestable(first))
    a = b.select("sha256", "source_type", "source_id", "issues", F.explode("accounts").alias("a"))
    return a.select("sha256", "source_type", "source_id", "a.header.*",
                    F.col("issues").alias("validation_issues"),
                    F.lit(FIXTURE_PARSED_AT).cast("timestamp_ntz").alias("parsed_at"))


def bronze_bank_transactions(first: DataFrame) -> DataFrame:
    """A4: one row per detail; account = header's unless empty, else the
    detail's."""
    b = first.filter(F.col("kind").isin("bank", "multi") & _ingestable(first))
    a = b.select("sha256", F.explode("accounts").alias("a"))
    d = a.select("sha256", F.col("a.header.account_number").alias("h_acct"), F.explode("a.details").alias("d"))
    return d.select(
        F.col("sha256").alias("statement_sha256"),
        F.coalesce(F.nullif(F.col("h_acct"), F.lit("")), F.col("d.account_number")).alias("account_number"),
        F.col("d.posting_date").alias("txn_date"), F.col("d.amount").alias("amount"),
        F.col("d.description").alias("raw_description"), F.col("d.running_balance").alias("running_balance"))


def bronze_cc_statements(first: DataFrame) -> DataFrame:
    """A5: card header with n_details = number of lines, which ``card_headers`` have counted already."""
    c = first.filter(F.col("kind") == "cc")
    counted = "n_details" in c.schema["card"].dataType.names
    return c.select("sha256", "source_type", "source_id", "card.header.*",
                    F.col("issues").alias("validation_issues"),
                    F.lit(FIXTURE_PARSED_AT).cast("timestamp_ntz").alias("parsed_at"),
                    F.col("card.n_details") if counted else F.size("card.details").alias("n_details"))


def bronze_cc_transactions(first: DataFrame) -> DataFrame:
    """Card detail rows."""
    c = first.filter(F.col("kind") == "cc").select("sha256", F.explode("card.details").alias("d"))
    return c.select(F.col("sha256").alias("statement_sha256"), F.col("d.card_number").alias("card_number"),
                    F.col("d.transaction_date").alias("txn_date"), F.col("d.posting_date").alias("posting_date"),
                    F.col("d.amount").alias("amount"), F.col("d.description").alias("raw_description"),
                    "d.original_currency", "d.original_amount", "d.exchange_rate")


def statement_ingest_result(documents: DataFrame, first: DataFrame, prior_shas: DataFrame) -> DataFrame:
    """What the ingest did with every received document. The hash check
    comes first: a known hash is 'already ingested' whatever it contains.

    A hash is either known or has one first copy, so documents are shuffled
    once for both, with their hashes packed."""
    key = first.select("sha256", F.col("source_id").alias("f_src"), F.col("source_order").alias("f_ord"), F.lit(False).alias("known"))
    p = prior_shas.select("sha256", F.lit(None).cast("string").alias("f_src"), F.lit(None).cast("int").alias("f_ord"),
                          F.lit(True).alias("known"))
    found = with_once(key.unionByName(p), packed(F.col("sha256")), "k_sha").drop("sha256")
    # Only what is asked of a document below is shuffled.
    asked = with_once(documents, packed(F.col("sha256")), "d_sha").select(
        "d_sha", "source_id", "source_order", "kind", "issues", F.coalesce(F.size("accounts"), F.lit(0)).alias("n_accounts"),
        F.when(F.size("accounts") > 0, F.col("accounts")[0]["header"]).alias("bank_h"), F.col("card.header").alias("card_h"))
    j = asked.join(found, F.col("d_sha") == F.col("k_sha"), "left").withColumn("sha256", unpacked(F.col("d_sha")))
    is_fin = F.col("kind").isNotNull()
    empty_multi = (F.col("kind") == "multi") & (F.col("n_accounts") == 0) & ~F.coalesce("known", F.lit(False))
    first_copy = (F.col("f_src") == F.col("source_id")) & (F.col("f_ord") == F.col("source_order"))
    new = is_fin & F.coalesce(first_copy, F.lit(False)) & ~empty_multi
    bank_h, card_h = F.col("bank_h"), F.col("card_h")
    h = lambda f: F.when(F.col("kind") == "cc", card_h[f]).otherwise(bank_h[f])
    acct = F.when(F.col("kind") == "cc", card_h["card_number_last4"]).otherwise(bank_h["account_number"])

    def when_new(c):
        return F.when(new, c)
    return j.select(
        "source_id",
        (is_fin & ~empty_multi).alias("was_finance_doc"),
        new.alias("was_new_row"),
        when_new(h("bank")).alias("bank"),
        when_new(F.concat_ws("_", h("bank"), h("product"))).alias("bank_product"),
        when_new(h("holder")).alias("holder"),
        when_new(account_last4(acct)).alias("last4"),
        when_new(h("period_start")).alias("period_start"),
        when_new(h("period_end")).alias("period_end"),
        F.when(is_fin, F.col("sha256")).alias("sha256"),
        F.when(empty_multi, F.concat(F.col("issues"), F.array(F.lit(MULTI_NO_ACCOUNTS))))
         .when(new, F.col("issues")).otherwise(F.array().cast("array<string>")).alias("validation_issues"),
    )


def statement_owner_metadata(results: DataFrame, holders: DataFrame) -> DataFrame:
    """Title, owner and last4 for each finance document. Owner by exact
    holder match (one row per holder_raw; min owner is the deterministic
    pick), '_unowned' when empty or unmatched."""
    hs = (holders.filter(F.col("holder_raw").isNotNull()).groupBy("holder_raw")
          .agg(F.min("owner").alias("owner")))
    r = results.filter(F.col("was_finance_doc"))
    j = r.join(hs, F.coalesce(r.holder, F.lit("")) == hs.holder_raw, "left")
    title = F.concat_ws(" ", F.coalesce(F.col("bank_product"), F.lit("statement")),
                        F.date_format("period_end", "yyyy-MM-dd"))
    return j.select("source_id", title.alias("title"),
                    F.coalesce(F.nullif(F.col("owner"), F.lit("")), F.lit("_unowned")).alias("owner"),
                    F.coalesce(F.col("last4"), F.lit("")).alias("last4"))


def bronze_rebuild_summary(results: DataFrame) -> DataFrame:
    """Counts per outcome of a full rebuild run."""
    status = (F.when(~F.col("was_finance_doc") & (F.size("validation_issues") > 0), F.lit("failed_validation"))
               .when(~F.col("was_finance_doc"), F.lit("not_finance"))
               .when(~F.col("was_new_row"), F.lit("already_ingested"))
               .when(F.size("validation_issues") > 0, F.lit("ingested_with_issues"))
               .otherwise(F.lit("ingested")))
    return results.groupBy(status.alias("status")).agg(F.count(F.lit(1)).alias("documents"))


BRONZE_TABLES = {
    "bank_transactions": bronze_bank_transactions, "cc_transactions": bronze_cc_transactions,
    "bank_statements": bronze_bank_statements, "cc_statements": bronze_cc_statements,
}


def write_bronze_batch(first: DataFrame, root: str, batch_id: str | None = None) -> str:
    """Write one batch's rows of the four tables; returns the batch's id.

    The batch is staged whole first. A call with the id of a batch that was
    staged but not finished takes the staged documents, whatever ``first``
    holds by then (its documents may look known already, since some headers
    were written), and overwrites that batch's own folder of each table. So a
    crash between any two writes neither doubles nor loses a row, and a retry
    is the same call again."""
    spark = first.sparkSession
    batch_id = batch_id or uuid.uuid4().hex
    staged = f"{root}/_batches/batch={batch_id}"
    if not sinks.is_written(spark, staged):
        sinks.write_table(first, staged)
    documents = spark.read.parquet(staged)
    for name, rows in BRONZE_TABLES.items():
        sinks.write_table(rows(documents), f"{root}/{name}/batch={batch_id}")
    return batch_id
