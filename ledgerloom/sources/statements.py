"""Parsed statement documents (input of A2–A7) and provenance landing (A1).

In production the PDF parser hands over one nested record per document:
a bank document with one or more accounts (header + detail lines), or a
card document (header + detail lines). Here the nested records are built
from the flat fixture tables with ``collect_list(struct)`` so that the
ingest path (dedup, ``explode``) is exercised; a statement's detail list is
one document's lines, bounded by the document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import with_once
from ..functions.ids import packed, unpacked

# Fixed values of the fixture: statements that start before this date were
# ingested by an earlier run (they are in the header tables already).
PRIOR_CUTOFF = "1996-01-01"
BANK_HEADER_FIELDS = ["holder", "bank", "product", "account_type", "account_number", "branch_name",
                      "transit_number", "plan_name", "period_start", "period_end", "opening_balance",
                      "total_deducted", "total_added", "closing_balance"]
BANK_DETAIL_FIELDS = ["account_number", "posting_date", "amount", "description", "running_balance"]
CC_HEADER_FIELDS = ["holder", "bank", "product", "card_number_last4", "statement_date", "period_start",
                    "period_end", "payment_due_date", "previous_balance", "payments_and_credits",
                    "purchases_and_other_charges", "new_installments", "cash_advances",
                    "total_interest_charges", "fees", "total_balance", "minimum_payment_due", "credit_limit",
                    "available_credit"]
CC_DETAIL_FIELDS = ["card_number", "transaction_date", "posting_date", "amount", "description",
                    "original_currency", "original_amount", "exchange_rate"]
MULTI_NO_ACCOUNTS = "multi_account_no_accounts"


def _custkey(col: str) -> F.Column:
    return F.regexp_extract(F.col(col), r"(\d+)", 1).cast("bigint")


def statement_documents(bank_statements: DataFrame, bank_transactions: DataFrame,
                        cc_statements: DataFrame, cc_transactions: DataFrame,
                        pages: DataFrame) -> DataFrame:
    """One nested record per received document (copies included).

    Variants (by customer key k): k % 23 == 0 — bank header without an
    account number (details carry it); k % 30 == 0 — multi-account kind;
    k % 41 == 0 — multi-account document without accounts; k % 19 == 0 —
    the same document received twice; k % 37 == 0 — a validation issue.
    Web pages are received too and are not finance documents.

    Hashes and references are packed while details and headers are shuffled
    to each other. Those of details are packed once a row: the join asks for
    hashes that are not null, which would work them out once more. Those of
    headers are a plain projection, through which Spark moves a filter."""
    def slim(rows: DataFrame, *columns: str) -> DataFrame:
        return rows.withColumns({c: packed(F.col(c)) for c in columns})

    def slim_once(rows: DataFrame, c: str) -> DataFrame:
        return with_once(rows.withColumnRenamed(c, f"_{c}"), packed(F.col(f"_{c}")), c)

    reference = [unpacked(F.col(c)).alias(c) if c != "source_type" else F.col(c) for c in ("sha256", "source_type", "source_id")]
    bd = (slim_once(bank_transactions, "statement_sha256").groupBy("statement_sha256", "account_number")
          .agg(F.collect_list(F.struct(
              F.col("account_number"), F.col("txn_date").alias("posting_date"), "amount",
              F.col("raw_description").alias("description"), "running_balance")).alias("details"))
          .withColumnRenamed("account_number", "d_acct"))
    bs = slim(bank_statements, "sha256", "source_id").withColumn("k", _custkey("account_number"))
    header = F.struct(*[
        (F.when(F.col("k") % 23 == 0, F.lit("")).otherwise(F.col("account_number")).alias("account_number")
         if f == "account_number" else F.col(f)) for f in BANK_HEADER_FIELDS])
    acct = F.struct(header.alias("header"),
                    F.coalesce(F.col("details"), F.array().cast(bd.schema["details"].dataType)).alias("details"))
    bank = (bs.join(bd, (bs.sha256 == bd.statement_sha256) & (bs.account_number == bd.d_acct), "left")
              .select(*reference, "k",
                      F.when(F.col("k") % 41 == 0, F.lit("multi")).when(F.col("k") % 30 == 0, F.lit("multi"))
                       .otherwise(F.lit("bank")).alias("kind"),
                      # an empty account list of the right element type
                      F.when(F.col("k") % 41 == 0, F.filter(F.array(acct), lambda a: F.lit(False)))
                       .otherwise(F.array(acct)).alias("accounts")))
    cd = (slim_once(cc_transactions, "statement_sha256").groupBy("statement_sha256")
          .agg(F.collect_list(F.struct(
              "card_number", F.col("txn_date").alias("transaction_date"), "posting_date", "amount",
              F.col("raw_description").alias("description"), "original_currency", "original_amount",
              "exchange_rate")).alias("details")))
    cs = slim(cc_statements, "sha256", "source_id").withColumn("k", _custkey("card_number_last4"))
    card = F.struct(F.struct(*[F.col(f) for f in CC_HEADER_FIELDS]).alias("header"),
                    F.coalesce(F.col("details"), F.array().cast(cd.schema["details"].dataType)).alias("details"))
    cc = (cs.join(cd, cs.sha256 == cd.statement_sha256, "left")
            .select(*reference, "k", F.lit("cc").alias("kind"), card.alias("card")))
    bank = bank.withColumn("card", F.lit(None).cast(cc.schema["card"].dataType))
    cc = cc.select("sha256", "source_type", "source_id", "k", "kind",
                   F.lit(None).cast(bank.schema["accounts"].dataType).alias("accounts"), "card")
    fin = bank.unionByName(cc).withColumn(
        "issues", F.when(F.col("k") % 37 == 0, F.array(F.lit("balance_mismatch")))
                   .otherwise(F.array().cast("array<string>")))
    first = fin.withColumn("source_order", F.lit(0))
    again = (fin.filter(F.col("k") % 19 == 0)
                .withColumn("source_id", F.concat(F.col("source_id"), F.lit("#2")))
                .withColumn("source_order", F.lit(1)))
    web = pages.select(F.sha2(F.col("html"), 256).alias("sha256"), F.lit("local").alias("source_type"),
                       F.concat(F.lit("page-"), F.col("page_id").cast("string")).alias("source_id"),
                       F.lit(None).cast("bigint").alias("k"), F.lit(None).cast("string").alias("kind"),
                       F.lit(None).cast(bank.schema["accounts"].dataType).alias("accounts"),
                       F.lit(None).cast(cc.schema["card"].dataType).alias("card"),
                       F.array().cast("array<string>").alias("issues"),
                       F.lit(0).alias("source_order"))
    return first.unionByName(again).unionByName(web).drop("k")


RECORD_FIELDS = ["kind", "accounts", "card", "issues"]


def received_records(documents: DataFrame) -> DataFrame:
    """The documents as the parser hands them over: JSON text each. By the first digits of the hash one in 64 breaks off
    early, and one in 64 has headers without ``period_end``."""
    body = F.to_json(F.struct(*RECORD_FIELDS))
    digits = F.substring("sha256", 1, 2)
    body = (F.when(digits.between("a0", "a3"), F.substr(body, F.lit(1), F.length(body) - 9))
             .when(digits.between("b0", "b3"), F.regexp_replace(body, r'"period_end":"[^"]*"', '"period_end":null'))
             .otherwise(body))
    return documents.select("sha256", "source_type", "source_id", "source_order", F.col("kind").isNotNull().alias("finance"),
                            body.alias("body"))


def prior_header_shas(bank_statements: DataFrame, cc_statements: DataFrame) -> DataFrame:
    """Document hashes already present in either header table."""
    b = bank_statements.filter(F.col("period_start") < F.lit(PRIOR_CUTOFF).cast("date")).select("sha256")
    c = cc_statements.filter(F.col("period_start") < F.lit(PRIOR_CUTOFF).cast("date")).select("sha256")
    return b.unionByName(c).distinct()


def page_provenance(pages: DataFrame, landed_at: str) -> DataFrame:
    """A1 over the web pages table: the landing record of each page."""
    return pages.select(
        F.lit("web/pages").alias("source"),
        F.lit(landed_at).cast("timestamp_ntz").alias("ingested_at"),
        F.lit(None).cast("timestamp_ntz").alias("source_timestamp"),
        F.concat(F.lit("page_"), F.col("page_id").cast("string"), F.lit(".html")).alias("filename"),
        F.octet_length("html").cast("bigint").alias("size_bytes"),
        F.sha2(F.col("html"), 256).alias("sha256"),
        F.col("url"),
    )


def land_files(spark, input_glob: str, lake_root: str, domain: str, source: str,
               landed_at: str, source_timestamp: str | None = None, extra: str = "{}") -> DataFrame:
    """A1 for real files: read bytes with the ``binaryFile`` source, hash
    them on the executors, and write bytes + provenance by domain, source, UTC
    date and file name. A same-day re-landing replaces the files of the same
    name and keeps the day's others; within one batch the last modified copy
    of a name wins, picked on metadata alone. ``source_timestamp`` is the
    file's modification time unless given."""
    raw = spark.read.format("binaryFile").load(input_glob)
    listed = raw.select("path", "modificationTime", F.element_at(F.split(F.col("path"), "/"), -1).alias("filename"))
    winner = listed.groupBy("filename").agg(F.max_by("path", F.struct("modificationTime", "path")).alias("path"))
    stamp = F.col("modificationTime") if source_timestamp is None else F.lit(source_timestamp).cast("timestamp")
    rec = raw.join(winner, "path").select(
        F.lit(f"{domain}/{source}").alias("source"),
        F.lit(landed_at).cast("timestamp_ntz").alias("ingested_at"),
        stamp.alias("source_timestamp"),
        F.col("length").alias("size_bytes"),
        F.sha2(F.col("content"), 256).alias("sha256"),
        F.lit(extra).alias("extra"),
        F.col("content"),
        F.lit(domain).alias("domain"), F.lit(source).alias("source_name"),
        F.to_date(F.lit(landed_at).cast("timestamp_ntz")).alias("ingest_date"),
        "filename",
    )
    (rec.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy("domain", "source_name", "ingest_date", "filename").parquet(f"{lake_root.rstrip('/')}/bronze_files"))
    return rec.drop("content")
