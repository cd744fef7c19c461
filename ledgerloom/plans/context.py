"""The model DAG as plain function composition.

``Lake`` plays the role of dbt's ``ref()``: each property builds (once per
instance) the lazy DataFrame of one model from its inputs. Nothing here
executes; Spark runs a plan when an action is called on a model. Callers
that consume one model many times can ``persist()`` it or write it out with
``plans.sinks``.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import with_once
from ..functions.ids import bar_md5
from ..session import DEFAULT_AS_OF
from ..sources.fixtures import (FIXTURE_PARSED_AT, Fixtures, dim_category_overrides, merchant_vectors, prior_review_queue,
                                query_vectors, wrong_normalizations)
from ..sources.seeds import read_seeds, write_seed
from ..sources.statements import RECORD_FIELDS, prior_header_shas, received_records, statement_documents
from . import enrich, enrichment_run, gold, rebuild, silver, sinks, transfers
from .ingest import card_headers, first_copies, investment_theses_upsert, questrade_snapshots, statement_ingest_result
from .table_sets import TableSet


class Lake:
    def __init__(self, spark: SparkSession, sf_dir: str, as_of: _dt.date = DEFAULT_AS_OF,
                 materialize: bool = True, seeds: str | None = None):
        """``seeds``: a folder of seed files (``<name>.csv``); without one the seeds come from the driver tables."""
        self.spark = spark
        self.sf_dir = sf_dir
        self.as_of = as_of
        self.fx = Fixtures(spark, sf_dir)
        self.materialize = materialize
        self._run_folder: str | None = None
        self._fact_stored: DataFrame | None = None  # the rows of fact_table, unless a run has put its own table there
        self._seeds = None if seeds is None else read_seeds(spark, seeds)[0]

    def table(self, name: str, df: DataFrame) -> DataFrame:
        """Materialise a multi-consumer model once (dbt's 'table')."""
        if not self.materialize:
            return df
        if self._run_folder is None:
            self._run_folder = sinks.run_folder(self.spark)
        return sinks.materialize(df, f"{self._run_folder}/{name}")

    # --- bronze ----------------------------------------------------------
    @property
    def bank_statements(self) -> DataFrame:
        return self.fx.bank_statements

    @property
    def bank_transactions(self) -> DataFrame:
        return self.fx.bank_transactions

    @property
    def cc_statements(self) -> DataFrame:
        return self.fx.cc_statements

    @property
    def cc_transactions(self) -> DataFrame:
        return self.fx.cc_transactions

    @property
    def banking_csv_raw(self) -> DataFrame:
        return self.fx.banking_csv_raw

    @cached_property
    def questrade_snapshots(self) -> DataFrame:
        return questrade_snapshots(self.fx.questrade_positions)

    @cached_property
    def investment_theses_bronze(self) -> DataFrame:
        return investment_theses_upsert(self.fx.thesis_records)

    # --- seeds -------------------------------------------------------------
    def _seed(self, name: str, derived: Callable[[], DataFrame]) -> DataFrame:
        return derived() if self._seeds is None else self._seeds[name]

    @cached_property
    def seed_files(self) -> tuple[dict[str, DataFrame], DataFrame]:
        """The seeds written out as files, with some wrong lines among them, and read back: ({name: rows}, rejects)."""
        folder = f"{sinks.run_folder(self.spark)}/seeds"
        frames = {"dim_account_normalization": self.dim_account_normalization, "dim_holders": self.dim_holders,
                  "dim_category_overrides": self.dim_category_overrides, "dim_transfer_rules": self.dim_transfer_rules,
                  "dim_category_rules": self.dim_category_rules.drop("line"), "dim_categories": self.dim_categories}
        for name, rows in frames.items():
            text = rows.select(*[F.col(c).cast("string") for c in rows.columns])
            if name == "dim_account_normalization":
                text = text.unionByName(wrong_normalizations(self.fx.t("customer")))
            write_seed(text, folder, name)
        rows, rejects = read_seeds(self.spark, folder)
        return {name: df.drop("line") for name, df in rows.items()}, rejects

    @property
    def dim_category_rules(self) -> DataFrame:
        return self._seed("dim_category_rules", lambda: self.fx.dim_category_rules)

    @property
    def dim_transfer_rules(self) -> DataFrame:
        return self._seed("dim_transfer_rules", lambda: self.fx.dim_transfer_rules)

    @property
    def dim_categories(self) -> DataFrame:
        return self._seed("dim_categories", lambda: self.fx.dim_categories)

    @property
    def dim_account_normalization(self) -> DataFrame:
        return self._seed("dim_account_normalization", lambda: self.fx.dim_account_normalization)

    @property
    def dim_holders(self) -> DataFrame:
        return self._seed("dim_holders", lambda: self.fx.dim_holders)

    @property
    def dim_merchants(self) -> DataFrame:
        return self.fx.dim_merchants

    @cached_property
    def dim_category_overrides(self) -> DataFrame:
        if self._seeds is not None:
            return self._seeds["dim_category_overrides"]
        # The seed is keyed by stable ids, which depend only on bronze lines
        # (statement, account, date, amount) — no numbering needed.
        # (hashed once per line: the seed's prefix filter would otherwise be
        # pushed through the projection and hash every line twice)
        bank = with_once(self.bank_transactions.select("statement_sha256", "account_number", "txn_date", "amount"),
                         bar_md5(F.col("statement_sha256"), F.col("account_number"), F.col("txn_date"),
                                 F.col("amount")), "stable_id").select("stable_id")
        card = with_once(self.cc_transactions.select("statement_sha256", "card_number", "txn_date", "amount"),
                         bar_md5(F.col("statement_sha256"), F.col("card_number"), F.col("txn_date"),
                                 F.col("amount")), "stable_id").select("stable_id")
        return dim_category_overrides(bank.unionByName(card))

    # --- silver ---------------------------------------------------------------
    @cached_property
    def dim_accounts(self) -> DataFrame:
        return silver.dim_accounts(self.questrade_snapshots, self.bank_statements, self.cc_statements,
                                   self.dim_account_normalization)

    @cached_property
    def txn_bank_numbered(self) -> DataFrame:
        return silver.txn_bank_numbered(self.bank_transactions, self.bank_statements)

    @cached_property
    def txn_cc_numbered(self) -> DataFrame:
        return silver.txn_cc_numbered(self.cc_transactions, self.cc_statements)

    @cached_property
    def txn_lines(self) -> DataFrame:
        return silver.txn_lines(self.txn_bank_numbered, self.txn_cc_numbered)

    @cached_property
    def txn_unified(self) -> DataFrame:
        return silver.txn_unified(self.txn_lines)

    def _staged(self, lines: DataFrame) -> DataFrame:
        return silver.with_categorisation_inputs(lines, self.description_rules)

    @cached_property
    def description_rules(self) -> DataFrame:
        """Written before the lines meet it: of a written table Spark knows the size, and where it is small the
        lines are not shuffled for it."""
        return self.table("description_rules", silver.text_rules(self.description_texts, self.dim_transfer_rules,
                                                                 self.dim_category_rules))

    @cached_property
    def description_texts(self) -> DataFrame:
        """The clean texts of all lines, written once for the rules of every model."""
        return self.table("description_texts", silver.description_texts(self.raw_descriptions))

    @cached_property
    def fact_merchants(self) -> DataFrame:
        """The merchants as the fact reads them, written for the same reason."""
        return self.table("fact_merchants", self.dim_merchants.select("merchant_id", "canonical_name", "category_id"))

    @cached_property
    def txn_staged(self) -> DataFrame:
        return silver.txn_unified(self._staged(self.txn_lines))

    @cached_property
    def fact_lines(self) -> DataFrame:
        """The lines with all that the fact needs but the merchant."""
        overrides = self.written_overrides
        lines = silver.txn_lines(silver.txn_bank_numbered(self.bank_transactions, self.bank_statements, overrides),
                                 silver.txn_cc_numbered(self.cc_transactions, self.cc_statements, overrides))
        return self._staged(silver.with_accounts(lines, self.dim_accounts))

    @cached_property
    def written_overrides(self) -> DataFrame:
        """The overrides as the fact and the semantic view read them: derived once, and of a known size."""
        return self.table("category_overrides", self.dim_category_overrides.select("stable_id", "category_id"))

    @cached_property
    def fact_rows(self) -> DataFrame:
        return silver.fact_rows(self.fact_lines, self.fact_merchants)

    @cached_property
    def fact_transactions(self) -> DataFrame:
        return silver.fact_transactions(self.fact_rows)

    @cached_property
    def fact_table(self) -> DataFrame:
        """fact_transactions written once; read by every model that scans
        the fact more than once (transfers, semantic view, alerts). Its rows
        are stored; ids, amounts and texts that follow are worked out on reading."""
        self._fact_stored = self.table("fact_transactions", self.fact_rows)
        return silver.fact_transactions(self._fact_stored)

    @property
    def fact_for_read(self) -> DataFrame:
        """The written fact if this run has written it, else the lazy plan
        (a single-consumer model need not pay for a write)."""
        return self.__dict__.get("fact_table", self.fact_transactions)

    def _fact_measures(self) -> tuple[DataFrame, Column]:
        """The fact as transfers read it, and its id, which is worked out only for the rows that they keep."""
        fact = self.fact_table
        return (fact, F.col("transaction_id")) if self._fact_stored is None else silver.fact_measures(self._fact_stored)

    @cached_property
    def transfer_candidates(self) -> DataFrame:
        return transfers.transfer_candidates(self.fact_for_read)

    @cached_property
    def transfer_matches(self) -> DataFrame:
        # Read by one-way detection and by fact_transfers.
        fact, transaction_id = self._fact_measures()
        return self.table("transfer_matches", transfers.mutual_best(fact, self.table, transaction_id))

    @cached_property
    def one_way_transfers(self) -> DataFrame:
        fact, transaction_id = self._fact_measures()
        return transfers.one_way_transfers(fact, self.dim_transfer_rules, self.transfer_matches, self.table,
                                           self.description_texts, transaction_id)

    @cached_property
    def fact_transfers(self) -> DataFrame:
        return transfers.fact_transfers(self.transfer_matches, self.one_way_transfers)

    @cached_property
    def review_unmapped_holders(self) -> DataFrame:
        return silver.review_unmapped_holders(self.bank_statements, self.cc_statements, self.dim_holders)

    @cached_property
    def investment_theses(self) -> DataFrame:
        return silver.investment_theses(self.investment_theses_bronze, self.as_of)

    @cached_property
    def reconciliation_gaps(self) -> DataFrame:
        return silver.reconciliation_gaps(self.banking_csv_raw, self.fact_for_read)

    # --- gold ------------------------------------------------------------------
    @cached_property
    def semantic_transactions(self) -> DataFrame:
        models = self.dim_merchants, self.dim_categories, self.fact_transfers, self.written_overrides, self.table
        fact = self.fact_table
        if self._fact_stored is None:
            return gold.semantic_transactions(fact, *models)
        return gold.semantic_transactions(silver.with_ids(self._fact_stored), *models, "overridden",
                                          lambda rows: silver.fact_transactions(rows, *gold.MARKS))

    @cached_property
    def spending_by_category(self) -> DataFrame:
        return gold.spending_by_category(self.fact_for_read)

    @cached_property
    def cash_flow_monthly(self) -> DataFrame:
        return gold.cash_flow_monthly(self.semantic_transactions)

    @cached_property
    def disposable_income(self) -> DataFrame:
        return gold.disposable_income(self.semantic_transactions)

    @cached_property
    def data_completeness(self) -> DataFrame:
        return gold.data_completeness(self.dim_accounts, self.fact_for_read, self.as_of)

    @cached_property
    def duplicate_alerts(self) -> DataFrame:
        return gold.duplicate_alerts(self.fact_table)

    @cached_property
    def outlier_alerts(self) -> DataFrame:
        return gold.outlier_alerts(self.fact_table)

    @cached_property
    def quality_alerts(self) -> DataFrame:
        return gold.quality_alerts(self.fact_table)

    @cached_property
    def transfer_review_queue(self) -> DataFrame:
        return gold.transfer_review_queue(self.semantic_transactions)

    @cached_property
    def net_worth_daily(self) -> DataFrame:
        return gold.net_worth_daily(self.bank_statements, self.as_of)

    # --- enrichment --------------------------------------------------------------
    @cached_property
    def merchant_vectors(self) -> DataFrame:
        return merchant_vectors(self.fx.t("embeddings"))

    @cached_property
    def query_vectors(self) -> DataFrame:
        return query_vectors(self.fx.t("embeddings"))

    @cached_property
    def prior_review_queue(self) -> DataFrame:
        return prior_review_queue(self.cc_transactions)

    @cached_property
    def raw_descriptions(self) -> DataFrame:
        return enrich.distinct_descriptions(self.bank_transactions, self.cc_transactions)

    @cached_property
    def merchant_clean(self) -> DataFrame:
        return enrich.merchant_clean_names(self.raw_descriptions)

    @cached_property
    def merchant_rule_match(self) -> DataFrame:
        return enrich.merchant_rule_match(self.merchant_clean, self.dim_category_rules)

    @cached_property
    def unresolved_descriptions(self) -> DataFrame:
        return enrich.unresolved_descriptions(self.raw_descriptions, self.prior_review_queue)

    @cached_property
    def rule_merchants(self) -> DataFrame:
        return enrich.rule_merchants(self.unresolved_descriptions, self.dim_merchants, self.dim_category_rules)

    @cached_property
    def nearest_merchant(self) -> DataFrame:
        return enrich.nearest_merchant(self.query_vectors, self.merchant_vectors)

    @cached_property
    def merchant_triage(self) -> DataFrame:
        return enrich.triage(self.query_vectors, self.nearest_merchant)

    @cached_property
    def merchant_new(self) -> DataFrame:
        return enrich.merchant_new(self.merchant_triage)

    @cached_property
    def merchant_review_queue(self) -> DataFrame:
        return enrich.merchant_review_queue(self.merchant_triage)

    @cached_property
    def enrichment_inputs(self) -> tuple[DataFrame, DataFrame]:
        """(descriptions, vectors) of an enrichment run: the ledger's and those that carry a vector."""
        queries = self.query_vectors
        return (self.raw_descriptions.unionByName(queries.select("raw_description")),
                queries.select("canonical_name", "vec"))

    @cached_property
    def merchant_tables(self) -> TableSet:
        """The merchant dimension and the review queue before the run, as one committed set."""
        tables = TableSet(self.spark, f"{sinks.run_folder(self.spark)}/merchants")
        columns = enrichment_run.MERCHANT_COLUMNS
        held = self.dim_merchants.select(*columns).unionByName(self.merchant_vectors.withColumn(
            "embedding", F.col("embedding").cast("array<float>")).select(*columns))
        tables.replace({enrichment_run.MERCHANTS: held, enrichment_run.QUEUE: self.prior_review_queue.select(
            *enrichment_run.QUEUE_COLUMNS)})
        return tables

    @cached_property
    def enriched(self) -> tuple[TableSet, DataFrame]:
        """(the set after one run, names that wait for a vector)."""
        descriptions, vectors = self.enrichment_inputs
        return self.merchant_tables, enrichment_run.run_enrichment(
            self.merchant_tables, descriptions, vectors, self.dim_category_rules, FIXTURE_PARSED_AT)

    @cached_property
    def fact_enriched(self) -> DataFrame:
        return silver.fact_transactions(silver.fact_rows(self.fact_lines, self.enriched[0].read(enrichment_run.MERCHANTS)))

    # --- ingest ---------------------------------------------------------------------
    @cached_property
    def statement_documents(self) -> DataFrame:
        return statement_documents(self.bank_statements, self.bank_transactions, self.cc_statements,
                                   self.cc_transactions, self.fx.t("pages"))

    @cached_property
    def rebuilt(self) -> TableSet:
        """The four statement tables and the failures, rebuilt from all received records."""
        documents = self.statement_documents
        tables = TableSet(self.spark, f"{sinks.run_folder(self.spark)}/bronze")
        rebuild.rebuild_bronze(tables, received_records(documents), documents.select(*RECORD_FIELDS).schema)
        return tables

    @cached_property
    def prior_header_shas(self) -> DataFrame:
        return prior_header_shas(self.bank_statements, self.cc_statements)

    @cached_property
    def first_copies(self) -> DataFrame:
        return first_copies(self.statement_documents, self.prior_header_shas)

    @cached_property
    def first_card_headers(self) -> DataFrame:
        """The first copies of the card documents without their details."""
        return first_copies(card_headers(self.statement_documents), self.prior_header_shas)

    @cached_property
    def statement_ingest_result(self) -> DataFrame:
        return statement_ingest_result(self.statement_documents, self.first_copies, self.prior_header_shas)

    @cached_property
    def export_lines(self) -> DataFrame:
        return self.fx.export_lines
