"""A full model run (the dbt ``run`` equivalent, A16).

Table models are written as Parquet under ``out_root/<layer>/<model>`` in
dependency order; each written table is read back and used downstream, so a
model is computed once per run and a lost executor re-reads a table instead
of recomputing its chain. View models are registered as session temp views
over the written tables (what the read-only SQL surface queries).
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from .context import Lake
from .sinks import materialize

# Materialisation of each model (table vs view), in dependency order.
TABLE_MODELS = [
    ("silver", "dim_accounts"),
    ("silver", "fact_transactions"),
    ("silver", "fact_transfers"),
    ("silver", "investment_theses"),
    ("silver", "reconciliation_gaps"),
    ("gold", "spending_by_category"),
    ("gold", "cash_flow_monthly"),
    ("gold", "disposable_income"),
    ("gold", "net_worth_daily"),
]
VIEW_MODELS = ["dim_merchants", "review_unmapped_holders", "semantic_transactions", "data_completeness",
               "quality_alerts", "transfer_review_queue"]


def run_models(lake: Lake, out_root: str) -> dict[str, DataFrame]:
    """Write every table model, register every view model; return all."""
    out: dict[str, DataFrame] = {}
    root = out_root.rstrip("/")
    for layer, name in TABLE_MODELS:
        df = materialize(getattr(lake, name), f"{root}/{layer}/{name}")
        # downstream models of this Lake read the written table from now on
        lake.__dict__[name] = df
        if name == "fact_transactions":
            lake.__dict__["fact_table"] = df
        out[name] = df
    for name in VIEW_MODELS:
        df = getattr(lake, name)
        df.createOrReplaceTempView(name)
        out[name] = df
    for name in [n for _, n in TABLE_MODELS]:
        out[name].createOrReplaceTempView(name)
    return out
