"""Declared data tests (E1–E4) and the schema description."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.ids import packed

# The declared tests of the silver and gold schema files.
NOT_NULL_TESTS = [
    ("dim_accounts", "account_id"), ("dim_accounts", "source_system"),
    ("dim_merchants", "merchant_id"),
    ("fact_transactions", "transaction_id"), ("fact_transactions", "account_id"),
    ("fact_transfers", "transaction_id"),
    ("net_worth_daily", "as_of_date"), ("net_worth_daily", "net_worth"),
    ("spending_by_category", "month"), ("spending_by_category", "category_id"),
]
UNIQUE_TESTS = [("dim_merchants", "merchant_id"), ("fact_transactions", "transaction_id"),
                ("net_worth_daily", "as_of_date")]
ACCEPTED_VALUES_TESTS = [("dim_accounts", "source_system", ["questrade", "bank", "credit_card"])]

REPORT_COLUMNS = ["model", "column_name", "test", "failures"]


def _models(lake, names) -> dict[str, DataFrame]:
    out = {}
    for n in names:
        out[n] = lake.fact_table if n == "fact_transactions" else getattr(lake, n)
    return out


def test_not_null(lake) -> DataFrame:
    """NULL count per declared column; one aggregation per model (all of
    its declared columns at once), then unpivoted to one row per test."""
    by_model: dict[str, list[str]] = {}
    for m, c in NOT_NULL_TESTS:
        by_model.setdefault(m, []).append(c)
    frames = []
    for m, df in _models(lake, by_model).items():
        cols = by_model[m]
        agg = df.agg(*[F.sum(F.when(F.col(c).isNull(), 1).otherwise(0)).cast("bigint").alias(c) for c in cols])
        frames.append(agg.select(F.explode(F.array(*[
            F.struct(F.lit(m).alias("model"), F.lit(c).alias("column_name"), F.lit("not_null").alias("test"),
                     F.coalesce(F.col(c), F.lit(0).cast("bigint")).alias("failures")) for c in cols])).alias("r"))
                      .select("r.*"))
    return _union(frames)


def test_unique(lake) -> DataFrame:
    """Number of non-NULL values that occur more than once."""
    frames = []
    # The fact is read once here, so it is not written for this test alone.
    models = {m: lake.fact_for_read if m == "fact_transactions" else getattr(lake, m) for m, _ in UNIQUE_TESTS}
    for m, c in UNIQUE_TESTS:
        df = models[m].filter(F.col(c).isNotNull())
        value = packed(F.col(c)) if df.schema[c].dataType.typeName() == "string" else F.col(c)
        dup = (df.groupBy(value.alias("value")).count().filter(F.col("count") > 1)
               .agg(F.count(F.lit(1)).alias("failures")))
        frames.append(dup.select(F.lit(m).alias("model"), F.lit(c).alias("column_name"),
                                 F.lit("unique").alias("test"), F.col("failures").cast("bigint")))
    return _union(frames)


def test_accepted_values(lake) -> DataFrame:
    """Rows whose value is outside the list (NULL passes)."""
    frames = []
    models = _models(lake, {m for m, _, _ in ACCEPTED_VALUES_TESTS})
    for m, c, values in ACCEPTED_VALUES_TESTS:
        bad = models[m].filter(F.col(c).isNotNull() & ~F.col(c).isin(*values)).agg(F.count(F.lit(1)).alias("failures"))
        frames.append(bad.select(F.lit(m).alias("model"), F.lit(c).alias("column_name"),
                                 F.lit("accepted_values").alias("test"), F.col("failures").cast("bigint")))
    return _union(frames)


def test_suite_report(lake) -> DataFrame:
    """All declared tests as one frame. Models read by more than one
    test are written once for the suite (a test run is a batch of scans)."""
    for name in ("dim_accounts", "net_worth_daily", "dim_merchants"):
        lake.__dict__[name] = lake.table(name, getattr(lake, name))
    return _union([test_not_null(lake), test_unique(lake), test_accepted_values(lake)])


def _union(frames):
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


# --- E6 ---------------------------------------------------------------------------------

MODEL_LAYERS = {
    "dim_accounts": "silver", "dim_merchants": "silver", "fact_transactions": "silver",
    "fact_transfers": "silver", "reconciliation_gaps": "silver", "review_unmapped_holders": "silver",
    "investment_theses": "silver", "semantic_transactions": "gold", "spending_by_category": "gold",
    "cash_flow_monthly": "gold", "disposable_income": "gold", "data_completeness": "gold",
    "quality_alerts": "gold", "transfer_review_queue": "gold", "net_worth_daily": "gold",
}


def schema_describe(lake) -> DataFrame:
    """(layer, table_name, position, column_name, data_type) generated from
    the models' analysed schemas, so it cannot drift from the code."""
    rows = []
    for name, layer in MODEL_LAYERS.items():
        for i, f in enumerate(getattr(lake, name).schema.fields):
            rows.append((layer, name, i + 1, f.name, f.dataType.simpleString()))
    return lake.spark.createDataFrame(
        rows, "layer string, table_name string, position int, column_name string, data_type string")
