"""Every registered query: a Spark builder and, where SQL can express it, the
DuckDB oracle text. Both read the driver tables of one sf directory."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .oracle import models_sql  # noqa: F401  (registers CTEs)
from .oracle.sqlkit import compose
from .plans.context import Lake

QueryFn = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, QueryFn] = {}
_ORACLE: dict[str, str] = {}


# Output boundary: inside the pipeline money is DECIMAL and issue lists are
# arrays; registered results present money as DOUBLE (the reference's type)
# and lists as JSON text, identically on the Spark and the oracle side, so
# any consumer (pandas included) sees the same plain types from both.
DECIMAL_OUTPUTS = frozenset("""
amount running_balance amount_gap price_at_open buy_threshold sell_threshold stop_loss confidence
expected_return_pct spend total_income total_spending net_savings essential_spending disposable_income
total_assets net_worth opening_balance total_deducted total_added closing_balance previous_balance
payments_and_credits purchases_and_other_charges new_installments cash_advances total_interest_charges
fees total_balance minimum_payment_due credit_limit available_credit original_amount
""".split())
JSON_OUTPUTS = frozenset({"validation_issues"})
# Calendar days are presented as midnight TIMESTAMP_NTZ (the reference's
# month columns are TIMESTAMP; the driver tables carry timestamps only).
DATE_OUTPUTS = frozenset("""
as_of_date closed month opened payment_due_date period_end period_start posting_date row_date
snapshot_date start_date statement_date transaction_date txn_date
""".split())


def _present(df: DataFrame) -> DataFrame:
    from pyspark.sql.types import ArrayType, DateType, DecimalType
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, DateType):
            c = c.cast("timestamp_ntz")
        elif isinstance(f.dataType, ArrayType) and f.name in JSON_OUTPUTS:
            c = F.to_json(c)
        cols.append(c.alias(f.name))
    return df.select(*cols)


def _present_sql(body: str, columns: list[str] | None) -> str:
    if not columns:
        return body
    repl = [f"CAST({c} AS DOUBLE) AS {c}" for c in columns if c in DECIMAL_OUTPUTS]
    repl += [f"CAST(to_json({c}) AS VARCHAR) AS {c}" for c in columns if c in JSON_OUTPUTS]
    repl += [f"CAST({c} AS TIMESTAMP) AS {c}" for c in columns if c in DATE_OUTPUTS]
    if not repl:
        return body
    return f"SELECT * REPLACE ({', '.join(repl)}) FROM (\n{body.strip()}\n) presented"


def register(name: str, columns: list[str] | None = None, oracle: str | None = None,
             oracle_deps: tuple[str, ...] = ()):
    """Decorator: ``fn(lake) -> DataFrame``; ``columns`` fixes the output
    order on both sides; ``oracle`` is the SELECT body over the CTEs."""
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            df = fn(Lake(spark, sf_dir))
            return _present(df.select(*columns) if columns else df)
        run.__name__ = f"q_{name}"
        run.__doc__ = fn.__doc__
        _QUERIES[name] = run
        if oracle is not None:
            _ORACLE[name] = compose(_present_sql(oracle, columns), oracle_deps)
        return fn
    return deco


def from_model(name: str, model: str | None = None, columns: list[str] | None = None,
               with_oracle: bool = True):
    """Register a Lake model whose oracle CTE has the same name."""
    model = model or name
    cols = columns
    body = None
    if with_oracle:
        sel = ", ".join(cols) if cols else "*"
        body = f"SELECT {sel} FROM {model}"
    register(name, cols, body, (model,) if with_oracle else ())(lambda lake: getattr(lake, model))


def queries() -> dict[str, QueryFn]:
    _load_all()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load_all()
    return dict(_ORACLE)


_LOADED = False


def _load_all():
    global _LOADED
    if _LOADED:
        return
    _LOADED = True
    from . import queries_enrich, queries_ingest, queries_ledger, queries_quality  # noqa: F401  (they register)


__all__ = ["queries", "oracle_sql", "register", "from_model", "F"]
